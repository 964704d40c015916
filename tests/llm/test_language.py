import numpy as np
import pandas as pd

from carelayers.llm import language
from helpers import document_table


def exact_bits(text: bytes, counts: dict[bytes, int]) -> float:
    """Code length by the definition: escapes along shrinking contexts, with exclusion."""
    tables = [{} for _ in range(4)]
    for gram, n in counts.items():
        for k in range(4):
            context, symbol = gram[3 - k : 3], gram[3]
            node = tables[k].setdefault(context, {})
            node[symbol] = node.get(symbol, 0) + n
    total, data = 0.0, b"\n\n\n" + text
    for i in range(3, len(data)):
        symbol, out = data[i], set()
        for k in (3, 2, 1, 0):
            node = tables[k].get(data[i - k : i])
            if node is None:
                continue
            kinds = len(node)
            space = sum(n for s, n in node.items() if s not in out) + kinds
            if symbol in node:
                total -= np.log2(node[symbol] / space)
                break
            total -= np.log2(kinds / space)
            out = set(node)
        else:
            total += np.log2(256 - len(out))
    return total


def test_code_lengths_are_exact():
    learned = {"a": b"the cat sat on the mat and the rat", "b": b"der hund und die katze und der baum"}
    counts = {}
    rows = []
    for name, text in learned.items():
        data = b"\n\n\n" + text
        grams = [data[i : i + 4] for i in range(len(data) - 3)]
        counts[name] = {g: grams.count(g) for g in grams}
        rows += [(name, int.from_bytes(g, "big"), n) for g, n in counts[name].items()]
    model = language.model_of(pd.DataFrame(rows, columns=["lang", "code", "n"]))
    texts = [b"", b"t", b"the hund", "日本 zebra".encode(), b"and der the rat" * 9]
    got = model.code_lengths(texts)
    want = [[exact_bits(t, counts[name]) for name in model.languages] for t in texts]
    assert np.allclose(got, want)
    assert model.predict([b"the cat and the mat", b"der hund und die katze"])[0] == ["a", "b"]


def test_windows_do_not_change_code_lengths(monkeypatch):
    data = b"\n\n\nsome words and other words"
    rows = [("x", int.from_bytes(data[i : i + 4], "big"), 1) for i in range(len(data) - 3)]
    model = language.model_of(pd.DataFrame(rows, columns=["lang", "code", "n"]).groupby(["lang", "code"], as_index=False).sum())
    texts = [b"some", b"", b"other words and more" * 20, b"x"]
    whole = model.code_lengths(texts)
    monkeypatch.setattr(language, "_STEP", 7)
    assert np.allclose(model.code_lengths(texts), whole)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(docs.where(~language.held_out()))
    found = language.identify(docs, model).where(language.held_out()).select("lang", "lang_pred").collect()
    assert len(found) > 200
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98


def test_prediction_depends_on_text_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs)
    first = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}
    hidden = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "'x' as source").repartition(5)
    second = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(hidden, model).collect()}
    assert {k: v[0] for k, v in first.items()} == {k: v[0] for k, v in second.items()}


def test_odd_rows(spark, sf_dir):
    model = language.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = [
        (1, None, "en", None), (2, "", "en", None), (3, "123 !!", "en", None), (4, "the and of the", None, "s"),
        (4, "the and of the", None, "s"), (None, "the and of", None, None), (5, "the of and " * 50_000, None, None),
        (6, "日本語", None, None),
    ]
    for extra in (False, True):
        out = language.identify(document_table(spark, rows, extra), model)
        assert out.columns.count("lang_pred") == out.columns.count("score") == 1
        found = sorted((r.doc_id or 0, r.lang_pred, r.score) for r in out.collect())
        assert len(found) == len(rows)
        assert [f[1] for f in found if f[0] in (1, 2, 3)] == ["und"] * 3
        assert all(0 <= f[2] <= 1 for f in found)
        assert all(f[1] != "und" for f in found if f[0] not in (1, 2, 3))
        assert {f[1] for f in found if f[0] in (0, 4, 5)} == {"en"}


def test_nothing_to_learn_from(spark):
    rows = [(1, "some words", None, None), (2, None, "en", None), (None, "some words", "en", None)]
    model = language.train(document_table(spark, rows))
    assert model.languages == []
    out = language.identify(document_table(spark, rows), model).collect()
    assert {(r.lang_pred, r.score) for r in out} == {("und", 0.0)}
    assert language.identify(document_table(spark, []), model).collect() == []


def test_bounds_hold(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.train(docs, max_docs=2, max_grams=500, max_languages=3)
    assert len(model.languages) == 3 and all(len(t.orders[3].grams) <= 500 for t in model.trees)


def test_every_label_gets_a_tree(spark, monkeypatch):
    """More labels than fit one block, all predicted; blocks give what one model of all gives."""
    random = np.random.default_rng(3)
    words = [["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)] for _ in range(70)]
    rows = [(100 * i + j, " ".join(random.permutation(w)), f"l{i:02}", None) for i, w in enumerate(words) for j in range(3)]
    # Equal texts under a label of another block: the first by name wins.
    rows += [(9000 + j, rows[j][1], "zz", None) for j in range(3)]
    docs = document_table(spark, rows)
    model = language.train(docs)
    assert isinstance(model, language.Blocks) and len(model.parts) == 5
    assert model.languages == [f"l{i:02}" for i in range(70)] + ["zz"]

    def found(model):
        return {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, model).collect()}

    got = found(model)
    assert {k: v[0] for k, v in got.items()} == {r[0]: "l00" if r[2] == "zz" else r[2] for r in rows}
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 1000)
    one = language.train(docs)
    assert isinstance(one, language.Model)
    want = found(one)
    assert {k: v[0] for k, v in want.items()} == {k: v[0] for k, v in got.items()}
    assert np.allclose([want[k][1] for k in sorted(want)], [got[k][1] for k in sorted(want)])


def test_a_bound_on_labels_counts_all_rows(spark):
    rows = [(i, "some words", "a" if i == 0 else "z", None) for i in range(4)]
    assert language.train(document_table(spark, rows), max_docs=1, max_languages=1).languages == ["z"]


def test_texts_that_are_scored_at_once_take_little_memory():
    """Every core has a worker, so what one step holds counts as often as there are cores."""
    import tracemalloc

    text = bytes(range(97, 123)) * 40_000
    codes, n = np.unique(language.gram_codes(np.frombuffer(text, dtype=np.uint8)), return_counts=True)
    model = language.model_of(pd.DataFrame({"lang": "x", "code": codes.astype(np.int64), "n": n}))
    model.code_lengths([b"abc"])
    tracemalloc.start()
    model.code_lengths([text[i : i + 1000] for i in range(0, len(text), 1000)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 28 << 20 and language._SCORED_BYTES <= len(text) + (1 << 20)
