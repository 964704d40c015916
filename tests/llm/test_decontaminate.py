"""Passages against a search of every window in every text."""

import random
import re

import pytest
from pyspark.sql import functions as F

from carelayers.llm import decontaminate

SCHEMA = "doc_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, n):
    windows = {}
    for name, text in items:
        ws = words_of(text)
        for i in range(max(1, len(ws) - n + 1) if ws else 0):
            windows.setdefault(tuple(ws[i : i + n]), set()).add(name)
    for key, text in docs:
        ws, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(ws) - size + 1):
                names = windows.get(tuple(ws[i : i + size]))
                if names:
                    hit.update(range(i, i + size))
                    found |= names
        yield key, len(ws), sorted(hit), sorted(str(x) for x in found if x is not None)


def got(spark, docs, items, n, extra=False):
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    if extra:
        for name in ("row", "__text", "number", "spans", "items", "n_words", "block", "name", "whole"):
            df, bench = df.withColumn(name, F.lit("x")), bench.withColumn(name, F.lit("x"))
    out = decontaminate.find_passages(df, bench, window=n).collect()
    for r in out:
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
        yield r.row.doc_id, r.n_words, [i for s in r.spans for i in range(s.start, s.end)], r["items"]


def tables(seed, n_docs, n_items):
    """Few words, so windows overlap, repeat and lie in each other."""
    rng = random.Random(seed)
    bag = ["a", "b", "A", "É", "é", "c1", "日本", "x"]
    glue = [" ", ", ", "\n", "--", "\x00", "_", " "]

    def text(k):
        return "".join(rng.choice(bag) + rng.choice(glue[:-1]) for _ in range(k))

    items = [(rng.choice([None, *range(n_items)]), rng.choice([None, "", "?", text(rng.randint(1, 9)), text(rng.randint(4, 40))])) for _ in range(n_items)]
    docs = [(rng.choice([None, *range(n_docs)]), rng.choice([None, "", "!!", text(rng.randint(0, 12)), text(90)])) for _ in range(n_docs)]
    return docs + docs[:5], items + items[:3]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("piece", [None, 8])
def test_equals_brute_force(spark, seed, piece, monkeypatch):
    """One block, and many blocks of a few pieces each."""
    docs, items = tables(seed, 60, 12)
    if piece:
        monkeypatch.setattr(decontaminate, "PIECE_WORDS", piece)
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    out = sorted(map(str, got(spark, docs, items, 5, extra=seed == 1)))
    assert out == sorted(map(str, brute(docs, items, 5)))


@pytest.mark.parametrize("seed", range(40))
def test_automaton(seed):
    docs, items = tables(seed, 30, 1 + seed % 9)
    n = 1 + seed % 7
    automaton = decontaminate.Automaton([(None if i is None else str(i), decontaminate.words((t or "").encode()), True) for i, t in items], n)
    for (key, text), (_, n_words, hit, names) in zip(docs, brute(docs, items, n)):
        found = decontaminate.words((text or "").encode())
        spans, what = automaton.scan(found)
        assert (len(found), [i for a, b in spans for i in range(a, b)], what) == (n_words, hit, names)


def test_empty_tables(spark):
    assert list(got(spark, [], [(1, "a b")], 10)) == []
    assert list(got(spark, [(1, "a b")], [], 10)) == [(1, 2, [], [])]


def test_a_long_text(spark):
    """A text of megabytes, nearly all of it known words, with one window at its end."""
    item = "one two three four five six seven eight nine ten eleven"
    text = "one two three four five six seven eight nine " * 60_000 + "ten"
    (row,) = got(spark, [(1, text)], [(3, item)], 10)
    assert row == (1, 540_001, list(range(539_991, 540_001)), ["3"])


def test_spans_are_removed(spark):
    item = "alpha beta gamma delta"
    rows = [
        (1, "Keep this. Alpha, beta; GAMMA\ndelta! And (this) too."),
        (2, "alpha beta gamma delta"),
        (3, "nothing here"),
        (4, None),
        (5, "a b c d e f g h alpha beta gamma delta and alpha beta gamma delta"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("text2", F.lit("x"))
    bench = spark.createDataFrame([(9, item)], "item_id bigint, text string")

    def cleaned(**limits):
        out = decontaminate.decontaminate(docs, bench, window=4, **limits)
        assert out.columns == ["doc_id", "text", "text2", "n_spans_removed"]
        return {r.doc_id: (r.text, r.n_spans_removed) for r in out.collect()}

    everything = cleaned()
    assert everything == {
        1: ("Keep this. ! And (this) too.", 1),
        2: ("", 1),
        3: ("nothing here", 0),
        4: (None, 0),
        5: ("a b c d e f g h  and ", 2),
    }
    by_coverage = cleaned(max_words=4, max_coverage=0.5)
    assert by_coverage == {k: (t, 0) for k, t in rows} | {2: ("", 1)}
