"""Phrases against counts of every phrase of every piece."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelayers.llm import phrases

SCHEMA = "doc_id bigint, text string, lang string"
NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lists(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(rows, least, top, longest=5):
    counts, n = {}, Counter()
    for _, text, lang in rows:
        lang = lang or ("und" if lang is None else lang)
        for ws in lists(text):
            n[lang] += len(ws)
            for size in range(1, longest + 1):
                held = counts.setdefault(lang, Counter())
                held.update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    for lang, held in counts.items():
        out = []
        frequent = {p: f for p, f in held.items() if f >= least}
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            longer = (q for q, f in frequent.items() if len(q) > len(p) and f >= a)
            if any(q[i : i + len(p)] == p for q in longer for i in range(len(q))):
                continue
            cuts = [(1000 * a * n[lang] // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(out)[:top], 1):
            yield lang, rank, p.decode(), -a, left, right, n[lang], -score


def found(spark, rows, least, top, extra=False, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    if extra:
        for name in ("chunk", "ids", "words", "n", "a", "phrase", "id", "less", "place", "total", "group", "rank"):
            df = df.withColumn(name, F.lit("x"))
    out = phrases.collocations(df, min_count=least, top=top, **options)
    assert out.columns == NAMES
    return sorted(map(tuple, out.collect()))


def table(seed, n, words):
    """A few words and phrases repeated often, with all kinds of breaks and blanks; a hot language."""
    rng = random.Random(seed)
    bag = [f"w{i}" for i in range(words)] + ["É", "é", "A", "a\x00b", "x y", "日本"]
    weights = [1 / (i + 1) for i in range(len(bag))]
    passages = ["new york city", "the the the the the the", "A b C d E f"]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\r\n", " \x0b", "!?"]

    def text():
        some = rng.choices(bag, weights, k=rng.randint(1, 60)) + rng.choices(passages, k=rng.randint(0, 4))
        rng.shuffle(some)
        return "".join(w + rng.choice(gaps) for w in some)

    langs = ["en"] * 6 + [None, "und", "de", ""]
    rows = [(i, rng.choice([None, "", " . ", *[text() for _ in range(5)]]), rng.choice(langs)) for i in range(n)]
    return rows + rows[: n // 9]


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    """With a chunk a task and ids sent to all; with many chunks and ids joined."""
    rows = table(seed, 250, 20)
    more = {"extra": True, "chunk_words": 200, "broadcast_rows": 0} if seed else {}
    assert found(spark, rows, 7, 25, **more) == sorted(brute(rows, 7, 25))


def test_chunks_hold_all_words():
    """Breaks inside long texts, and pieces longer than a slice, are cut without a loss."""
    data = b"a b\nc" * 50 + b"d" * 100 + b"\n" + b"e f " * 40
    old, phrases.SLICE_BYTES = phrases.SLICE_BYTES, 16
    try:
        slices = list(phrases._slices(data))
    finally:
        phrases.SLICE_BYTES = old
    assert b"\n".join(slices) == data and len(slices) > 10


@pytest.mark.parametrize("dense", [1, 50, 10**9])
@pytest.mark.parametrize("tile", [2, 16, 1024])
def test_pair_counts(dense, tile, monkeypatch):
    """Dense tiles, sparse ones, and both."""
    monkeypatch.setattr(phrases, "DENSE", dense)
    monkeypatch.setattr(phrases, "TILE", tile)
    rng = np.random.default_rng(dense + tile)
    ids = np.minimum(rng.geometric(0.05, 4000), 70).astype(np.int32) - 2
    expected = Counter((int(a), int(b)) for a, b in zip(ids, ids[1:]) if a >= 0 and b >= 0)
    got = Counter()
    for a, b, n in phrases.pair_counts(ids):
        for x, y, k in zip(a.tolist(), b.tolist(), n.tolist()):
            assert (x, y) not in got
            got[x, y] = k
    assert got == expected


def test_tight():
    ids = np.array([-1, 3, -1, -1, 1, 2, -1, 5, -1, 4, 4, 4], np.int32)
    assert phrases._tight(ids).tolist() == [1, 2, -1, 4, 4, 4]
    assert phrases._tight(np.array([-1, 7], np.int32)).tolist() == []


def test_scores_beyond_64_bits(spark):
    """1000 * a * n is far over 2 ** 63."""
    n, a, left, right = 9 * 10**14, 8 * 10**12, 10**13 + 1, 9 * 10**12 + 7
    every = spark.createDataFrame(
        [("en", "x", left, 1), ("en", "y", right, 1), ("en", "x y", a, 2)], "lang string, phrase string, n long, size int"
    )
    totals = spark.createDataFrame([("en", n)], "lang string, total long")
    (row,) = phrases._scored(every, totals).collect()
    assert (row.l, row.r, row.score) == (left, right, 1000 * a * n // (left * right))


def test_no_rows_and_no_words(spark):
    assert found(spark, [], 1, 5) == []
    assert found(spark, [(1, None, "en"), (2, ".", None), (3, "one", "en")], 1, 5) == []


def test_a_long_piece(spark):
    """One piece of megabytes, all one phrase that overlaps itself."""
    rows = [(1, "ab " * 700_000, "en"), (2, "ab", "en")]
    assert found(spark, rows, 100, 3) == sorted(brute(rows, 100, 3))
