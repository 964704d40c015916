"""Proofs against a brute-force tree that shares no code with the operator."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from carelayers.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, lower=False):
    doc_id, text, lang, source, n_chars = row
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    out = ""
    for value in (doc_id, source, lang, n_chars, text):
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return digest(out)


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def path_of(levels, place):
    for level in levels[:-1]:
        first = place // 8 * 8
        yield "".join(level[first:place]), "".join(level[place + 1 : first + 8])
        place //= 8


def brute(rows):
    trees = defaultdict(list)
    for row in rows:
        odd = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        trees[row[2]].append((row[0] is None, row[0] or 0, leaf_of(row), leaf_of(row, odd)))
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {t: levels_of([x[2] for x in sorted(trees[t])]) for t in order}
    top = levels_of([built[t][-1][0] for t in order])
    for n, t in enumerate(order):
        for place, (no_id, key, leaf, shown) in enumerate(sorted(trees[t])):
            path = [*path_of(built[t], place), *path_of(top, n)]
            node = shown
            for left, right in path:
                node = digest(left + node + right)
            proof = digest("".join(left + right for left, right in path))
            yield None if no_id else key, leaf, built[t][-1][0], top[-1][0], proof, node, node == top[-1][0]


def found(spark, rows, folder, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for name in ("tree", "key", "leaf", "place", "n", "digest", "children", "height", "path"):
            df = df.withColumn(name, F.lit("x"))
    out = merkle.verified_documents(df, folder)
    assert out.columns == NAMES
    return sorted(map(str, map(tuple, out.collect())))


def sample(n, langs, seed):
    rng = random.Random(seed)
    words = ["Ab", "cd", "Été", "", "x\ny", "Z"]
    return [
        (
            rng.choice([None, *range(n)]),
            rng.choice([None, "", " ".join(rng.choices(words, k=rng.randint(1, 9)))]),
            rng.choice(langs),
            rng.choice([None, "s", "a:b"]),
            rng.choice([None, 0, 12]),
        )
        for _ in range(n)
    ]


CASES = {
    "one tree": lambda: sample(200, ["en"], 1),
    "many small trees": lambda: sample(150, [None, "", "=", *(f"l{i}" for i in range(70))], 2),
    "hot tree": lambda: sample(700, [*["en"] * 20, None, "de", "é"], 3),
    "one row": lambda: [(5, "Only", "en", "s", 4)],
    "two lone trees": lambda: [(5, "A", "en", "s", 1), (5, "A", None, "s", 1)],
    "runs of eight": lambda: [(i, "T", "en", "s", 1) for i in range(65)],
    "repeated rows": lambda: [(7, "Same text", "en", "s", 9)] * 130 + [(7, "Other", "en", "s", 5)] * 3,
    "only nulls": lambda: [(None, None, None, None, None)] * 9,
    "long text": lambda: [(1, "Long text " * 300_000, "en", "s", None), (2, "b", "en", "s", 1)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_equals_brute_force(spark, tmp_path, case):
    rows = CASES[case]()
    assert found(spark, rows, str(tmp_path / "m"), extra=case == "hot tree") == sorted(map(str, brute(rows)))


def test_no_rows(spark, tmp_path):
    assert found(spark, [], str(tmp_path / "m")) == []


def test_a_few_requests(spark, tmp_path):
    """Only the leaves asked for, with the same proofs."""
    rows = [(i, f"T{i}", "en" if i % 7 else None, "s", 1) for i in range(300)]
    items = merkle.document_items(spark.createDataFrame(rows, SCHEMA))
    manifest = merkle.write_manifest(items, str(tmp_path / "m"))
    asked = spark.createDataFrame([("=en", 0), ("=en", 77), ("=en", 78), ("", 3), ("", 3), ("=no", 1)], "tree string, place long")
    proof = merkle.proof_digest(F.col("segments")).alias("proof")
    few = merkle.proofs(manifest, spark, asked).select("tree", "place", "key", proof).collect()
    every = {(r.tree, r.place): r for r in merkle.proofs(manifest, spark).select("tree", "place", "key", proof).collect()}
    assert len(every) == 300
    assert sorted((r.tree, r.place) for r in few) == [("", 3), ("=en", 0), ("=en", 77), ("=en", 78)]
    assert all(r == every[(r.tree, r.place)] for r in few)


def test_records_are_found_by_digest(spark, tmp_path):
    """Equal nodes of a tree share a record, and each record's digest is that of its children."""
    rows = [(1, "same", "en", "s", 4)] * 64
    manifest = merkle.write_manifest(merkle.document_items(spark.createDataFrame(rows, SCHEMA)), str(tmp_path / "m"))
    records = merkle._records(spark, f"{manifest.folder}/records", 1).collect()
    assert len(records) == 1 and digest("".join(records[0].children)) == records[0].digest
