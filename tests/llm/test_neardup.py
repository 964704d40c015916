import numpy as np

from carelayers.llm import graph, neardup
from helpers import document_table, joined, near_duplicates, shingle_sets


def words(random, n):
    return [f"w{x}" for x in random.integers(0, 5000, n)]


def edited(random, text, n):
    out = list(text)
    for at in random.integers(0, len(out), n):
        out[at] = f"e{random.integers(0, 10**6)}"
    return out


def result(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs).collect()}


def test_shingles_are_the_sets_of_words():
    texts = ["", "  \n", "One", "one two THREE four", "a b c d e", "A b\tc\nd\x0be f \x0cg", "x " * 40, "é É a b c d", "a b c d e f", "y" * 500 + " 1 2 3 4"]
    hashes, bounds = neardup.shingles(texts)
    sets = shingle_sets(enumerate(texts))
    assert np.diff(bounds).tolist() == [len(sets[i]) for i in range(len(texts))]
    again, cuts = neardup.shingles(texts[::-1])
    assert all(
        np.array_equal(hashes[bounds[i] : bounds[i + 1]], again[cuts[len(texts) - 1 - i] : cuts[len(texts) - i]])
        for i in range(len(texts))
    )


def test_registers_merge_and_estimate():
    random = np.random.default_rng(3)
    items = random.integers(0, 2**64, 4000, dtype=np.uint64)
    a, b = np.sort(items[:3000]), np.sort(items[1000:])
    both = np.sort(items)
    held = np.concatenate([a, b, both])
    s = neardup.sketches(held, np.cumsum([0, len(a), len(b), len(both)]))
    assert np.array_equal(np.maximum(s[0], s[1]), s[2])
    similarity = neardup.likeliest(s[:1], s[1:2], np.array([3000.0]), np.array([3000.0]))[0]
    assert abs(similarity - 0.5) < 0.1
    assert neardup.likeliest(s[:1], s[:1], np.array([3000.0]), np.array([3000.0]))[0] > 0.99


def test_registers_do_not_depend_on_the_limit():
    """A set in a batch with others, and one whose first limit leaves registers empty."""
    random = np.random.default_rng(4)
    sets = [np.sort(random.integers(0, 2**64, n, dtype=np.uint64)) for n in (1, 2, 5, 300, 1) for _ in range(8)]
    together = neardup.sketches(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))
    for i, s in enumerate(sets):
        assert np.array_equal(together[i], neardup.sketches(s, np.array([0, len(s)]))[0])
    assert (together.min(axis=1) > 0).all()


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = near_duplicates([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert result(docs) == want


def test_groups_chains_and_borders(spark):
    random = np.random.default_rng(5)
    rows, n = [], 0

    def add(text):
        nonlocal n
        rows.append((n * 7 % 1009, " ".join(text), None, None))
        n += 1

    for size, edits in ((150, 5), (400, 16), (60, 2), (300, 11)):  # about at the threshold
        base = words(random, size)
        for _ in range(60):
            add(edited(random, base, edits))
    chain = words(random, 200)
    for _ in range(40):  # each like the one before, the last unlike the first
        add(chain)
        chain = edited(random, chain, 2)
    passage = words(random, 80)
    for _ in range(120):  # share a passage only
        add(words(random, 60) + passage)
    for _ in range(50):
        add(words(random, 100))
    docs = document_table(spark, rows)
    assert result(docs) == near_duplicates([r[:2] for r in rows])


def test_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    random = np.random.default_rng(6)
    base = words(random, 120)
    rows = [(i, " ".join(edited(random, base, 5)), None, None) for i in range(80)]
    assert result(document_table(spark, rows)) == near_duplicates([r[:2] for r in rows])


def test_odd_rows(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [
        (1, None, None, None), (2, "", None, None), (3, " \n\t", None, None), (4, "one two", None, None),
        (5, "ONE  two", None, None), (6, "one two three", None, None), (7, long, None, None), (8, long + " x", None, None),
    ]
    want = near_duplicates([r[:2] for r in rows])
    assert result(document_table(spark, rows, True)) == want
    assert (want[5][1], want[8][1]) == (4, 7)
    no_id = document_table(spark, [(None, "one two", None, None), (9, "one two", None, None), (9, "one two", None, None)])
    found = sorted(map(str, map(tuple, neardup.near_duplicates(no_id).collect())))
    assert found == sorted(map(str, [(None, 1, None, True), (9, 1, 9, True), (9, 1, 9, True)]))
    empty = document_table(spark, [], True)
    kept = neardup.first_of_each(empty)
    assert kept.collect() == [] and kept.columns == empty.columns


def test_components(spark):
    random = np.random.default_rng(7)
    pairs = [(int(a), int(b)) for a, b in random.integers(0, 300, (150, 2))]
    pairs += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(1, 80)] + [(5, 5)]
    links = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r.node: r.component for r in graph.components(links).collect()}
    nodes = {x for p in pairs if p[0] != p[1] for x in p}
    assert found == joined(nodes, [p for p in pairs if p[0] != p[1]])
    by_rounds = {r.node: r.component for r in graph.components(links.repartition(4), one_task=0).collect()}
    assert by_rounds == found
    assert graph.components(links.limit(0)).collect() == []


def test_a_repeated_id_is_compared_by_each_text(spark):
    """9 has two texts; 10 and 11 are near one of them each, and so all three hang together."""
    random = np.random.default_rng(8)
    one, two = words(random, 90), words(random, 40)
    rows = [(9, " ".join(one), None, None), (9, " ".join(two), None, None), (10, " ".join(two) + " tail", None, None)]
    rows += [(11, " ".join(one) + " end", None, None), (12, " ".join(words(random, 50)), None, None)]
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(document_table(spark, rows)).collect())
    assert found == [(9, 36, 9), (9, 86, 9), (10, 37, 9), (11, 87, 9), (12, 46, 12)]


def test_strangers_meet_the_main_component_only_once(spark):
    """A bucket of 5000 rows of one component and 7 strangers makes no blocks of the component with itself."""
    rows = [("bucket", i if i < 7 else 100, f"c{i}") for i in range(5007)]
    parts = spark.createDataFrame(rows, "band string, component long, u string")
    met = neardup._blocked(parts).collect()
    assert sum(r.main for r in met) == 5000  # each row of the component once
    assert sum(not r.main for r in met) == 7 * (3 + 1)  # with three blocks of it, and with each other
    groups = {}
    for r in met:
        groups.setdefault((r.i, r.j), []).append(r)
    compared = sum(
        sum(not r.main for r in g) * sum(r.main for r in g) if i >= 0 else len(g) * (len(g) - 1) // 2
        for (i, _), g in groups.items()
    )
    assert compared == 7 * 5000 + 7 * 6 // 2


def test_all_pairs_of_different_components_meet(spark, monkeypatch):
    """Small blocks: every pair of components meets in one group, pairs of the main one in none."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rows = [("bucket", 1 if i < 20 else 2 if i < 31 else i, f"c{i}") for i in range(45)]
    met = neardup._blocked(spark.createDataFrame(rows, "band string, component long, u string")).collect()
    seen = {}
    for x in met:
        for y in met:
            if (x.i, x.j) == (y.i, y.j) and x.u < y.u and x.component != y.component:
                whole = x.main != y.main if x.i >= 0 else x.i == x.j or x.block != y.block
                seen[x.u, y.u] = seen.get((x.u, y.u), 0) + whole
    expected = {tuple(sorted((a[2], b[2]))) for a in rows for b in rows if a[1] != b[1]}
    assert {p for p, n in seen.items() if n == 1} == expected and max(seen.values()) == 1
