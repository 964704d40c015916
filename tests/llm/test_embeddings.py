import numpy as np
import pyarrow as pa

from carelayers.llm import embeddings
from helpers import cosine_links

KIND = "vec_id bigint, embedding array<float>"


def result(df, **how):
    return {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(df, **how).collect()}


def table(spark, ids, vectors, kind=KIND):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, kind)


def planted(n, dims, seed):
    random = np.random.default_rng(seed)
    base = random.normal(size=(n, dims)).astype(np.float32)
    near = base[: n // 4] + 0.3 * random.normal(size=(n // 4, dims)).astype(np.float32)
    exact = np.repeat(base[5:6], n // 3, axis=0)
    return np.concatenate([base, near, exact, base[:9] * np.float32(2.5)])


def test_all_pairs(spark, monkeypatch):
    vectors = planted(300, 24, 1)
    ids = np.random.default_rng(2).permutation(len(vectors)) * 3
    want = cosine_links(ids, vectors.astype(float))
    assert result(table(spark, ids, vectors)) == want
    # Many small tiles, strips and pieces give the same.
    for name, value in (("TILE_ROWS", 40), ("STRIP_ROWS", 7), ("PAIRS", 50), ("AXES", 5)):
        monkeypatch.setattr(embeddings, name, value)
    assert result(table(spark, ids, vectors)) == want


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    want = cosine_links([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float))
    assert result(df) == want
    low = cosine_links([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float), 0.3)
    assert result(df, threshold=0.3) == low


def test_weight_on_few_axes(spark):
    """Ranges of the first axis that are too far apart never meet."""
    random = np.random.default_rng(3)
    vectors = random.normal(size=(400, 8)) * [8, 4, 1, 1, 0.5, 0.1, 0.1, 0.0]
    ids = np.arange(400)
    assert result(table(spark, ids, vectors, "vec_id bigint, embedding array<double>")) == cosine_links(ids, vectors)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, -0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [2.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [1e-300, 0.0]), (12, [-0.0, 1.0]),
        (13, [0.0, 1.0]), (13, [0.0, 1.0]), (13, [1e300, 1e300]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as id", "2 as n", "3 as v")
    found = sorted(map(str, map(tuple, embeddings.near_duplicates(df).collect())))
    want = [
        (1, 2, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
        (8, 2, 1, False), (9, 1, 9, True), (10, 1, 9, False), (None, 0, None, True), (11, 2, 1, False), (12, 2, 12, True),
        (13, 2, 12, False), (13, 2, 12, False), (13, 0, 13, True),
    ]
    assert found == sorted(map(str, want))
    assert embeddings.near_duplicates(df.limit(0)).collect() == []
    assert embeddings.near_duplicates(df.where("vec_id = 2")).count() == 1


def test_tile_pairs_are_not_shuffled(spark, plan):
    """Every two tiles of near zones meet once, and no exchange moves them for it."""
    rows = [(t, t % 4, min(3, t % 4 + 1), bytes([t]), b"", b"") for t in range(24)]
    kind = "tile bigint, zone int, far int, keys binary, sizes binary, cells binary"
    met = embeddings._meetings(spark.createDataFrame(rows, kind).repartition(5).cache())
    text = plan(met)
    assert "CartesianProduct" in text and "Exchange" not in text.split("InMemoryRelation")[0]
    found = [(r.tile_a, r.tile_b, r.keys_a, r.keys_b) for r in met.collect()]
    assert all(x == bytes([a]) and y == bytes([b]) for a, b, x, y in found)
    pairs = sorted(tuple(sorted(p[:2])) for p in found)
    assert pairs == [(a, b) for a in range(24) for b in range(a, 24) if abs(a % 4 - b % 4) <= 1]


def test_a_task_gives_one_row_per_class(spark, monkeypatch):
    """Vectors that all link: rows do not grow with the pairs of tiles."""
    random = np.random.default_rng(4)
    vectors = 1 + 0.01 * random.normal(size=(200, 6))
    tiles = []
    for t in range(10):
        part = vectors[20 * t : 20 * t + 20]
        tiles.append((t, b"".join(embeddings._keys(part)), np.ones(20, "<i8").tobytes(), part.astype("<f8").tobytes()))
    pairs = [(a, b) for a in range(10) for b in range(a, 10)]
    names = ["tile_a", "tile_b", *(f"{c}_{w}" for w in "ab" for c in embeddings._HELD)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array([x]) for x in (a, b, *tiles[a][1:], *tiles[b][1:])], names=names) for a, b in pairs
    ]
    out = list(embeddings._compare(np.eye(6), "<f8", 0.9)(batches))
    assert sum(b.num_rows for b in out) == 200
    assert {x for b in out for x in b["links"].to_pylist()} == {199}
    assert len({x for b in out for x in b["b"].to_pylist()}) == 1
    monkeypatch.setattr(embeddings, "TILE_ROWS", 20)
    df = table(spark, range(200), vectors, "vec_id bigint, embedding array<double>")
    assert result(df) == {k: (199, 0) for k in range(200)}


def test_equal_vectors_of_several_batches_are_one_class(spark):
    """Also where a tile's rows come in several batches, and 0.0 and -0.0 are equal."""
    values = np.array([[1.0, 0.0], [1.0, -0.0], [0.0, 2.0], [3.0, 1.0], [3.0, 1.0]])
    keys = embeddings._keys(values)
    assert keys[0] == keys[1] and keys[3] == keys[4] and len(set(keys)) == 3
    order = sorted([(7, k, n, list(v)) for k, n, v in zip(keys, (1, 2, 3, 4, 5), values)] + [(8, keys[0], 6, [1.0, 0.0])], key=lambda r: r[:2])
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.float64())]

    def batches(size):
        for at in range(0, len(order), size):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*order[at : at + size]), kinds)], names=["place", "key", "n", "v"]
            )

    for size in (1, 2, 3, 9):
        for rows in (1, 2, 9):
            tiles = [t for b in embeddings._tile_of(batches(size), rows, 2) for t in b.to_pylist()]
            held = [
                (t["place"], t["keys"][16 * k : 16 * k + 16], n)
                for t in tiles
                for k, n in enumerate(np.frombuffer(t["sizes"], "<i8").tolist())
            ]
            assert sorted(held) == sorted([(7, keys[0], 3), (7, keys[2], 3), (7, keys[3], 9), (8, keys[0], 6)])
            assert all(len(t["cells"]) == len(t["keys"]) <= 16 * rows for t in tiles)
    hot = table(spark, range(3000), np.repeat([[0.0, 1.0, 2.0]], 3000, axis=0)).repartition(7)
    assert result(hot) == {k: (2999, 0) for k in range(3000)}


def test_place_on_the_axis_is_the_same_in_any_batch():
    random = np.random.default_rng(5)
    for dims in (1, 2, 7, 64, 300):
        values, axis = random.normal(size=(500, dims)).astype(np.float32), random.normal(size=dims)
        whole = embeddings._lead(values, axis)
        for size in (1, 2, 3, 17, 250):
            parts = [embeddings._lead(values[k : k + size], axis) for k in range(0, 500, size)]
            assert np.array_equal(np.concatenate(parts), whole)
