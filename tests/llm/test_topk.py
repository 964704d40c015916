import numpy as np

from carelayers.llm import topk


def brute(ids, vectors, k=5, every=50):
    v = np.floor(256 * vectors.astype(np.float64)).astype(np.int64)
    out = set()
    for i in np.flatnonzero(ids % every == 0):
        scores = v @ v[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:k]
        out |= {(int(ids[i]), r + 1, int(ids[j]), int(scores[j])) for r, j in enumerate(order)}
    return out


def result(df, **how):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(df, **how).collect()}


def table(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def test_scores_by_bitmaps():
    random = np.random.default_rng(1)
    for low, high in ((-300, 300), (0, 5), (-7, -3), (-(2**20), 2**20), (0, 1)):
        values, queries = random.integers(low, high, (150, 7)), random.integers(low, high, (5, 7))
        slices = topk.Index(values).scores(queries, slice(None))
        bits = [np.unpackbits(s.view(np.uint8), axis=1, bitorder="little")[:, :150].astype(np.int64) for s in slices]
        got = sum((-b if i == len(bits) - 1 else b) << i for i, b in enumerate(bits))
        assert np.array_equal(got, queries @ values.T)


def test_same_as_all_products(spark, monkeypatch):
    random = np.random.default_rng(2)
    ids = random.permutation(1200)
    vectors = random.normal(size=(1200, 10)).astype(np.float32)
    vectors[ids % 7 == 0] = vectors[0]  # many ties
    want = brute(ids, vectors)
    assert result(table(spark, ids, vectors)) == want
    for name, value in (("BLOCK_ROWS", 130), ("BLOCK_QUERIES", 5), ("BLOCKS_A_TASK", 2), ("_WORKING_BYTES", 64)):
        monkeypatch.setattr(topk, name, value)
    assert result(table(spark, ids, vectors)) == want
    assert result(table(spark, ids, vectors), k=40, every=100) == brute(ids, vectors, 40, 100)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.5]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]), (250, []), (1, [1.0, 0.0]),
        (2, [1.0, 0.0]), (None, [1.0, 1.0]), (300, [1.0, 0.0, 0.0]), (0, [0.75, 0.0]), (-50, [0.0, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as v", "2 as dims", "3 as block")
    # Both rows with id 0 ask and answer, also each other; vectors of another length do not meet.
    assert result(df) == {
        (0, 1, 1, 128 * 256), (0, 2, 2, 128 * 256), (0, 3, 0, 128 * 192), (0, 4, -50, 0),
        (0, 1, 1, 192 * 256), (0, 2, 2, 192 * 256),
        (-50, 1, 0, 0), (-50, 2, 0, 0), (-50, 3, 1, 0), (-50, 4, 2, 0),
    }
    assert result(df.limit(0)) == set()
    assert result(df.where("vec_id = 0")) == {(0, 1, 0, 128 * 192)}
    assert result(df.where("vec_id = -50")) == set()
