"""Near-duplicate vectors by comparing tiles along principal axes.

Vectors are scaled to length one and turned so that their leading axes hold most of their weight. A
pair's product over the leading axes plus the product of the lengths of the rest can never be below
its cosine; a pair whose bound cannot reach the threshold is left without its other axes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.llm.graph import components
from carelayers.sources.layers import shared_folder, shuffles_dropped

THRESHOLD = 0.9
#: Rows of a tile, and rows of one tile that meet all rows of the other at once.
TILE_ROWS = 4096
STRIP_ROWS = 256
#: Pairs whose further axes are added at once.
PAIRS = 1 << 16
#: Axes that are added between two looks at the bound.
AXES = 16
#: Ranges of the first axis; tiles of ranges too far apart never meet.
RANGES = 32
#: Bytes of the digest that stands for a vector.
KEY_BYTES = 16
#: Rows of results that a task gives at once.
ROWS_OUT = 1 << 16
#: What turning may add to or take from a product by rounding.
ROUNDING = 1e-9


def _usable(vector: str) -> Column:
    x = F.col(vector)
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    return x.isNotNull() & (F.size(x) > 0) & finite & F.exists(x, lambda c: c != 0)


def _values(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims)


def _keys(values: np.ndarray) -> list[bytes]:
    """Digests of the vectors: those of equal vectors are equal, also of 0.0 and -0.0."""
    held, width = (values + values.dtype.type(0)).tobytes(), values.shape[1] * values.itemsize
    return [blake2b(held[k : k + width], digest_size=KEY_BYTES).digest() for k in range(0, len(held), width)]


def _distinct(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first of equal keys, and how many there are of each."""
    return np.unique(np.array(keys, dtype=f"S{KEY_BYTES}"), return_index=True, return_counts=True)[1:]


def _moments(dims: int):
    """Sum of the outer products of a partition's unit vectors, as one row; equal ones of a batch count once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            values = _values(batch.column(0), dims)
            units = _units(values[_distinct(_keys(values))[0]])[0]
            total += units.T @ units
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], names=["m"])

    return run


def _units(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length one, and the vectors times a power of two that keeps products in range."""
    values = values.astype(np.float64)
    scaled = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1, keepdims=True))[1])
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True)), scaled


def principal_axes(vectors: DataFrame, dims: int) -> np.ndarray:
    """The axes of ``dims`` dimensions by falling weight, as columns.

    Every partition gives one matrix of ``dims * dims`` numbers, which are added up by position, so
    the driver gets one matrix.
    """
    parts = vectors.select("v").mapInArrow(_moments(dims), "m array<double>")
    summed = parts.select(F.posexplode("m").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    matrix = np.zeros(dims * dims)
    for row in summed.collect():
        matrix[row["at"]] = row["x"]
    return np.linalg.eigh(matrix.reshape(dims, dims))[1][:, ::-1].copy()


def _pairs(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float):
    """Positions of all pairs between the tiles whose cosine reaches the threshold."""
    dims = a.shape[1]
    least = threshold - ROUNDING
    cuts = [*range(AXES, dims, AXES), dims]
    rest_a = [np.sqrt((a[:, c:] ** 2).sum(axis=1)) for c in cuts]
    rest_b = [np.sqrt((b[:, c:] ** 2).sum(axis=1)) for c in cuts]
    for start in range(0, len(a), STRIP_ROWS):
        strip = slice(start, start + STRIP_ROWS)
        lead = a[strip, : cuts[0]] @ b[:, : cuts[0]].T
        all_i, all_j = np.nonzero(lead + np.outer(rest_a[0][strip], rest_b[0]) >= least)
        for at in range(0, len(all_i), PAIRS):
            i, j = all_i[at : at + PAIRS], all_j[at : at + PAIRS]
            so_far, i = lead[i, j], i + start
            for before, c, ra, rb in zip(cuts[:-1], cuts[1:], rest_a[1:], rest_b[1:]):
                so_far = so_far + np.einsum("ij,ij->i", a[i, before:c], b[j, before:c])
                go = so_far + ra[i] * rb[j] >= least
                i, j, so_far = i[go], j[go], so_far[go]
            x, y = raw_a[i], raw_b[j]
            cosine = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
            sure = cosine >= threshold
            yield i[sure], j[sure]


def _roots(n: int, pairs: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that links of ``pairs`` join it with."""
    root = np.arange(n)
    for a, b in pairs:
        while len(a):
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            apart = low < high
            if not apart.any():
                break
            np.minimum.at(root, high[apart], low[apart])
            while not np.array_equal(root, shorter := root[root]):
                root = shorter
            a, b = a[apart], b[apart]
    return root


def _lead(values: np.ndarray, axis: np.ndarray) -> np.ndarray:
    """Places along the axis, each from its own row alone: the same for equal vectors in any batch."""
    return (_units(values)[0] * axis).sum(axis=1)


def _led(axis: np.ndarray):
    """``(id, key, lead)`` of every vector."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _values(batch.column(1), len(axis))
            columns = [batch.column(0), pa.array(_keys(values), pa.binary()), pa.array(_lead(values, axis))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "key", "lead"])

    return run


def _combined(axis: np.ndarray):
    """``(key, n, v, lead)``: equal vectors of a batch as one row, so a very common one is no hot key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _values(batch.column(0), len(axis))
            keys = _keys(values)
            at, n = _distinct(keys)
            columns = [pa.array([keys[k] for k in at], pa.binary()), pa.array(n.astype(np.int64))]
            columns += [batch.column(0).take(pa.array(at)), pa.array(_lead(values[at], axis))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "v", "lead"])

    return run


_HELD = ("keys", "sizes", "cells")
_TILE = "place bigint, keys binary, sizes binary, cells binary"
_FOUND = "a binary, b binary, links bigint"


def _tile_of(batches: Iterable[pa.RecordBatch], rows: int, dims: int) -> Iterator[pa.RecordBatch]:
    """Tiles of at most ``rows`` classes, a new one where the group of the sorted rows changes.

    Rows are sorted by group and key; those of one key become one class with the sum of their sizes.
    """
    group, last, held = None, None, []

    def tile() -> pa.RecordBatch:
        row = [group, *(np.concatenate([h[k] for h in held]).tobytes() for k in range(3))]
        return pa.RecordBatch.from_arrays([pa.array([c]) for c in row], names=["place", *_HELD])

    for batch in batches:
        if not batch.num_rows:
            continue
        places, sizes = batch.column(0).to_numpy(), batch.column(2).to_numpy()
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint8).reshape(-1, KEY_BYTES)
        cells = _values(batch.column(3), dims)
        new = np.ones(len(places), dtype=bool)
        new[1:] = (places[1:] != places[:-1]) | (keys[1:] != keys[:-1]).any(axis=1)
        new[0] = last != (places[0], keys[0].tobytes())
        last = places[-1], keys[-1].tobytes()
        first = np.flatnonzero(new)
        more = first[0] if len(first) else len(places)
        if more:  # of the class that the batch before ended with
            held[-1][1][-1] += sizes[:more].sum()
        if not len(first):
            continue
        places, keys, cells, sizes = places[first], keys[first], cells[first], np.add.reduceat(sizes, first)
        at = 0
        while at < len(places):
            if held and (places[at] != group or sum(len(h[1]) for h in held) == rows):
                yield tile()
                held = []
            group = int(places[at])
            same = int(np.argmax(places[at:] != group)) or len(places) - at
            n = min(same, rows - sum(len(h[1]) for h in held))
            held.append((keys[at : at + n], sizes[at : at + n].astype("<i8"), cells[at : at + n]))
            at += n
    if held:
        yield tile()


class _Met:
    """The classes of the tiles that a task has met, their links and what they hang together with."""

    def __init__(self) -> None:
        self.first: dict[int, int] = {}
        self.keys: list[bytes] = []
        self.links = np.zeros(0, np.int64)
        self.root = np.zeros(0, np.int64)

    def places(self, tile: int, keys: bytes) -> np.ndarray:
        """Where the classes of a tile are, in order."""
        n = len(keys) // KEY_BYTES
        if tile not in self.first:
            at = self.first[tile] = len(self.root)
            self.keys.append(keys)
            self.links = np.concatenate([self.links, np.zeros(n, np.int64)])
            self.root = np.concatenate([self.root, np.arange(at, at + n)])
        return np.arange(self.first[tile], self.first[tile] + n)

    def add(self, at: np.ndarray, links: np.ndarray, root: np.ndarray) -> None:
        """Links of the classes at these places, and for each the position among them of one it hangs together with."""
        self.links[at] += links
        joined = np.flatnonzero(root != np.arange(len(root)))
        if len(joined):
            found = self.root[at[joined]], self.root[at[root[joined]]]
            self.root = _roots(len(self.root), [found])[self.root]

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row for each class that has a link: the end of its chain, and how many."""
        keys, some = b"".join(self.keys), np.flatnonzero(self.links)
        for start in range(0, len(some), ROWS_OUT):
            part = some[start : start + ROWS_OUT]
            ends = ([keys[k * KEY_BYTES : (k + 1) * KEY_BYTES] for k in ks] for ks in (part, self.root[part]))
            columns = [*(pa.array(x, pa.binary()) for x in ends), pa.array(self.links[part])]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "links"])


def _compare(axes: np.ndarray, dtype: str, threshold: float):
    dims = len(axes)

    def read(batch: pa.RecordBatch, i: int, first: int):
        keys, sizes, cells = (batch.column(first + k)[i].as_py() for k in range(3))
        units, raw = _units(np.frombuffer(cells, dtype=dtype).reshape(-1, dims))
        return keys, np.frombuffer(sizes, dtype="<i8"), units @ axes, raw

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = _Met()
        for batch in batches:
            for row in range(batch.num_rows):
                tile_a, tile_b = (batch.column(k)[row].as_py() for k in range(2))
                same = tile_a == tile_b
                keys_a, sizes_a, a, raw_a = read(batch, row, 2)
                keys_b, sizes_b, b, raw_b = (keys_a, sizes_a, a, raw_a) if same else read(batch, row, 5)
                links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                shift = 0 if same else len(a)
                root = np.arange(shift + len(b))
                for i, j in _pairs(a, b, raw_a, raw_b, threshold):
                    if same:
                        i, j = i[i < j], j[i < j]
                    np.add.at(links_a, i, sizes_b[j])
                    np.add.at(links_b, j, sizes_a[i])
                    found = root[i], root[shift + j]
                    root = _roots(len(root), [found])[root]
                if same:
                    met.add(met.places(tile_a, keys_a), links_a + links_b, root)
                else:
                    at = np.concatenate([met.places(tile_a, keys_a), met.places(tile_b, keys_b)])
                    met.add(at, np.concatenate([links_a, links_b]), root)
        yield from met.rows()

    return run


def _meetings(tiles: DataFrame) -> DataFrame:
    """``(tile_a, tile_b, ...)``: every two tiles of ranges that are near enough, and each tile with itself.

    Tasks read their share of the tiles once for each share that they meet, so nothing is shuffled or
    written for the pairs. Which of the two is ``a`` goes by a hash, so tasks have equal work.
    """

    def side(which: str) -> DataFrame:
        return tiles.select(*[F.col(c).alias(f"{c}_{which}") for c in ("tile", "zone", "far", *_HELD)])

    near = (F.col("zone_b") <= F.col("far_a")) & (F.col("zone_a") <= F.col("far_b"))
    lower = F.xxhash64(F.least("tile_a", "tile_b"), F.greatest("tile_a", "tile_b")) >= 0
    once = (F.col("tile_a") == F.col("tile_b")) | ((F.col("tile_a") < F.col("tile_b")) == lower)
    both = side("a").hint("shuffle_replicate_nl").join(side("b"), near & once)
    return both.select("tile_a", "tile_b", *[f"{c}_{w}" for w in "ab" for c in _HELD])


def _links(own: DataFrame, dims: int, threshold: float, written) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of vectors of one length: ``(id, key)``, ``(key, least, n)``, and ``(a, b, links)``.

    The last has a linked class, one it hangs together with, and its links in what a task compares.
    """
    axes = principal_axes(own, dims)
    kinds = dict(own.dtypes)
    led = own.select("id", "v").mapInArrow(_led(axes[:, 0]), f"id {kinds['id']}, key binary, lead double")
    led = written(led, f"led{dims}")
    classes = led.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.min("lead").alias("lead"))
    classes = written(classes, f"classes{dims}")
    ranges = max(1, min(RANGES, -(-classes.count() // TILE_ROWS)))
    bounds = classes.approxQuantile("lead", [r / ranges for r in range(1, ranges)], 0.01) if ranges > 1 else []
    bounds = sorted(set(bounds))
    zone = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<double>"), lambda b: b <= F.col("lead")))
    sizes = {r["zone"]: r["count"] for r in classes.groupBy(zone.alias("zone")).count().collect()}  # at most RANGES rows
    parts = F.create_map(*[F.lit(x) for z, n in sizes.items() for x in (z, -(-n // TILE_ROWS))])
    share = F.pmod(F.xxhash64("key"), F.element_at(parts, F.col("zone")))
    combined = own.select("v").mapInArrow(_combined(axes[:, 0]), f"key binary, n bigint, v {kinds['v']}, lead double")
    placed = combined.withColumn("zone", zone).withColumn("place", F.col("zone").cast("bigint") * (1 << 40) + share)
    n_tiles = sum(-(-n // TILE_ROWS) for n in sizes.values())
    sorted_rows = placed.select("place", "key", "n", "v").repartition(n_tiles, "place").sortWithinPartitions("place", "key")
    tiles = sorted_rows.mapInArrow(lambda batches: _tile_of(batches, TILE_ROWS, dims), _TILE)

    # Unit vectors with this cosine are no further apart than that on any axis.
    reach = (2 - 2 * threshold) ** 0.5 + ROUNDING
    edges = [-float("inf"), *bounds, float("inf")]
    far = [max(j for j in range(i, len(edges) - 1) if edges[j] - edges[i + 1] <= reach) for i in range(len(edges) - 1)]
    tiles = tiles.withColumn("zone", F.shiftright("place", 40).cast("int"))
    tiles = tiles.withColumn("far", F.element_at(F.array(*map(F.lit, far)), F.col("zone") + 1))
    tiles = written(tiles.withColumn("tile", F.monotonically_increasing_id()), f"tiles{dims}")
    dtype = "<f4" if kinds["v"] == "array<float>" else "<f8"
    found = written(_meetings(tiles).mapInArrow(_compare(axes, dtype, threshold), _FOUND), f"found{dims}")
    return led.select("id", "key"), classes.select("key", "least", "n"), found


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row.

    Rows link if the cosine of their whole vectors, in double precision, is at least ``threshold``.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing, and
    vectors of different lengths do not link. Rows that repeat an id are rows of their own, each with its
    own vector's component; a row without an id links with nothing and is its own component (NULL,
    kept). An empty table gives no rows.

    Equal vectors are one class, counted with its size and named by a digest. Classes are tiles of
    ``TILE_ROWS``, all pairs of tiles are compared whose ranges of the first axis are near enough, and a
    task gives one row per linked class, never its pairs. The work grows with the square of the classes,
    but vectors are shuffled and written once. The table is read several times and must be the same each time.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "embeddings")

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    usable = F.col("id").isNotNull() & _usable("v")
    kind = "array<float>" if dict(rows.dtypes)["v"] == "array<float>" else "array<double>"
    vectors = rows.where(usable).withColumn("v", F.col("v").cast(kind))
    alone = rows.where(~usable).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component"))
    with shuffles_dropped(spark):
        lengths = vectors.select(F.size("v").alias("dims")).distinct().collect()
        done = [_links(vectors.where(F.size("v") == r["dims"]), r["dims"], threshold, written) for r in lengths]
        if done:
            led, classes, found = (reduce(DataFrame.unionByName, frames) for frames in zip(*done))
            links = found.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
            joined = components(found.select("a", "b")).withColumnRenamed("node", "key")
            # Classes of one row without a link are left out, as they are their own component.
            several = classes.join(links, "key", "left").where("links is not null or n > 1")
            labelled = several.join(joined, "key", "left").withColumn("component", F.coalesce("component", "key"))
            labelled = written(labelled, "labelled")
    if not done:
        known = alone
    else:
        least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
        of_class = labelled.join(least, "component").select(
            "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
        )
        met = led.join(of_class, "key", "left")
        known = met.select(
            "id",
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "id").alias("component"),
        ).unionByName(alone)
    return known.select(
        F.col("id").alias(id_col),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )
