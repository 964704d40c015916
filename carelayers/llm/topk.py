"""Exact top-k inner products over a bit-sliced index.

Attributes are whole numbers. A block of rows keeps, for each attribute and each bit, one bitmap over
its rows. Sums of rows' attributes are then bitmap arithmetic: one ripple of AND and XOR adds a number
to all rows at once. The best rows are picked from the most significant slice of the sum downward.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelayers.sources.layers import shared_folder

#: Rows of an index block, queries that meet it at once, attributes whose sums are tabled together.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 512
GROUP = 4
#: Query blocks that one task runs through an index block.
BLOCKS_A_TASK = 16

_WORKING_BYTES = 1 << 16


# A number per row as bitmaps: slice ``b`` holds bit ``b``, and the last one is the sign.


class BitSlices:
    """Arithmetic on slices, for all rows at once."""

    @staticmethod
    def of(values: np.ndarray, words: int) -> list[np.ndarray]:
        """Slices of whole numbers; as many as the widest needs, with its sign."""
        low, high = int(values.min(initial=0)), int(values.max(initial=0))
        width = max(high, -low - 1, 0).bit_length() + 1
        padded = np.zeros(words * 64, dtype=np.int64)
        padded[: len(values)] = values
        bits = ((padded[None, :] >> np.arange(width)[:, None]) & 1).astype(np.uint8)
        return list(np.packbits(bits, axis=1, bitorder="little").view(np.uint64))

    @staticmethod
    def add(a: list[np.ndarray], b: list[np.ndarray], minus: bool = False) -> list[np.ndarray]:
        """``a + b``, or ``a - b``, one bit wider than the wider of both."""
        out, carry = [], None
        for i in range(max(len(a), len(b)) + 1):
            x, y = a[min(i, len(a) - 1)], b[min(i, len(b) - 1)]
            y = ~y if minus else y
            either = x ^ y
            if carry is None:  # nothing carried in, or one when subtracting
                out.append(~either if minus else either)
                carry = (x | y) if minus else (x & y)
            else:
                out.append(either ^ carry)
                carry = (x & y) | (carry & either)
        return out


def _bit(values: np.ndarray, b: int) -> np.ndarray:
    return (values >> b) & 1


class Index:
    """Bit slices of one block, with the sums of all subsets of every ``GROUP`` attributes."""

    def __init__(self, values: np.ndarray):
        self.rows, self.dims = values.shape
        self.words = -(-self.rows // 64)
        self.tables: list[np.ndarray] = []
        for start in range(0, self.dims, GROUP):
            own = [BitSlices.of(values[:, d], self.words) for d in range(start, min(start + GROUP, self.dims))]
            zero = [np.zeros(self.words, dtype=np.uint64)]
            sums = [zero]
            for slices in own:
                sums += [BitSlices.add(s, slices) if s is not zero else slices for s in sums]
            width = max(map(len, sums))
            table = np.empty((len(sums), width, self.words), dtype=np.uint64)
            for i, s in enumerate(sums):
                for b in range(width):
                    table[i, b] = s[min(b, len(s) - 1)]
            self.tables.append(table)
        live = np.zeros(self.words * 64, dtype=np.uint8)
        live[: self.rows] = 1
        self.live = np.packbits(live, bitorder="little").view(np.uint64)

    def scores(self, queries: np.ndarray, words: slice) -> list[np.ndarray]:
        """Slices of every query's inner product with the rows in ``words``: (queries, words) each."""
        low, high = int(queries.min(initial=0)), int(queries.max(initial=0))
        width = max(high, -low - 1, 0).bit_length() + 1
        total: list[np.ndarray] | None = None
        # Slices that a sum over all tables can need, for one bit of the query.
        widest = max(t.shape[1] for t in self.tables) + len(self.tables).bit_length()
        for b in range(width - 1, -1, -1):
            if total is not None:  # twice what the higher bits gave
                total = [np.zeros_like(total[0]), *total]
            for g, table in enumerate(self.tables):
                own = queries[:, g * GROUP : (g + 1) * GROUP]
                subset = (_bit(own, b) << np.arange(own.shape[1])).sum(axis=1)
                picked = table[subset, :, words]
                addend = [picked[:, s] for s in range(table.shape[1])]
                if total is None:
                    total = [np.zeros_like(addend[0])]
                total = BitSlices.add(total, addend, minus=b == width - 1)
                total = total[: widest + width - b]
        return total


def best(slices: list[np.ndarray], allowed: np.ndarray, k: int) -> np.ndarray:
    """Bitmaps, per query, of the rows with the ``k`` highest sums and of all rows equal to the last.

    Walks from the sign (where 0 is higher) to the lowest slice, keeping rows surely in and rows
    still equal so far; what is left equal at the end is the boundary.
    """
    surely, equal = np.zeros_like(allowed), allowed.copy()
    for i in range(len(slices) - 1, -1, -1):
        ones = slices[i] if i < len(slices) - 1 else ~slices[i]
        higher = equal & ones
        n = np.bitwise_count(surely | higher).sum(axis=1, dtype=np.int64)
        enough = (n >= k)[:, None]
        surely = np.where(enough, surely, surely | higher)
        equal = np.where(enough, higher, equal & ~ones)
    return surely | equal


def _search(index: Index, keys: np.ndarray, ids: np.ndarray, asking: tuple[np.ndarray, np.ndarray], queries: np.ndarray, k: int):
    """``(query, query_id, vec_id, score)`` of each query's best rows in the block, ties by smaller id.

    ``keys`` number the rows; ``asking`` are numbers and ids of the queries' rows.
    """
    query_keys, query_ids = asking
    queries_now = max(1, min(len(queries), 64))
    step = max(1, _WORKING_BYTES // 8 // queries_now)
    place = {int(v): i for i, v in enumerate(keys)}
    for q0 in range(0, len(queries), queries_now):
        some, these = queries[q0 : q0 + queries_now], slice(q0, q0 + queries_now)
        parts = [index.scores(some, slice(w, w + step)) for w in range(0, index.words, step)]
        slices = [np.concatenate([p[i] for p in parts], axis=1) for i in range(len(parts[0]))]
        allowed = np.repeat(index.live[None, :], len(some), axis=0)
        for i, v in enumerate(query_keys[these].tolist()):
            if (at := place.get(v)) is not None:  # a query is no answer to itself
                allowed[i, at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
        found = best(slices, allowed, k)
        q, w = np.nonzero(found)
        bits = np.unpackbits(found[q, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        q, row = q[at], w[at] * 64 + bit
        score = np.zeros(len(q), dtype=np.int64)
        for i, s in enumerate(slices):
            on = ((s[q, row // 64] >> (row % 64).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            score += (-on if i == len(slices) - 1 else on) << i
        order = np.lexsort((ids[row], -score, q))
        q, row, score = q[order], row[order], score[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        keep = nth < k
        yield query_keys[these][q[keep]], query_ids[these][q[keep]], ids[row[keep]], score[keep]


def _blocked(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows ``(key, vec_id, values)`` gathered into blocks of at most ``rows`` of one partition."""
    keys, ids, values, held = [], [], [], 0

    def block():
        return np.concatenate(keys), np.concatenate(ids), np.concatenate(values)

    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows - held)
            at, held = at + part.num_rows, held + part.num_rows
            keys.append(part.column(0).to_numpy())
            ids.append(part.column(1).to_numpy())
            values.append(part.column(2).flatten().to_numpy().reshape(part.num_rows, -1))
            if held == rows:
                yield block()
                keys, ids, values, held = [], [], [], 0
    if held:
        yield block()


_PACKED = "dims bigint, kind string, keys binary, ids binary, cells binary"
_NAMES = ["dims", "kind", "keys", "ids", "cells"]
_FOUND = ["query", "query_id", "vec_id", "score"]


def _narrowest(values: np.ndarray) -> str:
    """The smallest type of whole numbers that holds all values."""
    low, high = values.min(initial=0), values.max(initial=0)
    return next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def _pack(rows: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, values in _blocked(batches, rows):
            kind = _narrowest(values)
            row = [values.shape[1], kind, *(x.astype("<i8").tobytes() for x in (keys, ids)), values.astype(kind).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in row], names=_NAMES)

    return run


def _unpack(kind: str, keys: bytes, ids: bytes, cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = np.frombuffer(keys, dtype="<i8")
    return rows, np.frombuffer(ids, dtype="<i8"), np.frombuffer(cells, dtype=kind).astype(np.int64).reshape(len(rows), -1)


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """``(vec_id, v array<bigint>)``: ``floor(scale * x)``; rows with unusable vectors are left out.

    Unusable: no id, NULL or empty vector, a NULL or non-finite component, one beyond 2**31.
    """
    x = F.col(vector_col)
    limit = float(1 << 31) / scale
    usable = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < limit))
    rows = df.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & usable)
    cells = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("bigint"))
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), cells.alias("v"))


def top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 50,
    k: int = 5,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best inner products of each query, ties by id.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but the query's own.
    Unusable vectors (see ``quantised``) take no part; vectors only meet vectors of their length. Rows
    that repeat an id are queries and candidates of their own, each with ranks from 1. Fewer than ``k``
    candidates give fewer rows, none gives none.

    Rows are written once as blocks, any ``BLOCK_ROWS`` of a partition, so no key decides where a row
    goes. Each task takes one index block and up to ``BLOCKS_A_TASK`` query blocks and gives ``k``
    rows per query; these are combined before the last shuffle.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "topk")
    rows = quantised(df, id_col, vector_col)
    rows.withColumn("key", F.monotonically_increasing_id()).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows").withColumn("dims", F.size("v"))

    def blocks(part: DataFrame, name: str, size: int) -> DataFrame:
        packed = part.repartition(max(1, -(-part.count() // size))).sortWithinPartitions("dims")
        packed = packed.select("key", "vec_id", "v").mapInArrow(_pack_by_length(size), _PACKED)
        packed.withColumn("block", F.monotonically_increasing_id()).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    index = blocks(rows, "index", BLOCK_ROWS)
    asked = blocks(rows.where(F.col("vec_id") % every == 0), "queries", BLOCK_QUERIES)
    # Every index block meets every query block of its length: pairs of blocks, not of rows.
    n_lanes = max(1, -(-asked.count() // BLOCKS_A_TASK))
    tasks = max(1, index.count() * n_lanes)
    lane = F.pmod(F.xxhash64("block"), F.lit(n_lanes)).cast("int").alias("lane")
    lanes = F.explode(F.sequence(F.lit(0), F.lit(n_lanes - 1))).alias("lane")
    targets = index.select("dims", F.col("block").alias("i_block"))
    held = index.select(F.col("block").alias("i_block"), "kind", "keys", "ids", "cells", lanes)
    packed = ["kind", "keys", "ids", "cells"]
    queries = asked.select("dims", lane, *[F.col(c).alias(f"q_{c}") for c in packed])
    queries = queries.join(targets, "dims").drop("dims").repartition(tasks, "i_block", "lane")
    # A merge join, as it brings the pairs of one index block one after the other.
    met = held.repartition(tasks, "i_block", "lane").hint("merge").join(queries, ["i_block", "lane"])
    met = met.select("i_block", *packed, *[f"q_{c}" for c in packed])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, *rest = (c[i].as_py() for c in batch.columns)
                if block != now:
                    now, (keys, ids, values) = block, _unpack(*rest[:4])
                    built = Index(values)
                *asking, queries_here = _unpack(*rest[4:])
                for found in _search(built, keys, ids, asking, queries_here, k):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=_FOUND)

    found = met.mapInArrow(run, ", ".join(f"{c} bigint" for c in _FOUND))
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _pack_by_length(size: int):
    """Blocks of one partition's rows, a new block where the length of the vectors changes."""
    pack = _pack(size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            for batch in batches:
                lengths = batch.column(2).value_lengths().to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(lengths)) + 1).tolist(), batch.num_rows]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if b > a:
                        yield int(lengths[a]), batch.slice(a, b - a)

        for _, same in groupby(runs(), key=lambda r: r[0]):
            yield from pack(b for _, b in same)

    return run
