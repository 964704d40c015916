"""Harmonic packing of tokenized documents into sequences of equal length.

A document is cut into whole sequences, then at most one half, one quarter and one eighth of a
sequence, then a tail shorter than that. Every piece belongs to the class ``k`` of pieces that go
``k`` times into a sequence, and a sequence of class ``k`` holds exactly ``k`` of them. So workers
fill sequences without knowing of each other, and the exact parts leave no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.llm.batches import hand_over_little, steps, texts
from carelayers.llm.tokens import library_encoder
from carelayers.sources.layers import shared_folder

CAPACITY = 1024
END = 0
#: How many workers' unfilled sequences one worker of the next round takes over.
FAN_IN = 32

_PIECE = "__id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_NAMES = ["__id", "start", "length", "ids_crc32", "doc_tokens", "k", "sequence_id", "offset"]


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: wholes, half, quarter, eighth, tail."""
    lengths = [capacity] * (n // capacity)
    rest = n % capacity
    for part in (capacity // 2, capacity // 4, capacity // 8):
        if rest >= part > 0:
            lengths.append(part)
            rest -= part
    return [*lengths, rest] if rest else lengths


class _Bins:
    """One open sequence per class; sequence ids start at ``first``."""

    def __init__(self, first: int, capacity: int):
        self.next, self.capacity = first, capacity
        self.open: dict[int, list[tuple]] = defaultdict(list)

    def add(self, piece: tuple) -> list[tuple]:
        """Take a piece ``(id, start, length, ...)``; a sequence's pieces when it becomes full."""
        k = self.capacity // piece[2]
        held = self.open[k]
        held.append(piece)
        if len(held) < k:
            return []
        del self.open[k]
        return self.close(held, k)

    def close(self, held: list[tuple], k: int | None = None) -> list[tuple]:
        sequence, offset, out = self.next, 0, []
        self.next += 1
        for piece in held:
            out.append((*piece[:5], k or self.capacity // piece[2], sequence, offset))
            offset += piece[2]
        return out

    def rest(self) -> Iterator[tuple]:
        for k, held in self.open.items():
            for piece in held:
                yield (*piece[:5], k, None, None)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("__id", id_type), *[(n, pa.int64()) for n in _NAMES[1:]]])


def _first_id(level: int) -> int:
    """Sequence ids that no other worker or round uses: round, worker, running number."""
    return (level << 56) | (TaskContext.get().partitionId() << 32)


def _pack_texts(tokenizer: str, capacity: int, end: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, schema = library_encoder(tokenizer), None
        bins = _Bins(_first_id(1), capacity)
        stop = int(end).to_bytes(4, "little")
        for part in steps(batches):
            schema = _schema(part.schema.field(0).type)
            out = []
            for doc, ids in zip(part.column(0).to_pylist(), encoder(texts(part.column(1)))):
                ids, start = ids + stop, 0
                for length in cut(len(ids) // 4, capacity):
                    code = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    out += bins.add((doc, start, length, code, len(ids) // 4))
                    start += length
            yield _batch(out, schema)
        if schema is not None:
            yield _batch(list(bins.rest()), schema)

    return run


def _pack_rest(level: int, capacity: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, bins = None, _Bins(_first_id(level), capacity)
        for batch in batches:
            schema = _schema(batch.schema.field(0).type)
            rows = zip(*(batch.column(i).to_pylist() for i in range(5)))
            yield _batch([done for piece in rows for done in bins.add(piece)], schema)
        if schema is not None:
            yield _batch(list(bins.rest()), schema)

    return run


def _pack_last(level: int, capacity: int):
    """Any pieces together: longest first into the fullest sequence that has room.

    Gets less than one sequence of every class, so its size does not depend on the input.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, pieces = None, []
        for batch in batches:
            schema = _schema(batch.schema.field(0).type)
            pieces += zip(*(batch.column(i).to_pylist() for i in range(5)))
        if schema is None:
            return
        room: list[list[list[tuple]]] = [[] for _ in range(capacity + 1)]
        for piece in sorted(pieces, key=lambda p: -p[2]):
            free = next((r for r in range(piece[2], capacity) if room[r]), capacity)
            held = room[free].pop() if room[free] else []
            held.append(piece)
            room[free - piece[2]].append(held)
        bins, out = _Bins(_first_id(level), capacity), []
        for held in (h for hs in room for h in hs):
            out += bins.close(held)
        yield _batch(out, schema)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
) -> DataFrame:
    """Pieces ``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A document is its ids and then ``end``, so NULL and empty texts are one token; NULL ids and
    repeated rows are documents of their own; an empty table gives no piece; other columns are not
    looked at. Every round is written to the shared folder and read again, so its sequence numbers
    stay as they are if an executor is lost. What a round leaves is less than one sequence of every
    class and worker; ``FAN_IN`` workers' leavings are one worker's input of the next round, and
    those of a single worker are packed together by size.
    """
    spark: SparkSession = docs.sparkSession
    hand_over_little(spark)
    kind = dict(docs.dtypes)[id_col]
    fields = _PIECE.format(id=kind) + ", k bigint, sequence_id bigint, offset bigint"
    folder = shared_folder(spark, "packing")

    def written(df: DataFrame, level: int) -> DataFrame:
        df.write.parquet(f"{folder}/round{level}")
        return spark.read.parquet(f"{folder}/round{level}")

    picked = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    packed = picked.mapInArrow(_pack_texts(tokenizer, capacity, end), fields)
    level, filled = 1, []
    now = written(packed.withColumn("worker", F.spark_partition_id()), level)
    workers = (now.agg(F.max("worker")).first()[0] or 0) + 1
    while True:
        filled.append(now.where(F.col("sequence_id").isNotNull()))
        rest = now.where(F.col("sequence_id").isNull())
        if workers == 1:
            break
        workers, level = -(-workers // FAN_IN), level + 1
        # The worker number itself is the target, so leavings of neighbours meet.
        moved = rest.repartitionByRange(workers, F.floor(F.col("worker") / FAN_IN))
        again = moved.drop("worker").mapInArrow(_pack_rest(level, capacity), fields)
        now = written(again.withColumn("worker", F.spark_partition_id()), level)
        workers = (now.agg(F.max("worker")).first()[0] or 0) + 1
    last = rest.drop("worker").coalesce(1).mapInArrow(_pack_last(level + 1, capacity), fields)
    filled.append(written(last.withColumn("worker", F.lit(0)), level + 1))
    out = filled[0]
    for more in filled[1:]:
        out = out.unionByName(more)
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(F.col("__id").alias(id_col), *columns)
