"""Arrow batches in pieces of bounded size, for the operators that work on whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

#: Bytes of Arrow data that one step works on; a longer row makes a step of its own.
STEP_BYTES = 4 << 20
#: Bytes of rows that Spark collects before it hands them to a worker; an executor holds up to four times as
#: much for every core meanwhile, and the worker as much again.
HANDED_BYTES = 2 << 20
_HANDED = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * "_kmgtp".index(unit or "_")


def hand_over_little(spark: SparkSession) -> None:
    """From now on the session hands rows to workers in batches of ``HANDED_BYTES``, or of less if it did so.

    Spark's own bounds are 10,000 rows and 64 MB, so a task with long texts holds tens of MB several times.
    Plans take the setting when they run, so it stays. Batches only get shorter; results are the same.
    """
    if _bytes(spark.conf.get(_HANDED, "1g")) > HANDED_BYTES:
        spark.conf.set(_HANDED, str(HANDED_BYTES))


def steps(batches: Iterable[pa.RecordBatch], max_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``max_bytes`` each, in order, none of them empty."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * max_bytes / max(1, batch.nbytes)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts(column: pa.Array) -> list[str]:
    """The column as text; NULL is the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]
