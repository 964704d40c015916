"""CSV input, plain or gzip by file suffix."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from carelayers.sources.schemas import SCHEMAS, conform


def read_raw(
    spark: SparkSession,
    path: str,
    *,
    table: str | None = None,
    infer: bool = False,
    quote: str = '"',
    escape: str = '"',
    partitions: int | None = None,
) -> DataFrame:
    """Read one CSV table with a header; a missing path fails at once with ``PATH_NOT_FOUND``.

    ``infer=True`` lets Spark look at the whole input once more to choose types. Otherwise every
    column is text, doubled quotes inside quotes are one quote, and ``table`` names the declared
    types to convert to.
    A gzip file is one task however big it is: give ``partitions`` to spread its rows after the
    scan (or see ``spread``), or better write the first layer once and work from there.
    """
    if infer:
        df = spark.read.csv(path, header=True, inferSchema=True)
    else:
        df = spark.read.csv(path, header=True, quote=quote, escape=escape, multiLine=False)
        if table is not None:
            df = conform(df, table)
    return df.repartition(partitions) if partitions else df


def spread(df: DataFrame, pieces: int | None = None) -> DataFrame:
    """Rows over ``pieces`` tasks (by default all cores) when the scan has fewer, else ``df``.

    For costly row-wise work on a file that cannot be split: one gzip file, or Parquet with one
    row group. A table of many pieces is not shuffled.
    """
    pieces = pieces or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(pieces) if df.rdd.getNumPartitions() < pieces else df


def first_rows(df: DataFrame, n: int, order: list[str] | None = None) -> DataFrame:
    """``n`` rows when ``n`` is above 0, else all rows; in a stated order when one is given."""
    if n <= 0:
        return df
    return (df.orderBy(*order) if order else df).limit(n)


# Tables that come as plain CSV; the others are gzip.
PLAIN_CSV = ("outputevents", "diagnoses_icd", "d_icd_diagnoses")


class RawFolder(Mapping):
    """A folder of CSV tables as ``{table: DataFrame}``, each read when it is asked for.

    ``sample`` above 0 takes that many rows of every table not named in ``whole``. A gzip file cannot
    be split, so the rows of a table in fewer files are spread over ``pieces`` tasks (by default as many as
    the session runs at once) right after the scan.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        *,
        plain: tuple[str, ...] = PLAIN_CSV,
        infer: bool = False,
        sample: int = 0,
        whole: tuple[str, ...] = (),
        pieces: int | None = None,
    ):
        self.spark, self.folder, self.plain = spark, folder.rstrip("/"), plain
        self.infer, self.sample, self.whole = infer, sample, whole
        self.pieces = pieces or spark.sparkContext.defaultParallelism

    def path(self, table: str) -> str:
        suffix = ".csv" if table in self.plain else ".csv.gz"
        return f"{self.folder}/{table.upper()}{suffix}"

    def __getitem__(self, table: str) -> DataFrame:
        if table not in SCHEMAS:
            raise KeyError(table)
        df = read_raw(self.spark, self.path(table), table=table, infer=self.infer)
        df = df if table in self.whole else first_rows(df, self.sample)
        return df if table in self.plain else spread(df, self.pieces)

    def __iter__(self) -> Iterator[str]:
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)
