"""From raw documents to packed token sequences; each stage works on what the one before kept.

Counted as part of the subpackage ``llm``. A stage takes ``(spark, docs, sf_dir)``, where ``docs`` is
what the stage before has written, and returns a DataFrame; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.llm import language, lines, neardup, packing, secrets
from carelayers.llm.tokens import default_tokenizer
from carelayers.sources.layers import shared_folder

#: Packed sequences cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def _unused(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores more as it takes to be none of the columns."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Label every document with its predicted language; those in no language go.

    NULL texts and texts without a letter go, as does all text where no row has a language to learn from;
    NULL languages get the predicted one. Repeated rows are rows of their own, other columns stay.
    """
    model = language.train(docs.where(~language.held_out()))
    label = _unused(docs, "lang_found")
    found = language.identify(docs, model, into=(label, _unused(docs, "score_found")))
    found = found.where(F.col(label) != language.UNDETERMINED)
    return found.withColumn("lang", F.col(label)).select(*docs.columns)


def remove_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that many sources share, but for their first place; all documents stay.

    NULL texts stay NULL; rows without an id keep their lines; a NULL source is none; other columns stay.
    """
    return _counted(lines.dedup_lines(docs, removed_col=_unused(docs, "removed"))).select(*docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates stays, the one with the smallest id.

    NULL and empty texts and rows without an id stay; rows that repeat an id stay or go together.
    """
    return neardup.first_of_each(docs).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; all documents stay, NULL texts and other columns as they are."""
    return _counted(secrets.redacted(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of equal length; NULL and empty texts have an end token only."""
    return packing.pack(docs, default_tokenizer())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_shared_lines),
    ("near-duplicates", remove_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/stage{n}")
        docs = spark.read.parquet(f"{folder}/stage{n}")
    return STAGES[-1][1](spark, docs, sf_dir)
