import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from carelayers.llm import batches, language, neardup, packing, secrets
from carelayers.llm.tokens import default_tokenizer

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def setting(spark):
    """Sets the session's own bound; what it was comes back afterwards."""
    before = spark.conf.get(SETTING)
    yield lambda value: spark.conf.set(SETTING, value)
    spark.conf.set(SETTING, before)


def long_texts(spark, n=1200):
    text = F.repeat(F.concat(F.lit("word "), F.col("id").cast("string"), F.lit(" ")), 900)
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))


OPERATORS = {
    "train": lambda docs: language.train(docs.limit(5)),
    "identify": lambda docs: language.identify(docs, language.Model([], [], None, None)),
    "near_duplicates": lambda docs: neardup.near_duplicates(docs.limit(5)),
    "scan": secrets.scan,
    "redacted": secrets.redacted,
    "pack": lambda docs: packing.pack(docs.limit(5), default_tokenizer()),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_workers_get_few_bytes_at_once(spark, setting, name):
    """Of one task with about 9 MB of texts, a worker gets all rows, in batches of bounded size."""

    def handed(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([part.num_rows]), pa.array([part.nbytes])], names=["rows", "size"])

    setting("64m")
    docs = long_texts(spark)
    OPERATORS[name](docs)
    got = docs.select("text").mapInArrow(handed, "rows bigint, size bigint").collect()
    assert sum(r["rows"] for r in got) == 1200
    assert sum(r["size"] for r in got) > 8 << 20
    assert max(r["size"] for r in got) < 1.5 * batches.HANDED_BYTES


@pytest.mark.parametrize("own, then", [("64m", "2097152"), ("512k", "512k"), ("2097153b", "2097152"), ("1g", "2097152")])
def test_a_smaller_bound_of_the_session_stays(spark, setting, own, then):
    setting(own)
    batches.hand_over_little(spark)
    assert batches._bytes(spark.conf.get(SETTING)) == batches._bytes(then)
