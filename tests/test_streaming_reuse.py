"""The stateless cleaning operators run on a streaming frame unchanged."""

import os

from carelayers.plans import procedures
from carelayers.sources.layers import shared_folder, write_layer


def test_cleaning_a_stream_equals_cleaning_the_batch(spark, inputs, rows):
    root = shared_folder(spark, "stream")
    write_layer(inputs.cptevents, root, "bronze", "cptevents")
    path = os.path.join(root, "bronze_cptevents")
    schema = spark.read.parquet(path).schema
    stream = procedures.silver_cptevents(spark.readStream.schema(schema).parquet(path))
    query = (
        stream.writeStream.format("memory").queryName("silver_stream")
        .option("checkpointLocation", os.path.join(root, "progress")).start()
    )
    try:
        query.processAllAvailable()
        expected = procedures.silver_cptevents(inputs.cptevents)
        assert rows(spark.table("silver_stream")) == rows(expected)
    finally:
        query.stop()
