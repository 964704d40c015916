import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("carelayers-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def inputs(spark, sf_dir):
    from carelayers.catalog.registry import Inputs

    return Inputs(spark, sf_dir)


@pytest.fixture(scope="session")
def rows():
    """All rows of a frame as sorted tuples of text, so NULLs and mixed types compare."""

    def collect(df, columns=None):
        picked = df.select(*(columns or df.columns))
        return sorted(tuple(map(str, r)) for r in picked.collect())

    return collect


@pytest.fixture(scope="session")
def plan():
    """The physical plan as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
