"""Registered queries and the plain SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelayers.catalog.inputs import INPUTS, input_frame, input_sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
# Named intermediate results that the SQL of several queries shares.
STEPS: dict[str, str] = {}

_NAME = re.compile(r"\b(?:in|silver|gold|step)_\w+")


class Inputs:
    """The derived inputs of one data folder, as attributes: ``inputs.cptevents``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUTS:
            raise AttributeError(name)
        return input_frame(self.spark, self.folder, name)

    def spread(self, name: str) -> DataFrame:
        """An input for costly row-wise work, its rows over all cores."""
        return input_frame(self.spark, self.folder, name, spread_rows=True)


def register(name: str, sql: str | None = None):
    """Register ``function(inputs) -> DataFrame``. ``sql`` may name ``in_<input>`` and steps."""

    def keep(function: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Inputs(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return keep


def _definition(name: str) -> str | None:
    if name in STEPS:
        return STEPS[name]
    if name.startswith("in_") and name[3:] in INPUTS:
        return input_sql(name[3:])
    return None


def complete_sql(sql: str) -> str:
    """``sql`` with the inputs and steps it uses, and those they use, in front."""
    parts: dict[str, str] = {}

    def add(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            definition = _definition(name)
            if definition is not None and name not in parts:
                add(definition)
                parts[name] = definition

    add(sql)
    if not parts:
        return sql
    return "with " + ",\n".join(f"{n} as ({d})" for n, d in parts.items()) + "\n" + sql


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages to eight places, as summation order may change the last bits."""
    return df.withColumns({c: F.round(c, 8) for c in columns})
