"""Removal of lines that many sites share, found by the spread of their hash over sites.

Only DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.sources.layers import shared_folder

#: A line on so many sites is boilerplate.
MIN_SITES = 10
#: Size of a sketch: 2 ** LG_K registers.
LG_K = 12
#: Relative error of a sketch's estimate that a line's exact count is taken within.
MARGIN = 3 * 1.04 / 2 ** (LG_K / 2)
#: Shared lines that are sent to all tasks (some 60 bytes each), those with most places first.
SENT_LINES = 500_000


def _hash(line: Column) -> list[Column]:
    """128 bits of a line, as two numbers."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def line_places(docs: DataFrame, id_col: str, text_col: str, site_col: str) -> DataFrame:
    """``(id, site, pos, h1, h2)`` of every line that is not empty; lines are split at ``\\n``."""
    lines = docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("whole"),
        F.col(site_col).cast("string").alias("site"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"),
    )
    return lines.where("line <> ''").select("id", "whole", "site", "pos", *_hash(F.col("line")))


def boilerplate(places: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``(h1, h2, first, rows)`` of the lines on at least ``min_sites`` sites, their first place, and their places with a site.

    Sketches of each line's sites are merged by the aggregation. A line whose estimate is too near
    ``min_sites`` to be sure gets an exact count of its sites; NULL is not a site.
    """
    spread = places.groupBy("h1", "h2").agg(
        F.count("site").alias("rows"),
        F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"),
        F.min(F.struct("id", "pos")).alias("first"),
    )
    # Fewer rows than sites asked for cannot be enough.
    possible = spread.where(F.col("rows") >= min_sites)
    low, high = min_sites * (1 - MARGIN), min_sites * (1 + MARGIN)
    sure = possible.where(F.col("sites") > high)
    near = possible.where(F.col("sites").between(low, high))
    pairs = places.join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").where("site is not null")
    exact = (
        pairs.select("h1", "h2", F.xxhash64("site").alias("s1"), "site")
        .groupBy("h1", "h2", "s1", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    proven = near.join(exact, ["h1", "h2"], "left_semi")
    return sure.unionByName(proven).select("h1", "h2", "first", "rows")


def _places_of(places: DataFrame, shared: DataFrame, sent: int) -> DataFrame:
    """``places`` joined with the lines ``shared`` (written), a hot line's without a shuffle.

    Up to ``sent`` lines go to all tasks, those with most places; what other lines there are have few
    places each, and are joined by a shuffle.
    """
    by = ["h1", "h2"]
    if shared.count() <= sent:
        return places.join(F.broadcast(shared), by)
    hot = shared.orderBy(F.col("rows").desc(), *by).limit(sent)
    keys = F.broadcast(hot.select(*by))
    cold = places.join(keys, by, "left_anti").join(shared.join(keys, by, "left_anti"), by)
    return places.join(F.broadcast(hot), by).unionByName(cold)


def _without(text: Column, removed: Column) -> Column:
    """``text`` without the lines at the sorted positions ``removed``, in linear time.

    The lines between two neighbouring removed positions stay together as one slice.
    """
    lines = F.split(text, "\n")
    marks = F.concat(F.array(F.lit(-1)), removed, F.array(F.size(lines)))
    runs = F.transform(
        F.sequence(F.lit(0), F.size(removed)),
        lambda i: F.slice(lines, F.get(marks, i) + 2, F.get(marks, i + 1) - F.get(marks, i) - 1),
    )
    return F.array_join(F.flatten(runs), "\n")


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    removed_col: str = "n_removed",
    sent: int = SENT_LINES,
) -> DataFrame:
    """Every row of ``docs`` without the lines that at least ``min_sites`` sites share.

    The first place of such a line, by id and position, keeps it, so no text is lost from the whole
    table; all its other places lose it. ``removed_col`` says how many lines a row lost. Lines are
    compared whole and exactly; empty lines stay. NULL text stays NULL, empty text empty. Rows
    without an id lose nothing, but count. Rows that repeat an id lose each its own lines; where several
    of them have a line at the same, first place, it is one place, and all keep it. A NULL site is no
    site. Other columns are passed on.

    Shuffles 40 bytes a line once, combined before, and the documents once by id and text. The lines to
    remove are written to the shared folder.
    """
    spark = docs.sparkSession
    places = line_places(docs, id_col, text_col, site_col)
    folder = shared_folder(spark, "lines")
    boilerplate(places, min_sites).write.parquet(folder)
    found = _places_of(places, spark.read.parquet(folder), sent).where("id is not null and struct(id, pos) <> first")
    lost = found.groupBy("id", F.col("whole").alias("text_hash")).agg(F.sort_array(F.collect_set("pos")).alias("removed"))
    whole = docs.select(*[F.col(c) for c in docs.columns if c.lower() != removed_col.lower()])
    same_text = F.xxhash64(F.col(f"whole.`{text_col}`")) == F.col("lost.text_hash")
    same = (F.col(f"whole.`{id_col}`") == F.col("lost.id")) & same_text
    joined = whole.alias("whole").join(lost.alias("lost"), same, "left")
    text, removed = F.col(f"whole.`{text_col}`"), F.col("lost.removed")
    untouched = text.isNull() | removed.isNull()
    clean = F.when(untouched, text).otherwise(_without(text, removed))
    n = F.when(untouched, 0).otherwise(F.size(removed))
    picked = [clean.alias(c) if c == text_col else F.col(f"whole.`{c}`") for c in whole.columns]
    return joined.select(*picked, n.cast("bigint").alias(removed_col))
