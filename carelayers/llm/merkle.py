"""A manifest of a table as a Merkle tree, and proofs found by descent through its records.

Rows of one tree (say, one language) are leaves in order; every eight consecutive nodes have a parent,
up to one subroot per tree; the subroots, in order, are the leaves of a last tree with the root on top.
A node is stored as a record from its digest to the digests of its children and found by that digest
alone. Requests start together at the root and part where the digits of their places differ, so
requests with a common path travel as one row; children passed by are collected on the way.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelayers.operators.ranking import rank_within

#: Children of a node.
FAN_OUT = 8
#: Lists of trees up to so many rows are broadcast.
BROADCAST_ROWS = 500_000
_SEGMENT = "array<struct<left:string,right:string>>"


def hash_of(digests: Column) -> Column:
    """SHA-256 of the digests' text in a row, as lower-case hex."""
    return F.sha2(F.array_join(digests, ""), 256)


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the values in a row, each as ``bytes:value``, NULL as ``-``."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and the siblings on its path, lowest first, lead to."""
    return F.aggregate(segments, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def _beside(children: Column, place: Column) -> Column:
    """The children before and after the one at ``place`` (from 0)."""
    left = F.array_join(F.slice(children, F.lit(1), place), "")
    right = F.array_join(F.slice(children, place + 2, F.lit(FAN_OUT)), "")
    return F.struct(left.alias("left"), right.alias("right"))


@dataclass(frozen=True)
class Manifest:
    """Where leaves, records and subroots lie; heights of the highest tree and of the last one."""

    folder: str
    root: str | None
    height: int
    top_height: int


def _height(n: int) -> int:
    """Levels above ``n`` leaves."""
    height = 0
    while FAN_OUT**height < n:
        height += 1
    return height


def _write_levels(leaves: DataFrame, height: int, folder: str) -> DataFrame:
    """Records of all levels, written level by level; returns ``(tree, n, height, digest)`` of the subroots.

    ``leaves``: ``(tree, n, place, digest)`` with the size of the tree and the place from 0.
    """
    nodes, subroots = leaves, []
    for level in range(height + 1):
        top = nodes.where(F.col("n") <= FAN_OUT**level)
        subroots.append(top.select("tree", "n", F.lit(level).alias("height"), "digest"))
        if level == height:
            break
        parent = F.floor(F.col("place") / FAN_OUT).cast("bigint")
        run = F.sort_array(F.collect_list(F.struct("place", "digest")))
        grown = nodes.where(F.col("n") > FAN_OUT**level).groupBy("tree", "n", parent.alias("place")).agg(run.alias("run"))
        grown = grown.select("tree", "n", "place", F.col("run.digest").alias("children"))
        grown.withColumn("digest", hash_of(F.col("children"))).write.parquet(f"{folder}/height={level + 1}")
        nodes = leaves.sparkSession.read.parquet(f"{folder}/height={level + 1}")
    out = subroots[0]
    for more in subroots[1:]:
        out = out.unionByName(more)
    return out


def _bounded(df: DataFrame) -> DataFrame:
    """``df`` to be broadcast if it is small, as counted."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def write_manifest(items: DataFrame, folder: str) -> Manifest:
    """Write items, leaves, records and subroots below ``folder``.

    ``items`` has ``tree`` (text, not NULL; trees are ordered by its bytes), ``key`` (the order of leaves,
    NULL last; equal keys go by leaf, then by the other columns), ``leaf`` (hex digest) and any other
    columns, which the written leaves keep. No items give no root.
    """
    spark = items.sparkSession
    items.write.parquet(f"{folder}/items")
    items = spark.read.parquet(f"{folder}/items")
    placed = rank_within(items, ["tree"], ["key", "leaf"], "place").withColumn("place", F.col("place") - 1)
    placed.write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    leaves.groupBy("tree").agg((F.max("place") + 1).alias("n")).write.parquet(f"{folder}/sizes")
    sizes = spark.read.parquet(f"{folder}/sizes")
    height = _height(sizes.agg(F.max("n")).first()[0] or 0)
    bottom = leaves.select("tree", "place", F.col("leaf").alias("digest")).join(_bounded(sizes), "tree")
    subroots = _write_levels(bottom, height, f"{folder}/records")
    one = subroots.select(F.lit("").alias("all"), "tree", "height", "digest")
    rank_within(one, ["all"], ["tree"], "place").select(
        "tree", "height", "digest", (F.col("place") - 1).alias("place")
    ).write.parquet(f"{folder}/subroots")
    subroots = spark.read.parquet(f"{folder}/subroots")
    n = subroots.count()
    top = subroots.select(F.lit("").alias("tree"), F.lit(n).cast("bigint").alias("n"), "place", "digest")
    root = _write_levels(top, _height(n), f"{folder}/top").first()
    return Manifest(folder, root["digest"] if root else None, height, _height(n))


def _records(spark, folder: str, height: int) -> DataFrame:
    """``(digest, children)`` of a level; equal nodes have one record."""
    rows = spark.read.parquet(f"{folder}/height={height}")
    return rows.groupBy("digest").agg(F.any_value("children").alias("children"))


def _down(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """From nodes to their children: the next digit of the place, and the children passed by."""
    met = frontier.join(records, "digest")
    kept = [c for c in frontier.columns if c not in ("digest", "place", "path")]
    at = met.select(*kept, "place", "path", "children", F.posexplode("children").alias("digit", "child"))
    passed = F.array(_beside(F.col("children"), F.col("digit")))
    return at.select(
        *kept,
        F.col("child").alias("digest"),
        (F.col("place") * FAN_OUT + F.col("digit")).alias("place"),
        F.concat("path", passed).alias("path"),
    )


def proofs(manifest: Manifest, spark, requests: DataFrame | None = None) -> DataFrame:
    """The written leaves with ``subroot`` and ``segments``, their siblings level by level, lowest first.

    ``requests`` is ``(tree, place)``; other leaves are left out. Without it all leaves are asked for.
    A segment has the siblings on the left and those on the right, each as digests in a row.
    """
    folder = manifest.folder
    subroots = spark.read.parquet(f"{folder}/subroots")
    leaves = spark.read.parquet(f"{folder}/leaves")
    if requests is not None:
        requests = requests.select("tree", "place").distinct()
        leaves = leaves.join(requests, ["tree", "place"], "left_semi")
    path = F.array().cast(_SEGMENT)
    frontier = subroots.where("place = 0").select(
        F.lit(manifest.root).alias("digest"), F.lit(0).cast("bigint").alias("place"), path.alias("path")
    )
    for level in range(manifest.top_height, 0, -1):
        frontier = _down(frontier, _records(spark, f"{folder}/top", level))
    trees = subroots.select("tree", "height", "place")
    entered = frontier.join(trees, "place").select(
        "tree", "height", F.col("digest").alias("subroot"), "digest", F.lit(0).cast("bigint").alias("place"), "path"
    )
    if requests is not None:
        entered = entered.join(requests.select("tree").distinct(), "tree", "left_semi")
    frontier = entered.where(F.lit(False))
    for level in range(manifest.height, 0, -1):
        frontier = frontier.unionByName(entered.where(F.col("height") == level))
        records = _records(spark, f"{folder}/records", level)
        if level == 1:
            break
        frontier = _down(frontier, records)
        if requests is not None:
            digits = F.floor(F.col("place") / FAN_OUT ** (level - 1)).cast("bigint")
            prefixes = requests.select("tree", digits.alias("place")).distinct()
            frontier = frontier.join(prefixes, ["tree", "place"], "left_semi")
    alone = entered.where("height = 0").withColumn("children", F.array("digest"))
    runs = alone.unionByName(frontier.join(records, "digest")) if manifest.height else alone
    run = F.floor(F.col("place") / FAN_OUT).cast("bigint")
    held = leaves.groupBy(F.col("tree").alias("of"), run.alias("run")).agg(
        F.collect_list(F.struct(*leaves.columns)).alias("held")
    )
    same = (F.col("tree") == F.col("of")) & (F.col("place") == F.col("run"))
    each = runs.select("tree", "place", "height", "subroot", "path", "children").join(held, same)
    each = each.select("height", "subroot", "path", "children", F.explode("held").alias("leaf"))
    last = F.array(_beside(F.col("children"), (F.col("leaf.place") % FAN_OUT).cast("int")))
    segments = F.concat(F.when(F.col("height") > 0, last).otherwise(path), F.reverse("path"))
    return each.select("leaf.*", "subroot", segments.alias("segments"))


def proof_digest(segments: Column) -> Column:
    """SHA-256 of all siblings in a row."""
    return hash_of(F.transform(segments, lambda s: F.concat(s["left"], s["right"])))


#: What a leaf of a document covers, in this order.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def document_items(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Items of a documents table: the leaf, and ``shown``, the leaf of what a tampered copy shows.

    Where 3 divides the CRC-32 of the id, the copy has the letters A-Z of the text in lower case.
    A NULL tree comes before all others; a NULL id comes last in its tree and is never tampered with.
    """
    tampered = F.crc32(F.col(id_col).cast("string")) % 3 == 0
    lowered = F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    shown = [lowered if c == text_col else F.col(c) for c in LEAF_COLUMNS]
    leaf = leaf_digest([F.col(c) for c in LEAF_COLUMNS])
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),
        F.col(id_col).alias("key"),
        leaf.alias("leaf"),
        F.when(tampered, leaf_digest(shown)).otherwise(leaf).alias("shown"),
    )


def verified_documents(docs: DataFrame, folder: str) -> DataFrame:
    """Every document with its proof, and whether the copy shown folds back to the root.

    Columns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``; one row per row of
    ``docs``, whose other columns do not matter. Rows that repeat an id are leaves of their own; wholly
    equal rows have equal digests and one record per node, and places of their own. Empty and NULL
    texts differ (``0:`` and ``-``). An empty table gives no rows.
    """
    manifest = write_manifest(document_items(docs), folder)
    root = F.lit(manifest.root)
    folded = proofs(manifest, docs.sparkSession).withColumn("folded_root", fold(F.col("shown"), F.col("segments")))
    return folded.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        root.cast("string").alias("root"),
        proof_digest(F.col("segments")).alias("proof_sha256"),
        "folded_root",
        F.coalesce(F.col("folded_root") == root, F.lit(False)).alias("verified"),
    )
