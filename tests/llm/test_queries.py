"""Registered queries against plain SQL on another engine, and the whole pipeline."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from carelayers.llm import language, queries, secrets
from helpers import near_duplicates
from test_oracle import TABLES, TYPES, table_of


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    cursor = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]).upper() for c in cursor.description}
    assert types == {c: TYPES[kind] for c, kind in df.dtypes}
    assert table_of(df.collect(), df.columns) == table_of(cursor.fetchall(), columns)


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))


COLUMNS = {
    "op1_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op6_neardup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op7_embeddings": ["vec_id", "n_links", "component_id", "kept"],
    "op8_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op10_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert df.columns == COLUMNS[name]
    table = "embeddings" if name == "op7_embeddings" else "documents"
    ids = {r[0] for r in df.collect()}
    assert ids == {r[0] for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()}


def brute_lines(docs, min_sites=10):
    sites, first = {}, {}
    for d in docs:
        for pos, line in enumerate(d["text"].split("\n")):
            if line:
                sites.setdefault(line, set()).add(d["source"])
                first[line] = min(first.get(line, (d["doc_id"], pos)), (d["doc_id"], pos))
    for d in docs:
        kept = [
            line
            for pos, line in enumerate(d["text"].split("\n"))
            if not line or len(sites[line]) < min_sites or first[line] == (d["doc_id"], pos)
        ]
        yield {**d, "text": "\n".join(kept)}


def test_pipeline_stage_by_stage(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rejected = spark.createDataFrame(
        [(10**6, "1234 !!", "en", "s", 7), (10**6 + 1, None, "en", "s", None)], docs.schema
    )
    docs = docs.unionByName(rejected)
    now = [r.asDict() for r in docs.collect()]
    model = language.train(docs.where(~language.held_out()))
    labels = {r.doc_id: r.lang_pred for r in language.identify(docs, model).collect()}
    expected = [
        lambda rows: [{**d, "lang": labels[d["doc_id"]]} for d in rows if labels[d["doc_id"]] != "und"],
        lambda rows: [{**d, "n_chars": len(d["text"])} for d in brute_lines(rows)],
        lambda rows: _kept(rows),
        lambda rows: [{**d, "text": (t := secrets.redact(d["text"])), "n_chars": len(t)} for d in rows],
    ]
    for n, ((_, stage), step) in enumerate(zip(corpus_pipeline.STAGES, expected)):
        out = stage(spark, docs, sf_dir)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        now = step(now)
        key = lambda d: d["doc_id"]
        assert sorted((r.asDict() for r in docs.collect()), key=key) == sorted(now, key=key)
        assert now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r.doc_id for r in packed.collect()} == {d["doc_id"] for d in now}


def _kept(rows):
    component = near_duplicates([(d["doc_id"], d["text"]) for d in rows])
    return [d for d in rows if component[d["doc_id"]][1] == d["doc_id"]]


def test_run_gives_the_same_as_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    whole = corpus_pipeline.run(spark, sf_dir)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, whole.select(columns).collect())) == sorted(map(tuple, docs.select(columns).collect()))


def test_stages_over_odd_rows(spark, tmp_path):
    """NULLs in every column, repeated rows, empty texts, and columns with names that stages use."""
    rows = [(i, f"The words of text {i} are its own\nand one line is shared {i % 2}", "en", f"s{i}", 9) for i in range(24)]
    rows += [(None, "no number here but words", "en", "s1", 1), (30, None, "en", "s1", None), (31, "", None, None, 0)]
    rows += [(32, "a word and nothing else", None, None, None), (5, "another text with the number of five", "en", "s9", 2)]
    rows += [rows[3], rows[3], (33, "token = abcdefghijklmnop1234 and words", "en", "s2", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("lang_found", "score_found", "removed", "id", "n", "c", "u", "spans", "whole", "component_id"):
        docs = docs.withColumn(name, F.lit(name))
    columns, kept = docs.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, None)
        assert out.columns == columns
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        kept.append(docs.count())
        assert all(r.lang_found == "lang_found" and r.removed == "removed" for r in docs.collect())
    # Only the two rows without a letter go at first; all copies of a row, which share its id, stay.
    assert kept == [len(rows) - 2] * 2 + [kept[2]] * 2
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert texts[33].startswith("[redacted]") and {None, 5, 32} <= set(texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, None)
    assert packed.count() >= len(texts)


def test_pipeline_over_an_empty_table(spark, tmp_path):
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([], columns).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_nothing_else_imports_the_subpackage():
    import carelayers

    root = os.path.dirname(carelayers.__file__)
    for folder, _, names in os.walk(root):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as file:
                    assert "carelayers.llm" not in file.read()
