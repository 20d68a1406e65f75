"""Queries against their SQL, and the pipeline against its stages' promises."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from growthlab.llm import pii, queries
from tests.llm import plain

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "conversations", "pages")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    frame = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted(map(str, (tuple(r) for r in frame.select(columns).collect())))
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert got == sorted(map(str, want)) and got


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)))
def test_other_queries_return_whole_tables(spark, name):
    frame = entry.queries()[name](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert frame.count() == docs or name == "op1_benchmark_leaks"


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    dirty = [(None, None, "en", "src0", 0), (None, "", None, None, None), (5, "x y z", "en", "src0", 5)]
    docs = docs.unionByName(spark.createDataFrame(dirty, docs.schema)).unionByName(docs.limit(3))
    bench = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, FOLDER)
        after = docs.collect()
        assert docs.columns == columns, name
        ids = {(r.doc_id, r.text) for r in before}
        if name != "personal data":
            assert {(r.doc_id, r.text) for r in after} <= ids
        if name == "near duplicates":
            classes = plain.near([(f"{r.doc_id:09}", r.text) for r in before if r.doc_id is not None], 5)
            kept = {f"{r.doc_id:09}" for r in after if r.doc_id is not None}
            assert kept == {c for _, c in classes.values()} and len({r.doc_id for r in after}) == len(after)
        if name == "benchmark leaks":
            leaked = {r.doc_id for r in before if any(b in (r.text or "") for b in bench)}
            assert {r.doc_id for r in before} - {r.doc_id for r in after} == leaked
        if name == "personal data":
            assert len(after) == len(before) and not any(pii.base_spans(r.text or "") for r in after)
            assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in last.collect()} <= {r.doc_id for r in after}
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_pipeline_with_clashing_columns_and_a_long_text(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    long = " ".join(f"{w} {k}" for k in range(60_000) for w in ("the", "and", "of"))
    docs = docs.unionByName(spark.createDataFrame([(900_000, long, "en", "src1", len(long))], docs.schema))
    names = ["kept", "score", "_row", "marks", "extra", "_good", "n_words", "base", "_print", "component_id"]
    docs = docs.withColumns({n: F.lit(k) for k, n in enumerate(names)})
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        first = docs.select(names).distinct().collect()
        assert [tuple(r) for r in first] == [tuple(range(len(names)))], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() > 0


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
