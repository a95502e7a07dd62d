"""The registered queries of the text package: SQL where there is one, and the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from stopline.llm import queries
from tools.check import rows_of


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_same_rows(spark, sf, name):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    got = queries.QUERIES[name](spark, sf).toPandas()
    want = con.execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline_takes_every_decision(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = {r[0] for r in queries.QUERIES["op4_likelihood_ratio"](spark, sf).where("kept").select("doc_id").collect()}
    first = stages["quality_rules"](spark, docs, sf)
    assert {r[0] for r in first.select("doc_id").collect()} == good
    assert first.columns == docs.columns
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert set(got["doc_id"]) <= good and len(got) and got["doc_id"].is_unique
