"""Registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

import os

import duckdb
import pytest

import corpus_pipeline
from tessera.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = [tuple(r[c] for c in columns) for r in QUERIES[name](spark, SF).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want.fetchall()))


def test_pipeline(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, last = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = os.path.join(tmp_dir, name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        if name in ("exact_duplicates", "near_duplicates"):
            assert docs.count() == docs.select("text").distinct().count() <= last
        last = docs.count()
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
