"""Every registered query against its DuckDB oracle on the smallest supplied tables."""

from __future__ import annotations

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import ORACLE_SQL, QUERIES

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(HERE, "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert len(QUERIES) == 37


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF)
    stypes = {f.name: check.spark_family(f.dataType) for f in sdf.schema.fields}
    got_cols, got = check.rows_of(sdf.toPandas())
    rel = con.sql(ORACLE_SQL[key])
    dtypes = {n: check.duck_family(t) for n, t in zip(rel.columns, rel.types)}
    want_cols, want = check.rows_of(rel.df())
    assert got_cols == want_cols
    assert stypes == dtypes
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["lang", "n"]
    assert df.count() == 11
