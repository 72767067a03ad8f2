"""Session helpers: partition sizing and reliable materialization."""

from __future__ import annotations

import os

import pytest

from tessera.session import QueryScope, checkpoint_dir, materialize, release, scale_settings


def test_scale_settings():
    small = scale_settings(10 << 20)
    assert small["spark.sql.shuffle.partitions"] == "200"
    ten_tb = scale_settings(10 << 40)
    assert int(ten_tb["spark.sql.shuffle.partitions"]) == (10 << 40) // (2048 << 20)
    big = scale_settings(100 << 40)
    assert big["spark.sql.shuffle.partitions"] == "50000"
    assert big["spark.sql.files.maxPartitionBytes"] == str(512 << 20)


def test_materialize_writes_a_table(spark):
    folder = checkpoint_dir(spark)
    assert folder, "tests run with a checkpoint folder"
    df = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    done = materialize(df)
    assert sorted(r["count"] for r in done.collect()) == sorted(r["count"] for r in df.collect())
    # The lineage is cut: the plan now starts from the written rows.
    assert "Aggregate" not in done._jdf.queryExecution().analyzed().toString()
    local = folder.removeprefix("file:")
    assert any(files for _, _, files in os.walk(local))
    before = set(os.listdir(local))
    release(done)
    gone = before - set(os.listdir(local))
    assert len(gone) == 1 and gone.pop().startswith("materialized-")
    release(done)


def test_a_scope_leaves_nothing_even_if_it_fails(spark):
    local = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(local))
    with pytest.raises(RuntimeError), QueryScope() as scope:
        assert scope.materialize(spark.range(5)).count() == scope.materialize(spark.range(5)).count() == 5
        raise RuntimeError
    assert set(os.listdir(local)) == before
    with QueryScope() as scope:
        kept = scope.result(scope.materialize(spark.range(3)), 3)
        with pytest.raises(ValueError, match="more than 2"):
            scope.result(spark.range(3), 2)
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2]


def test_clustering_keys_leave_no_table_and_no_folder(spark):
    from tessera.plans import QUERIES

    local, cached = checkpoint_dir(spark).removeprefix("file:"), spark.sparkContext._jsc.getPersistentRDDs()
    files, tables = set(os.listdir(local)), cached.size()
    keys = ["point_distance", "nearest_center", "average_vectors", "kmeans_step", "centers_distance", "kmeans", "kmeans_trace", "cluster_results", "cluster_report"]
    for key in keys:
        assert QUERIES[key](spark, "/root/testdata/sf0.001").collect(), key
        assert set(os.listdir(local)) == files and spark.sparkContext._jsc.getPersistentRDDs().size() == tables, key


def test_materialize_without_checkpoint_folder_persists(spark, monkeypatch):
    import tessera.session as session

    monkeypatch.setattr(session, "checkpoint_dir", lambda _spark: None)
    df = spark.range(100).selectExpr("id % 3 AS k").groupBy("k").count()
    done = session.materialize(df)
    assert done.storageLevel.useDisk and done.storageLevel.useMemory
    assert sorted(r["count"] for r in done.collect()) == [33, 33, 34]
    session.release(done)
    assert not done.storageLevel.useMemory


def test_literal_frame(spark):
    from tessera.schemas import CENTRE
    from tessera.session import literal_frame

    df = literal_frame(spark, [(0, 1, 2), (1, -3, None)], CENTRE)
    assert df.dtypes == [("pos", "int"), ("x", "int"), ("y", "int")]
    assert [tuple(r) for r in df.collect()] == [(0, 1, 2), (1, -3, None)]
    empty = literal_frame(spark, [], CENTRE)
    assert empty.dtypes == df.dtypes and empty.count() == 0
    assert "Scan ExistingRDD" not in df._jdf.queryExecution().executedPlan().toString()
