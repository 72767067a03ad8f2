"""Exact medians by distributed selection."""

from __future__ import annotations

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.clusters import cluster_results
from tessera.operators.selection import middle_values, truncated_median


def brute(values):
    values = sorted(values)
    n = len(values)
    lower, upper = values[(n - 1) // 2], values[n // 2]
    return lower, upper, n


@pytest.mark.parametrize("bits", [8, 16, 32])
def test_middle_values_equal_brute_force(spark, bits):
    r = random.Random(bits)
    spans = [(0, 0), (-3, 3), (-(1 << 31), (1 << 31) - 1), (1 << 20, (1 << 20) + 40), (-50, -1)]
    rows = [(g, r.randint(*spans[g % 5]), r.choice([0, 1, 1, 2, 9, -1, None])) for g in range(10) for _ in range(r.randrange(1, 80))]
    rows += [(None, 7, 3), (None, None, 5), (99, None, 1), (98, 4, 0)]
    got = middle_values(spark.createDataFrame(rows, "g int, y int, n long"), ["g"], "y", F.col("n"), bits).collect()
    want = {}
    for g, y, n in rows:
        if y is not None and n is not None and n > 0:
            want.setdefault(g, []).extend([y] * n)
    assert {(x.g, x.lower, x.upper, x.n) for x in got} == {(g, *brute(v)) for g, v in want.items()}


def test_median_is_truncated_toward_zero(spark):
    rows = [("a", -3), ("a", 0), ("b", 1), ("b", 4), ("c", -(1 << 31)), ("c", -(1 << 31)), ("d", (1 << 31) - 1), ("d", (1 << 31) - 2)]
    got = truncated_median(spark.createDataFrame(rows, "g string, y int"), ["g"], "y", F.lit(1)).collect()
    assert {x.g: x.median for x in got} == {"a": -1, "b": 2, "c": -(1 << 31), "d": (1 << 31) - 2}


def test_empty_table(spark):
    assert middle_values(spark.createDataFrame([], "g int, y int"), ["g"], "y", F.lit(1)).count() == 0


def test_one_cluster_of_a_million_distinct_scores(spark):
    n = 1_000_000
    points = spark.range(n).select(F.lit(0).alias("x"), ((F.col("id") * 2654435761) % 4294967296 - 2147483648).cast("int").alias("y"))
    results = cluster_results([(0, 0)], points, ["sql", "java"], 50000)
    values = sorted((i * 2654435761) % 4294967296 - 2147483648 for i in range(n))
    assert len(set(values)) == n
    middle = values[n // 2 - 1] + values[n // 2]
    assert [tuple(r) for r in results.collect()] == [("sql", 100.0, n, int(middle / 2))]
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        results.explain("formatted")
    assert "percentile" not in plan.getvalue() and "ObjectHashAggregate" not in plan.getvalue()
