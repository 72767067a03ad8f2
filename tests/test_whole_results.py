"""Registered queries whose result is every pair, on tables made here."""

from __future__ import annotations

import pytest

from tessera.plans import QUERIES
from tessera.plans import bindings as B
from tessera.schemas import POSTING_COLUMNS


@pytest.fixture
def sf_dir(spark, tmp_dir):
    """20 orders, five of each tag, of which the last five have no line."""
    orders = [(i, B.TAG_TERMS[i % 4]) for i in range(20)]
    lines = [(i, n, float(20 + i * 3 + n)) for i in range(15) for n in (1, 2)] + [(99, 1, 5.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderpriority string").coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_quantity double").coalesce(1).write.parquet(f"{tmp_dir}/lineitem.parquet")
    return tmp_dir


def test_a_pair_has_every_field_of_both_postings(spark, sf_dir):
    pairs = QUERIES["question_answer_join"](spark, sf_dir)
    assert pairs.columns == ["q_" + c for c in POSTING_COLUMNS] + ["a_" + c for c in POSTING_COLUMNS]
    want = [(1, i, None, None, 0, B.TAG_TERMS[i % 4], 2, i * 10 + n, None, i, i * 3 + n - 5, None) for i in range(15) for n in (1, 2)]
    assert sorted(map(str, map(tuple, pairs.collect()))) == sorted(map(str, want))


def test_every_point_against_every_starting_centre(spark, sf_dir):
    points = {(i % 4 * B.CLUSTER_SPREAD, max(0, i * 3 - 3)) for i in range(15)}
    centres = [(r.pos, r.x, r.y) for r in QUERIES["sample_per_language"](spark, sf_dir).collect()]
    found = QUERIES["point_distance"](spark, sf_dir)
    assert found.columns == ["x", "y", "pos", "cx", "cy", "distance"]
    want = [(x, y, pos, cx, cy, float((x - cx) ** 2 + (y - cy) ** 2)) for x, y in points for pos, cx, cy in centres]
    assert sorted(map(tuple, found.collect())) == sorted(want) and len(want) == len(points) * B.CLUSTER_KERNELS
