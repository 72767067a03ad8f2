"""Sum and max of an integer column (FIXTURES C6)."""

from __future__ import annotations

import pytest

from tessera.operators.aggregates import list_max, list_sum


@pytest.mark.parametrize(
    "values, total, largest",
    [([4, 9, 1], 14, 9), ([-3, -8], -11, 0), ([], 0, 0), ([1, 2, 0], 3, 2), ([3, 7, 2], 12, 7), ([5, 5, 5], 15, 5)],
)
def test_sum_and_max(spark, values, total, largest):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert list_sum(df).first().list_sum == total
    assert list_max(df).first().list_max == largest


def test_sum_widens_past_32_bits(spark):
    df = spark.createDataFrame([(2**31 - 1,), (2**31 - 1,)], "x int")
    assert list_sum(df).first().list_sum == 2 * (2**31 - 1)
