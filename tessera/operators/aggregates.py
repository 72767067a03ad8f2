"""Sum and maximum of an integer column (global aggregates, partial per task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def list_sum(df: DataFrame, column: str = "x") -> DataFrame:
    """One row ``list_sum``: the sum as bigint, 0 for no rows."""
    return df.agg(F.coalesce(F.sum(F.col(column)).cast("long"), F.lit(0).cast("long")).alias("list_sum"))


def list_max(df: DataFrame, column: str = "x") -> DataFrame:
    """One row ``list_max``: the largest value, but never below 0 (0 for no rows)."""
    return df.agg(F.greatest(F.coalesce(F.max(F.col(column)), F.lit(0)), F.lit(0)).alias("list_max"))
