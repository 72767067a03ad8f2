"""Exact order statistics of groups by distributed selection.

The values of a group are never gathered or sorted. A round counts them by the next digit of
their order-preserving code, finds in the running counts the digit that holds the wanted
rank, and the next round counts only values with the digits found so far. A round shuffles
at most one row per group and digit from each map task, whatever the number of rows or of
distinct values, so one group may hold all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of a digit: a round counts at most 2**DIGIT_BITS ranges a group.
DIGIT_BITS = 16
INT_BITS = 32
INT_MIN = -(1 << 31)


def middle_values(rows: DataFrame, by: Sequence[str], value: str, weight: Column, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """``(*by, lower, upper, n)``: the two middle values of an integer column in each group.

    With ``n`` the weight of a group, counted by ``weight``, these are the values of rank
    ``(n - 1) div 2`` and ``n div 2`` in ascending order from 0; they are one and the same if ``n``
    is odd. Null values, null weights and weights of 0 or less take no part; null group keys form a
    group.
    """
    by = list(by)
    shifts = list(range(INT_BITS, 0, -digit_bits))[1:] + [0]
    code = F.col(value).cast("long") - F.lit(INT_MIN).cast("long")
    coded = rows.select(*by, code.alias("_code"), weight.cast("long").alias("_w")).where(F.col("_code").isNotNull() & (F.col("_w") > 0))

    # First digits, group sizes and from them the two ranks, all from one small count table.
    counts = coded.groupBy(*by, F.shiftright("_code", shifts[0]).alias("_digit")).agg(F.sum("_w").alias("_c"))
    group = Window.partitionBy(*by)
    counts = counts.select("*", F.sum("_c").over(group.orderBy("_digit")).alias("_upto"), F.sum("_c").over(group).alias("n"))
    ranks = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.expr("(n - 1) div 2").alias("rank")), F.struct(F.lit(1).alias("side"), F.expr("n div 2").alias("rank"))))
    found = counts.select("*", ranks.alias("_r")).where(_holds(F.col("_r.rank")))
    found = found.select(*by, "n", F.col("_r.side").alias("_side"), F.col("_digit").alias("_prefix"), (F.col("_r.rank") - (F.col("_upto") - F.col("_c"))).alias("_rank"))

    for above, shift in zip(shifts, shifts[1:]):
        # One or two rows a group; each starts a chain of its own, so every round reads the rows once.
        wanted = found.select(*[F.col(c).alias(f"_g_{c}") for c in by], "n", "_side", "_prefix", "_rank")
        same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by] + [F.shiftright("_code", above) == F.col("_prefix")]
        counts = coded.join(wanted, same).groupBy(*by, "n", "_side", "_rank", F.shiftright("_code", shift).alias("_digit")).agg(F.sum("_w").alias("_c"))
        counts = counts.withColumn("_upto", F.sum("_c").over(Window.partitionBy(*by, "_side").orderBy("_digit")))
        found = counts.where(_holds(F.col("_rank")))
        found = found.select(*by, "n", "_side", F.col("_digit").alias("_prefix"), (F.col("_rank") - (F.col("_upto") - F.col("_c"))).alias("_rank"))

    exact = F.col("_prefix") + F.lit(INT_MIN).cast("long")
    return found.groupBy(*by).agg(
        F.min(F.when(F.col("_side") == 0, exact)).alias("lower"), F.min(F.when(F.col("_side") == 1, exact)).alias("upper"), F.min("n").alias("n")
    )


def _holds(rank: Column) -> Column:
    """Whether the running count of a digit passes ``rank`` and that of the digit before does not."""
    return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)


def truncated_median(rows: DataFrame, by: Sequence[str], value: str, weight: Column, digit_bits: int = DIGIT_BITS) -> DataFrame:
    """``(*by, median)``: the middle value, or the mean of the two middle ones truncated toward zero."""
    middle = middle_values(rows, by, value, weight, digit_bits)
    return middle.select(*by, F.call_function("div", F.col("lower") + F.col("upper"), F.lit(2)).cast("int").alias("median"))
