"""Per-cluster report: dominant term, its share, size and median score.

Computed on the ``(x, y, n)`` form: the points are assigned to their nearest
centre by a narrow projection and counted per (centre, x). The median is exact and
found by selection (:mod:`.selection`): rounds of counting by score range, so that
no task holds the scores of a cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CLUSTER_REPORT_FORMAT
from ..functions.geometry import Point
from ..functions.text import check_vocabulary, vocabulary_array
from .clustering import weight_column, assign, int_div
from .selection import truncated_median


def cluster_results(
    centres: Sequence[Point], points: DataFrame, langs: Sequence[str], spread: int
) -> DataFrame:
    """``(lang, lang_percent, cluster_size, median_score)`` per non-empty cluster.

    * ``lang`` - the term whose x occurs most often in the cluster (ties: smaller x);
    * ``lang_percent`` - its count * 100 div the cluster size, as a double
      (whole percents);
    * ``median_score`` - middle score, or the mean of the two middle scores
      truncated toward zero.

    Clusters are keyed by centre value (duplicate centres give one row) and
    sorted by median score, then term and size.
    """
    terms = check_vocabulary(langs)
    weighted = points.select("x", "y", weight_column(points).alias("n"))
    assigned = assign(weighted, centres)
    per_term = assigned.groupBy("cx", "cy", "x").agg(F.sum("n").alias("cnt"))
    dominant = per_term.groupBy("cx", "cy").agg(
        F.max(F.struct(F.col("cnt"), (-F.col("x")).alias("neg_x"))).alias("top"),
        F.sum("cnt").alias("cluster_size"),
    )
    medians = truncated_median(assigned, ["cx", "cy"], "y", F.col("n"))
    joined = dominant.join(medians, ["cx", "cy"])
    top_x = -F.col("top.neg_x")
    result = joined.select(
        F.element_at(vocabulary_array(terms), int_div(top_x, F.lit(spread)).cast("int") + 1).alias("lang"),
        int_div(F.col("top.cnt") * 100, F.col("cluster_size")).cast("double").alias("lang_percent"),
        F.col("cluster_size").cast("long").alias("cluster_size"),
        F.col("median").alias("median_score"),
    )
    return result.orderBy("median_score", "lang", "cluster_size")


def cluster_report(results: DataFrame) -> DataFrame:
    """One fixed-width text ``line`` per cluster, in the order of ``results``."""
    return results.select(
        F.format_string(
            CLUSTER_REPORT_FORMAT,
            F.col("median_score"),
            F.col("lang"),
            F.col("lang_percent"),
            F.col("cluster_size"),
        ).alias("line")
    )
