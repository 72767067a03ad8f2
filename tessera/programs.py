"""The three programs' main flows, from input files to result DataFrames.

Each function reads its input with the sources, applies the operators with
the default constants and returns DataFrames; printing (``show``) is left to
the caller. Nothing here gathers data on the driver except the k centres of
the clustering.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .constants import (
    KMEANS_ETA,
    KMEANS_KERNELS,
    KMEANS_MAX_ITERATIONS,
    LANG_SPREAD,
    LANGUAGES,
    SAMPLE_SEED,
)
from .operators import clustering, clusters, postings, ranking, sampling, survey
from .session import QueryScope
from .sources import parse_articles, parse_postings, read_lines, read_survey


@dataclass
class Rankings:
    """The three rankings of one article set."""

    naive: DataFrame  # every term, zero counts kept
    using_index: DataFrame  # matched terms, by the size of their posting lists
    reduce: DataFrame  # matched terms, one partial aggregation


def rank_article_file(spark: SparkSession, path: str, langs: Sequence[str] = LANGUAGES) -> Rankings:
    """Article lines at ``path`` -> the three rankings of ``langs``.

    The file is read once: the size of a term's posting list, the number of articles that mention it and
    the count by key are one number, so all three rankings follow from one table of counts.
    """
    counts = ranking.term_counts(parse_articles(read_lines(spark, path)), langs)
    ordered = ranking.order_ranking(counts, langs)
    return Rankings(naive=ranking.zero_filled(counts, langs), using_index=ordered, reduce=ordered)


@dataclass
class Clustering:
    """Outcome of clustering a posting file."""

    kmeans: clustering.KMeansResult
    results: DataFrame  # CLUSTER_RESULT, sorted by median score
    report: DataFrame  # one fixed-width line per cluster


def cluster_posting_file(
    spark: SparkSession,
    path: str,
    langs: Sequence[str] = LANGUAGES,
    spread: int = LANG_SPREAD,
    kernels: int = KMEANS_KERNELS,
    eta: float = KMEANS_ETA,
    max_iterations: int = KMEANS_MAX_ITERATIONS,
    seed: int = SAMPLE_SEED,
    on_empty: str = "error",
    debug: bool = False,
) -> Clustering:
    """Posting lines at ``path`` -> vectors -> starting centres -> k-means -> report.

    The vectors are reduced to ``(x, y, n)`` once and cut from their lineage;
    sampling, every k-means step and the report read that table, which is gone when this returns.
    """
    with QueryScope() as scope:
        vectors = postings.question_vectors(parse_postings(read_lines(spark, path)), langs, spread)
        points = scope.materialize(postings.weighted_vectors(vectors))
        centres = sampling.take_centres(sampling.sample_vectors(points, langs, kernels, spread, seed))
        result = clustering.kmeans(
            points, centres, eta=eta, max_iterations=max_iterations, on_empty=on_empty, debug=debug, cache_points=False
        )
        results = scope.result(clusters.cluster_results(result.centres, points, langs, spread), kernels)
    return Clustering(kmeans=result, results=results, report=clusters.cluster_report(results))


def time_usage_by_life_period(spark: SparkSession, path: str) -> DataFrame:
    """Survey CSV at ``path`` -> average hours per (working, sex, age), sorted."""
    columns, df = read_survey(spark, path)
    primary, work, other = survey.classified_columns(columns)
    return survey.time_usage_grouped(survey.time_usage_summary(primary, work, other, df))
