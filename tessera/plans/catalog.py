"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the supplied tables whole (no id subsets, no row caps).
The clustering keys share one preparation: the vectors are reduced to
``(x, y, n)``, the starting centres are drawn from that table, and k-means runs over it. What a
key materializes on the way is gone when it returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregates, clusters, postings, ranking, sampling, survey
from ..operators import clustering as km
from ..schemas import CENTRE_MOVE
from ..session import QueryScope, literal_frame
from ..sources.survey import survey_typed
from . import bindings as B

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def list_digest(column: str, *fields: str) -> Column:
    """The md5 of the given fields of a list's entries, in order."""
    entry = lambda e: F.concat_ws(":", *[e[f].cast("string") for f in fields])
    return F.md5(F.array_join(F.transform(column, entry), ",").cast("binary"))


# -- text ranking ------------------------------------------------------------


@query("parse_articles")
def parse_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.articles(spark, sf_dir)


@query("mentions_filter")
def mentions_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.mentions_filter(B.articles(spark, sf_dir), B.SINGLE_TERM)


@query("occurrences_of_lang")
def occurrences_of_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.occurrences_of_lang(B.articles(spark, sf_dir), B.SINGLE_TERM)


@query("language_article_pairs")
def language_article_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.language_article_pairs(B.articles(spark, sf_dir), B.ARTICLE_TERMS)


@query("rank_langs")
def rank_langs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_langs(B.articles(spark, sf_dir), B.ARTICLE_TERMS)


@query("make_index")
def make_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.make_index(B.articles(spark, sf_dir), B.ARTICLE_TERMS)


@query("posting_lists")
def posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk of every term, its list of articles as a digest of titles and lengths in order."""
    chunks = ranking.posting_lists(B.articles(spark, sf_dir), B.ARTICLE_TERMS, B.LIST_CHUNK)
    sized = chunks.withColumn("articles", F.transform("articles", lambda a: F.struct(a["title"], F.length(a["text"]).alias("size"))))
    return sized.select("lang", "chunk", "n", list_digest("articles", "title", "size").alias("articles_md5"))


@query("rank_langs_using_index")
def rank_langs_using_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranking.make_index(B.articles(spark, sf_dir), B.ARTICLE_TERMS)
    return ranking.rank_langs_using_index(index, B.ARTICLE_TERMS)


@query("rank_langs_reduce")
def rank_langs_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_langs_reduce(B.articles(spark, sf_dir), B.ARTICLE_TERMS)


# -- postings ----------------------------------------------------------------


@query("parse_postings")
def parse_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.postings(spark, sf_dir)


@query("questions")
def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.questions(B.postings(spark, sf_dir))


@query("answers")
def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.answers(B.postings(spark, sf_dir))


@query("question_answer_join")
def question_answer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.question_answer_join(B.postings(spark, sf_dir))


@query("grouped_postings")
def grouped_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk of every question, its list of pairs as a digest of the answers in order."""
    chunks = postings.grouped_postings(B.postings(spark, sf_dir), size=B.PAIR_CHUNK)
    return chunks.select("qid", "chunk", "n", list_digest("pairs", "a_id", "a_score").alias("pairs_md5"))


@query("scored_postings")
def scored_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.scored_postings(B.postings(spark, sf_dir))


@query("vector_postings")
def vector_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.vectors(spark, sf_dir)


# -- sampling and k-means ----------------------------------------------------


def weighted_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted vectors ``(x, y, n)``, a lazy plan over the supplied tables."""
    return postings.weighted_vectors(B.vectors(spark, sf_dir, B.CLUSTER_SPREAD))


def starting_centres(points: DataFrame) -> list:
    return sampling.take_centres(starting_sample(points))


def starting_sample(points: DataFrame) -> DataFrame:
    return sampling.sample_per_language(points, B.TAG_TERMS, B.CLUSTER_KERNELS, B.CLUSTER_SEED)


def run_kmeans(points: DataFrame, centres) -> km.KMeansResult:
    return km.kmeans(
        points,
        centres,
        eta=B.CLUSTER_ETA,
        max_iterations=B.CLUSTER_MAX_ITERATIONS,
        cache_points=False,
    )


@query("distinct_vectors")
def distinct_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.distinct_vectors(B.vectors(spark, sf_dir))


@query("sample_per_language")
def sample_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return starting_sample(B.vectors(spark, sf_dir))


@query("sample_global")
def sample_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = B.vectors(spark, sf_dir, B.SMALL_SPREAD)
    return sampling.sample_global(vectors, B.CLUSTER_KERNELS, B.CLUSTER_SEED)


# Keys whose result grows with the points read the tables once for the centres and once for the result.
# The others have at most a row per centre: they run inside a scope, on points that are computed
# once, and nothing of it is left when the key returns.


@query("point_distance")
def point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = weighted_points(spark, sf_dir)
    return km.point_distance(points, starting_centres(points))


@query("nearest_center")
def nearest_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = weighted_points(spark, sf_dir)
    return km.nearest_center(points, starting_centres(points))


@query("average_vectors")
def average_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    with QueryScope() as scope:
        points = scope.materialize(weighted_points(spark, sf_dir))
        assigned = km.assign(points, starting_centres(points))
        return scope.result(km.average_vectors(assigned, by=("cx", "cy")), B.CLUSTER_KERNELS)


@query("kmeans_step")
def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    with QueryScope() as scope:
        points = scope.materialize(weighted_points(spark, sf_dir))
        centres = starting_centres(points)
        new = km.kmeans_step(points, centres)
    rows = [(i, o[0], o[1], n[0], n[1]) for i, (o, n) in enumerate(zip(centres, new))]
    return literal_frame(spark, rows, CENTRE_MOVE)


@query("centers_distance")
def centers_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    with QueryScope() as scope:
        points = scope.materialize(weighted_points(spark, sf_dir))
        centres = starting_centres(points)
        return km.centers_distance_of(spark, centres, km.kmeans_step(points, centres))


@query("kmeans")
def kmeans_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    with QueryScope() as scope:
        points = scope.materialize(weighted_points(spark, sf_dir))
        return run_kmeans(points, starting_centres(points)).centres_frame(spark)


@query("kmeans_trace")
def kmeans_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    with QueryScope() as scope:
        points = scope.materialize(weighted_points(spark, sf_dir))
        return run_kmeans(points, starting_centres(points)).trace_frame(spark)


@query("cluster_results")
def cluster_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    with QueryScope() as scope:
        points = scope.materialize(weighted_points(spark, sf_dir))
        result = run_kmeans(points, starting_centres(points))
        return scope.result(clusters.cluster_results(result.centres, points, B.TAG_TERMS, B.CLUSTER_SPREAD), B.CLUSTER_KERNELS)


@query("cluster_report")
def cluster_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_report(cluster_results(spark, sf_dir))


# -- time-use survey -----------------------------------------------------------


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = B.survey(spark, sf_dir)
    primary, work, other = survey.classified_columns(df.columns)
    return survey.time_usage_summary(primary, work, other, df)


@query("survey_typed")
def survey_typed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_typed(B.survey_strings(spark, sf_dir))


@query("classify_columns")
def classify_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.classify_columns(B.survey(spark, sf_dir))


@query("time_usage_summary")
def time_usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(spark, sf_dir)


@query("time_usage_summary_typed")
def time_usage_summary_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_summary_typed(summary(spark, sf_dir))


@query("time_usage_grouped")
def time_usage_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_grouped(summary(spark, sf_dir))


@query("time_usage_grouped_sql")
def time_usage_grouped_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_grouped_sql(summary(spark, sf_dir))


@query("time_usage_grouped_typed")
def time_usage_grouped_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey.time_usage_grouped_typed(survey.time_usage_summary_typed(summary(spark, sf_dir)))


# -- list aggregates -------------------------------------------------------------


@query("list_sum")
def list_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.list_sum(B.integers(spark, sf_dir))


@query("list_max")
def list_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.list_max(B.integers(spark, sf_dir))
