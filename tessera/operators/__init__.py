"""DataFrame -> DataFrame operators built from Spark's own columns, joins and aggregations."""

from .aggregates import list_max, list_sum
from .clusters import cluster_report, cluster_results
from .clustering import (
    EmptyClusterError,
    KMeansResult,
    assign,
    average_vectors,
    centers_distance,
    centres_frame,
    kmeans,
    kmeans_step,
    nearest_center,
    point_distance,
)
from .postings import (
    answers,
    grouped_postings,
    question_answer_join,
    question_vectors,
    questions,
    scored_postings,
    vector_postings,
    weighted_vectors,
)
from .ranking import (
    language_article_pairs,
    make_index,
    mentions_filter,
    occurrences_of_lang,
    posting_lists,
    rank_langs,
    rank_langs_reduce,
    rank_langs_using_index,
    term_counts,
    zero_filled,
)
from .sampling import distinct_vectors, sample_global, sample_per_language, sample_vectors, take_centres
from .survey import (
    classified_columns,
    classify_columns,
    time_usage_grouped,
    time_usage_grouped_sql,
    time_usage_grouped_sql_query,
    time_usage_grouped_typed,
    time_usage_summary,
    time_usage_summary_typed,
)

__all__ = [
    "EmptyClusterError",
    "KMeansResult",
    "answers",
    "assign",
    "average_vectors",
    "centers_distance",
    "centres_frame",
    "classified_columns",
    "classify_columns",
    "cluster_report",
    "cluster_results",
    "distinct_vectors",
    "grouped_postings",
    "kmeans",
    "kmeans_step",
    "language_article_pairs",
    "list_max",
    "list_sum",
    "make_index",
    "mentions_filter",
    "nearest_center",
    "occurrences_of_lang",
    "posting_lists",
    "point_distance",
    "question_answer_join",
    "question_vectors",
    "questions",
    "rank_langs",
    "rank_langs_reduce",
    "rank_langs_using_index",
    "term_counts",
    "sample_global",
    "sample_per_language",
    "sample_vectors",
    "scored_postings",
    "take_centres",
    "time_usage_grouped",
    "time_usage_grouped_sql",
    "time_usage_grouped_sql_query",
    "time_usage_grouped_typed",
    "time_usage_summary",
    "time_usage_summary_typed",
    "vector_postings",
    "weighted_vectors",
    "zero_filled",
]
