"""Spark-side bindings of the supplied parquet tables to the operators' inputs.

Each binding is a lazy DataFrame over ``{sf_dir}/{table}.parquet``; column
pruning and filters reach the parquet scan. The matching DuckDB bindings
live in :mod:`tessera.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import postings as qa
from ..sources.articles import parse_articles
from ..sources.postings import parse_postings

# ---------------------------------------------------------------------------
# Fixed values of the test bindings
# ---------------------------------------------------------------------------

# Article vocabulary: punctuation-attached and case variants are distinct
# tokens; the last term matches nothing.
ARTICLE_TERMS: tuple[str, ...] = (
    "the", "and", "of", "en", "the,", "The", "de", "la", "die", "und", "zzz-none",
)
# Term used by the single-term keys.
SINGLE_TERM = "the"

# Article line framing: 14-character prefix and 16-character tail.
ARTICLE_PREFIX = "<page> <title>"
ARTICLE_SUFFIX = "</text>  </page>"

# Question tags used as the clustering vocabulary (4-NOT SPECIFIED is left out).
TAG_TERMS: tuple[str, ...] = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
CLUSTER_SPREAD = 50000
CLUSTER_KERNELS = 12
CLUSTER_ETA = 20.0
CLUSTER_MAX_ITERATIONS = 120
CLUSTER_SEED = 42
# Spread that takes the whole-space sampling branch.
SMALL_SPREAD = 100

# Most entries of a chunk of a question's pairs and of a term's posting list.
PAIR_CHUNK = 4
LIST_CHUNK = 64

# Survey minute columns, for l_linenumber = 1..7 in this order.
SURVEY_MINUTE_COLUMNS: tuple[str, ...] = (
    "t010101", "t180301", "t050101", "t180501", "t120101", "t180201", "t500101",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet`` as it is stored."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def article_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` = prefix, document id as title, separator, text, tail.

    Built as a column (texts hold newlines, so a rendered text file would
    split them).
    """
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.concat(
            F.lit(ARTICLE_PREFIX),
            F.col("doc_id").cast("string"),
            F.lit("</title><text>"),
            F.col("text"),
            F.lit(ARTICLE_SUFFIX),
        ).alias("value")
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_articles(article_lines(spark, sf_dir))


def posting_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions from orders, answers from line items, as posting lines."""
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    question_lines = orders.select(
        F.concat(
            F.lit("1,"), F.col("o_orderkey").cast("string"), F.lit(",,,0,"), F.col("o_orderpriority")
        ).alias("value")
    )
    answer_lines = lineitem.select(
        F.concat(
            F.lit("2,"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"),
            F.lit(",,"),
            F.col("l_orderkey").cast("string"),
            F.lit(","),
            (F.col("l_quantity").cast("int") - 25).cast("string"),
        ).alias("value")
    )
    return question_lines.unionByName(answer_lines)


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_postings(posting_lines(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str, spread: int = CLUSTER_SPREAD) -> DataFrame:
    """``(x, y)`` for every answered question with a tag in ``TAG_TERMS``."""
    return qa.question_vectors(postings(spark, sf_dir), TAG_TERMS, spread)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One respondent per order; minute column i = quantity of line i (0 if none).

    The seven minute columns come from one conditional aggregation of the
    line items by order key, then a left join onto orders on that same key.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    minutes = lineitem.groupBy("l_orderkey").agg(
        *[
            F.sum(F.when(F.col("l_linenumber") == i, F.col("l_quantity"))).alias(name)
            for i, name in enumerate(SURVEY_MINUTE_COLUMNS, start=1)
        ]
    )
    joined = orders.join(minutes, orders.o_orderkey == minutes.l_orderkey, "left")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("tucaseid"),
        (F.col("o_orderkey") % 5 + 1).alias("telfs"),
        (F.col("o_custkey") % 2 + 1).alias("tesex"),
        (F.lit(15) + F.col("o_custkey") % 60).alias("teage"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("int").alias(c) for c in SURVEY_MINUTE_COLUMNS],
    )


def survey_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey table with every column cast to string."""
    df = survey(spark, sf_dir)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def integers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer column ``x`` = quantity - 25 (negative values included)."""
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select((F.col("l_quantity").cast("int") - 25).alias("x"))
