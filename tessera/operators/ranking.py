"""Rank vocabulary terms by the number of articles that mention them.

Three forms with the same counts:

* :func:`rank_langs` - every term, zero counts kept;
* :func:`rank_langs_using_index` - from the inverted index, matched terms only;
* :func:`rank_langs_reduce` - one partial aggregation, matched terms only.

All three make a single pass over the articles: each article contributes one
``(term, article)`` pair per distinct matched term, and the counting is a
``groupBy`` whose partial aggregation runs before the shuffle, so a term
found in a third of all articles still moves only one row per map task.
Ties are broken by reverse vocabulary order (a stable ascending sort that is
then reversed).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import check_vocabulary, mentioned_terms, mentions, term_position
from ..schemas import RANKING
from ..session import literal_frame
from .skew import CHUNK, chunked


TERM = StructType([StructField("lang", StringType())])


def vocabulary_table(spark: SparkSession, terms: Sequence[str]) -> DataFrame:
    """``(lang)``, one row per term, as a plan literal."""
    return literal_frame(spark, [(t,) for t in terms], TERM)


def mentions_filter(articles: DataFrame, lang: str) -> DataFrame:
    """Articles whose text has ``lang`` as a whole space-separated token."""
    return articles.where(mentions("text", lang))


def occurrences_of_lang(articles: DataFrame, lang: str) -> DataFrame:
    """One row ``(lang, n)``: how many articles mention ``lang`` (0 when none)."""
    counted = articles.agg(F.count_if(mentions("text", lang)).alias("n"))
    return counted.select(F.lit(lang).alias("lang"), F.col("n"))


def language_article_pairs(articles: DataFrame, langs: Sequence[str], keep: Sequence[str] = ("title",)) -> DataFrame:
    """One row per (term, article) where the article mentions the term.

    An article repeating a term still yields one pair. Columns: ``lang`` then
    ``keep``. The match is a narrow projection against the vocabulary as a
    literal array, a parameter of the query, whatever its length.
    """
    terms = check_vocabulary(langs)
    return articles.select(F.explode(mentioned_terms("text", terms)).alias("lang"), *keep)


def make_index(articles: DataFrame, langs: Sequence[str]) -> DataFrame:
    """Inverted index in long form: ``(lang, title, text)``, one row per posting.

    Terms without any match are absent. The index is not gathered into one
    row per term: a common term may hold a large share of all articles, and
    a row holding all of them would not fit one task. Counting or filtering
    by ``lang`` works on the long form directly; :func:`posting_lists` is the nested form.
    """
    return language_article_pairs(articles, langs, keep=("title", "text"))


def posting_lists(articles: DataFrame, langs: Sequence[str], size: int = CHUNK, keep: Sequence[str] = ("title", "text"), partitions: int | None = None) -> DataFrame:
    """Inverted index in nested form: ``(lang, chunk, articles, n)``.

    ``articles`` is an array of structs of ``keep`` with at most ``size`` entries and ``n`` their number. The
    posting list of a common term has several chunks, numbered from 0 and full but for the last, in the
    order of the md5 of the first column of ``keep``, so no row and no task holds all of it. Terms without
    any match are absent. Exploded, the chunks are the long form.
    """
    pairs = language_article_pairs(articles, langs, keep=keep)
    return chunked(pairs, "lang", keep[0], list(keep), size, "articles", partitions=partitions)


def rank_langs(articles: DataFrame, langs: Sequence[str]) -> DataFrame:
    """``(lang, n)`` for every term, most mentioned first; zero counts kept."""
    terms = check_vocabulary(langs)
    spark = articles.sparkSession
    hits = language_article_pairs(articles, terms, keep=()).select("lang", F.lit(1).alias("w"))
    # Zero rows for every term let one aggregation produce the zero counts.
    zeros = vocabulary_table(spark, terms).select("lang", F.lit(0).alias("w"))
    counts = hits.unionByName(zeros).groupBy("lang").agg(F.sum("w").cast("long").alias("n"))
    return order_ranking(counts, terms)


def rank_langs_using_index(index: DataFrame, langs: Sequence[str] | None = None) -> DataFrame:
    """``(lang, n)`` = size of each term's posting list, most mentioned first.

    ``index`` is in long form (its rows are counted) or in chunks with their sizes ``n`` (which are
    added; the lists are not read). Ties follow reverse vocabulary order when ``langs`` is given, else
    reverse alphabetical order.
    """
    size = F.sum("n") if "chunk" in index.columns else F.count(F.lit(1))
    counts = index.groupBy("lang").agg(size.alias("n"))
    return order_ranking(counts, langs)


def term_counts(articles: DataFrame, langs: Sequence[str]) -> DataFrame:
    """``(lang, n)`` of the matched terms, unordered: the table that all three rankings follow from.

    One scan, computed at once: at most one row per term of the vocabulary reaches the driver and
    comes back as a literal.
    """
    counts = language_article_pairs(articles, langs, keep=()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return literal_frame(articles.sparkSession, [(r["lang"], r["n"]) for r in counts.collect()], RANKING)


def zero_filled(counts: DataFrame, langs: Sequence[str]) -> DataFrame:
    """``(lang, n)`` for every term, in order, from the counts of the matched ones."""
    terms = check_vocabulary(langs)
    zeros = vocabulary_table(counts.sparkSession, terms).select("lang", F.lit(0).cast("long").alias("n"))
    return order_ranking(counts.unionByName(zeros).groupBy("lang").agg(F.sum("n").cast("long").alias("n")), terms)


def rank_langs_reduce(articles: DataFrame, langs: Sequence[str]) -> DataFrame:
    """``(lang, n)`` for matched terms via one partially aggregated count."""
    terms = check_vocabulary(langs)
    counts = language_article_pairs(articles, terms, keep=()).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return order_ranking(counts, terms)


def order_ranking(counts: DataFrame, langs: Sequence[str] | None) -> DataFrame:
    """Sort ``(lang, n)`` by count descending, ties in reverse vocabulary order."""
    if langs is None:
        return counts.orderBy(F.desc("n"), F.desc("lang")).select("lang", "n")
    return counts.orderBy(F.desc("n"), F.desc(term_position("lang", list(langs)))).select("lang", "n")
