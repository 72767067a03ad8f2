"""Questions, answers, their join, best scores and 2-D vectors.

Scoring never gathers a question's answers: scores are reduced by parent id,
combined map-side (one row per question per map task, so a question holding a third of all
answers is not a hot task), before they meet the questions. :func:`question_vectors` needs
no join at all: questions and answers meet in one aggregation of fixed-width values. The pairs
themselves, and the groups of them, deal hot questions into pieces (:mod:`.skew`).

Filters on parsed fields are avoided before these aggregations: Catalyst
pushes such filters below the parsing projection, where they re-run the
parse once per use of a parsed field.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import check_vocabulary, term_position, vocabulary_array
from ..schemas import POSTING_COLUMNS
from .skew import CHUNK, chunked, salted_join

QUESTION = 1
ANSWER = 2


def questions(postings: DataFrame) -> DataFrame:
    """Postings of type 1."""
    return postings.where(F.col("posting_type") == QUESTION)


def answers(postings: DataFrame) -> DataFrame:
    """Postings of type 2 (any other type is ignored everywhere)."""
    return postings.where(F.col("posting_type") == ANSWER)


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in POSTING_COLUMNS])


def _answers_checked(postings: DataFrame, strict: bool) -> DataFrame:
    a = answers(postings)
    if strict:
        a = a.withColumn(
            "parent_id",
            F.coalesce(F.col("parent_id"), F.raise_error(F.lit("answer posting without a parent id"))),
        )
    return a


def question_answer_join(postings: DataFrame, strict: bool = False, partitions: int | None = None) -> DataFrame:
    """Inner equi-join question.id = answer.parent_id, one row per pair.

    Columns are the posting fields prefixed ``q_`` and ``a_``. Unanswered
    questions and orphan answers vanish; an answer without a parent id is
    dropped, or fails the job with ``strict=True``.

    Both sides grow with the data, so the join is a sort-merge join. A
    question that holds a large share of all answers is found by a sketch of
    the parent ids, and the join is then by question and piece
    (:func:`.skew.salted_join`), so that no task gets all of its answers.
    """
    return _pairs(postings, strict, partitions).drop("_piece", "_pieces")


def _pairs(postings: DataFrame, strict: bool, partitions: int | None = None) -> DataFrame:
    q = _prefixed(questions(postings), "q_")
    a = _prefixed(_answers_checked(postings, strict), "a_")
    return salted_join(q, "q_id", a, "a_parent_id", F.col("a_id"), partitions)


def grouped_postings(postings: DataFrame, strict: bool = False, size: int = CHUNK, partitions: int | None = None) -> DataFrame:
    """Question/answer pairs grouped by question id: ``(qid, chunk, pairs, n)``.

    ``pairs`` is an array of structs of the pair columns of :func:`question_answer_join`, without the
    repeated parent id, with at most ``size`` entries; ``n`` is their number. A question with more
    pairs has several chunks, numbered from 0 and full but for the last, in the order of the md5 of the
    answer id, so that a heavily answered question is neither one row nor one task.
    Exploded, the chunks are the pairs of the join.
    """
    pairs = _pairs(postings, strict, partitions)
    fields = [c for c in pairs.columns if c not in ("_piece", "_pieces", "q_id", "a_parent_id")]
    pairs = pairs.withColumnRenamed("q_id", "qid")
    return chunked(pairs, "qid", "a_id", fields, size, "pairs", dealt=True)


def scored_postings(postings: DataFrame, strict: bool = False) -> DataFrame:
    """Each answered question with ``high_score`` = max(0, best answer score).

    Columns: the question's posting fields, then ``high_score``. If several
    questions share an id, the row with the smallest tag (null first) is kept,
    then the smallest in the other fields.

    The best score is one hash aggregation of two fixed-width columns, parent
    id and score, combined map-side, so a heavily answered question
    sends one row per map task. The question's fields are fetched afterwards, by a join of the
    scores with the questions; of questions that share an id the first is kept by a rank that is
    limited before its shuffle.
    """
    parent = F.col("parent_id")
    if strict:
        parent = F.coalesce(parent, F.raise_error(F.lit("answer posting without a parent id")))
    best = answers(postings).select(parent.alias("qid"), "score").groupBy("qid").agg(F.max("score").alias("best"))
    others = ["tags", *[c for c in POSTING_COLUMNS if c not in ("id", "tags")]]
    first = Window.partitionBy("id").orderBy(*[F.col(c).asc_nulls_first() for c in others])
    kept = questions(postings).withColumn("_place", F.row_number().over(first)).where(F.col("_place") == 1).drop("_place")
    # Null-safe, because a plain equality would infer a filter on the parent id that re-runs the parser.
    joined = kept.join(best, F.col("id").eqNullSafe(F.col("qid")))
    return joined.select(*POSTING_COLUMNS, F.greatest(F.col("best"), F.lit(0)).alias("high_score"))


def vector_postings(scored: DataFrame, langs: Sequence[str], spread: int) -> DataFrame:
    """``(x, y)`` = (index of the tag in ``langs`` * spread, high score).

    The tag must equal a vocabulary term exactly; questions with a null or
    unknown tag are dropped.
    """
    terms = check_vocabulary(langs)
    if spread <= 0:
        raise ValueError("spread must be positive, or the term cannot be recovered from x")
    position = term_position("tags", terms)
    return scored.where(position > 0).select(
        ((position - 1) * spread).cast("int").alias("x"),
        F.col("high_score").cast("int").alias("y"),
    )


def tag_code(tags: str, terms: Sequence[str]) -> Column:
    """A number that orders tags as their strings do, as far as ``terms`` can tell.

    Twice the number of smaller terms, plus one if the tag is a term: odd for
    known tags, even for unknown ones, 0 for null.
    """
    smaller = F.size(F.filter(vocabulary_array(terms), lambda t: t < F.col(tags)))
    return F.coalesce(F.when(F.col(tags).isNotNull(), smaller * 2 + (term_position(tags, terms) > 0).cast("int")), F.lit(0))


def question_vectors(postings: DataFrame, langs: Sequence[str], spread: int, strict: bool = False) -> DataFrame:
    """``vector_postings(scored_postings(postings), langs, spread)`` in one pass.

    The vectors need, per question id, only the question's vocabulary
    position and the best answer score, all fixed-width values. So instead
    of scanning the postings once per join side, every posting is projected
    to ``(question id, tag position if a question, score if an answer)`` and
    one hash aggregation on the question id combines both kinds of rows: a
    single scan, a single shuffle of partial aggregates, no join. A question
    id with several question rows uses the one with the smallest tag, as in
    ``scored_postings``: tags are compared by :func:`tag_code`.
    """
    terms = check_vocabulary(langs)
    if spread <= 0:
        raise ValueError("spread must be positive, or the term cannot be recovered from x")
    is_question = F.col("posting_type") == QUESTION
    is_answer = F.col("posting_type") == ANSWER
    parent = F.col("parent_id")
    if strict:
        parent = F.coalesce(parent, F.raise_error(F.lit("answer posting without a parent id")))
    # No row filter before the aggregation: a filter on parsed fields would be
    # pushed below the parser and evaluate it twice. Other posting types and
    # answers without a parent get a null key, whose group has no question
    # and is dropped by the final filter.
    keyed = postings.select(
        F.when(is_question, F.col("id")).when(is_answer, parent).alias("qid"),
        F.when(is_question, tag_code("tags", terms)).alias("code"),
        F.when(is_answer, F.col("score")).alias("answer_score"),
    )
    per_question = keyed.groupBy("qid").agg(
        F.min("code").alias("code"),
        F.max("answer_score").alias("best"),
    )
    # A question must exist with a known tag (an odd code) and have at least
    # one answer (best not null). The null-key group has no
    # question, so it fails the first test; testing the key itself would be
    # pushed through the aggregation into the parser.
    known = (F.col("code") % 2 == 1) & F.col("best").isNotNull()
    in_order = sorted(range(len(terms)), key=lambda i: terms[i].encode("utf-8"))
    place = F.get(F.expr(f"array({', '.join(map(str, in_order))})"), F.shiftright("code", 1))
    return per_question.where(known).select(
        (place * spread).cast("int").alias("x"),
        F.greatest(F.col("best"), F.lit(0)).cast("int").alias("y"),
    )


def weighted_vectors(vectors: DataFrame) -> DataFrame:
    """Distinct points with their multiplicity: ``(x, y, n)``.

    Every k-means and cluster statistic is exact on this form (integer sums
    weighted by ``n``, weighted median, counts per x), and its size is the
    number of distinct points rather than the number of questions.
    """
    if "n" in vectors.columns:
        return vectors.groupBy("x", "y").agg(F.sum("n").cast("long").alias("n"))
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
