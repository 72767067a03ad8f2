"""Questions, answers, join, scores and vectors (FIXTURES C2)."""

from __future__ import annotations

import pytest

from tessera.operators.postings import (
    answers,
    grouped_postings,
    question_answer_join,
    question_vectors,
    questions,
    scored_postings,
    vector_postings,
    weighted_vectors,
)
from tessera.sources import parse_postings

from .test_sources import POSTING_LINES, lines_df

TAGS = ["sql", "java", "go"]


@pytest.fixture
def postings(spark):
    return parse_postings(lines_df(spark, POSTING_LINES))


def test_questions_and_answers(postings):
    assert questions(postings).count() == 4
    assert answers(postings).count() == 5


def test_join_pairs(postings):
    pairs = sorted((r.q_id, r.a_id) for r in question_answer_join(postings).collect())
    assert pairs == [(1, 11), (1, 13), (2, 12), (4, 14)]
    grouped = grouped_postings(postings)
    assert grouped.columns == ["qid", "chunk", "pairs", "n"]
    assert sorted((r.qid, r.chunk, sorted(p.a_id for p in r.pairs)) for r in grouped.collect()) == [(1, 0, [11, 13]), (2, 0, [12]), (4, 0, [14])]


def test_scores_floor_at_zero(postings):
    scores = {r.id: r.high_score for r in scored_postings(postings).collect()}
    assert scores == {1: 0, 2: 7, 4: 9}


def test_vectors(postings):
    scored = scored_postings(postings)
    got = sorted(tuple(r) for r in vector_postings(scored, TAGS, 50000).collect())
    assert got == [(0, 7), (50000, 0)]


def test_single_pass_vectors_equal_two_step_form(postings, spark):
    two_step = sorted(tuple(r) for r in vector_postings(scored_postings(postings), TAGS, 50000).collect())
    assert sorted(tuple(r) for r in question_vectors(postings, TAGS, 50000).collect()) == two_step
    from tessera.plans import bindings as B

    supplied = B.postings(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in vector_postings(scored_postings(supplied), B.TAG_TERMS, 50000).collect())
    b = sorted(tuple(r) for r in question_vectors(supplied, B.TAG_TERMS, 50000).collect())
    assert a == b and len(a) == 1182


def test_answer_without_parent(spark):
    p = parse_postings(lines_df(spark, ["1,1,,,0,sql", "2,2,,1,4", "2,3,,,5"]))
    assert question_answer_join(p).count() == 1
    assert scored_postings(p).first().high_score == 4
    with pytest.raises(Exception, match="without a parent"):
        question_answer_join(p, strict=True).collect()
    with pytest.raises(Exception, match="without a parent"):
        question_vectors(p, ["sql"], 10, strict=True).collect()


def test_duplicate_question_ids_give_one_row(spark):
    p = parse_postings(lines_df(spark, ["1,1,,,0,sql", "1,1,,,3,sql", "2,2,,1,4"]))
    rows = scored_postings(p).collect()
    assert len(rows) == 1 and rows[0].score == 0 and rows[0].high_score == 4
    assert [tuple(r) for r in question_vectors(p, ["sql"], 10).collect()] == [(0, 4)]


def test_weighted_vectors(spark):
    v = spark.createDataFrame([(0, 1), (0, 1), (5, 2)], "x int, y int")
    assert sorted(tuple(r) for r in weighted_vectors(v).collect()) == [(0, 1, 2), (5, 2, 1)]
    assert sorted(tuple(r) for r in weighted_vectors(weighted_vectors(v)).collect()) == [(0, 1, 2), (5, 2, 1)]


def test_spread_must_be_positive(postings):
    with pytest.raises(ValueError):
        vector_postings(scored_postings(postings), TAGS, 0)


def test_ids_beyond_32_bit_parse_and_join(spark):
    lines = spark.createDataFrame([("1,3000000000,,,0,java",), ("2,3000000001,,3000000000,4",)], "value string")
    rows = question_answer_join(parse_postings(lines)).collect()
    assert [(r.q_id, r.a_id) for r in rows] == [(3000000000, 3000000001)]


@pytest.mark.parametrize("seed", range(4))
def test_both_ways_to_the_vectors_agree_on_repeated_ids(spark, seed):
    import random

    r = random.Random(seed)
    rows = [(1, i, None, None, r.randrange(9), r.choice(["java", "sql", "zzz", "kotlin", None])) for i in range(6) for _ in range(3)]
    rows += [(2, 100 + k, None, r.randrange(6), r.randrange(-3, 9), None) for k in range(8)]
    rows += [(1, 7, None, None, 0, "java"), (1, 7, None, None, 0, "zzz"), (2, 200, None, 7, 3, None)]
    p = spark.createDataFrame(rows, "posting_type int, id long, accepted_answer long, parent_id long, score int, tags string")
    for langs in (["sql", "java"], ["zzz", "kotlin", "java"]):
        two_step = sorted(tuple(v) for v in vector_postings(scored_postings(p), langs, 10).collect())
        assert sorted(tuple(v) for v in question_vectors(p, langs, 10).collect()) == two_step
    assert (0, 3) in [tuple(v) for v in question_vectors(p, ["java"], 10).collect()]


@pytest.mark.parametrize("seed", range(3))
def test_scores_of_repeated_ids_equal_brute_force(spark, seed):
    import random

    r = random.Random(seed)
    ask = [(1, r.randrange(7), r.choice([None, 3]), None, r.randrange(3), r.choice([None, "b", "a", "c" * 30])) for _ in range(25)]
    say = [(2, 100 + i, None, r.choice([None, *range(9)]), r.randrange(-9, 9), None) for i in range(30)] + [(3, 5, None, 2, 99, "x")]
    p = spark.createDataFrame(ask + say, "posting_type int, id long, accepted_answer long, parent_id long, score int, tags string").repartition(3)
    best = {}
    for _, _, _, parent, score, _ in say[:-1]:
        if parent is not None:
            best[parent] = max(best.get(parent, 0), score)
    least = lambda v: (v is not None, v if v is not None else 0)
    order = lambda q: (q[5] is not None, q[5] or "", q[0], least(q[2]), least(q[3]), q[4])
    want = [(*min((q for q in ask if q[1] == i), key=order), best[i]) for i in {q[1] for q in ask} if i in best]
    assert sorted(map(str, (tuple(x) for x in scored_postings(p).collect()))) == sorted(map(str, want))


def test_groups_of_a_question_with_repeated_answers(spark):
    rows = [(1, 1, None, None, 0, "a"), (1, 1, None, None, 0, "b"), (1, 2, None, None, 0, None)]
    rows += [(2, 50 + i % 40, None, 1 + i // 90, i % 3, None) for i in range(100)]
    p = spark.createDataFrame(rows, "posting_type int, id long, accepted_answer long, parent_id long, score int, tags string").repartition(4)
    chunks = grouped_postings(p, size=8, partitions=3).collect()
    assert sorted(map(str, chunks)) == sorted(map(str, grouped_postings(p.coalesce(1), size=8, partitions=50).collect()))
    assert all(c.n == len(c.pairs) <= 8 for c in chunks)
    pairs = sorted((r.q_id, r.q_tags or "", r.a_id, r.a_score) for r in question_answer_join(p).collect())
    assert sorted((c.qid, x.q_tags or "", x.a_id, x.a_score) for c in chunks for x in c.pairs) == pairs and len(pairs) == 190
    assert {c.qid: c.chunk for c in sorted(chunks, key=lambda c: c.chunk)} == {1: 22, 2: 1}
