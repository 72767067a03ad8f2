"""Plan-shape guards for the properties the design relies on at scale."""

from __future__ import annotations

import contextlib
import io

import pytest

from tessera.operators import postings as qa
from tessera.operators.clustering import assign, average_vectors
from tessera.operators.ranking import rank_langs, rank_langs_reduce
from tessera.operators.sampling import sample_per_language
from tessera.plans import bindings as B

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def parse_filters(p: str) -> list[str]:
    """Filter nodes whose condition re-runs the line parser."""
    blocks = p.split("\n\n")[1:]
    return [b for b in blocks if ") Filter" in b.split("\n")[0] and "split(" in b]


@pytest.fixture
def postings(spark):
    return B.postings(spark, SF)


def test_vectors_one_hash_aggregation_no_join_no_parse_filters(postings):
    p = plan(qa.question_vectors(postings, B.TAG_TERMS, 50000))
    assert "Join" not in p
    assert "SortAggregate" not in p
    assert "partial_min" in p and "partial_max" in p
    assert not parse_filters(p)


def test_scores_are_a_hash_aggregation_and_fields_are_fetched_after(postings):
    p = plan(qa.scored_postings(postings))
    assert "SortAggregate" not in p and "ObjectHashAggregate" not in p
    assert "partial_max" in p and "WindowGroupLimit" in p
    assert not parse_filters(p)


def test_type_filter_reads_only_the_first_field(postings):
    p = plan(qa.questions(postings))
    assert not parse_filters(p)
    assert "substring_index" in p


def test_filter_on_another_parsed_field_would_rerun_the_split(postings):
    # Why the aggregations above avoid row filters: this one lands on the parser.
    from pyspark.sql import functions as F

    assert parse_filters(plan(postings.where(F.col("parent_id").isNotNull())))


def test_ranking_is_one_partial_aggregation_without_join(spark):
    articles = B.articles(spark, SF)
    for df in (rank_langs(articles, B.ARTICLE_TERMS), rank_langs_reduce(articles, B.ARTICLE_TERMS)):
        p = plan(df)
        assert "Join" not in p
        assert "partial_sum" in p or "partial_count" in p
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_per_term_sample_limits_before_the_shuffle(spark):
    vectors = spark.createDataFrame([(x, y) for x in (0, 10) for y in range(50)], "x int, y int")
    p = plan(sample_per_language(vectors, ["a", "b"], 4))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_kmeans_assignment_is_narrow(spark):
    points = spark.createDataFrame([(0, 1, 2), (5, 5, 1)], "x int, y int, n long")
    p = plan(average_vectors(assign(points, [(0, 0), (5, 5)]), by=("cx", "cy")))
    assert "Join" not in p and "BroadcastExchange" not in p
    tree = p.split("\n\n")[0]
    assert tree.count("Exchange") == 1  # the one aggregation shuffle


def test_pair_join_is_sort_merge_by_question_and_piece(postings):
    p = plan(qa.question_answer_join(postings))
    tree = p.split("\n\n")[0]
    assert "SortMergeJoin" in tree and "approx_top_k" in p
    assert "_piece" in p.split("SortMergeJoin", 2)[2].split("\n\n")[0]


def test_three_rankings_of_a_file_read_it_once(spark, tmp_dir, monkeypatch):
    import os

    from tessera.programs import rank_article_file

    path = os.path.join(tmp_dir, "articles.dat")
    with open(path, "w", encoding="utf-8") as f:
        f.write("<page> <title>a</title><text>x y</text>  </page>\n<page> <title>b</title><text>y</text>  </page>\n")
    kind = type(spark.range(1))
    jobs, collect = [], kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: jobs.append(plan(df)) or collect(df))
    r = rank_article_file(spark, path, ["x", "y", "z"])
    assert [p.split("\n\n")[0].count("Scan text") for p in jobs] == [1]
    monkeypatch.undo()
    assert all("Scan text" not in plan(df) for df in (r.naive, r.using_index, r.reduce))
    os.remove(path)
    assert [tuple(x) for x in r.naive.collect()] == [("y", 2), ("x", 1), ("z", 0)]
    assert [tuple(x) for x in r.using_index.collect()] == [tuple(x) for x in r.reduce.collect()] == [("y", 2), ("x", 1)]
