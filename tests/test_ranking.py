"""Text ranking: mentions, occurrences, the three rankings and the index."""

from __future__ import annotations

import pytest

from tessera.operators.ranking import (
    language_article_pairs,
    make_index,
    mentions_filter,
    occurrences_of_lang,
    order_ranking,
    posting_lists,
    rank_langs,
    rank_langs_reduce,
    rank_langs_using_index,
    term_counts,
    zero_filled,
)

VOCAB = ["alpha", "beta", "gamma", "delta"]
C1 = [
    ("a1", "alpha beta"),
    ("a2", "beta, gamma"),
    ("a3", "Beta  alpha alpha"),
    ("a4", ""),
    ("a5", "gamma beta"),
]


@pytest.fixture
def c1(spark):
    return spark.createDataFrame(C1, "title string, text string")


def ranked(df):
    return [(r.lang, r.n) for r in df.collect()]


def test_occurrences(c1):
    got = {t: occurrences_of_lang(c1, t).first().n for t in VOCAB}
    assert got == {"alpha": 2, "beta": 2, "gamma": 2, "delta": 0}


def test_occurrences_on_empty_input(spark):
    empty = spark.createDataFrame([], "title string, text string")
    assert tuple(occurrences_of_lang(empty, "x").first()) == ("x", 0)


def test_mentions_is_whole_token_and_case_sensitive(spark):
    df = spark.createDataFrame(
        [("1", "C++ is fine"), ("2", "the, end"), ("3", "tab\tC++"), ("4", "c++")], "title string, text string"
    )
    assert [r.title for r in mentions_filter(df, "C++").collect()] == ["1"]
    assert [r.title for r in mentions_filter(df, "the,").collect()] == ["2"]
    assert mentions_filter(df, "the").count() == 0


def test_rank_langs_keeps_zeros_ties_in_reverse_vocabulary_order(c1):
    assert ranked(rank_langs(c1, VOCAB)) == [("gamma", 2), ("beta", 2), ("alpha", 2), ("delta", 0)]


def test_rank_langs_using_index_and_reduce(c1):
    index = make_index(c1, VOCAB)
    assert index.count() == 6
    assert index.select("lang").distinct().count() == 3
    expected = [("gamma", 2), ("beta", 2), ("alpha", 2)]
    assert ranked(rank_langs_using_index(index, VOCAB)) == expected
    assert ranked(rank_langs_reduce(c1, VOCAB)) == expected


def test_pairs_count_each_article_once(spark):
    df = spark.createDataFrame([("t", "x x x y")], "title string, text string")
    assert sorted(tuple(r) for r in language_article_pairs(df, ["x", "y", "z"]).collect()) == [("x", "t"), ("y", "t")]


def test_duplicate_vocabulary_rejected(c1):
    with pytest.raises(ValueError, match="duplicate"):
        rank_langs(c1, ["alpha", "alpha"])


# A table of counts that is worked out by hand: each row of OFFICE is an article.
OFFICE = [
    ("memo", "ink ink paper"),
    ("order", "paper clip"),
    ("note", "clip ink clip"),
    ("draft", "stapler,"),
    ("blank", ""),
    ("none", None),
]


@pytest.mark.parametrize(
    "langs, counts",
    [
        (["ink", "paper", "clip"], [("clip", 2), ("paper", 2), ("ink", 2)]),
        (["clip", "ink", "stapler"], [("ink", 2), ("clip", 2), ("stapler", 0)]),
        (["stapler,"], [("stapler,", 1)]),
        (["glue", "tape"], [("tape", 0), ("glue", 0)]),
    ],
)
def test_every_ranking_of_every_vocabulary(spark, langs, counts):
    office = spark.createDataFrame(OFFICE, "title string, text string").repartition(3)
    found = [c for c in counts if c[1]]
    assert ranked(rank_langs(office, langs)) == counts
    assert ranked(rank_langs_reduce(office, langs)) == found
    assert ranked(rank_langs_using_index(make_index(office, langs), langs)) == found
    assert ranked(rank_langs_using_index(posting_lists(office, langs, size=1), langs)) == found
    shared = term_counts(office, langs)
    assert ranked(zero_filled(shared, langs)) == counts and ranked(order_ranking(shared, langs)) == found
    assert [occurrences_of_lang(office, t).first().n for t, _ in counts] == [n for _, n in counts]


def test_rankings_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "title string, text string")
    assert ranked(rank_langs(empty, ["ink"])) == [("ink", 0)]
    assert ranked(rank_langs_reduce(empty, ["ink"])) == [] == posting_lists(empty, ["ink"]).collect()
    assert ranked(zero_filled(term_counts(empty, ["ink"]), ["ink"])) == [("ink", 0)]


@pytest.mark.parametrize("size", [1, 7, 64, 5000])
def test_posting_lists_are_the_index_in_bounded_chunks(spark, size):
    texts = [(f"t{i % 400}", "common " + ("every-third " if i % 3 == 0 else "") + ("rare" if i % 97 == 0 else "")) for i in range(500)]
    articles = spark.createDataFrame(texts, "title string, text string").repartition(5)
    langs = ["common", "every-third", "rare", "absent"]
    chunks = posting_lists(articles, langs, size=size, partitions=4).collect()
    again = posting_lists(articles.repartition(2), langs, size=size, partitions=64).collect()
    assert sorted(map(str, chunks)) == sorted(map(str, again))
    assert all(c.n == len(c.articles) <= size for c in chunks)
    long_form = sorted((r.lang, r.title, r.text) for r in make_index(articles, langs).collect())
    assert sorted((c.lang, a.title, a.text) for c in chunks for a in c.articles) == long_form
    for lang in langs:
        sizes = [c.n for c in sorted(chunks, key=lambda c: c.chunk) if c.lang == lang]
        assert all(n == size for n in sizes[:-1])
        assert sorted(c.chunk for c in chunks if c.lang == lang) == list(range(len(sizes)))


def test_large_vocabulary(c1):
    many = [*VOCAB, *(f"absent-{i}" for i in range(3000))]
    small = sorted(tuple(r) for r in language_article_pairs(c1, VOCAB).collect())
    assert sorted(tuple(r) for r in language_article_pairs(c1, many).collect()) == small
    assert ranked(rank_langs_reduce(c1, many)) == ranked(rank_langs_reduce(c1, VOCAB))
    counts = ranked(rank_langs(c1, many))
    assert len(counts) == len(many)
    assert [p for p in counts if p[0] in VOCAB] == ranked(rank_langs(c1, VOCAB))


def test_three_rankings_agree_on_supplied_data(spark):
    from tessera.plans import bindings as B

    articles = B.articles(spark, "/root/testdata/sf0.001")
    full = ranked(rank_langs(articles, B.ARTICLE_TERMS))
    nonzero = [p for p in full if p[1] > 0]
    assert ranked(rank_langs_reduce(articles, B.ARTICLE_TERMS)) == nonzero
    assert ranked(rank_langs_using_index(make_index(articles, B.ARTICLE_TERMS), B.ARTICLE_TERMS)) == nonzero
    assert ("zzz-none", 0) in full
    counts = [n for _, n in full]
    assert counts == sorted(counts, reverse=True)


def test_ranking_independent_of_partitioning(spark):
    from tessera.plans import bindings as B

    articles = B.articles(spark, "/root/testdata/sf0.001")
    one = ranked(rank_langs(articles.repartition(1), B.ARTICLE_TERMS))
    seven = ranked(rank_langs(articles.repartition(7), B.ARTICLE_TERMS))
    assert one == seven


def test_index_ranking_without_vocabulary_breaks_ties_by_term(c1):
    ranked = [(r.lang, r.n) for r in rank_langs_using_index(make_index(c1, VOCAB)).collect()]
    assert ranked == [("gamma", 2), ("beta", 2), ("alpha", 2)]
