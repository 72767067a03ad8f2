"""The look-up of texts across the groups of the similarity join."""

from __future__ import annotations

import random

import pytest

from tessera.llm import ngram_join

from .test_operators import documents


def by_brute_force(sets, num):
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= num * (len(sets[i]) + len(sets[j]) - n) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    first = {}
    for i, x in enumerate(label):
        first.setdefault(x, i)
    return [first[x] for x in label]


def test_looked_up_rows_do_not_grow_with_texts_times_groups(spark, monkeypatch):
    common, rows = " ".join(f"c{j}" for j in range(40)), []
    for i in range(400):
        rows.append((i, " ".join([common, *(f"u{i}-{j}" for j in range(3)), *(f"p{i // 2}-{j}" for j in range(12))])))
    rows.append((400, rows[0][1] + " more"))
    cells, links = [], ngram_join._opened_links
    monkeypatch.setattr(ngram_join, "_opened_links", lambda df, *a: cells.append(df.filter("query").count()) or links(df, *a))
    got = ngram_join.link_components(documents(spark, rows), 1, 90, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == {**{i: i for i in range(400)}, 400: 0}
    assert sum(cells) <= 401


@pytest.mark.parametrize(("groups", "members"), [(1, 8192), (1, 5), (4, 5), (2, 40)])
def test_gathered_tokens_find_every_link(spark, monkeypatch, groups, members):
    monkeypatch.setattr(ngram_join, "OPEN_GROUPS", groups)
    r, texts = random.Random(groups + members), []
    for family in range(8):
        base = [f"f{family}-{j}" for j in range(r.choice([5, 12, 30, 60]))]
        for _ in range(30):
            words = [w for w in base if r.random() > 0.08] + [f"x{r.randrange(60)}" for _ in range(r.randrange(4))]
            texts.append(" ".join(words or ["x"]))
    sets = [set(t.split()) for t in texts]
    got = ngram_join.link_components(documents(spark, list(enumerate(texts))), 1, 80, 100, group_members=members).collect()
    assert [c for _, c in sorted((r.doc_id, r.component_id) for r in got)] == by_brute_force(sets, 80)


def test_rows_go_to_python_in_small_batches(spark):
    import pyarrow as pa

    from tessera.llm.common import cut, small_batches

    def rows(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(b.num_rows for b in batches)], pa.int64())], names=["n"])

    texts = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('abcd', 500) AS text").mapInArrow(rows, "n long")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    with pytest.raises(RuntimeError), small_batches(spark):
        assert cut(texts).first().n < 2000
        raise RuntimeError
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
