"""The pipeline's stages on a small table with copies, nulls, repeated rows and clashing columns, against brute force."""

from __future__ import annotations

import collections
import random

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id long, node long, size long, row string, token string"
STAGES = dict(corpus_pipeline.STAGES)
R = random.Random(11)
PARTS = {"x": ["ab", "ra", "ka", "do"], "y": ["ulo", "mi", "tem", "sy"]}


def prose(lang, n):
    return " ".join("".join(R.choice(PARTS[lang]) for _ in range(3)) for _ in range(n))


def near(text, k):
    words = text.split(" ")
    words[k] = "changed"
    return " ".join(words)


LONG = prose("x", 60)
BASE = [(i, prose("xy"[i % 2], 30 + i % 20), "xy"[i % 2], "ab"[i % 3 == 0]) for i in range(60)]
ROWS = [
    *BASE, (100, LONG, "x", "a"), (101, near(LONG, 30), "x", "a"), (None, near(LONG, 59), None, None), (102, BASE[4][1], "x", "b"), (4, BASE[4][1], "x", "b"),
    (103, None, "y", "a"), (104, "", None, "a"), (105, "12 !?", "x", "b"), (None, prose("y", 25), None, "a"), (3, prose("y", 31), "y", None), (106, LONG.upper(), "x", "a"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, 9, 10, "r", "t") for r in rows], SCHEMA).repartition(3)


def kept(df):
    return sorted(((r.doc_id, r.text, r.lang, r.source) for r in df.collect()), key=str)


def test_language_id_keeps_rows_with_letters(spark):
    docs = table(spark, ROWS)
    out = STAGES["language_id"](spark, docs, "")
    assert out.columns == docs.columns
    assert kept(out) == sorted((r for r in ROWS if any(c.isalpha() for c in r[1] or "")), key=str)


def test_exact_duplicates_keeps_the_largest_id(spark):
    docs = table(spark, ROWS)
    out = STAGES["exact_duplicates"](spark, docs, "")
    assert out.columns == docs.columns
    groups = collections.defaultdict(list)
    for r in ROWS:
        groups[r[1] or ""].append(r)
    got = kept(out)
    assert len(got) == len(groups)
    for text, rows in groups.items():
        best = max((r[0] for r in rows if r[0] is not None), default=None)
        assert sum((t or "") == text and i == best for i, t, _, _ in got) == 1


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def test_near_duplicates_keeps_one_of_each_component(spark):
    docs = table(spark, ROWS)
    out = STAGES["near_duplicates"](spark, docs, "")
    assert out.columns == docs.columns
    sets = [shingles(r[1]) for r in ROWS]
    label = list(range(len(ROWS)))
    for i in range(len(ROWS)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label = [label[j] if x == label[i] else x for x in label]
    groups = collections.defaultdict(list)
    for r, s, k in zip(ROWS, sets, label):
        groups[k if s else ("empty", r)].append(r)
    got = collections.Counter(kept(out))
    for rows in groups.values():
        here = [r for r in set(rows) if got[r]]
        if not shingles(rows[0][1]):
            assert got[rows[0]] == len(rows)
            continue
        # The smallest id stays; rows equal in id and text stay together.
        least = min((r[0] for r in rows if r[0] is not None), default=None)
        assert {(r[0], r[1]) for r in here} == {(least, here[0][1])}
        assert sum(got[r] for r in here) == sum(r[:2] == here[0][:2] for r in rows)
    assert sum(got.values()) < len(ROWS) - 3


def test_mix_takes_rows_whole(spark):
    docs = table(spark, ROWS)
    out = STAGES["mix"](spark, docs, "")
    assert out.columns == docs.columns
    counts = collections.Counter(kept(out))
    assert set(counts) <= set(ROWS) and max(counts[r] / ROWS.count(r) for r in counts) <= 3


def test_pack_has_every_token_once(spark):
    docs = table(spark, ROWS)
    pieces = STAGES["pack"](spark, docs, "").collect()
    by_row = collections.Counter((p.doc_id, p.doc_tokens) for p in pieces if p.start == 0)
    assert sum(by_row.values()) == len(ROWS) and collections.Counter(i for i, _ in by_row.elements()) == collections.Counter(r[0] for r in ROWS)
    at = collections.defaultdict(list)
    for p in pieces:
        at[p.sequence_id].append((p.offset, p.length))
    for spans in at.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) <= 2048


def test_stages_on_an_empty_table(spark):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, []), "").count() == 0, name
