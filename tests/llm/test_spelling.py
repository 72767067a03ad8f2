"""Spelling variants against brute force."""

from __future__ import annotations

import collections
import random
import re
import zlib

import pytest

from tessera.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, root string"


def edits(a, b):
    """Whether the words differ by exactly one edit."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, modulus, letters, least):
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if modulus and h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= letters:
                counts[run] += 1
    n = {w: k for w, k in counts.items() if k >= least}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(map(str, out))


def corpus(seed, words, docs, length):
    r = random.Random(seed)
    made = ["".join(r.choice("abcdéÿ") for _ in range(r.randrange(3, 9))) for _ in range(words)]
    weight = [1 / (1 + i) for i in range(words)]
    rows = []
    for i in range(docs):
        text = []
        for w in r.choices(made, weight, k=length):
            if r.random() < 0.2:
                p = r.randrange(len(w))
                w = r.choice([w[:p] + w[p + 1 :], w[:p] + r.choice("abcd") + w[p:], w[:p] + "a" + w[p + 1 :]])
            text.append(w.title() if r.random() < 0.1 else w)
        rows.append((i, r.choice([" ", ", ", "1"]).join(text)))
    return rows + [(None, None), (None, rows[0][1]), (5, ""), (6, "?! 12"), (7, rows[1][1]), (7, rows[1][1]), (8, "×÷ Āabcdab Éabcdab")]


@pytest.mark.parametrize("group", [1, 3, 16, 10**9])
def test_variants_equal_brute_force(spark, group):
    rows = corpus(3, 150, 60, 60)
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)
    got = spelling.spelling_variants(docs, modulus=7, letters=4, least=2, group=group).collect()
    want = brute(rows, 7, 4, 2)
    assert len(want) > 200 and sum(r.form is not None for r in got) > 50
    assert any(r.form is not None and r.root != r.form for r in got)
    assert sorted(str(tuple(r)) for r in got) == want


def test_default_limits_and_long_words(spark):
    long = "ab" * 3000
    texts = [long] * 30 + [long[:-1]] * 5 + [long[:2999] + "c" + long[3000:]] * 6 + ["abcdef"] * 5 + ["abcdeg"] * 4 + ["abcde"] * 99 + ["bcdefa"] * 5
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)
    got = spelling.spelling_variants(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, None, 6, 5)
    assert len(got) == 5


def test_signatures_of_near_words_meet():
    r = random.Random(9)
    for _ in range(400):
        a = "".join(r.choice("abcé") for _ in range(r.randrange(1, 12)))
        p = r.randrange(len(a))
        for b in (a[:p] + "z" + a[p + 1 :], a[:p] + a[p + 1 :], a[:p] + r.choice("ab") + a[p:]):
            assert {k for k, _ in spelling.signatures(a)} & {k for k, _ in spelling.signatures(b)}
    word = "signature"
    assert spelling.left_out(word) == [spelling.whole_hash(word[:i] + word[i + 1 :]) for i in range(len(word))]


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA), modulus=199).count() == 0
