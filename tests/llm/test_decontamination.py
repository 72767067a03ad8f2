"""Benchmark decontamination against brute force, and what it cuts out."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from tessera.llm import decontamination

WORD = re.compile(decontamination.WORD)
ITEMS = "item_id long, text string, n_words long"
DOCS = "doc_id long, text string, lang string, item_id long, n_hit int"


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    found |= own
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(map(str, out))


def made(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "x", 1, 2) for i, t in docs], DOCS).repartition(3),
        spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS),
    )


R = random.Random(5)
PROSE = [" ".join(R.choice("ab cd EF \u00e9t\u00e9 g2 h".split()) for _ in range(R.randrange(1, 60))) for _ in range(60)]
ITEM_ROWS = [(i % 9, t) for i, t in enumerate(PROSE[:10])] + [(40, "Zeta! only"), (41, "one"), (42, None), (43, ""), (44, "?!"), (None, "null item here"), (None, "other null item"), (41, "one")]
DOC_ROWS = [
    *enumerate(PROSE), (100, None), (101, ""), (102, " .. "), (103, "ZETA, only"), (104, "zeta"), (104, "zeta only"), (None, "one"), (None, "one"),
    (105, "x" * 5000 + " " + PROSE[3].upper()), (106, "the null\tITEM here, other-null(item) zeta only"), (107, "one" + "\u00a0" + "one"), (108, "\U0001f600 one\u0000one"),
]


@pytest.mark.parametrize("size, windows", [(10, 1 << 20), (3, 1 << 20), (3, 50), (1, 2)])
def test_report_equals_brute_force(spark, size, windows, monkeypatch):
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 700)
    docs, items = made(spark, DOC_ROWS, ITEM_ROWS)
    got = decontamination.leak_report(docs, items, window=size, windows=windows).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(DOC_ROWS, ITEM_ROWS, size)


def test_spans_and_documents_go(spark):
    rows = [(1, "keep this, one TWO three four; and that"), (2, "clean"), (None, None), (3, "\u00e9 one two three four"), (3, "one two three four")]
    docs, items = made(spark, rows, [(7, "One two three FOUR")])
    got = decontamination.decontaminate(docs, items, window=3)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(
        [(1, "keep this, ; and that"), (2, "clean"), (None, None), (3, "\u00e9 "), (3, "")], key=str
    )
    left = decontamination.decontaminate(docs, items, remove="documents", window=3)
    assert left.columns == docs.columns and sorted((r.doc_id for r in left.collect()), key=str) == [2, None]
    found = {r.doc_id: r for r in decontamination.find_leaks(docs.select("doc_id", "text"), items, 3).collect()}
    assert (found[1].starts, found[1].ends, found[1].byte_starts, found[1].byte_ends, found[1].items) == ([2], [6], [11], [29], ["7"])


def test_empty_tables(spark):
    docs, items = made(spark, DOC_ROWS, ITEM_ROWS)
    assert decontamination.leak_report(docs.limit(0), items).count() == 0
    clean = decontamination.leak_report(docs, items.limit(0)).collect()
    assert len(clean) == len(DOC_ROWS) and not any(r.contaminated or r.n_hit or r.n_items for r in clean)
