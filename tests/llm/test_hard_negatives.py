"""Hard negatives against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, rank int, anchor_id string"


def brute(rows, anchors, k, m):
    best = {}
    for i, x, y in rows:
        if i is None or y is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = (y, [max(-(1 << 26), min(1 << 26, math.floor(256 * c))) for c in x])
        best[i] = min(best.get(i, row), row)
    out = []
    for a in best:
        if not anchors(a):
            continue
        y, x = best[a]
        scored = [(-sum(p * q for p, q in zip(x, v)), i, z) for i, (z, v) in best.items() if i != a and len(v) == len(x)]
        for ps, p, _ in sorted(s for s in scored if s[2] == y)[:k]:
            good = sorted(s for s in scored if s[2] != y and -30 * ps <= -100 * s[0] <= -90 * ps)[:m]
            out += [(a, p, r + 1, n, -ps, -ns) for r, (ns, n, _) in enumerate(good)]
    return sorted(out)


def vectors(seed, n, dims):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        c = centres[i % 4]
        rows.append((i, [round(x + r.gauss(0, 0.7), 2) for x in c], r.randrange(3)))
    rows += [(n + i, rows[5][1], rows[5][2] if i % 2 else 1) for i in range(40)]  # ties
    rows += [(n + 50, [0.0] * dims, 1), (n + 51, None, 1), (n + 52, [], 0), (n + 53, [None] * dims, 0), (n + 54, [math.nan] * dims, 0), (n + 55, [1.0] * dims, None)]
    rows += [(None, [1.0] * dims, 1), (7, rows[7][1], rows[7][2]), (10, [2.0] * dims, 0), (n + 60, [1e300] + [-1e300] * (dims - 1), 2), (n + 61, [0.5] * (dims + 3), 2), (n + 62, [0.7] * (dims + 3), 2), (n + 63, [0.3] * (dims + 3), 1)]
    return rows


@pytest.mark.parametrize("dims, block", [(2, 16384), (19, 16384), (19, 40), (64, 100)])
def test_negatives_equal_brute_force(spark, dims, block):
    rows = vectors(dims, 300, dims)
    df = spark.createDataFrame([(i, x, y, 1, "x") for i, x, y in rows], SCHEMA).repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, block_rows=block).collect()
    want = brute(rows, lambda i: i % 5 == 0, 5, 10)
    assert len(want) > 500 and sorted(map(tuple, got)) == want


def test_bounds_hold_and_tighten():
    r = np.random.default_rng(3)
    a, b = r.integers(-300, 300, (20, 37)), r.integers(-300, 300, (30, 37))
    exact, rows, columns = a @ b.T, np.arange(20), np.arange(30)
    one, two, width = hard_negatives.Summaries(a), hard_negatives.Summaries(b), np.inf
    for level in range(len(one.levels)):
        low, high = one.bounds(level, rows, two, columns)
        assert (low <= exact).all() and (exact <= high).all() and (high - low).mean() < width
        width = (high - low).mean()
    assert (hard_negatives.exact_scores(a, b) == exact).all()
    big = a * (1 << 18)
    assert (hard_negatives.exact_scores(big, big) == big @ big.T).all()


def test_empty_and_lonely(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 5 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1, 1, "x"), (1, [1.0], 2, 1, "x")], SCHEMA)
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 5 == 0).count() == 0
