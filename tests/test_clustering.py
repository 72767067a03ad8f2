"""Sampling and k-means (FIXTURES C3)."""

from __future__ import annotations

import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry
from tessera.functions.geometry import CentreGrid
from tessera.operators.clustering import (
    EmptyClusterError,
    assigned_distance,
    average_vectors,
    centers_distance,
    centers_distance_of,
    centres_frame,
    kmeans,
    kmeans_step,
    nearest_center,
    point_distance,
)
from tessera.operators.postings import weighted_vectors
from tessera.operators.sampling import (
    distinct_vectors,
    sample_global,
    sample_per_language,
    sample_vectors,
    take_centres,
)


def pts(spark, points):
    return spark.createDataFrame(points, "x int, y int")


def test_one_step_and_convergence(spark):
    p = pts(spark, [(0, 1), (0, 2), (0, 9), (10, 9)])
    assert kmeans_step(p, [(0, 0), (10, 10)]) == [(0, 4), (10, 9)]
    result = kmeans(p, [(0, 0), (10, 10)], eta=20)
    assert result.centres == [(0, 4), (10, 9)]
    assert result.iterations == 1 and result.converged
    assert [t[6] for t in result.trace] == [16.0, 1.0] and result.trace[0][7] == 17.0


def test_mean_truncates_toward_zero(spark):
    assert kmeans_step(pts(spark, [(0, 1), (0, 2)]), [(0, 0)]) == [(0, 1)]
    assert kmeans_step(pts(spark, [(0, -1), (0, -2)]), [(0, 0)]) == [(0, -1)]
    means = average_vectors(pts(spark, [(-5, 3), (0, 0)])).first()
    assert (means.x, means.y, means.n) == (-2, 1, 2)


def test_tie_goes_to_earliest_centre(spark):
    (row,) = nearest_center(pts(spark, [(0, 5)]), [(0, 0), (0, 10)]).collect()
    assert (row.cx, row.cy) == (0, 0)


def test_empty_cluster_error_or_keep(spark):
    p = pts(spark, [(0, 0)])
    with pytest.raises(EmptyClusterError):
        kmeans_step(p, [(0, 0), (9, 9)])
    assert kmeans_step(p, [(0, 0), (9, 9)], on_empty="keep") == [(0, 0), (9, 9)]


def test_duplicate_centres_move_together(spark):
    p = pts(spark, [(0, 2), (0, 4)])
    assert kmeans_step(p, [(0, 0), (0, 0)]) == [(0, 3), (0, 3)]


def test_weighted_equals_unweighted(spark):
    raw = pts(spark, [(0, 1), (0, 1), (0, 7), (50000, 3), (50000, 3), (50000, -8), (0, -3)])
    centres = [(0, 0), (50000, 0), (0, 5)]
    a = kmeans(raw, centres, eta=0.5, max_iterations=10)
    b = kmeans(weighted_vectors(raw), centres, eta=0.5, max_iterations=10)
    assert a.centres == b.centres and a.iterations == b.iterations


def test_max_iterations_and_resume(spark):
    p = pts(spark, [(0, 0), (0, 100), (100, 0), (100, 100)])
    result = kmeans(p, [(0, 0), (1, 1)], eta=0.0, max_iterations=3, iteration=2, on_empty="keep")
    assert result.iterations == 3 and not result.converged
    assert {t[0] for t in result.trace} == {2, 3}


def test_point_and_centre_distances(spark):
    rows = point_distance(pts(spark, [(1, 1)]), [(0, 0), (4, 5)]).collect()
    assert [(r.pos, r.distance) for r in rows] == [(0, 2.0), (1, 25.0)]
    old = centres_frame(spark, [(0, 0), (10, 10)])
    new = centres_frame(spark, [(0, 4), (10, 9)])
    assert centers_distance(old, new).first().distance == 17.0
    with pytest.raises(Exception, match="differ in length"):
        centers_distance(old, centres_frame(spark, [(0, 4)])).collect()


def test_sample_per_language(spark):
    data = [(x, y) for x in (0, 10) for y in range(20)] + [(0, 1)] * 5
    s = sample_per_language(pts(spark, data), ["a", "b"], 6, seed=42)
    rows = s.collect()
    assert [r.pos for r in rows] == list(range(6))
    assert [r.x for r in rows] == [0, 0, 0, 10, 10, 10]
    assert len({(r.x, r.y) for r in rows}) == 6
    again = sample_per_language(pts(spark, data).repartition(5), ["a", "b"], 6, seed=42).collect()
    assert rows == again
    other = sample_per_language(pts(spark, data), ["a", "b"], 6, seed=7).collect()
    assert other != rows
    assert take_centres(s) == [(r.x, r.y) for r in rows]


def test_sample_errors(spark):
    data = pts(spark, [(0, 1), (0, 2), (10, 1)])
    with pytest.raises(ValueError, match="multiple"):
        sample_per_language(data, ["a", "b"], 3)
    with pytest.raises(Exception, match="wrong size"):
        sample_per_language(data, ["a", "b"], 4).collect()
    with pytest.raises(Exception, match="wrong size"):
        sample_global(pts(spark, []), 2).collect()


def test_sample_global(spark):
    data = pts(spark, [(x, y) for x in range(5) for y in range(5)] * 2)
    rows = sample_global(data, 7).collect()
    assert len(rows) == 7 and len({(r.x, r.y) for r in rows}) == 7
    assert distinct_vectors(data).count() == 25


def test_sample_branch_follows_spread(spark):
    data = pts(spark, [(x, y) for x in (0, 100, 200) for y in range(10)])
    small = sample_vectors(data, ["a", "b", "c"], 6, spread=100).collect()
    assert small == sample_global(data, 6).collect()
    large = sample_vectors(data, ["a", "b", "c"], 6, spread=500).collect()
    assert large == sample_per_language(data, ["a", "b", "c"], 6).collect()


def test_extreme_integer_centres(spark):
    p = pts(spark, [(-(2**31), 0), (2**31 - 1, 0)])
    rows = nearest_center(p, [(-(2**31), 0), (2**31 - 1, 0)]).collect()
    assert [(r.cx, r.cy) for r in rows] == [(-(2**31), 0), (2**31 - 1, 0)]
    assert nearest_center(p, [(-(2**31), 0)]).schema["cx"].dataType.simpleString() == "int"


@pytest.mark.parametrize("k", [45, 210, 1000, 3000])
def test_a_step_with_many_centres_equals_brute_force(spark, k):
    points = [((i * 7919) % 5003, (i * 104729) % 997) for i in range(400)]
    centres = [((i * 31) % 5003, (i * 17) % 997) for i in range(k - 1)]
    centres.append(centres[0])  # a tie goes to the earlier centre
    table = spark.createDataFrame(points, "x int, y int")
    got = {(r.x, r.y): (r.cx, r.cy) for r in nearest_center(table, centres).collect()}
    for p in points:
        best = min(centres, key=lambda c: (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2)
        assert got[p] == best


@pytest.mark.parametrize("seed, k, scale", [(1, 300, (50000, 1)), (2, 3000, (1, 1)), (3, 700, (1, 300))])
def test_grid_of_centres_equals_the_linear_walk(spark, seed, k, scale):
    r = random.Random(seed)
    centres = [(r.randrange(15) * scale[0] - 3 * scale[0], r.randrange(-400, 400) * scale[1]) for _ in range(k)]
    centres += centres[:20]  # equal centres: the first counts
    points = [(r.randrange(-20, 30) * scale[0] + r.randrange(3), r.randrange(-900, 900) * scale[1]) for _ in range(600)] + centres[:200]
    points += [(cx + 1, cy) for cx, cy in centres[:50]] + [(-(1 << 31), 1 << 30), ((1 << 31) - 1, -5)]
    table = spark.createDataFrame(points, "x int, y int")
    grid = table.select("x", "y", CentreGrid(centres).nearest("x", "y").alias("c")).select("x", "y", "c.*")
    walk = table.select("x", "y", geometry._walk(centres, "x", "y").alias("c")).select("x", "y", "c.*")
    assert grid.dtypes == walk.dtypes
    assert sorted(map(tuple, grid.collect())) == sorted(map(tuple, walk.collect()))


def test_few_candidates_a_cell():
    r = random.Random(4)
    grid = CentreGrid([(r.randrange(100000), r.randrange(100000)) for _ in range(3000)])
    sizes = [len(c) for c in grid.cells]
    assert min(sizes) >= 1 and sum(sizes) / len(sizes) < 60


def test_grid_is_faster_than_the_walk(spark):
    r = random.Random(6)
    centres = [(r.randrange(100000), r.randrange(100000)) for _ in range(3000)]
    points = spark.range(0, 20_000, 1, 4).select((F.col("id") * 7919 % 100000).cast("int").alias("x"), (F.col("id") * 104729 % 100000).cast("int").alias("y"))
    took = {}
    for name, nearest in (("grid", CentreGrid(centres).nearest("x", "y")), ("walk", geometry._walk(centres, "x", "y"))):
        started = time.perf_counter()
        total = points.select(nearest["pos"].cast("long").alias("p")).agg(F.sum("p")).first()[0]
        took[name] = (total, time.perf_counter() - started)
    assert took["grid"][0] == took["walk"][0] and took["grid"][1] < took["walk"][1]


def test_one_row_a_point_and_distance_of_centre_lists(spark):
    table = spark.createDataFrame([(0, 0), (9, 0), (5, 1)], "x int, y int")
    got = sorted(tuple(x) for x in assigned_distance(table, [(0, 0), (10, 0)]).collect())
    assert got == [(0, 0, 0, 0, 0.0), (5, 1, 0, 0, 26.0), (9, 0, 10, 0, 1.0)]
    moved = centers_distance_of(spark, [(0, 0), (5, 5)], [(3, 4), (5, 5)])
    assert moved.first().distance == 25.0
    assert "Exchange" not in moved._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="length"):
        centers_distance_of(spark, [(0, 0)], [(0, 0), (1, 1)])


def full_steps(points, centres, steps):
    """Centres after each full step, in plain Python; a centre without points stays."""
    out = []
    for _ in range(steps):
        sums = {}
        for x, y, n in points:
            c = min(centres, key=lambda c: (x - c[0]) ** 2 + (y - c[1]) ** 2)
            a = sums.get(c, (0, 0, 0))
            sums[c] = (a[0] + x * n, a[1] + y * n, a[2] + n)
        cut = lambda a, n: abs(a) // n * (1 if a >= 0 else -1)
        centres = [(cut(sums[c][0], sums[c][2]), cut(sums[c][1], sums[c][2])) if c in sums else c for c in centres]
        out.append(centres)
    return out


@pytest.mark.parametrize("k, n, spread", [(45, 3000, 400), (1000, 4000, 3000)])
def test_incremental_steps_equal_full_steps(spark, k, n, spread):
    r = random.Random(k)
    hubs = [(r.randrange(-spread * 8, spread * 8), r.randrange(-spread * 8, spread * 8)) for _ in range(k)]
    points = sorted({(hx + r.randrange(-spread, spread), hy + r.randrange(-spread, spread)) for hx, hy in r.choices(hubs, k=n)})
    points = [(x, y, r.randrange(1, 4)) for x, y in points]
    centres = [p[:2] for p in r.sample(points, k - 2)]
    centres += [centres[0], (10**6, 10**6)]  # a repeated centre and one without points
    table = spark.createDataFrame(points, "x int, y int, n long").coalesce(4)
    steps = 6
    got = kmeans(table, centres, eta=-1.0, max_iterations=steps, on_empty="keep")
    want = full_steps(points, centres, steps)
    for step in range(steps):
        assert [(t[4], t[5]) for t in got.trace if t[0] == step + 1] == want[step]
    assert len(got.searched) == steps - 1 and got.searched[0] == len(points)
    assert got.searched[1] < len(points) and min(got.searched[1:]) < 0.7 * len(points)
    # A new anchor searches for all points again; on the whole fewer are searched than by full steps.
    assert sum(got.searched) < 0.85 * len(points) * len(got.searched)
