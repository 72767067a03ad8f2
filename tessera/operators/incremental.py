"""K-means steps that search again only for points whose nearest centre may have changed.

At an anchor step every point is assigned, and with its centre two distances are written: to that centre and to the
second nearest. When centres have moved since, by ``drift`` each, the point's own centre is at most
``first + drift`` away and every other at least ``second`` less the largest drift of the others. While the
one is below the other the assignment stands, with no tie, and nothing has to be computed for
the point. A later step therefore reads the anchor table through one comparison, searches for the
points that fail it, and corrects the anchor's sums by what these points moved from one centre to
another. The centres of every step are exactly those of a full step.

A step is one job that returns at most two rows a centre. When more than a ``REFRESH``-th of the points fail,
the step after it sets a new anchor.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Point, check_centres, distances_sql, nearest_centre
from ..session import materialize, release

REFRESH = 2
#: Room for the rounding of distances; relative.
SLACK = 1e-12


class Anchor:
    """A written assignment of ``points(x, y, n)`` to ``centres`` with its sums and distance bounds."""

    def __init__(self, points: DataFrame, centres: Sequence[Point]):
        self.centres = check_centres(centres)
        others = distances_sql(self.centres, "'pos', c.pos, 'd', {d}")
        found = points.select("x", "y", "n", nearest_centre(self.centres).alias("_c"))
        second = F.expr(f"array_min(transform(filter({others}, o -> o.pos <> _c.pos), o -> o.d))")
        self.table = materialize(
            found.select(
                "x", "y", "n", F.col("_c.pos").alias("pos"),
                (F.sqrt("_c.d") * (1 + SLACK)).alias("first"),
                F.coalesce(F.sqrt(second) * (1 - SLACK), F.lit(float("inf"))).alias("second"),
            )
        )
        self.sums: dict[int, tuple[int, int, int]] = {}
        self.size = 0
        for pos, x, y, n, rows in _sums(self.table.withColumn("sign", F.lit(1))):
            self.sums[pos] = (x, y, n)
            self.size += rows

    def moved_sums(self, centres: Sequence[Point]) -> tuple[dict[int, tuple[int, int, int]], int]:
        """Sums of x, y and n by position for an assignment to ``centres``, and how many points were searched."""
        centres = check_centres(centres)
        if len(centres) != len(self.centres):
            raise ValueError("centre lists differ in length")
        drift = [math.dist(a, b) * (1 + SLACK) for a, b in zip(self.centres, centres)]
        far = max(range(len(drift)), key=drift.__getitem__)
        next_far = max((d for i, d in enumerate(drift) if i != far), default=0.0)
        own = F.expr(f"CAST(split('{','.join(map(repr, drift))}', ',') AS ARRAY<DOUBLE>)")[F.col("pos")]
        rest = F.when(F.col("pos") == far, F.lit(next_far)).otherwise(F.lit(drift[far]))
        unsure = self.table.where(~(F.col("first") + own < F.col("second") - rest))
        searched = unsure.select("x", "y", "n", "pos", nearest_centre(centres)["pos"].alias("now"))
        moves = F.explode(F.array(*[F.struct(F.col(c).alias("pos"), F.lit(s).alias("sign")) for c, s in (("pos", -1), ("now", 1))]))
        sums, count = dict(self.sums), 0
        for pos, x, y, n, rows in _sums(searched.select("x", "y", "n", moves.alias("m")).select("x", "y", "n", "m.*")):
            before = sums.get(pos, (0, 0, 0))
            sums[pos] = (before[0] + x, before[1] + y, before[2] + n)
            count += rows
        return sums, count // 2

    def release(self) -> None:
        release(self.table)


def _sums(rows: DataFrame) -> list[tuple[int, int, int, int, int]]:
    """``(pos, sum of x, of y, of n, rows)`` a position, at most a row a centre; exact."""
    weight = F.col("n") * F.col("sign")
    whole = [F.sum(F.col(c).cast("decimal(38,0)") * weight).alias(c) for c in ("x", "y")]
    found = rows.groupBy("pos").agg(*whole, F.sum(weight).alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    return [(r["pos"], int(r["x"]), int(r["y"]), int(r["n"]), int(r["rows"])) for r in found]


def means(centres: Sequence[Point], sums: dict[int, tuple[int, int, int]]) -> dict[Point, Point]:
    """Old centre value to the mean of its points, truncated toward zero; equal centres share their points."""
    by_value: dict[Point, tuple[int, int, int]] = {}
    for pos, (x, y, n) in sums.items():
        before = by_value.get(centres[pos], (0, 0, 0))
        by_value[centres[pos]] = (before[0] + x, before[1] + y, before[2] + n)
    return {c: (_div(x, n), _div(y, n)) for c, (x, y, n) in by_value.items() if n}


def _div(a: int, n: int) -> int:
    return abs(a) // n * (1 if a >= 0 else -1)


class Incremental:
    """Successive steps over ``points(x, y, n)``; :attr:`searched` has the points searched in each."""

    def __init__(self, points: DataFrame):
        self.points, self.anchor, self.stale, self.searched = points, None, True, []

    def means(self, centres: Sequence[Point]) -> dict[Point, Point]:
        if self.stale:
            self.close()
            self.anchor, self.stale = Anchor(self.points, centres), False
            sums, count = self.anchor.sums, self.anchor.size
        else:
            sums, count = self.anchor.moved_sums(centres)
            self.stale = count * REFRESH > self.anchor.size
        self.searched.append(count)
        return means(check_centres(centres), sums)

    def close(self) -> None:
        if self.anchor is not None:
            self.anchor.release()
            self.anchor = None
