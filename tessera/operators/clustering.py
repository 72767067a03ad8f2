"""Integer k-means over 2-D points.

Semantics kept: squared Euclidean distance in double precision; a point goes
to the earliest of equally near centres; the new centre is the mean of its
points truncated toward zero after an exact integer sum; centres are matched
by value, so duplicate centres move together; the loop stops when the summed
squared move is below ``eta`` or after ``max_iterations`` steps and returns
the new centres.

Execution: points are reduced once to ``(x, y, n)`` and that table is cut
from its lineage (checkpointed to the session's shared checkpoint folder, or
persisted when none is set). Each step is one job: a narrow projection
assigns points against the centres inlined as literals, and one partially
aggregated ``groupBy`` returns at most k rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..constants import KMEANS_ETA, KMEANS_MAX_ITERATIONS
from ..functions.geometry import (
    Point,
    centres_distance_py,
    check_centres,
    distances_sql,
    nearest_centre,
    point_distance_py,
    squared_distance,
)
from ..functions.literals import struct_array
from ..schemas import CENTRE, KMEANS_TRACE
from ..session import literal_frame, materialize, release
from .incremental import Incremental
from .postings import weighted_vectors


MOVE = StructType([StructField(c, IntegerType()) for c in ("ox", "oy", "nx", "ny")])


class EmptyClusterError(RuntimeError):
    """A centre attracted no point during a k-means step."""


def weight_column(points: DataFrame) -> Column:
    """Multiplicity of each row: ``n`` for weighted points, else 1."""
    return F.col("n") if "n" in points.columns else F.lit(1).cast("long")


def int_div(numerator: Column, denominator: Column) -> Column:
    """Integer division truncating toward zero, exact on longs and decimals (SQL ``div``)."""
    return F.call_function("div", numerator, denominator)


def assign(points: DataFrame, centres: Sequence[Point]) -> DataFrame:
    """``points`` plus ``cx, cy`` (value of the nearest centre) and ``cpos``."""
    nearest = nearest_centre(centres)
    return points.withColumn("_c", nearest).select(
        *points.columns,
        F.col("_c.pos").alias("cpos"),
        F.col("_c.cx").alias("cx"),
        F.col("_c.cy").alias("cy"),
    )


def nearest_center(points: DataFrame, centres: Sequence[Point]) -> DataFrame:
    """``(x, y, cx, cy)``: each point with the value of its closest centre."""
    return assign(points.select("x", "y"), centres).select("x", "y", "cx", "cy")


def point_distance(points: DataFrame, centres: Sequence[Point]) -> DataFrame:
    """``(x, y, pos, cx, cy, distance)`` for every point against every centre.

    Generated per point from the inlined centre list (no join).
    """
    fields = "'pos', c.pos, 'cx', c.cx, 'cy', c.cy, 'distance', {d}"
    return points.select("x", "y", F.inline(F.expr(distances_sql(centres, fields))))


def assigned_distance(points: DataFrame, centres: Sequence[Point]) -> DataFrame:
    """``(x, y, cx, cy, distance)``: each point, its nearest centre and the squared distance to it.

    One row per point, where :func:`point_distance` has one per point and centre.
    """
    return assign(points.select("x", "y"), centres).select(
        "x", "y", "cx", "cy", squared_distance(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")).alias("distance")
    )


def average_vectors(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean point per group of ``by``: ``(*by, x, y, n)``, coordinates truncated toward zero.

    Sums are exact (38-digit decimals, weighted by ``n`` when present).
    """
    w = weight_column(points)
    sums = points.groupBy(*by).agg(
        F.sum(F.col("x").cast("decimal(38,0)") * w).alias("_sx"),
        F.sum(F.col("y").cast("decimal(38,0)") * w).alias("_sy"),
        F.sum(w).alias("n"),
    )
    return sums.select(
        *by,
        int_div(F.col("_sx"), F.col("n")).cast("int").alias("x"),
        int_div(F.col("_sy"), F.col("n")).cast("int").alias("y"),
        F.col("n"),
    )


def step_means(points: DataFrame, centres: Sequence[Point]) -> dict[Point, Point]:
    """Old centre value -> mean of its points, for centres that got points (one job)."""
    centres = check_centres(centres)
    assigned = assign(points, centres)
    means = average_vectors(assigned, by=("cx", "cy"))
    rows = means.collect()  # at most len(centres) rows
    return {(int(r["cx"]), int(r["cy"])): (int(r["x"]), int(r["y"])) for r in rows}


def kmeans_step(points: DataFrame, centres: Sequence[Point], on_empty: str = "error") -> list[Point]:
    """New centre list, position for position.

    A centre without points raises :class:`EmptyClusterError`
    (``on_empty='error'``) or stays where it is (``on_empty='keep'``).
    """
    if on_empty not in ("error", "keep"):
        raise ValueError("on_empty must be 'error' or 'keep'")
    return _moved(centres, step_means(points, centres), on_empty)


def _moved(centres: Sequence[Point], moved: dict[Point, Point], on_empty: str) -> list[Point]:
    new: list[Point] = []
    for c in check_centres(centres):
        if c in moved:
            new.append(moved[c])
        elif on_empty == "keep":
            new.append(c)
        else:
            raise EmptyClusterError(f"centre {c} has no points")
    return new


@dataclass
class KMeansResult:
    centres: list[Point]
    iterations: int
    converged: bool
    trace: list[tuple] = field(default_factory=list)
    #: Points whose nearest centre was searched for, in each step after the first.
    searched: list[int] = field(default_factory=list)

    def centres_frame(self, spark: SparkSession) -> DataFrame:
        """``(pos, x, y)`` of the final centres (k rows)."""
        return centres_frame(spark, self.centres)

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        """One row per step and centre: old and new value, its move and the step's total move."""
        return literal_frame(spark, self.trace, KMEANS_TRACE)


def centres_frame(spark: SparkSession, centres: Sequence[Point]) -> DataFrame:
    centres = check_centres(centres)
    return literal_frame(spark, [(i, x, y) for i, (x, y) in enumerate(centres)], CENTRE)


def kmeans(
    points: DataFrame,
    centres: Sequence[Point],
    eta: float = KMEANS_ETA,
    max_iterations: int = KMEANS_MAX_ITERATIONS,
    iteration: int = 1,
    on_empty: str = "error",
    debug: bool = False,
    cache_points: bool = True,
) -> KMeansResult:
    """Run k-means from ``centres`` until the summed squared move is below ``eta``.

    ``points`` is ``(x, y)`` or weighted ``(x, y, n)``. ``iteration`` is the
    number of the first step, as when resuming; at most
    ``max_iterations - iteration + 1`` steps run. Pass ``cache_points=False``
    when ``points`` is already a materialized ``(x, y, n)`` table.

    From the second step on the points are searched again only where their nearest
    centre may have changed (:mod:`.incremental`); the centres are the same.
    """
    if on_empty not in ("error", "keep"):
        raise ValueError("on_empty must be 'error' or 'keep'")
    means = check_centres(centres)
    table = materialize(weighted_vectors(points)) if cache_points else points
    trace: list[tuple] = []
    steps = Incremental(table)
    try:
        step = iteration
        while True:
            # The first step moves centres furthest: bounds set before it would not hold for long.
            moved = step_means(table, means) if step == iteration else steps.means(means)
            new = _moved(means, moved, on_empty)
            moves = [point_distance_py(a, b) for a, b in zip(means, new)]
            distance = centres_distance_py(means, new)
            trace.extend(
                (step, pos, a[0], a[1], b[0], b[1], move, distance)
                for pos, (a, b, move) in enumerate(zip(means, new, moves))
            )
            if debug:
                print(f"step {step}: centres moved by {distance:g} in all (stops below {eta:g})")
                for move, a, b in sorted(zip(moves, means, new), reverse=True):
                    print(f"  {move:12g}  {a} to {b}")
            if distance < eta:
                return KMeansResult(new, step, True, trace, steps.searched)
            if step >= max_iterations:
                if debug:
                    print(f"stopped after step {step} without settling")
                return KMeansResult(new, step, False, trace, steps.searched)
            means = new
            step += 1
    finally:
        steps.close()
        if cache_points:
            release(table)


def centers_distance_of(spark: SparkSession, old: Sequence[Point], new: Sequence[Point]) -> DataFrame:
    """One row ``distance``: the summed squared move between two centre lists of equal length.

    The lists are one array literal that an expression folds, so nothing is joined or shuffled.
    """
    old, new = check_centres(old), check_centres(new)
    if len(old) != len(new):
        raise ValueError("centre lists differ in length")
    moves = struct_array([(a[0], a[1], b[0], b[1]) for a, b in zip(old, new)], MOVE)
    total = F.aggregate(moves, F.lit(0.0), lambda acc, m: acc + squared_distance(m["ox"], m["oy"], m["nx"], m["ny"]))
    return spark.range(1).select(total.alias("distance"))


def centers_distance(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row ``distance``: summed squared move between two ``(pos, x, y)`` centre tables.

    Both tables hold at most k rows; they are matched on ``pos`` and must
    have the same positions.
    """
    o = old.select("pos", F.col("x").alias("ox"), F.col("y").alias("oy"))
    n = new.select("pos", F.col("x").alias("nx"), F.col("y").alias("ny"))
    paired = o.join(n, "pos", "full_outer")
    mismatch = F.raise_error(F.lit("centre lists differ in length"))
    move = F.when(F.col("ox").isNull() | F.col("nx").isNull(), mismatch).otherwise(
        squared_distance(F.col("ox"), F.col("oy"), F.col("nx"), F.col("ny"))
    )
    return paired.agg(F.sum(move).alias("distance"))
