"""Distinct points and deterministic starting-centre samples.

Samples are bottom-k by ``md5(seed|x|y)``: uniform without replacement,
independent of partitioning and run order, and reproducible from SQL. Both
samples return ``(pos, x, y)`` with ``pos`` the centre's 0-based position.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SAMPLE_SEED, SMALL_SPREAD_THRESHOLD
from ..functions.geometry import Point
from ..functions.text import check_vocabulary


def sample_key(seed: int = SAMPLE_SEED) -> Column:
    """Hex md5 of ``'seed|x|y'``; ordering by it is a seeded random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("x").cast("string"), F.col("y").cast("string")))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Distinct ``(x, y)`` points (any weight column is dropped)."""
    return vectors.select("x", "y").dropDuplicates()


def sample_per_language(
    vectors: DataFrame, langs: Sequence[str], kernels: int, seed: int = SAMPLE_SEED
) -> DataFrame:
    """``kernels / len(langs)`` distinct points per term, ordered by x then draw order.

    Per term the points with the smallest keys are kept. Spark plans the
    ``row_number() <= k`` filter as a group limit that already runs before
    the shuffle, so each map task sends at most k rows per term however
    large a term is. Fails when ``kernels`` is not a multiple of the
    vocabulary size or when some term has too few distinct points.
    """
    terms = check_vocabulary(langs)
    if kernels <= 0 or kernels % len(terms) != 0:
        raise ValueError("kernels must be a positive multiple of the vocabulary size")
    per_lang = kernels // len(terms)
    keyed = distinct_vectors(vectors).withColumn("_h", sample_key(seed))
    draw = Window.partitionBy("x").orderBy("_h", "y")
    picked = keyed.withColumn("_rn", F.row_number().over(draw)).where(F.col("_rn") <= per_lang)
    return _numbered(picked, kernels, ("x", "_h", "y"))


def sample_global(vectors: DataFrame, kernels: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """``kernels`` distinct points drawn from the whole space, in draw order.

    ``orderBy(...).limit(k)`` runs as a per-task top-k followed by one merge
    of at most k rows per task.
    """
    if kernels <= 0:
        raise ValueError("kernels must be positive")
    keyed = distinct_vectors(vectors).withColumn("_h", sample_key(seed))
    picked = keyed.orderBy("_h", "x", "y").limit(kernels)
    return _numbered(picked, kernels, ("_h", "x", "y"))


def sample_vectors(
    vectors: DataFrame, langs: Sequence[str], kernels: int, spread: int, seed: int = SAMPLE_SEED
) -> DataFrame:
    """Starting centres: the whole-space sample when ``spread`` is below the
    small-spread threshold (terms are then too close to sample separately),
    else the per-term sample."""
    if spread < SMALL_SPREAD_THRESHOLD:
        return sample_global(vectors, kernels, seed)
    return sample_per_language(vectors, langs, kernels, seed)


def _numbered(picked: DataFrame, kernels: int, order: Sequence[str]) -> DataFrame:
    """Number the picked rows by ``order``; fail unless there are exactly ``kernels``.

    At most ``kernels + 1`` rows are taken (enough to tell "too many"), so
    the one row that gathers them is bounded by the ``kernels`` parameter,
    not by the data. An empty sample fails too. Everything stays in one
    pipeline, so the upstream plan is computed once.
    """
    rows = picked.select(F.struct(*[F.col(c) for c in order]).alias("_r")).limit(kernels + 1)
    gathered = rows.agg(F.collect_list("_r").alias("_s"))
    wrong_size = F.raise_error(
        F.concat(F.lit(f"sample has the wrong size (wanted {kernels}): "), F.size("_s").cast("string"))
    )
    checked = gathered.select(F.when(F.size("_s") == kernels, F.array_sort("_s")).otherwise(wrong_size).alias("_s"))
    return checked.select(F.posexplode("_s").alias("pos", "_r")).select(
        F.col("pos").cast("int").alias("pos"),
        F.col("_r.x").cast("int").alias("x"),
        F.col("_r.y").cast("int").alias("y"),
    )


def take_centres(sample: DataFrame) -> list[Point]:
    """Collect a ``(pos, x, y)`` centre table, of ``kernels`` rows, in position order."""
    rows = sample.orderBy("pos").collect()
    return [(int(r["x"]), int(r["y"])) for r in rows]
