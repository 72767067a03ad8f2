"""Hard negatives by segment summary filtering.

Vectors are made whole numbers, ``floor(256 x)``, and a score is the inner product of two of them. The
positives of an anchor are the best rows of its label; the negatives of an anchor and a positive
are the best rows of other labels whose score lies between two shares of the positive's.

A vector is cut into segments, and of each segment its mean and its deviation (the norm of what is left
without the mean) are kept. For a segment of length ``m`` the product of two vectors lies within
``m * mean * mean'`` plus or minus ``deviation * deviation'``, so two small matrix products
bound all scores of a tile from below and above. A level halves the segments of the level before,
``LEVELS`` of them; candidates that cannot reach an answer go at each level, and only those left are
scored exactly, in whole numbers.

Both searches are block joins of the stated anchors against all rows: anchors and candidates are dealt
into blocks by a hash, and a cell joins one block of each. Positives are joined within blocks of a label (a hot label has more
blocks), negatives within blocks of all rows. A cell returns a bounded list for each anchor and the lists are merged by a window
that is limited before its shuffle. No cell holds more than about ``BLOCK_ROWS`` rows a side.

Results for special rows: a null id, a null label, a null vector or one with a null or non-finite component takes
no part, nor does an empty vector; of several rows of one id the one with the smallest label, then
vector counts; rows score only with vectors of the same length; ties go to the smaller id;
a component counts as at most ``LARGEST`` either way, so that scores stay whole 64-bit numbers; an anchor without
positives, or a positive without negatives in its range, gives no rows; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

SCALE = 256
LARGEST = 1 << 26
POSITIVES = 5
NEGATIVES = 10
#: A negative's score is at least LOW and at most HIGH hundredths of the positive's.
LOW, HIGH = 30, 90
BLOCK_ROWS = 16384
TILE = 128
#: Segments of each level.
LEVELS = (1, 4, 16)


class Summaries:
    """Segment means and deviations of whole-number rows, a pair of matrices a level."""

    def __init__(self, x: np.ndarray, levels: tuple[int, ...] = LEVELS):
        x = x.astype(np.float64)
        self.levels = []
        for segments in sorted({min(n, x.shape[1]) for n in levels}):
            edges = np.linspace(0, x.shape[1], segments + 1).astype(int)
            sizes = np.diff(edges)
            mean = np.add.reduceat(x, edges[:-1], axis=1) / sizes
            rest = x - np.repeat(mean, sizes, axis=1)
            deviation = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))
            self.levels.append((mean * np.sqrt(sizes), deviation))

    def bounds(self, level: int, rows: np.ndarray, other: "Summaries", columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest scores of ``rows`` with ``columns`` of the other, with room for rounding."""
        (mean, dev), (mean_, dev_) = self.levels[level], other.levels[level]
        mean, dev, mean_, dev_ = mean[rows], dev[rows], mean_[columns], dev_[columns]
        about, slack = mean @ mean_.T, dev @ dev_.T
        length = np.sqrt((mean**2).sum(1) + (dev**2).sum(1))[:, None] * np.sqrt((mean_**2).sum(1) + (dev_**2).sum(1))[None, :]
        slack += 1e-9 * length + 1e-6
        return about - slack, about + slack


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows; in doubles where those are exact."""
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 2**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def largest(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, or minus infinity where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def best(scores: np.ndarray, ids: np.ndarray, wanted: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the places of its k best wanted candidates, ties to the smaller id."""
    out = []
    for row, mask in zip(scores, wanted):
        at = np.flatnonzero(mask)
        out.append(at[np.lexsort((ids[at], -row[at]))[:k]])
    return out


class Block:
    """Candidates of a cell: of equal vectors of a label only the ``keep`` smallest ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, keep: int, levels: tuple[int, ...] = LEVELS):
        both = np.ascontiguousarray(np.column_stack((labels, x)))
        _, group = np.unique(both.view(f"V{both.shape[1] * 8}").ravel(), return_inverse=True)
        order = np.lexsort((ids, group))
        g = group[order]
        first = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1]) + 1))
        place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
        at = order[place < keep]
        self.ids, self.labels, self.x = ids[at], labels[at], x[at]
        self.summaries = Summaries(self.x, levels)


def positives_in_cell(ids: np.ndarray, x: np.ndarray, block: Block, k: int) -> list[tuple[int, int, int]]:
    """``(anchor, candidate, score)`` of the k best other candidates of every anchor."""
    own, out = Summaries(x), []
    for at in range(0, len(ids), TILE):
        rows, columns = np.arange(at, min(at + TILE, len(ids))), np.arange(len(block.ids))
        for level in range(len(own.levels)):
            low, high = own.bounds(level, rows, block.summaries, columns)
            # The anchor itself may be among the k + 1 best.
            columns = columns[(high >= largest(low, k + 1)[:, None]).any(axis=0)]
        scores = exact_scores(x[rows], block.x[columns])
        found = block.ids[columns]
        for i, places in zip(rows, best(scores, found, found[None, :] != ids[rows, None], k)):
            out += [(int(ids[i]), int(found[j]), int(scores[i - at, j])) for j in places]
    return out


def negatives_in_cell(
    ids: np.ndarray, labels: np.ndarray, x: np.ndarray, positives: list[list[tuple[int, int]]], block: Block, k: int, low_share: int, high_share: int
) -> list[tuple[int, int, int, int, int]]:
    """``(anchor, positive, positive_score, candidate, score)`` of the k best candidates in each positive's range."""
    own, out = Summaries(x), []
    widest = max((len(p) for p in positives), default=0)
    # Ranges that no score can meet stand for missing positives.
    floor_, ceiling = np.full((len(ids), widest), 1.0), np.zeros((len(ids), widest))
    for i, pairs in enumerate(positives):
        for j, (_, score) in enumerate(pairs):
            floor_[i, j], ceiling[i, j] = -(-low_share * score // 100), high_share * score // 100
    for at in range(0, len(ids), TILE):
        rows, columns = np.arange(at, min(at + TILE, len(ids))), np.arange(len(block.ids))
        for level in range(len(own.levels)):
            low, high = own.bounds(level, rows, block.summaries, columns)
            other = labels[rows, None] != block.labels[columns][None, :]
            needed = np.zeros(low.shape, bool)
            for j in range(widest):
                lo, hi = floor_[rows, j, None], ceiling[rows, j, None]
                sure = other & (low >= lo) & (high <= hi)
                reach = largest(np.where(sure, low, -np.inf), k)
                needed |= other & (low <= hi) & (high >= np.maximum(lo, reach[:, None]))
            columns = columns[needed.any(axis=0)]
        scores = exact_scores(x[rows], block.x[columns])
        found, other = block.ids[columns], labels[rows, None] != block.labels[columns][None, :]
        for j in range(widest):
            wanted = other & (scores >= floor_[rows, j, None]) & (scores <= ceiling[rows, j, None])
            for i, places in zip(rows, best(scores, found, wanted, k)):
                if len(places):
                    positive, score = positives[i][j]
                    out += [(int(ids[i]), positive, score, int(found[c]), int(scores[i - at, c])) for c in places]
    return out


def whole(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component, as whole numbers within ``LARGEST``."""
    limit = float(LARGEST)
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * scale))).cast("long"))


def prepared(vectors: DataFrame, label: Column, is_anchor: Column, scale: int = SCALE) -> DataFrame:
    """``(vec_id, label, x, dim, asked)``, one row an id."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding"), is_anchor.alias("asked"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & finite)
    rows = rows.select("vec_id", "label", whole(F.col("embedding"), scale).alias("x"), F.coalesce("asked", F.lit(False)).alias("asked"))
    one = rows.groupBy("vec_id").agg(F.min(F.struct("label", "x", "asked")).alias("r")).select("vec_id", "r.*")
    return one.withColumn("dim", F.size("x"))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    flat = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return table.column("vec_id").to_numpy().astype(np.int64), table.column("label").to_numpy().astype(np.int64), flat.reshape(table.num_rows, -1)


def _dealt(anchors: DataFrame, rows: DataFrame, sizes: DataFrame, by: list[str], block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Anchors and candidates, each copied to every cell it takes part in: block ``qb`` of anchors with block ``cb``."""
    blocks = sizes.select(
        *[F.col(c).alias(f"s_{c}") for c in by], F.ceil(F.col("n") / block_rows).alias("blocks"), F.greatest(F.ceil(F.col("asked") / block_rows), F.lit(1)).alias("query_blocks")
    )
    where = [F.col(c) == F.col(f"s_{c}") for c in by]
    hashed = F.xxhash64("vec_id")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    def to_cells(df: DataFrame, deal: dict[str, Column]) -> DataFrame:
        return df.join(blocks, where).select(*[F.col(c).alias(c) for c in df.columns], *[c.cast("long").alias(n) for n, c in deal.items()])

    queries = to_cells(anchors, {"qb": F.pmod(hashed, F.col("query_blocks")), "blocks": F.col("blocks")}).withColumn("cb", every("blocks")).drop("blocks")
    candidates = to_cells(rows, {"cb": F.pmod(hashed, F.col("blocks")), "query_blocks": F.col("query_blocks")}).withColumn("qb", every("query_blocks")).drop("query_blocks")
    return queries, candidates


def positives(rows: DataFrame, k: int = POSITIVES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(anchor_id, positive_id, score)``: the k best other rows of every anchor's label."""
    keys = ["dim", "label"]
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if("asked").alias("asked")).filter("asked > 0 AND n > 1")
    queries, candidates = _dealt(rows.filter("asked").drop("asked"), rows.drop("asked"), cut(sizes), keys, block_rows)

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            ids, _, x = _matrix(left)
            found = positives_in_cell(ids, x, Block(*_matrix(right), k + 1), k)
        return pa.table({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate(("anchor_id", "positive_id", "score"))})

    keys += ["qb", "cb"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(cell, "anchor_id long, positive_id long, score long")
    place = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")
    return found.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k).drop("place")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
    low_share: int = LOW, high_share: int = HIGH, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``."""
    rows = cut(prepared(vectors, F.col("label") if label is None else label, is_anchor, scale))
    near = positives(rows, n_positives, block_rows)
    pairs = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_id", "score"))).alias("positives"))  # at most n_positives
    anchors = cut(rows.filter("asked").drop("asked").join(pairs, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"))
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    asked = anchors.groupBy("dim").agg(F.count(F.lit(1)).alias("asked"))
    queries, candidates = _dealt(anchors, rows.drop("asked"), cut(sizes.join(asked, "dim")), ["dim"], block_rows)
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            given = [[(p["positive_id"], p["score"]) for p in ps] for ps in left.column("positives").to_pylist()]
            found = negatives_in_cell(*_matrix(left), given, Block(*_matrix(right), n_negatives), n_negatives, low_share, high_share)
        return pa.table({n: pa.array([f[i] for f in found], pa.int64()) for i, n in enumerate(names)})

    keys = ["dim", "qb", "cb"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(cell, ", ".join(f"{n} long" for n in names))
    place = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= n_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, min({'label': CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT, 'x': list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT)}) AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND list_count(embedding) = len(embedding) AND isfinite(list_min(embedding)) AND isfinite(list_max(embedding))
  GROUP BY vec_id),
p AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.r.label = c.r.label AS same, list_sum(list_transform(list_zip(a.r.x, c.r.x), lambda z: z[1] * z[2]))::BIGINT AS s
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.r.x) = len(c.r.x) WHERE a.vec_id % 100 = 0),
g AS (SELECT a, c, s FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, c) <= 5)
SELECT g.a AS anchor_id, g.c AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, p.c AS negative_id, g.s AS positive_score, p.s AS negative_score
FROM g JOIN p ON g.a = p.a AND NOT p.same AND 30 * g.s <= 100 * p.s AND 100 * p.s <= 90 * g.s
WINDOW w AS (PARTITION BY g.a, g.c ORDER BY p.s DESC, p.c) QUALIFY row_number() OVER w <= 10
"""
