"""Nearest neighbours by a block matrix join over int8 product tiles.

Queries and candidates are dealt into blocks by a hash, and every pair of a query block and
a candidate block is one cell of the join. A cell holds at most about ``BLOCK_ROWS`` rows a
side whatever the table's size; the query set is the one the caller states.

In a cell each vector is ``scale * int8 + residual``. Products of int8 tiles are whole
numbers that float32 holds exactly (1024 dimensions at a time), so they give the distance
of the rounded vectors, and the residual norms bound how far the true distance can be from
it. Pairs whose lower bound exceeds the query's k-th smallest upper bound cannot be among
the k nearest; the others are computed again in double precision from the original vectors
and go through a heap. A window over the cells' heaps gives the result, which is exact.

Equal vectors of a block are compared once: only their ``k + 1`` smallest ids can matter. Bounds and
heaps count ids, each by its nearest vector in the block, so an id with many vectors takes one place.

Results for special rows: a vector that is null, empty, zero or holds null or non-finite
components, and a null id, take no part; rows repeated with one id and vector count once; if
an id has several vectors, its smallest distance counts, and it is never its own neighbour;
vectors are compared with those of the same length only; ties go to the smaller id; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK_ROWS = 16384
TILE_QUERIES = 128
EXACT_DIMENSIONS = 1024  # 1024 * 127 * 127 < 2**24


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows, their scales and the norms of the residuals."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.sqrt(((x - scale[:, None] * q) ** 2).sum(axis=1))


def tile_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of two int8 tiles."""
    out = np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], EXACT_DIMENSIONS):
        part = slice(at, at + EXACT_DIMENSIONS)
        out += a[:, part].astype(np.float32) @ b[:, part].astype(np.float32).T
    return out


def exact_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of rows, added component by component in double precision."""
    d = np.ascontiguousarray((a - b).T)  # a sum over the outer axis adds row by row
    return np.sqrt((d * d).sum(axis=0))


def _distinct(ids: np.ndarray, x: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` smallest ids of every distinct vector."""
    rows = np.ascontiguousarray(x).view(f"V{x.shape[1] * 8}").ravel()
    _, group = np.unique(rows, return_inverse=True)
    order = np.lexsort((ids, group))
    g = group[order]
    first = np.concatenate(([0], np.flatnonzero(g[1:] != g[:-1]) + 1))
    place = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    return order[place < keep]


def _by_id(about: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The smallest value of each id's columns, which stand together."""
    return np.minimum.reduceat(about, starts, axis=1)


def nearest_in_cell(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """``(query_id, vec_id, distance)`` of the k nearest of each query inside the cell."""
    x = c + 0.0  # one zero, so that equal vectors have equal bytes
    at = _distinct(c_ids, x, k + 1)
    at = at[np.argsort(c_ids[at], kind="stable")]
    c_ids, c = c_ids[at], x[at]
    starts = np.concatenate(([0], np.flatnonzero(c_ids[1:] != c_ids[:-1]) + 1))
    own = c_ids[starts]
    c8, c_scale, c_rest = quantise(c)
    c_norm = c_scale * np.sqrt((c8.astype(np.float64) ** 2).sum(axis=1))
    out = []
    for start in range(0, len(q), TILE_QUERIES):
        ids, part = q_ids[start : start + TILE_QUERIES], q[start : start + TILE_QUERIES]
        q8, scale, rest = quantise(part)
        norm = scale * np.sqrt((q8.astype(np.float64) ** 2).sum(axis=1))
        squared = norm[:, None] ** 2 + c_norm[None, :] ** 2 - 2 * np.outer(scale, c_scale) * tile_products(q8, c8)
        about = np.sqrt(np.maximum(squared, 0))
        slack = rest[:, None] + c_rest[None, :] + 1e-7 * (norm[:, None] + c_norm[None, :])
        about[ids[:, None] == c_ids[None, :]] = np.inf
        upper = about + slack
        limit = np.partition(_by_id(upper, starts), k - 1, axis=1)[:, k - 1] if len(own) > k else np.full(len(ids), np.inf)
        row, col = np.nonzero((about - slack <= limit[:, None]) & np.isfinite(about))
        heaps: dict[int, list[tuple[float, int]]] = {}
        for at in range(0, len(row), 65536):
            r, s = row[at : at + 65536], col[at : at + 65536]
            d, v = exact_distance(part[r], c[s]), c_ids[s]
            nearest_vector = np.lexsort((d, v, r))  # of an id only the nearest vector goes on
            r, d, v = r[nearest_vector], d[nearest_vector], v[nearest_vector]
            first = np.concatenate(([True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])))
            for i, d, v in zip(r[first].tolist(), d[first].tolist(), v[first].tolist()):
                heap = heaps.setdefault(i, [])
                if heap and any(-w == v for _, w in heap):  # the id's vectors reach over two slices of pairs
                    kept = [(e, w) for e, w in heap if -w != v]
                    d = min([d, *(-e for e, w in heap if -w == v)])
                    heap[:] = kept
                    heapq.heapify(heap)
                if len(heap) < k:
                    heapq.heappush(heap, (-d, -v))
                elif (-d, -v) > heap[0]:
                    heapq.heapreplace(heap, (-d, -v))
        out += [(int(ids[i]), -v, -d) for i, heap in heaps.items() for d, v in heap]
    return out


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.combine_chunks()
    ids = table.column("vec_id").to_numpy().astype(np.int64)
    vectors = table.column("embedding").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return ids, flat.reshape(len(ids), -1)


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of every query among all rows but its own."""
    rows = vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asked")
    )
    rows = cut(rows.dropDuplicates(["vec_id", "embedding"]).withColumn("dim", F.size("embedding")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asked").cast("long")).alias("q")).first()
    blocks, query_blocks = max(1, -(-size["n"] // block_rows)), max(1, -(-(size["q"] or 0) // block_rows))
    spread = F.xxhash64("vec_id", "embedding")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    queries = rows.filter("asked").select("dim", F.pmod(spread, F.lit(query_blocks)).cast("int").alias("qb"), every(blocks).alias("cb"), "vec_id", "embedding")
    candidates = rows.select("dim", every(query_blocks).alias("qb"), F.pmod(spread, F.lit(blocks)).cast("int").alias("cb"), "vec_id", "embedding")

    def cell(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = nearest_in_cell(*_matrix(left), *_matrix(right), k)
        return pa.table(
            {
                "query_id": pa.array([f[0] for f in found], pa.int64()),
                "vec_id": pa.array([f[1] for f in found], pa.int64()),
                "score": pa.array([f[2] for f in found], pa.float64()),
            }
        )

    keys = ["dim", "qb", "cb"]
    cells = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score double")
    best = cells.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
