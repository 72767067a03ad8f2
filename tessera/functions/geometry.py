"""Distance and nearest-centre expressions over integer points.

Centres are a short driver-side list (at most ``kernels`` entries) that is
inlined as literals, so assigning a point to its centre is a narrow,
codegen-compiled projection: no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Point = tuple[int, int]

#: Number of centres from which they are looked up in a grid, and most lines of a grid an axis.
INDEXED = 256
MOST_LINES = 64


def squared_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Squared Euclidean distance; differences are taken in double precision.

    No square root: the k-means convergence test compares this sum of
    squares with ``eta``.
    """
    dx = x1.cast("double") - x2.cast("double")
    dy = y1.cast("double") - y2.cast("double")
    return dx * dx + dy * dy


def point_distance_py(p: Point, q: Point) -> float:
    """Driver-side twin of :func:`squared_distance` for centre lists."""
    dx = float(p[0] - q[0])
    dy = float(p[1] - q[1])
    return dx * dx + dy * dy


def centres_distance_py(old: Sequence[Point], new: Sequence[Point]) -> float:
    """Sum of squared moves between two centre lists of equal length."""
    if len(old) != len(new):
        raise ValueError("centre lists differ in length")
    return sum(point_distance_py(a, b) for a, b in zip(old, new))


def check_centres(centres: Sequence[Point]) -> list[Point]:
    centres = [(int(x), int(y)) for x, y in centres]
    if not centres:
        raise ValueError("no centres given")
    return centres


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def centre_array_sql(centres: Sequence[Point]) -> str:
    """The centres as one array literal of ``struct<pos, cx, cy>``, which Spark folds to a constant."""
    structs = (
        f"named_struct('pos', {pos}, 'cx', CAST({cx} AS INT), 'cy', CAST({cy} AS INT))"
        for pos, (cx, cy) in enumerate(check_centres(centres))
    )
    return f"array({', '.join(structs)})"


def distances_sql(centres: Sequence[Point], fields: str, x: str = "x", y: str = "y") -> str:
    """``transform`` of the centre array; ``fields`` may use ``c`` and the squared distance ``{d}``."""
    dx = f"(CAST({_quoted(x)} AS DOUBLE) - CAST(c.cx AS DOUBLE))"
    dy = f"(CAST({_quoted(y)} AS DOUBLE) - CAST(c.cy AS DOUBLE))"
    struct = fields.format(d=f"{dx} * {dx} + {dy} * {dy}")
    return f"transform({centre_array_sql(centres)}, c -> named_struct({struct}))"


def nearest_centre(centres: Sequence[Point], x: str = "x", y: str = "y") -> Column:
    """Struct ``(d, pos, cx, cy)`` of the closest centre to columns ``(x, y)``.

    The smallest struct has the smallest distance and then the smallest position, so a tie
    goes to the earliest centre in the list. The generated code does not grow with the
    number of centres: they are one array constant that a lambda walks through. From
    ``INDEXED`` centres on, the lambda walks through the candidates of the point's cell
    in a :class:`CentreGrid` only.
    """
    centres = check_centres(centres)
    if len(centres) >= INDEXED:
        return CentreGrid(centres).nearest(x, y)
    return _walk(centres, x, y)


def _walk(centres: Sequence[Point], x: str, y: str) -> Column:
    fields = "'d', {d}, 'pos', c.pos, 'cx', c.cx, 'cy', c.cy"
    return F.expr(f"array_min({distances_sql(centres, fields, x, y)})")


class CentreGrid:
    """A static index over centres: for each cell of a grid the centres that can be nearest to a point in it.

    The lines of the grid are quantiles of the centres' coordinates, so cells hold few centres
    even if the axes have very different scales. The candidates of a cell are the centres whose least distance to
    the cell is no more than the smallest of all centres' largest distances to it: any other centre is
    further than that one from every point of the cell. The pruning is exact and keeps ties. Points
    outside the grid (beyond the centres' bounding box by a sixteenth of its width) walk through all centres.
    """

    def __init__(self, centres: Sequence[Point], lines: int | None = None):
        self.centres = check_centres(centres)
        lines = lines or max(2, min(MOST_LINES, int(len(self.centres) ** 0.5)))
        at = np.array(self.centres, np.float64)
        self.edges = [self._lines(at[:, axis], lines) for axis in (0, 1)]
        self.cells = self._candidates(at)

    @staticmethod
    def _lines(values: np.ndarray, lines: int) -> list[int]:
        low, high = int(values.min()), int(values.max())
        inner = np.unique(values).astype(np.int64).tolist()
        if 2 * len(inner) <= lines:  # few values: each gets a strip of its own, where most points lie
            inner += [v - 1 for v in inner]
        else:
            inner = np.quantile(values, np.linspace(0, 1, lines + 1), method="nearest").astype(np.int64).tolist()
        beyond = [max(1, (high - low) // part) for part in (64, 16)]
        return sorted({*(low - m for m in beyond), *inner, *(high + m for m in beyond)})

    def _candidates(self, at: np.ndarray) -> list[list[int]]:
        (xs, ys), out = self.edges, []
        for left, right in zip(xs, xs[1:]):
            near_x = np.maximum(0, np.maximum(left - at[:, 0], at[:, 0] - right))
            far_x = np.maximum(np.abs(at[:, 0] - left), np.abs(at[:, 0] - right))
            for low, high in zip(ys, ys[1:]):
                near_y = np.maximum(0, np.maximum(low - at[:, 1], at[:, 1] - high))
                far_y = np.maximum(np.abs(at[:, 1] - low), np.abs(at[:, 1] - high))
                limit = (far_x * far_x + far_y * far_y).min()
                # Room for the rounding of squares beyond 2**53.
                out.append(np.flatnonzero(near_x * near_x + near_y * near_y <= limit * (1 + 1e-12)).tolist())
        return out

    def nearest(self, x: str, y: str) -> Column:
        (xs, ys), (qx, qy) = self.edges, (_quoted(x), _quoted(y))
        flat, ends = [p for c in self.cells for p in c], [0]
        for c in self.cells:
            ends.append(ends[-1] + len(c))
        columns = f"size(filter({_numbers(xs[1:-1])}, e -> e < {qx}))"
        rows = f"size(filter({_numbers(ys[1:-1])}, e -> e < {qy}))"
        cell = f"({columns} * {len(ys) - 1} + {rows})"
        own = f"slice({_numbers(flat)}, CAST({_numbers(ends)}[{cell}] AS INT) + 1, CAST({_numbers(ends)}[{cell} + 1] - {_numbers(ends)}[{cell}] AS INT))"
        inside = f"{qx} BETWEEN {xs[0]} AND {xs[-1]} AND {qy} BETWEEN {ys[0]} AND {ys[-1]}"
        candidates = f"CASE WHEN {inside} THEN {own} ELSE {_numbers(range(len(self.centres)))} END"
        cx, cy = (_numbers([c[axis] for c in self.centres]) for axis in (0, 1))
        dx, dy = (f"(CAST({q} AS DOUBLE) - CAST({c}[CAST(p AS INT)] AS DOUBLE))" for q, c in ((qx, cx), (qy, cy)))
        place = "CAST(p AS INT)"
        fields = f"'d', {dx} * {dx} + {dy} * {dy}, 'pos', {place}, 'cx', CAST({cx}[{place}] AS INT), 'cy', CAST({cy}[{place}] AS INT)"
        return F.expr(f"array_min(transform({candidates}, p -> named_struct({fields})))")


def _numbers(values: Sequence[int]) -> str:
    """A constant array of bigints, split from one text when the plan is optimised: a tenth of the time of as many literals."""
    if not len(values):
        return "CAST(array() AS ARRAY<BIGINT>)"
    return f"CAST(split('{','.join(map(str, values))}', ',') AS ARRAY<BIGINT>)"
