"""Parts of rings in the cells of a grid, by halving: a ring is cut to half of its cells, and each half again.

A corner goes down to its own cell in a logarithmic number of cuts, so a ring is never held against every cell of its
box, and a cell gets its own part alone. Where a part fills its box, all cells below it are full and nothing more is cut.
Rings first become parts in tiles of many cells; tiles are dealt anew, so one ring over a continent is the work of many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec

#: Cells along the side of a tile, and rows of a batch that a task gives out.
TILE, ROWS = 64, 4096
#: Rings of so many corners are cut as lists: a call on an array takes longer than all their corners.
FEW = 24

Ring = tuple[np.ndarray, np.ndarray]
Box = tuple[float, float, float, float]


def open_ring(xs, ys) -> Ring:
    """Corners as arrays, the last one not repeated."""
    x, y = np.asarray(xs, float), np.asarray(ys, float)
    if len(x) > 1 and x[0] == x[-1] and y[0] == y[-1]:
        x, y = x[:-1], y[:-1]
    return x, y


def ring_area(x: np.ndarray, y: np.ndarray) -> float:
    """Signed area, above zero if counterclockwise."""
    if len(x) < 3:
        return 0.0
    x0, y0 = x - x[0], y - y[0]  # near zero, so that large coordinates cost no digits
    return float(np.dot(x0, np.concatenate((y0[1:], y0[:1]))) - np.dot(y0, np.concatenate((x0[1:], x0[:1])))) / 2


def cut_low(x: np.ndarray, y: np.ndarray, at: float, sign: int) -> Ring:
    """The part of a ring with sign * x <= sign * at. New corners lie on the line exactly."""
    inside = sign * x <= sign * at
    if inside.all():
        return x, y
    if not inside.any():
        return x[:0], y[:0]
    after_x, after_y = np.roll(x, -1), np.roll(y, -1)
    crosses = inside != np.roll(inside, -1)
    t = np.where(crosses, (at - x) / np.where(crosses, after_x - x, 1), 0)
    keep = np.stack([inside, crosses], axis=1).ravel()
    return np.stack([x, np.full_like(x, at)], axis=1).ravel()[keep], np.stack([y, y + t * (after_y - y)], axis=1).ravel()[keep]


def _cut_few(x: list[float], y: list[float], at: float, sign: int) -> tuple[list[float], list[float]]:
    """``cut_low`` of lists, with the same arithmetic."""
    inside = [sign * v <= sign * at for v in x]
    if all(inside):
        return x, y
    out_x, out_y = [], []
    for k, here in enumerate(inside):
        after = k + 1 if k + 1 < len(x) else 0
        if here:
            out_x.append(x[k])
            out_y.append(y[k])
        if here != inside[after]:
            out_x.append(at)
            out_y.append(y[k] + (at - x[k]) / (x[after] - x[k]) * (y[after] - y[k]))
    return out_x, out_y


def cut_to_box(x: np.ndarray, y: np.ndarray, box: Box) -> Ring:
    """The part of a ring in a box (min x, min y, max x, max y)."""
    if len(x) <= FEW:
        few_x, few_y = x.tolist(), y.tolist()
        for k in (2, 0):
            few_x, few_y = _cut_few(few_x, few_y, float(box[k]), k - 1)
        for k in (3, 1):
            few_y, few_x = _cut_few(few_y, few_x, float(box[k]), k - 2)
        return np.array(few_x, float), np.array(few_y, float)
    x, y = cut_low(x, y, box[2], 1)
    x, y = cut_low(x, y, box[0], -1)
    y, x = cut_low(y, x, box[3], 1)
    y, x = cut_low(y, x, box[1], -1)
    return x, y


def fills(x: np.ndarray, y: np.ndarray, box: Box) -> bool:
    """Whether a ring that was cut to a box is all of it: no corner inside, and its area but for rounding."""
    on = (x == box[0]) | (x == box[2]) | (y == box[1]) | (y == box[3])
    whole = (box[2] - box[0]) * (box[3] - box[1])
    return bool(on.all()) and abs(abs(ring_area(x, y)) - whole) <= 1e-12 * whole


def halved(x: np.ndarray, y: np.ndarray, cells: tuple[int, int, int, int], box_of: Callable[..., Box], least: int = 1) -> Iterator[tuple[tuple[int, int, int, int], np.ndarray, np.ndarray, bool]]:
    """Ranges of cells (first and last column, first and last row) with the ring's part in their box, and whether it fills the box.

    A range that is full is given whole; others are halved until no side has more than ``least`` cells. Parts may reach beyond the cells, as boxes do.
    """
    stack = [(cells, x, y)]
    while stack:
        (i0, i1, j0, j1), x, y = stack.pop()
        box = box_of(i0, i1, j0, j1)
        x, y = cut_to_box(x, y, box)
        if len(x) < 3:
            continue
        full = fills(x, y, box)
        wide, high = i1 - i0 + 1, j1 - j0 + 1
        if full or max(wide, high) <= least:
            yield (i0, i1, j0, j1), x, y, full
        elif wide >= high:
            m = i0 + max(least, wide // 2 // least * least)
            stack += [((i0, m - 1, j0, j1), x, y), ((m, i1, j0, j1), x, y)]
        else:
            m = j0 + max(least, high // 2 // least * least)
            stack += [((i0, i1, j0, m - 1), x, y), ((i0, i1, m, j1), x, y)]


class Squares:
    """Square cells of a width; cell (i, j) begins at (i, j) times it."""

    def __init__(self, width: float):
        self.width = width

    def around(self, x0: float, y0: float, x1: float, y1: float) -> tuple[int, int, int, int]:
        return tuple(math.floor(v / self.width) for v in (x0, x1, y0, y1))

    def box(self, i0: int, i1: int, j0: int, j1: int) -> Box:
        return i0 * self.width, j0 * self.width, (i1 + 1) * self.width, (j1 + 1) * self.width

    def names(self, i: int, j: int) -> tuple[int, int]:
        return i, j

    def cut(self, i: int, j: int, x: np.ndarray, y: np.ndarray) -> Ring:
        return x, y

    def whole(self, i: int, j: int) -> Ring:
        x0, y0, x1, y1 = self.box(i, i, j, j)
        return np.array([x0, x1, x1, x0]), np.array([y0, y0, y1, y1])


class Hexagons:
    """Cells of a pointy grid in columns and rows: column i of row j is q = i - floor(j / 2)."""

    def __init__(self, grid: GridSpec):
        if grid.orientation != "pointy":
            raise ValueError("parts of rings are cut on a pointy grid")
        self.grid = grid

    def around(self, x0: float, y0: float, x1: float, y1: float) -> tuple[int, int, int, int]:
        g = self.grid
        x0, x1, y0, y1 = x0 - g.origin_x, x1 - g.origin_x, y0 - g.origin_y, y1 - g.origin_y
        return math.floor(x0 / g.flat_to_flat - 1), math.ceil(x1 / g.flat_to_flat + 0.5), math.floor((y0 - g.side) / (1.5 * g.side)), math.ceil((y1 + g.side) / (1.5 * g.side))

    def box(self, i0: int, i1: int, j0: int, j1: int) -> Box:
        g, f, s = self.grid, self.grid.flat_to_flat, self.grid.side
        return g.origin_x + (i0 - 0.5) * f, g.origin_y + (1.5 * j0 - 1) * s, g.origin_x + (i1 + 1) * f, g.origin_y + (1.5 * j1 + 1) * s

    def names(self, i: int, j: int) -> tuple[int, int]:
        return i - j // 2, j

    def cut(self, i: int, j: int, x: np.ndarray, y: np.ndarray) -> Ring:
        return clip_convex(x, y, *self.whole(i, j))

    def whole(self, i: int, j: int) -> Ring:
        turn = np.radians(-30 + 60 * np.arange(6))
        g = self.grid
        cx, cy = g.origin_x + g.flat_to_flat * (i - j // 2 + j / 2), g.origin_y + 1.5 * g.side * j
        return cx + g.side * np.cos(turn), cy + g.side * np.sin(turn)


def _clip_few(x: list[float], y: list[float], hx: list[float], hy: list[float]) -> tuple[list[float], list[float]]:
    """``clip_convex`` of lists, with the same arithmetic."""
    for k, (ax, ay) in enumerate(zip(hx, hy)):
        after = k + 1 if k + 1 < len(hx) else 0
        dx, dy = hx[after] - ax, hy[after] - ay
        side = [dx * (v - ay) - dy * (u - ax) for u, v in zip(x, y)]
        if not side or min(side) >= 0:
            continue
        out_x, out_y = [], []
        for i, here in enumerate(side):
            j = i + 1 if i + 1 < len(side) else 0
            if here >= 0:
                out_x.append(x[i])
                out_y.append(y[i])
            if (here >= 0) != (side[j] >= 0):
                t = here / (here - side[j])
                out_x.append(x[i] + t * (x[j] - x[i]))
                out_y.append(y[i] + t * (y[j] - y[i]))
        x, y = out_x, out_y
    return x, y


def clip_convex(x: np.ndarray, y: np.ndarray, hx: np.ndarray, hy: np.ndarray) -> Ring:
    """A ring cut to a convex polygon given counterclockwise (one half plane after the other)."""
    if len(x) <= FEW:
        few_x, few_y = _clip_few(x.tolist(), y.tolist(), hx.tolist(), hy.tolist())
        return np.array(few_x, float), np.array(few_y, float)
    for k in range(len(hx)):
        if not len(x):
            break
        ax, ay = hx[k], hy[k]
        dx, dy = hx[(k + 1) % len(hx)] - ax, hy[(k + 1) % len(hx)] - ay
        side = dx * (y - ay) - dy * (x - ax)
        inside = side >= 0
        if inside.all():
            continue
        after_x, after_y, after = np.roll(x, -1), np.roll(y, -1), np.roll(side, -1)
        crosses = inside != (after >= 0)
        t = np.where(crosses, side / np.where(crosses, side - after, 1), 0)
        keep = np.stack([inside, crosses], axis=1).ravel()
        x = np.stack([x, x + t * (after_x - x)], axis=1).ravel()[keep]
        y = np.stack([y, y + t * (after_y - y)], axis=1).ravel()[keep]
    return x, y


def parts_of(x: np.ndarray, y: np.ndarray, cells: tuple[int, int, int, int], grid) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The ring's part in each cell of a range: the cell's two names, and corners (those of the cell where it is full)."""
    for (i0, i1, j0, j1), px, py, full in halved(x, y, cells, grid.box):
        if full:
            for j in range(j0, j1 + 1):
                for i in range(i0, i1 + 1):
                    yield (*grid.names(i, j), *grid.whole(i, j))
        else:
            cx, cy = grid.cut(i0, j0, px, py)
            if len(cx) > 2:
                yield (*grid.names(i0, j0), cx, cy)


def _ddl(df: DataFrame, names: list[str]) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields if f.name in names)


def _rows(batches: Iterator[pa.RecordBatch], keep: list[str], made: list[tuple[str, pa.DataType]], each: Callable) -> Iterator[pa.RecordBatch]:
    """What ``each`` makes of every row, as batches of ``ROWS``; columns to keep are taken as they are, nulls and whole numbers too."""
    for batch in batches:
        rows = zip(*[batch.column(k) for k in range(len(keep), batch.num_columns)])
        source, out = [], []

        def give() -> pa.RecordBatch:
            at = pa.array(source, pa.int64())
            columns = [batch.column(k).take(at) for k in range(len(keep))] + [pa.array([o[k] for o in out], kind) for k, (_, kind) in enumerate(made)]
            return pa.RecordBatch.from_arrays(columns, names=[*keep, *[n for n, _ in made]])

        for n, row in enumerate(rows):
            *whole, xs, ys = row
            for found in each(*[v.as_py() for v in whole], xs.values.to_numpy(zero_copy_only=False), ys.values.to_numpy(zero_copy_only=False)):
                source.append(n)
                out.append(found)
                if len(out) >= ROWS:
                    yield give()
                    source, out = [], []
        if out:
            yield give()


CORNERS = pa.list_(pa.float64())


def tiles(rings: DataFrame, keep: list[str], grid) -> DataFrame:
    """Rings cut to tiles of ``TILE`` by ``TILE`` cells, dealt over all tasks: ``keep``, i0, i1, j0, j1, xs, ys.

    Rings with a null or non-finite corner, with lists of different length or of fewer than three corners, and null rings have no part.
    """
    usable = lambda c: ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    given = rings.select(*keep, F.col("xs").cast("array<double>").alias("xs"), F.col("ys").cast("array<double>").alias("ys"))
    given = given.where((F.size("xs") == F.size("ys")) & (F.size("xs") > 2)).where(usable("xs") & usable("ys"))

    def coarse(xs: np.ndarray, ys: np.ndarray) -> Iterator[tuple]:
        x, y = open_ring(xs, ys)
        # Full ranges come whole; they are cut into tiles too, so that a task makes the cells of one tile.
        for (i0, i1, j0, j1), px, py, _ in halved(x, y, grid.around(x.min(), y.min(), x.max(), y.max()), grid.box, TILE):
            for j in range(j0, j1 + 1, TILE):
                for i in range(i0, i1 + 1, TILE):
                    some = (i, min(i + TILE - 1, i1), j, min(j + TILE - 1, j1))
                    yield (*some, *((px, py) if some == (i0, i1, j0, j1) else cut_to_box(px, py, grid.box(*some))))

    made = [*[(c, pa.int64()) for c in ("i0", "i1", "j0", "j1")], ("xs", CORNERS), ("ys", CORNERS)]
    cut = given.mapInArrow(lambda b: _rows(b, keep, made, coarse), _ddl(given, keep) + "i0 bigint, i1 bigint, j0 bigint, j1 bigint, xs array<double>, ys array<double>")
    return cut.repartition(F.xxhash64("i0", "j0", "xs", "ys", *keep))


def parts(rings: DataFrame, keep: list[str], grid, names: tuple[str, str]) -> DataFrame:
    """Each ring's part in each cell that it meets: ``keep``, the cell's two ``names``, xs, ys (open), area_m2 (above zero)."""
    given = tiles(rings, keep, grid)

    def fine(i0: int, i1: int, j0: int, j1: int, xs: np.ndarray, ys: np.ndarray) -> Iterator[tuple]:
        for a, b, x, y in parts_of(xs, ys, (i0, i1, j0, j1), grid):
            area = abs(ring_area(x, y))
            if area > 0:
                yield a, b, x, y, area

    made = [(names[0], pa.int64()), (names[1], pa.int64()), ("xs", CORNERS), ("ys", CORNERS), ("area_m2", pa.float64())]
    return given.mapInArrow(lambda b: _rows(b, keep, made, fine), _ddl(given, keep) + f"{names[0]} bigint, {names[1]} bigint, xs array<double>, ys array<double>, area_m2 double")


def hex_parts(rings: DataFrame, keep: list[str], grid: GridSpec) -> DataFrame:
    """``parts`` in hexes (q, r)."""
    return parts(rings, keep, Hexagons(grid), ("q", "r"))


def square_parts(rings: DataFrame, keep: list[str], width: float) -> DataFrame:
    """``parts`` in square cells (cx, cy)."""
    return parts(rings, keep, Squares(width), ("cx", "cy"))
