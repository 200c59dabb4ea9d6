"""Which shapes come close: shapes meet in square cells as blocks of rows, whose boxes and then sides numpy holds against each other.

A shape is rows of segments: line_id, x1, y1, x2, y2; a point is a segment without length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from hexloom.tables import written

COORDINATES = ("x1", "y1", "x2", "y2")
#: Sides of a shape that stays whole, of a part of one that does not, and of a block of shapes.
WHOLE, PART, BLOCK = 64, 256, 1024
#: Pairs of sides that are looked at together.
PAIRS = 1 << 17
#: Bytes of a record batch that goes to Python.
BATCH_BYTES = 8 << 20


def _boxed(segments: DataFrame) -> DataFrame:
    """Segments with the box (bx0, bx1, by0, by1) and the number of sides (n) of their shape."""
    w = Window.partitionBy("line_id")
    return segments.withColumns({
        "bx0": F.min(F.least("x1", "x2")).over(w), "bx1": F.max(F.greatest("x1", "x2")).over(w),
        "by0": F.min(F.least("y1", "y2")).over(w), "by1": F.max(F.greatest("y1", "y2")).over(w), "n": F.count("*").over(w),
    })


def _level(reach: Column, limit_m: float) -> Column:
    return F.greatest(F.lit(0), F.ceil(F.log2(reach / limit_m) - 1e-9)).cast("int")


def _pieces(boxed: DataFrame, by: list[str], base: float) -> DataFrame:
    """Shapes with a level as pieces: whole ones in the cell of their middle, others as their sides in each cell that these pass, some at a time."""
    w = F.pow(F.lit(2.0), "level") * base
    at = lambda c: F.floor(c / w)
    s = boxed.withColumn("whole", (F.col("n") <= WHOLE) & (F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")) <= w))
    s = s.withColumn("cx", F.explode(F.when(F.col("whole"), F.array(at((F.col("bx0") + F.col("bx1")) / 2))).otherwise(F.sequence(at(F.least("x1", "x2")), at(F.greatest("x1", "x2"))))))
    # Of a column, those cells between the heights that the segment has there, and a little more than rounding takes.
    part = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.try_divide(x - F.col("x1"), F.col("x2") - F.col("x1")), F.lit(0.0))))
    y = lambda t: F.col("y1") + (F.col("y2") - F.col("y1")) * t
    ya, yb = y(part(F.col("cx") * w)), F.when(F.col("x1") == F.col("x2"), F.col("y2")).otherwise(y(part((F.col("cx") + 1) * w)))
    rows = F.sequence(at(F.least(ya, yb) - w / 1e6), at(F.greatest(ya, yb) + w / 1e6))
    s = s.withColumn("cy", F.explode(F.when(F.col("whole"), F.array(at((F.col("by0") + F.col("by1")) / 2))).otherwise(rows)))
    key = ["line_id", *by, "turn", "level", "cx", "cy", "whole"]
    sides = F.count("*").over(Window.partitionBy(*key))
    s = s.withColumn("some", F.when(F.col("whole"), F.lit(0)).otherwise(F.pmod(F.xxhash64(*COORDINATES), F.ceil(sides / PART))))
    return s.groupBy(*key, "some").agg(
        F.collect_list(F.struct(*COORDINATES)).alias("sides"), F.count("*").alias("n"), F.first("reach").alias("reach"),
        F.min(F.least("x1", "x2")).alias("bx0"), F.max(F.greatest("x1", "x2")).alias("bx1"), F.min(F.least("y1", "y2")).alias("by0"), F.max(F.greatest("y1", "y2")).alias("by1"),
    )


def _spread(pieces: DataFrame, limit_m: float, base: float) -> DataFrame:
    """Pieces in all cells whose shapes they may come close to: those of a cell reach half its width out of it."""
    unit = F.pow(F.lit(2.0), "level")
    w, out = unit * base, unit * (limit_m + base / 2) * (1 + 1e-9)
    around = int(-(-(limit_m + base / 2) // base))

    def cells(c: str, lo: str, hi: str) -> Column:
        return F.when(F.col("whole"), F.sequence(F.floor((F.col(lo) - out) / w), F.floor((F.col(hi) + out) / w))).otherwise(F.sequence(F.col(c) - around, F.col(c) + around))

    return pieces.withColumn("cx", F.explode(cells("cx", "bx0", "bx1"))).withColumn("cy", F.explode(cells("cy", "by0", "by1")))


PIECE = ("line_id", "reach", "bx0", "bx1", "by0", "by1", "sides")


def _blocks(pieces: DataFrame, cell: list[str], parts: int, name: str) -> DataFrame:
    """Pieces of a cell in blocks with a bounded number of sides, in the column ``name``."""
    w = Window.partitionBy(*cell, "whole")
    dealt = pieces.repartition(parts, *cell).withColumn("block", F.pmod(F.xxhash64("line_id", "some"), F.ceil(F.sum("n").over(w) / BLOCK)))
    return written(dealt.groupBy(*cell, "whole", "block").agg(F.collect_list(F.struct(*PIECE)).alias(name)), "meets-blocks").drop("block").repartition(parts, *cell)


def _unpacked(lists: pa.ListArray) -> dict:
    values = lists.values
    field = lambda n: values.field(PIECE.index(n))
    sides = field("sides")
    ids = field("line_id")
    return {
        "at": lists.offsets.to_numpy(), "ids": ids, "key": ids.to_numpy(zero_copy_only=False), **{n: field(n).to_numpy(zero_copy_only=False) for n in PIECE[1:-1]},
        "first": sides.offsets.to_numpy(), **{n: sides.values.field(k).to_numpy(zero_copy_only=False) for k, n in enumerate(COORDINATES)},
    }


def _gap2(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """The squared distance of boxes (x0, x1, y0, y1)."""
    gx = np.maximum(np.maximum(a[0] - b[1], b[0] - a[1]), 0.0)
    gy = np.maximum(np.maximum(a[2] - b[3], b[2] - a[3]), 0.0)
    return gx * gx + gy * gy


def _nearest_places(o: dict, f: dict, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, ...]:
    """For pairs of pieces those with sides within reach, as their places in the list, and the distance and the two nearest places; of equals those first in order."""
    na, nb = np.diff(o["first"])[i], np.diff(f["first"])[j]
    sizes = na * nb
    g = np.repeat(np.arange(len(i)), sizes)
    begins = np.cumsum(sizes) - sizes
    k = np.arange(len(g)) - begins[g]
    s, t = o["first"][i][g] + k // nb[g], f["first"][j][g] + k % nb[g]
    sides = lambda q, at: [q[n][at] for n in COORDINATES]
    box = lambda x1, y1, x2, y2: [np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)]
    a, b = sides(o, s), sides(f, t)
    # No side further off than two corners of the pair is its nearest.
    most = np.minimum(np.minimum.reduceat((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2, begins), o["reach"][i] ** 2)
    keep = _gap2(box(*a), box(*b)) <= most[g] * (1 + 1e-9) + 1e-6
    g, a, b = g[keep], [v[keep] for v in a], [v[keep] for v in b]
    best = [np.full(len(g), np.inf)] + [np.zeros(len(g))] * 4

    def foot(px: np.ndarray, py: np.ndarray, x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dx, dy = x2 - x1, y2 - y1
        length = dx * dx + dy * dy
        along = np.clip(((px - x1) * dx + (py - y1) * dy) / np.where(length == 0, 1.0, length), 0.0, 1.0)
        return x1 + along * dx, y1 + along * dy

    for own in (True, False):
        for c in (0, 2):
            px, py = (a if own else b)[c : c + 2]
            fx, fy = foot(px, py, *(b if own else a))
            new = [np.hypot(px - fx, py - fy), *((px, py, fx, fy) if own else (fx, fy, px, py))]
            less, tie = new[0] < best[0], new[0] == best[0]
            if tie.any():
                for n, m in zip(new[1:], best[1:]):
                    less |= tie & (n < m)
                    tie &= n == m
            best = [np.where(less, n, m) for n, m in zip(new, best)]
    turn = lambda q, x, y: np.sign((q[2] - q[0]) * (y - q[1]) - (q[3] - q[1]) * (x - q[0]))
    cross = (turn(a, b[0], b[1]) * turn(a, b[2], b[3]) < 0) & (turn(b, a[0], a[1]) * turn(b, a[2], a[3]) < 0)
    best = [np.where(cross, n, m) for n, m in zip((0.0, a[0], a[1], a[0], a[1]), best)]
    least = np.full(len(i), np.inf)
    np.minimum.at(least, g, best[0])
    here = np.flatnonzero((best[0] == least[g]) & (best[0] <= o["reach"][i][g]))
    order = here[np.lexsort([*(v[here] for v in best[:0:-1]), g[here]])]
    order = order[np.diff(g[order], prepend=-1) != 0]
    return (g[order], *(v[order] for v in best))


def _met(batches: Iterator[pa.RecordBatch], schema: pa.Schema, pairs: str, nearest: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        o, f = _unpacked(batch.column(0)), _unpacked(batch.column(1))
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        sides = 0

        def looked_at(i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
            cost = np.cumsum(np.diff(o["first"])[i] * np.diff(f["first"])[j])
            at = 0
            while at < len(i):
                end = max(at + 1, int(np.searchsorted(cost, (cost[at - 1] if at else 0) + PAIRS, side="right")))
                g, *found = _nearest_places(o, f, i[at:end], j[at:end])
                a, b = i[at:end][g], j[at:end][g]
                at = end
                if nearest and len(a):
                    least = np.full(len(o["reach"]), np.inf)
                    np.minimum.at(least, a, found[0])
                    keep = found[0] == least[a]
                    # Of those that meet a shape one is enough.
                    keep[np.setdiff1d(np.flatnonzero(found[0] == 0), np.unique(np.where(found[0] == 0, a, -1), return_index=True)[1])] = False
                    a, b, found = a[keep], b[keep], [v[keep] for v in found]
                if len(a):
                    yield pa.RecordBatch.from_arrays([o["ids"].take(pa.array(a)).cast(schema.types[0]), f["ids"].take(pa.array(b)).cast(schema.types[1]), *map(pa.array, found)], schema=schema)

        box = lambda q, at: [q[n][at] for n in PIECE[2:6]]
        for r in range(batch.num_rows):
            i, j = np.arange(o["at"][r], o["at"][r + 1]), np.arange(f["at"][r], f["at"][r + 1])
            hit = _gap2([v[:, None] for v in box(o, i)], box(f, j)) <= (o["reach"][i] ** 2 * (1 + 1e-9))[:, None]
            if pairs != "all":
                p, q = o["key"][i][:, None], f["key"][j][None, :]
                hit &= (p < q if pairs == "below" else p != q).astype(bool)
            p, q = np.nonzero(hit)
            waiting.append((i[p], j[q]))
            sides += int((np.diff(o["first"])[i[p]] * np.diff(f["first"])[j[q]]).sum())
            if sides >= PAIRS:
                yield from looked_at(*map(np.concatenate, zip(*waiting)))
                waiting, sides = [], 0
        if waiting:
            yield from looked_at(*map(np.concatenate, zip(*waiting)))


def close_shapes(
    own: DataFrame, far: DataFrame, limit_m: float, *, reach: Column | None = None, least: Column | None = None, turns: Column | None = None, by: list[str] | None = None,
    pairs: str = "all", wanted: str | None = None, nearest: bool = False,
) -> DataFrame:
    """Pairs of shapes (a of ``own``, b of ``far``) within reach: d and the two nearest places (px, py and qx, qy), of equals those first in order.

    ``reach`` is the distance for a shape of ``own`` by its box (bx0, bx1, by0, by1), at least ``limit_m``, which it is without; ``least`` a bound below the reach of what a shape of
    ``far`` may be close to; ``turns`` the distances by which ``far`` stands moved along x. ``by`` are columns that a pair has in common. ``pairs`` is "all", "below" (a before b) or "other"
    (a not b); ``wanted`` a condition on line_id and line_id_b. ``nearest`` leaves out pairs of which a has a nearer b at hand; its nearest ones stay.

    Cells are as wide as the reach and as nine in ten shapes, a whole shape of ``own`` has one of them, so a pair comes once. Blocks of a cell with a bounded number of sides meet
    block by block: a pair is a comparison of boxes in numpy, and only pairs whose boxes are within reach look at sides. Shapes that are wider, or have many sides, are cut to cells.
    """
    spark, by = own.sparkSession, by or []
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    reach = F.lit(float(limit_m)) if reach is None else reach
    boxed = _boxed(own).withColumn("reach", reach).withColumn("turn", F.lit(0.0)).withColumn("level", _level(F.col("reach"), limit_m))
    boxed = written(boxed, "meets-own")
    size = F.greatest(F.col("bx1") - F.col("bx0"), F.col("by1") - F.col("by0")) / F.pow(F.lit(2.0), "level")
    head = boxed.agg(F.percentile_approx(size, 0.9).alias("size"), F.collect_set("level").alias("levels")).first()
    base = min(64.0 * limit_m, max(float(limit_m), 1.001 * (head["size"] or 0.0)))
    there = _boxed(far).withColumn("reach", F.lit(0.0)).withColumn("turn", F.explode(F.array(F.lit(0.0)) if turns is None else turns))
    there = there.withColumns({c: F.col(c) + F.col("turn") for c in ("x1", "x2", "bx0", "bx1")})
    lowest = F.lit(0) if least is None else _level(least, limit_m)
    there = there.withColumn("level", F.explode(F.filter(F.array(*[F.lit(v) for v in sorted(head["levels"])]).cast("array<int>"), lambda v: v >= lowest)))
    cell = [*by, "level", "cx", "cy"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    mine, others = _pieces(boxed, by, base), _spread(_pieces(there, by, base), limit_m, base)
    kind = {n: t.schema["line_id"].dataType for n, t in (("a", own), ("b", far))}
    schema = ", ".join([*(f"{n} {k.simpleString()}" for n, k in kind.items()), *(f"{n} double" for n in ("d", "px", "py", "qx", "qy"))])
    arrow = pa.schema([*((n, to_arrow_type(k)) for n, k in kind.items()), *((n, pa.float64()) for n in ("d", "px", "py", "qx", "qy"))])
    run = lambda t: t.select("o", "f").mapInArrow(lambda batches: _met(batches, arrow, pairs, nearest), schema)
    if wanted is None:
        mine, others = _blocks(mine, cell, parts, "o"), _blocks(others, cell, parts, "f").withColumnRenamed("whole", "whole_b")
        met = mine.hint("merge").join(others, cell)
    else:
        one = lambda t, name: t.select(*cell, "line_id", "whole", F.array(F.struct(*PIECE)).alias(name))
        met = one(mine, "o").hint("merge").join(one(others, "f").withColumnsRenamed({"line_id": "line_id_b", "whole": "whole_b"}), cell).where(wanted)
    if wanted is None and mine.where("not whole").isEmpty() and others.where("not whole_b").isEmpty():
        return run(met)
    once = run(met.where("whole and whole_b"))
    again = run(met.where("not (whole and whole_b)")).groupBy("a", "b").agg(F.min(F.struct("d", "px", "py", "qx", "qy")).alias("n")).select("a", "b", "n.*")
    return once.unionByName(again)
