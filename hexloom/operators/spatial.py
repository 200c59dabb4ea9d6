"""Polygons, lines and hexes: spatial predicates as hash joins on cells, then exact kernels on Arrow batches.

A polygon is rows of rings: feature_id, is_hole, xs, ys (arrays; open or closed). A line is rows of
segments: line_id, x1, y1, x2, y2. Hexes are (q, r) of a pointy grid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType

from hexloom.functions.geodesy import ring_km2
from hexloom.functions.hexgrid import GridSpec
from hexloom.functions.ids import hashed_id
from hexloom.operators.meets import BATCH_BYTES, close_shapes
from hexloom.operators.parts import clip_convex, hex_parts, open_ring, ring_area, square_parts  # noqa: F401
from hexloom.operators.points import first_width
from hexloom.tables import written


def cells_of_box(grid: GridSpec, min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """All cells of a pointy grid whose circle meets a box, as an array of (q, r)."""
    pad, f, s = grid.side, grid.flat_to_flat, grid.side
    rows = F.sequence(F.floor((min_y - pad - grid.origin_y) / (1.5 * s)), F.ceil((max_y + pad - grid.origin_y) / (1.5 * s)))

    def row(r: Column) -> Column:
        first, last = F.ceil((min_x - pad - grid.origin_x) / f - r / 2), F.floor((max_x + pad - grid.origin_x) / f - r / 2)
        return F.transform(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>")), lambda q: F.struct(q.alias("q"), r.alias("r")))

    return F.flatten(F.transform(rows, row))


def clipped(rings: DataFrame, grid: GridSpec) -> DataFrame:
    """Each ring with the area of its part in each cell it meets (area_m2, below zero for holes)."""
    keep = [c for c in rings.columns if c not in ("xs", "ys")]
    return hex_parts(rings, keep, grid).select(*keep, "q", "r", F.when(F.col("is_hole"), -F.col("area_m2")).otherwise(F.col("area_m2")).alias("area_m2"))


def feature_hexes(rings: DataFrame, grid: GridSpec) -> DataFrame:
    """Each feature with its area in each cell. Parts of one feature are taken to be disjoint."""
    return clipped(rings, grid).groupBy("feature_id", "q", "r").agg(F.sum("area_m2").alias("area_m2")).where("area_m2 > 1e-9")


def land_classes(hexes: DataFrame, land: DataFrame, grid: GridSpec, threshold: float) -> DataFrame:
    """Every hex (q, r) with land area and fraction, water fraction, land class, whether it is coastal, and the area its class gets wrong."""
    parts = land.groupBy("q", "r").agg(F.sum("area_m2").alias("land_m2"))
    share = F.least(F.lit(1.0), F.coalesce("land_m2", F.lit(0.0)) / grid.area)
    out = hexes.join(parts, ["q", "r"], "left").withColumn("land_fraction", share)
    is_land = F.col("land_fraction") >= threshold
    return out.select(
        *hexes.columns, F.coalesce("land_m2", F.lit(0.0)).alias("land_m2"), "land_fraction", (1 - F.col("land_fraction")).alias("water_fraction"), F.when(is_land, "land").otherwise("water").alias("land_class"),
        ((F.col("land_fraction") > 0) & (F.col("land_fraction") < 1)).alias("is_coastal"), (F.when(is_land, 1 - F.col("land_fraction")).otherwise(F.col("land_fraction")) * grid.area).alias("error_m2"),
    )


def hex_lakes(lakes: DataFrame, grid: GridSpec) -> DataFrame:
    """For each cell the fraction under lakes, the sorted ids and the largest one; of ties the smaller id."""
    return lakes.groupBy("q", "r").agg(
        F.least(F.lit(1.0), F.sum("area_m2") / grid.area).alias("lake_fraction"), F.array_join(F.array_sort(F.collect_set(F.col("feature_id").cast("string"))), "|").alias("lake_ids"),
        F.min(F.struct((-F.col("area_m2")).alias("k"), "feature_id"))["feature_id"].alias("primary_lake"),
    )


def memberships(shares: DataFrame, grid: GridSpec) -> DataFrame:
    """Each (feature, cell) with its share of the cell's covered area and of the cell, and whether it is the largest there (then the smaller id)."""
    w = Window.partitionBy("q", "r")
    return shares.withColumns({
        "share_of_covered": F.col("area_m2") / F.sum("area_m2").over(w), "share_of_hex": F.col("area_m2") / grid.area,
        "is_dominant": F.row_number().over(w.orderBy(F.desc("area_m2"), "feature_id")) == 1,
    })


def component_stats(shares: DataFrame, hexes: DataFrame) -> DataFrame:
    """For each component its cells, area, largest land fraction, whether a terrestrial cell represents it, and its primary cell (area, then q, r)."""
    each = shares.join(hexes.select("q", "r", "land_fraction", "land_class"), ["q", "r"], "left")
    return each.groupBy("feature_id").agg(
        F.count("*").alias("hexes"), F.sum("area_m2").alias("area_m2"), F.max("land_fraction").alias("max_land_fraction"), F.coalesce(F.bool_or(F.col("land_class") == "land"), F.lit(False)).alias("represented"),
        F.max_by(F.struct("q", "r"), F.struct(F.round("area_m2", 6).alias("a"), (-F.col("q")).alias("nq"), (-F.col("r")).alias("nr"))).alias("primary_hex"),
    )


def union_area(parts: list[tuple[np.ndarray, np.ndarray]]) -> float:
    """The area of the union of simple rings, by slabs between all vertices and crossings: exact for straight edges."""
    ys = [np.concatenate([y for _, y in parts])] if parts else []
    edges = [(x[k], y[k], x[(k + 1) % len(x)], y[(k + 1) % len(x)], i) for i, (x, y) in enumerate(parts) for k in range(len(x))]
    if not edges:
        return 0.0
    e = np.array([(a, b, c, d) for a, b, c, d, _ in edges])
    own = np.array([i for *_, i in edges])
    # Crossings of edges of any two rings.
    d = e[:, 2:] - e[:, :2]
    cross = d[:, None, 0] * d[None, :, 1] - d[:, None, 1] * d[None, :, 0]
    to = e[None, :, :2] - e[:, None, :2]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (to[..., 0] * d[None, :, 1] - to[..., 1] * d[None, :, 0]) / cross
        u = (to[..., 0] * d[:, None, 1] - to[..., 1] * d[:, None, 0]) / cross
    hit = (cross != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
    i, _ = np.nonzero(hit)
    ys.append(e[i, 1] + t[hit] * d[i, 1])
    levels = np.unique(np.concatenate(ys))
    total = 0.0
    for lo, hi in zip(levels[:-1], levels[1:]):
        mid = (lo + hi) / 2
        meets = (np.minimum(e[:, 1], e[:, 3]) < mid) & (np.maximum(e[:, 1], e[:, 3]) > mid)
        x = e[meets, 0] + (mid - e[meets, 1]) / d[meets, 1] * d[meets, 0]
        who = own[meets]
        order = np.argsort(x, kind="stable")
        inside: dict[int, bool] = {}
        depth, begin = 0, 0.0
        for at, k in zip(x[order], who[order]):
            now = not inside.get(k, False)
            inside[k] = now
            if now:
                depth += 1
                if depth == 1:
                    begin = at
            else:
                depth -= 1
                if depth == 0:
                    total += (at - begin) * (hi - lo)
    return total


def union_in_hexes(rings: DataFrame, grid: GridSpec, by: list[str] | None = None) -> DataFrame:
    """For each cell (and each value of ``by``) the area under at least one ring: overlapping tiles count once. Rings are outer ones.

    Rings that are equal are dropped first, then parts that are equal in a cell, as all are that fill it. What is left of a cell is one small group.
    """
    by = by or []
    key = [*by, "q", "r"]
    each = hex_parts(rings.dropDuplicates([*by, "xs", "ys"]), by, grid).dropDuplicates([*key, "xs", "ys"])
    cells = each.groupBy(*key).agg(F.count("*").alias("n"), F.max("area_m2").alias("most"), F.collect_list(F.struct("xs", "ys")).alias("parts"))
    # One part alone, and one that fills its cell, need no union: only cells with borders of several parts go to Python.
    alone = (F.col("n") == 1) | (F.col("most") >= grid.area * (1 - 1e-12))

    @F.pandas_udf(DoubleType())
    def area(parts: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else union_area([open_ring(r["xs"], r["ys"]) for r in p]) for p in parts], dtype=float)

    found = cells.withColumn("area_m2", F.coalesce(area(F.when(~alone, F.col("parts"))), F.col("most")))
    return found.select(*key, "area_m2").where("area_m2 > 1e-9")


def _with_box(parts: DataFrame) -> DataFrame:
    """Parts of rings with the box around them (x0, x1, y0, y1) and whether they are that box (is_box)."""
    parts = parts.withColumns({"x0": F.array_min("xs"), "x1": F.array_max("xs"), "y0": F.array_min("ys"), "y1": F.array_max("ys")})
    whole = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    at_corners = F.forall("xs", lambda v: (v == F.col("x0")) | (v == F.col("x1"))) & F.forall("ys", lambda v: (v == F.col("y0")) | (v == F.col("y1")))
    return parts.withColumn("is_box", (F.size("xs") == 4) & at_corners & (F.abs(F.col("area_m2") - whole) <= 1e-9 * whole))


def _cells_of_features(rings: DataFrame, cell_m: float) -> DataFrame:
    """For each feature and square cell that it meets (cx, cy) one row: its parts there, the box around them, whether they are that box (is_box) and whether that box is the cell (is_full)."""
    tiles = _with_box(square_parts(rings, ["feature_id"], cell_m))
    each = tiles.groupBy("feature_id", "cx", "cy").agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), (F.every("is_box") & (F.count("*") == 1)).alias("is_box"),
        F.collect_list(F.struct("xs", "ys")).alias("parts"),
    )
    fits = (F.col("x0") == F.col("cx") * cell_m) & (F.col("x1") == (F.col("cx") + 1) * cell_m) & (F.col("y0") == F.col("cy") * cell_m) & (F.col("y1") == (F.col("cy") + 1) * cell_m)
    # A box needs no corners, and the rows that meet the points stay short.
    return each.withColumns({"is_full": F.col("is_box") & fits, "parts": F.when(~F.col("is_box"), F.col("parts"))})


def _held(points: DataFrame, cells: DataFrame, cell_m: float, interior: bool = False) -> DataFrame:
    """Pairs of a point (id) and a feature of its cell that holds it. A point has one cell and a cell one row for each feature, so a pair comes once.

    With ``interior`` a place on a side is outside. A point on the border of cells then stands in each of them with the side of the border that it is asked for (sx, sy),
    and is held by what holds it on all sides; a side along that border is told by them, any other one that passes the point leaves it out.
    """
    step = lambda c: F.floor(c / cell_m)
    at = points.select("id", "x", "y", step(F.col("x")).alias("cx"), step(F.col("y")).alias("cy"))
    px, py = F.col("x"), F.col("y")
    right, above = (F.lit(True), F.lit(True)) if not interior else (F.col("sx") > 0, F.col("sy") > 0)

    def crossings(part: Column) -> Column:
        n = F.size(part["xs"])

        def hit(k: Column) -> Column:
            ax, ay, bx, by = part["xs"][k], part["ys"][k], part["xs"][(k + 1) % n], part["ys"][(k + 1) % n]
            where = (bx - ax) * (py - ay) / (by - ay) + ax
            if not interior:
                return ((ay > py) != (by > py)) & (px < where)
            return F.when(above, (ay > py) != (by > py)).otherwise((ay >= py) != (by >= py)) & F.when(right, px < where).otherwise(px > where)

        return F.size(F.filter(F.sequence(F.lit(0), n - 1), hit))

    def passed(part: Column) -> Column:
        """Whether a side passes the point, other than one along the border of cells that it is on."""
        n = F.size(part["xs"])

        def on(k: Column) -> Column:
            ax, ay, bx, by = part["xs"][k], part["ys"][k], part["xs"][(k + 1) % n], part["ys"][(k + 1) % n]
            near = px.between(F.least(ax, bx), F.greatest(ax, bx)) & py.between(F.least(ay, by), F.greatest(ay, by))
            along = (F.col("on_x") & (ax == px) & (bx == px)) | (F.col("on_y") & (ay == py) & (by == py))
            return near & ((bx - ax) * (py - ay) == (by - ay) * (px - ax)) & ~along

        return F.exists(F.sequence(F.lit(0), n - 1), on)

    odd = F.aggregate(F.transform("parts", crossings), F.lit(0), lambda a, b: a + b) % 2 == 1
    if not interior:
        in_box = (px >= F.col("x0")) & (px < F.col("x1")) & (py >= F.col("y0")) & (py < F.col("y1"))
        return at.join(cells, ["cx", "cy"]).where(F.col("is_full") | (in_box & F.when(F.col("is_box"), F.lit(True)).otherwise(odd))).select("id", "feature_id")
    on_x, on_y = px == F.col("cx") * cell_m, py == F.col("cy") * cell_m
    at = at.withColumns({"on_x": on_x, "on_y": on_y})

    def within(p: Column, low: Column, high: Column, on: Column, after: Column) -> Column:
        return ((p > low) & (p < high)) | (on & F.when(after, p == low).otherwise(p == high))

    in_box = within(px, F.col("x0"), F.col("x1"), F.col("on_x"), right) & within(py, F.col("y0"), F.col("y1"), F.col("on_y"), above)
    inside = F.col("is_full") | (in_box & F.when(F.col("is_box"), F.lit(True)).otherwise(odd & ~F.exists("parts", passed)))
    found = at.where("not (on_x or on_y)").withColumns({"sx": F.lit(1), "sy": F.lit(1)}).join(cells, ["cx", "cy"]).where(inside).select("id", "feature_id")
    sides = F.array(*[F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy"), F.lit(2 * i + 1).alias("sx"), F.lit(2 * j + 1).alias("sy")) for i in (0, -1) for j in (0, -1)])
    sides = F.filter(sides, lambda c: (F.col("on_x") | (c["sx"] > 0)) & (F.col("on_y") | (c["sy"] > 0)))
    border = at.where("on_x or on_y").withColumns({"c": F.explode(sides), "asked": F.size(sides)}).select("id", "x", "y", "on_x", "on_y", "asked", "c.*")
    border = border.join(cells, ["cx", "cy"]).where(inside).groupBy("id", "feature_id", "asked").agg(F.count("*").alias("n")).where("n = asked")
    return found.unionByName(border.select("id", "feature_id"))


def points_in_polygons(points: DataFrame, rings: DataFrame, cell_m: float, interior: bool = False) -> DataFrame:
    """Pairs of a point (id, x, y) and a feature that holds it, by the even-odd rule over all rings of the feature.

    Points meet the parts of rings in square cells, so a point is held against the corners in its cell alone; a part that is a box, as all are that
    fill their cell, is four comparisons. A place on a left or lower side is inside, on a right or upper one it is not; with ``interior`` a place on any side is outside.
    """
    cells = _cells_of_features(rings, cell_m)
    return _held(points, written(cells, "feature-cells") if interior else cells, cell_m, interior)


def first_polygon(points: DataFrame, rings: DataFrame, cell_m: float, interior: bool = False) -> DataFrame:
    """Every point with the smallest feature that holds it, null if none does; ``interior`` as of ``points_in_polygons``.

    No place in a cell has a feature after the first one that fills the cell, so those are left out before points come in: however many
    features lie over a place, it meets those before the first that fills its cell. A place on the border of a cell may be outside of what fills it, so with
    ``interior`` the few places there meet all features of their cells.
    """
    cells = _cells_of_features(rings, cell_m)
    if interior:
        cells = written(cells, "feature-cells")
    last = cells.where("is_full").groupBy("cx", "cy").agg(F.min("feature_id").alias("last"))
    few = cells.join(last, ["cx", "cy"], "left").where("last is null or feature_id <= last").drop("last")
    if interior:
        on = (F.col("x") == F.floor(F.col("x") / cell_m) * cell_m) | (F.col("y") == F.floor(F.col("y") / cell_m) * cell_m)
        held = _held(points.where(~on), few, cell_m, True).unionByName(_held(points.where(on), cells, cell_m, True))
    else:
        held = _held(points, few, cell_m)
    found = held.groupBy("id").agg(F.min("feature_id").alias("feature_id"))
    return points.join(found, "id", "left")


def bind_points(points: DataFrame, rings: DataFrame, cell_m: float, limit_m: float, interior: bool = False) -> DataFrame:
    """Every point with a feature, the method and the distance: the one that holds it, else the nearest within a limit, else UNRESOLVED."""
    held = first_polygon(points, rings, cell_m, interior)
    left = held.where("feature_id is null").select("id", "x", "y")
    near = nearest_segment(left, segments_of(rings), limit_m)
    found = held.where("feature_id is not null").select("id", "feature_id", F.lit("CONTAINS").alias("method"), F.lit(0.0).alias("distance_m"))
    return found.unionByName(near.select("id", F.col("line_id").alias("feature_id"), F.when(F.col("line_id").isNull(), "UNRESOLVED").otherwise("NEAREST").alias("method"), "distance_m"))


def segments_of(rings: DataFrame) -> DataFrame:
    """The sides of rings as segments; line_id is the feature."""
    n = F.size("xs")
    side = F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(F.col("xs")[k].alias("x1"), F.col("ys")[k].alias("y1"), F.col("xs")[(k + 1) % n].alias("x2"), F.col("ys")[(k + 1) % n].alias("y2"))))
    return rings.select(F.col("feature_id").alias("line_id"), side.alias("s")).select("line_id", "s.*").where("x1 <> x2 or y1 <> y2")


def segment_distance(x: Column, y: Column) -> Column:
    """Distance of a place to the segment x1, y1, x2, y2."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((x - F.col("x1")) * dx + (y - F.col("y1")) * dy, dx * dx + dy * dy), F.lit(0.0))))
    return F.hypot(x - F.col("x1") - t * dx, y - F.col("y1") - t * dy)


def nearest_segment(points: DataFrame, segments: DataFrame, limit_m: float) -> DataFrame:
    """Every point (id, x, y) with the nearest line up to a distance (of ties the smaller line), and the distance; nulls if none is.

    Cells begin as wide as points lie apart and grow fourfold, up to the limit, for points that have no line within a cell's width: so a point meets
    the few segments around it, however many lie within the limit. A segment stands in the cells that it passes and those around.
    """
    asked, width = points.select("id", "x", "y"), first_width(points, limit_m)
    out = None
    while True:
        step = lambda c: F.floor(c / width)  # noqa: B023, E731
        tiles = segments.withColumn("cx", F.explode(F.sequence(step(F.least("x1", "x2")) - 1, step(F.greatest("x1", "x2")) + 1)))
        # Of a column, those rows that the segment has in it and the columns beside it, and a little more than rounding takes.
        part = lambda x: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(F.try_divide(x - F.col("x1"), F.col("x2") - F.col("x1")), F.lit(0.0))))
        y = lambda t: F.col("y1") + (F.col("y2") - F.col("y1")) * t
        ya, yb = y(part((F.col("cx") - 1) * width)), F.when(F.col("x1") == F.col("x2"), F.col("y2")).otherwise(y(part((F.col("cx") + 2) * width)))
        tiles = tiles.withColumn("cy", F.explode(F.sequence(step(F.least(ya, yb) - width / 1e6) - 1, step(F.greatest(ya, yb) + width / 1e6) + 1)))
        at = asked.select("id", "x", "y", step(F.col("x")).alias("cx"), step(F.col("y")).alias("cy"))
        near = at.join(tiles.hint("merge"), ["cx", "cy"]).withColumn("distance_m", segment_distance(F.col("x"), F.col("y"))).where(F.col("distance_m") <= width)
        best = near.groupBy("id").agg(F.min(F.struct("distance_m", "line_id")).alias("b")).select("id", "b.line_id", "b.distance_m")
        if width < limit_m:
            best = written(best, "nearest-segment")
        out = best if out is None else out.unionByName(best)
        if width >= limit_m:
            return points.join(out, "id", "left")
        asked = written(asked.join(best.select("id"), "id", "left_anti"), "nearest-segment-left")
        if asked.isEmpty():
            return points.join(out, "id", "left")
        width = min(4 * width, float(limit_m))


def line_in_hexes(segments: DataFrame, grid: GridSpec) -> DataFrame:
    """Each line's length in each cell it crosses: a segment is cut by the cell's six half planes (Liang-Barsky)."""
    box = [F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2")]
    each = segments.withColumn("cell", F.explode(cells_of_box(grid, *box))).select(*segments.columns, "cell.q", "cell.r")
    cx, cy = grid.centre(F.col("q"), F.col("r"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    highs, lows = [F.lit(1.0)], [F.lit(0.0)]
    for k in range(6):
        nx, ny = math.cos(math.radians(60 * k)), math.sin(math.radians(60 * k))
        # n . (p - c) <= half the width, with p = start + t * d
        a, b = nx * dx + ny * dy, grid.flat_to_flat / 2 - nx * (F.col("x1") - cx) - ny * (F.col("y1") - cy)
        flat, t = F.abs(a) < 1e-12, F.try_divide(b, a)
        highs.append(F.when(flat, F.when(b < 0, -1.0).otherwise(1.0)).when(a > 0, t).otherwise(1.0))
        lows.append(F.when(~flat & (a < 0), t).otherwise(0.0))
    high, low = F.least(*highs), F.greatest(*lows)
    each = each.withColumn("length_m", (high - low) * F.hypot(dx, dy)).where("length_m > 1e-9")
    return each.groupBy("line_id", "q", "r").agg(F.sum("length_m").alias("length_m"))


def without_clip_edges(segments: DataFrame, box: tuple[float, float, float, float], tolerance: float = 1.0) -> DataFrame:
    """Segments that don't run along the sides of a clip box."""
    along = F.lit(False)
    for c, at in (("x", box[0]), ("x", box[2]), ("y", box[1]), ("y", box[3])):
        along = along | ((F.abs(F.col(f"{c}1") - at) <= tolerance) & (F.abs(F.col(f"{c}2") - at) <= tolerance))
    return segments.where(~along)


def touches_clip(rings: DataFrame, box: tuple[float, float, float, float], tolerance: float) -> DataFrame:
    """For each feature whether it comes within a tolerance of the clip box's sides."""
    near = (F.array_min("xs") <= box[0] + tolerance) | (F.array_min("ys") <= box[1] + tolerance) | (F.array_max("xs") >= box[2] - tolerance) | (F.array_max("ys") >= box[3] - tolerance)
    return rings.groupBy("feature_id").agg(F.bool_or(near).alias("touches_clip_boundary"))


def ring_faults(rings: DataFrame) -> DataFrame:
    """Rings with fewer than three corners, without area, or crossing themselves: feature_id and fault."""

    @F.pandas_udf("string")
    def fault(xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(xs, ys):
            x, y = open_ring(a, b)
            if len(x) < 3:
                out.append("TOO_FEW_CORNERS")
            elif _crosses(x, y):
                out.append("CROSSES_ITSELF")
            else:
                out.append("NO_AREA" if abs(ring_area(x, y)) < 1e-9 else None)
        return pd.Series(out, dtype=object)

    return rings.select("feature_id", fault("xs", "ys").alias("fault")).where("fault is not null")


#: Pairs of sides that are looked at together.
PAIRS = 1 << 20


def _crosses(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sides of a ring cross.

    Sides are sorted by where they begin along x or y, and each meets those that begin before it ends, along the axis with
    fewer such pairs; pairs are looked at in blocks, so memory is bounded for any ring.
    """
    a = np.stack([x, y], axis=1)
    b = np.roll(a, -1, axis=0)
    best = None
    for axis in (0, 1):
        low, high = np.minimum(a[:, axis], b[:, axis]), np.maximum(a[:, axis], b[:, axis])
        order = np.argsort(low, kind="stable")
        met = np.searchsorted(low[order], high[order], side="right") - np.arange(len(x)) - 1
        if best is None or met.sum() < best[1].sum():
            best = order, met
    order, met = best
    a, b = a[order], b[order]
    turn = lambda p, q, r: np.sign((q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0]))
    ends = np.cumsum(met)
    total = int(ends[-1])
    for at in range(0, total, PAIRS):
        k = np.arange(at, min(at + PAIRS, total))
        i = np.searchsorted(ends, k, side="right")
        j = i + 1 + k - (ends[i] - met[i])
        # Sides that share a corner turn to 0 there, so they never cross.
        if np.any((turn(a[i], b[i], a[j]) * turn(a[i], b[i], b[j]) < 0) & (turn(a[j], b[j], a[i]) * turn(a[j], b[j], b[i]) < 0)):
            return True
    return False


def within_distance_pairs(rings: DataFrame, limit_m: float) -> DataFrame:
    """Pairs of features (a below b) whose outlines come within a distance, and that distance; shapes meet as blocks in square cells."""
    s = segments_of(rings)
    return close_shapes(s, s, limit_m, pairs="below").select("a", "b", F.col("d").alias("distance_m"))


def ground_areas(rings: DataFrame, steps: int = 32) -> DataFrame:
    """For each feature its area on the ellipsoid in square kilometres (``ring_km2``); holes count against it."""

    @F.pandas_udf(DoubleType())
    def area(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([ring_km2(*open_ring(a, b), steps) for a, b in zip(xs, ys)], dtype=float)

    each = rings.withColumn("km2", area("xs", "ys"))
    return each.groupBy("feature_id").agg(F.sum(F.when(F.col("is_hole"), -F.col("km2")).otherwise(F.col("km2"))).alias("ground_km2"))


def _overlap_width(rings: DataFrame, grid: GridSpec) -> float:
    """The width of the square cells in which rings meet: a cell of the grid, but for rings of few corners as wide as they are, up to eight cells, so that a ring has a few parts."""
    span = lambda c: F.array_max(c) - F.array_min(c)
    mean = rings.agg(F.avg((span("xs") + span("ys")) / 2).alias("m"), F.avg(F.size("xs")).alias("n")).first()
    if not mean["m"] or not math.isfinite(mean["m"]) or mean["n"] > 16:
        return grid.flat_to_flat
    return grid.flat_to_flat * min(8, max(1, round(mean["m"] / grid.flat_to_flat)))


#: Boxes of a block, how many cells the widest box has along a side at most, and pairs that wait for each other in a task.
BOXES, SPAN, PAIRS_AT_ONCE = 1024, 32, 1 << 18
BOX = ("feature_id", "x0", "x1", "y0", "y1")


def ring_boxes(rings: DataFrame, holes: bool = False) -> DataFrame:
    """Outer rings with the box around them, and whether their feature is that box and no other outer ring (alone); with ``holes`` no other ring at all."""
    usable = lambda c: ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    every = F.count("*").over(Window.partitionBy("feature_id")) if holes else F.lit(1)
    outer = rings.withColumn("rings", every).where(~F.col("is_hole")).select("feature_id", "is_hole", "rings", F.col("xs").cast("array<double>").alias("xs"), F.col("ys").cast("array<double>").alias("ys"))
    outer = outer.where((F.size("xs") == F.size("ys")) & (F.size("xs") > 2)).where(usable("xs") & usable("ys"))
    closed = (F.size("xs") == 5) & (F.get("xs", F.lit(0)) == F.element_at("xs", -1)) & (F.get("ys", F.lit(0)) == F.element_at("ys", -1))
    x, y = (F.when(closed, F.slice(c, 1, 4)).otherwise(F.col(c)) for c in ("xs", "ys"))
    apart = lambda c, i, j: F.get(c, F.lit(i)) - F.get(c, F.lit(j))
    area = F.abs(apart(x, 2, 0) * apart(y, 3, 1) - apart(x, 3, 1) * apart(y, 2, 0)) / 2  # of four corners
    boxed = _with_box(outer.withColumns({"xs": x, "ys": y}).withColumn("area_m2", F.when(F.size("xs") == 4, area).otherwise(0.0)))
    alone = F.coalesce("is_box", F.lit(False)) & (F.col("area_m2") > 0) & F.col("feature_id").isNotNull() & (F.count("*").over(Window.partitionBy("feature_id")) == 1) & (F.col("rings") == 1)
    return boxed.withColumn("alone", alone).drop("is_box", "area_m2", "rings")


def _tied(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of a table of hits as stars: each column that is hit with the first row of its component, and those rows that begin none, which a column of theirs ties.

    Returned are these rows, the columns, and the columns' first rows.
    """
    to_row, to_column = np.full(hit.shape[0], -1), np.full(hit.shape[1], -1)
    for first in np.flatnonzero(hit.any(axis=1)):
        if to_row[first] >= 0:
            continue
        to_row[first], fresh = first, np.array([first])
        while len(fresh):
            columns = np.flatnonzero(hit[fresh].any(axis=0) & (to_column < 0))
            to_column[columns] = first
            fresh = np.flatnonzero(hit[:, columns].any(axis=1) & (to_row < 0))
            to_row[fresh] = first
    columns = np.flatnonzero(to_column >= 0)
    return np.flatnonzero((to_row >= 0) & (to_row != np.arange(len(to_row)))), columns, to_column[columns]


def box_pairs(own: DataFrame, there: DataFrame | None = None, least_m2: float = 0.0, links: bool = False, limit_m: float | None = None, unit_m: float = 1.0) -> DataFrame:
    """Pairs of boxes (feature_id, x0, x1, y0, y1) that overlap: a, b and overlap_m2, or with ``links`` pairs that tie the same components together.

    With ``limit_m`` pairs of one table up to that distance, with all that ``relations`` says of them: a, b, overlap_m2, shared_m (border in common, in whole ``unit_m``) and separation_m.

    Boxes of a square cell meet as blocks in numpy. A pair belongs to the cell that holds the lower left corner of what is common to both, so it comes once and whole, and no
    pairs are sorted or added up.
    """
    spark, one_table = own.sparkSession, there is None
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    every = own if there is None else own.select(*BOX).unionByName(there.select(*BOX))
    head = every.agg(F.percentile_approx(size, 0.9).alias("most"), F.max(size).alias("widest")).first()
    width = max(head["most"] or 1.0, (head["widest"] or 1.0) / SPAN)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    pad = 0.0 if limit_m is None else max(limit_m, 2 * unit_m) / 2 * (1 + 1e-9)
    step = lambda c: F.floor((F.col(c) + (pad if c.endswith("1") else -pad)) / width)

    def blocks(t: DataFrame, name: str) -> DataFrame:
        cells = t.select(*BOX).withColumn("cx", F.explode(F.sequence(step("x0"), step("x1")))).withColumn("cy", F.explode(F.sequence(step("y0"), step("y1"))))
        count = F.ceil(F.count("*").over(Window.partitionBy("cx", "cy")) / BOXES)
        dealt = cells.repartition(parts, "cx", "cy").withColumn("block", F.pmod(F.xxhash64("feature_id"), count))
        return written(dealt.groupBy("cx", "cy", "block").agg(F.collect_list(F.struct(*BOX)).alias(name)), "overlap-blocks").withColumnRenamed("block", f"block_{name}")

    mine = blocks(own, "o")
    others = mine.withColumnsRenamed({"o": "f", "block_o": "block_f"}) if there is None else blocks(there, "f")
    met = mine.hint("merge").join(others.hint("merge"), ["cx", "cy"])
    if there is None:
        met = met.where("block_o <= block_f")
    # Pairs of blocks are dealt over all tasks, as a busy cell has many.
    met = met.select("cx", "cy", (F.lit(there is None) & (F.col("block_o") == F.col("block_f"))).alias("same"), "o", "f").repartition(parts, F.xxhash64("cx", "cy", "block_o", "block_f"))
    kinds = [own.schema["feature_id"].dataType, (own if there is None else there).schema["feature_id"].dataType]
    measures = [] if links else ["overlap_m2"] if limit_m is None else ["overlap_m2", "shared_m", "separation_m"]
    arrow = pa.schema([("a", to_arrow_type(kinds[0])), ("b", to_arrow_type(kinds[1])), *((c, pa.float64()) for c in measures)])

    def related(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """The overlap, the border in common and the distance of pairs of boxes."""
        sx, sy = np.minimum(a[1], b[1]) - np.maximum(a[0], b[0]), np.minimum(a[3], b[3]) - np.maximum(a[2], b[2])
        over = np.where((sx > 0) & (sy > 0), sx * sy, 0.0)
        u, v = [np.rint(c / unit_m) for c in a], [np.rint(c / unit_m) for c in b]
        shared = np.zeros(len(over))
        for s, t in ((0, 2), (2, 0)):  # sides that lie on each other, and how far they run together
            # A box without width in whole units has two sides in one place, which are no border.
            real = (u[s] < u[s + 1]) & (v[s] < v[s + 1])
            same = sum((u[s + i] == v[s + j]).astype(float) for i in (0, 1) for j in (0, 1)) * real
            shared += same * np.maximum(np.minimum(u[t + 1], v[t + 1]) - np.maximum(u[t], v[t]), 0.0) * unit_m
        return over, shared, np.where((over > 0) | (shared > 0), 0.0, np.hypot(np.maximum(-sx, 0.0), np.maximum(-sy, 0.0)))

    def unpacked(lists: pa.ListArray) -> tuple:
        at, values = lists.offsets.to_numpy(), lists.values
        return at, values.field(0), values.field(0).to_numpy(zero_copy_only=False), [values.field(k).to_numpy() for k in range(1, 5)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (o_at, o_ids, o_key, o), (f_at, f_ids, f_key, f) = unpacked(batch.column("o")), unpacked(batch.column("f"))
            cx, cy, same = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cx", "cy", "same"))
            waiting, held = [], 0

            def table() -> pa.RecordBatch:
                i, j, *m = (np.concatenate(c) for c in zip(*waiting))
                a, b = o_ids.take(pa.array(i)), f_ids.take(pa.array(j))
                if one_table:
                    turned = pa.array((o_key[i] > f_key[j]).astype(bool))
                    a, b = pc.if_else(turned, b, a), pc.if_else(turned, a, b)
                return pa.RecordBatch.from_arrays([a.cast(arrow.types[0]), b.cast(arrow.types[1]), *map(pa.array, m)], schema=arrow)

            for r in range(batch.num_rows):
                i, j = slice(o_at[r], o_at[r + 1]), slice(f_at[r], f_at[r + 1])
                for begin in range(i.start, i.stop, BOXES):
                    rows = slice(begin, min(begin + BOXES, i.stop))
                    (ax0, ax1, ay0, ay1), (bx0, bx1, by0, by1) = [c[rows, None] for c in o], [c[j] for c in f]
                    x0, y0 = np.maximum(ax0, bx0), np.maximum(ay0, by0)
                    if limit_m is None:
                        hit = (x0 < ax1) & (x0 < bx1) & (y0 < ay1) & (y0 < by1)
                    else:
                        hit = (x0 - np.minimum(ax1, bx1) <= 2 * pad) & (y0 - np.minimum(ay1, by1) <= 2 * pad)
                    if not links:
                        hit &= (np.floor((x0 - pad) / width) == cx[r]) & (np.floor((y0 - pad) / width) == cy[r])
                    p, q = np.nonzero(hit)
                    if same[r]:
                        first = rows.start - i.start + p < q
                        p, q = p[first], q[first]
                    u, v = rows.start + p, j.start + q
                    if limit_m is None:
                        m = [(np.minimum(o[1][u], f[1][v]) - x0[p, q]) * (np.minimum(o[3][u], f[3][v]) - y0[p, q])]
                        keep = m[0] > least_m2
                    else:
                        m = related([c[u] for c in o], [c[v] for c in f])
                        keep = m[2] <= limit_m
                    u, v, m = u[keep], v[keep], [c[keep] for c in m]
                    if links and len(u):
                        tied = np.zeros(hit.shape, bool)
                        tied[u - rows.start, v - j.start] = True
                        n, c, d = _tied(tied)
                        u, v, m = np.concatenate([d, n]) + rows.start, np.concatenate([c, np.argmax(tied[n], axis=1)]) + j.start, []
                    if len(u):
                        waiting.append((u, v, *([] if links else m)))
                        held += len(u)
                    if held >= PAIRS_AT_ONCE:
                        yield table()
                        waiting, held = [], 0
            if waiting:
                yield table()

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    schema = ", ".join([f"a {kinds[0].simpleString()}", f"b {kinds[1].simpleString()}", *(f"{c} double" for c in measures)])
    return met.mapInArrow(run, schema)


def overlaps(rings: DataFrame, grid: GridSpec, least_m2: float = 1e-6, others: DataFrame | None = None, links: bool = False) -> DataFrame:
    """Pairs of features (a below b) whose outer rings overlap, and the area of the overlap; with ``others`` pairs of a feature of each table.

    Features that are one box meet as blocks, so their pairs come once and whole. Of other features parts of rings meet in square cells of ``grid``'s width or more; only those
    whose boxes overlap go on, and a cell adds the part of the overlap inside it. Two parts that are boxes, as all are that fill their cell, are four comparisons; other pairs are united in Python.
    With ``links`` there are only a and b, and instead of all pairs of boxes some that tie the same components together, about as many as boxes in a block and not their square.
    """
    flagged = lambda t: written(ring_boxes(t), "overlap-rings")
    own = flagged(rings)
    far = None if others is None else flagged(others)
    found = box_pairs(own.where("alone"), None if far is None else far.where("alone"), least_m2, links)
    rest = []
    if not own.where("not alone").isEmpty():
        rest.append(_part_overlaps(own, grid, least_m2, far, "not (alone and alone_b)" if far is not None else "not alone or not alone_b"))
    elif far is not None and not far.where("not alone").isEmpty():
        rest.append(_part_overlaps(own, grid, least_m2, far, "not alone_b"))
    for more in rest:
        found = found.unionByName(more.select(*found.columns))
    return found


def _part_overlaps(rings: DataFrame, grid: GridSpec, least_m2: float, others: DataFrame | None, wanted: str) -> DataFrame:
    """The overlaps of those pairs that ``wanted`` picks by alone and alone_b, from parts of rings in cells."""
    width = _overlap_width(rings, grid)
    made = lambda t: written(_with_box(square_parts(t, ["feature_id", "alone"], width)), "overlap-parts")
    each = made(rings)
    there = each if others is None else made(others)
    pairs = each.join(there.withColumnsRenamed({c: f"{c}_b" for c in there.columns if c not in ("cx", "cy")}), ["cx", "cy"]).where(wanted)
    if others is None:
        pairs = pairs.where("feature_id < feature_id_b")
    pairs = pairs.where("x0 < x1_b and x0_b < x1 and y0 < y1_b and y0_b < y1")
    a, b = F.col("feature_id").alias("a"), F.col("feature_id_b").alias("b")
    common_side = lambda c: F.least(f"{c}1", f"{c}1_b") - F.greatest(f"{c}0", f"{c}0_b")
    boxes = pairs.where("is_box and is_box_b").select(a, b, (common_side("x") * common_side("y")).alias("m2"))

    @F.pandas_udf(DoubleType())
    def common(xs: pd.Series, ys: pd.Series, area: pd.Series, xb: pd.Series, yb: pd.Series, area_b: pd.Series) -> pd.Series:
        return pd.Series([m + n - union_area([open_ring(a, b), open_ring(c, d)]) for a, b, m, c, d, n in zip(xs, ys, area, xb, yb, area_b)], dtype=float)

    found = boxes.unionByName(pairs.where("not (is_box and is_box_b)").select(a, b, common("xs", "ys", "area_m2", "xs_b", "ys_b", "area_m2_b").alias("m2")))
    return found.groupBy("a", "b").agg(F.sum("m2").alias("overlap_m2")).where(F.col("overlap_m2") > least_m2)


def land_fragments(land: DataFrame, hexes: DataFrame, grid: GridSpec) -> DataFrame:
    """Land of one subject inside a hex that is not terrestrial: fragment_id, hex_id, subject, area_m2. Needs land (feature_id, q, r, area_m2), hexes (q, r, land_class)."""
    wet = land.join(hexes.where("land_class <> 'land'").select("q", "r"), ["q", "r"])
    hex_id = grid.hex_id(F.col("q"), F.col("r"))
    return wet.where("area_m2 > 0").select(hashed_id("lfr_", hex_id, F.col("feature_id"), length=14).alias("fragment_id"), hex_id.alias("hex_id"), F.col("feature_id").alias("subject"), "area_m2")
