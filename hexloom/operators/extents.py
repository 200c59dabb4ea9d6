"""Distances between shapes on the ground, over the date line too, and what groups of shapes measure there."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexloom.functions.geodesy import geodesic_m, geodesic_of_projected, ring_km2
from hexloom.functions.projection import HALF_EXTENT, RADIUS, WORLD
from hexloom.operators.authority import group_id
from hexloom.operators.meets import COORDINATES, close_shapes
from hexloom.tables import written

#: The ellipsoid's distances are within this factor of those on the mean sphere.
NEAR_SPHERE = 1.006
#: Hulls of a group are first made by this many tasks.
HULL_PARTS = 32


def ground_distances(segments: DataFrame, limit_m: float, others: DataFrame | None = None, wanted: str | None = None) -> DataFrame:
    """Pairs of shapes within ``limit_m`` on the ground: a, b, distance_m (in the projection) and ground_m (on the ellipsoid).

    Shapes are rows of segments (line_id, x1, y1, x2, y2; a point is a segment without length), corners inside the world or over its
    east or west edge by less than the limit. Without ``others`` pairs are those of one table, a before b. Nearest are the two places that are
    nearest in the projection, of equals those first in order; between them the ellipsoid is measured. Either shape may lie
    beyond the date line: copies of the shapes near an edge stand a world width off, so both frames meet in one join.
    Shapes meet as blocks in cells as wide as the limit at their latitude needs (``meets.close_shapes``); the limit must be below 300 km. Segments with a null
    are left out. Touching or crossing outlines have 0; a shape inside another has the distance of the outlines. ``wanted`` is a condition on line_id and line_id_b where not all pairs are asked for.
    """
    own = _given(segments)
    far = own if others is None else _given(others)
    found = close_shapes(own, far, limit_m, reach=_reach(limit_m), least=_least(limit_m), turns=_turns(limit_m), pairs="below" if others is None else "all", wanted=wanted)
    return _on_ground(found).where(F.col("ground_m") <= limit_m)


def _given(segments: DataFrame, *keep: str) -> DataFrame:
    return segments.select("line_id", *keep, *[F.col(c).cast("double") for c in COORDINATES]).na.drop()


def _scale(y: Column, further_m: float) -> Column:
    """The projection's scale at a height, or so many metres nearer to the pole (below zero: to the equator)."""
    lat = F.atan(F.sinh(F.abs(y) / RADIUS)) + further_m / 6_300_000.0
    return 1 / F.cos(F.least(F.lit(1.57), F.greatest(F.lit(0.0), lat)))


def _reach(limit_m: float) -> Column:
    """How far places within the limit of a shape may lie from it in the projection."""
    return _scale(F.greatest(F.abs("by0"), F.abs("by1")), limit_m) * (limit_m * 1.01)


def _least(limit_m: float) -> Column:
    """How far places may lie from a shape in the projection that are surely within the limit."""
    return _scale(F.when((F.col("by0") <= 0) & (F.col("by1") >= 0), 0.0).otherwise(F.least(F.abs("by0"), F.abs("by1"))), -limit_m) * limit_m


def _turns(limit_m: float) -> Column:
    edge = F.cosh(F.greatest(F.abs("by0"), F.abs("by1")) / RADIUS) * (4 * limit_m)
    return F.array_compact(F.array(F.lit(0.0), F.when(F.col("bx0") < edge - HALF_EXTENT, WORLD), F.when(F.col("bx1") > HALF_EXTENT - edge, -WORLD)))


def _on_ground(found: DataFrame) -> DataFrame:
    ground = F.when(F.col("d") == 0, 0.0).otherwise(geodesic_of_projected(*[F.col(c) for c in ("px", "py", "qx", "qy")]))
    return found.select("a", "b", F.col("d").alias("distance_m"), ground.alias("ground_m"))


#: Parts of the limit within which a nearest shape is looked for, one after the other.
STEPS = (1 / 32, 1 / 4, 1.0)


def nearest_in_group(segments: DataFrame, limit_m: float, by: str) -> DataFrame:
    """The pairs of ``ground_distances`` that hold every shape's nearest one (in the projection) of its group: a, b, distance_m, ground_m. ``segments`` has the group, one for a shape.

    The reach widens up to the limit for shapes that have no other one within it, so shapes in a crowd meet the few around them. A place within the reach of a round is
    within the limit on the ground; shapes that are left after all rounds meet all those that the limit allows.
    """
    all_ = _given(segments, by)
    asked, out = written(all_, "nearest-shapes"), None
    for step in STEPS:
        least = limit_m * step / 1.02
        found = close_shapes(asked, all_, least, reach=_least(limit_m) * (step / 1.02), turns=_turns(limit_m), by=[by], pairs="other", nearest=True)
        found = written(_on_ground(found), "nearest-found")
        out = found if out is None else out.unionByName(found)
        asked = written(asked.join(found.select(F.col("a").alias("line_id")).distinct(), "line_id", "left_anti"), "nearest-left")
        if asked.isEmpty():
            return out
    left = close_shapes(asked, all_, limit_m, reach=_reach(limit_m), least=_least(limit_m), turns=_turns(limit_m), by=[by], pairs="other")
    return out.unionByName(_on_ground(left).where(F.col("ground_m") <= limit_m))


def hull(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corners of the convex hull, anticlockwise; of places on one line the two ends."""
    rows = sorted(set(zip(x.tolist(), y.tolist())))
    around: list[tuple[float, float]] = []
    for run in (rows, rows[::-1]):  # the lower and the upper chain
        chain: list[tuple[float, float]] = []
        for px, py in run:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (py - chain[-2][1]) <= (chain[-1][1] - chain[-2][1]) * (px - chain[-2][0]):
                chain.pop()
            chain.append((px, py))
        around += chain[:-1]
    c = np.array(around or rows, float).reshape(-1, 2)
    return c[:, 0], c[:, 1]


def widest_m(lon: np.ndarray, lat: np.ndarray) -> float:
    """The largest distance on the ellipsoid between two of some places; it is measured only where the sphere says that a pair may be wider than the widest so far."""
    p = np.radians(lat)
    v = np.stack([np.cos(p) * np.cos(np.radians(lon)), np.cos(p) * np.sin(np.radians(lon)), np.sin(p)], axis=1)
    best = 0.0
    for k in range(len(lon) - 1):
        chord = np.sqrt(((v[k + 1 :] - v[k]) ** 2).sum(axis=1))
        most = 2 * 6371008.8 * np.arcsin(np.minimum(1.0, chord / 2)) * NEAR_SPHERE
        for m in np.argsort(-most):
            if most[m] <= best:
                break
            best = max(best, float(geodesic_m(lon[k : k + 1], lat[k : k + 1], lon[k + 1 + m : k + 2 + m], lat[k + 1 + m : k + 2 + m])[0]))
    return best


def group_extents(points: DataFrame, by: str) -> DataFrame:
    """For each group of projected places (``by``, x, y) extent_m, the largest distance on the ground between two corners of its convex hull,
    extent_projected_m, the same in the projection, and hull_km2, the hull's area on the ground.

    A group is measured in the frame in which it is narrower: as given, or with places of negative x moved a world width east, which is
    whole across the date line. Each task cuts its places to hulls, other tasks cut parts of a group again, so only corners meet in one. Rows with a null are left out; one place has 0 for all three.
    """
    head = f"{by} {points.schema[by].dataType.simpleString()}"
    schema = f"{head}, x double, y double, moved boolean"

    def corners(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (group, moved), g in rows.groupby([by, "moved"], sort=False):
            x, y = hull(g["x"].to_numpy(), g["y"].to_numpy())
            out.append(pd.DataFrame({by: [group] * len(x), "x": x, "y": y, "moved": bool(moved)}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({by: [], "x": [], "y": [], "moved": []})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            east = b.assign(x=np.where(b["x"] < 0, b["x"] + WORLD, b["x"]), moved=True)
            yield corners(pd.concat([b.assign(moved=False), east], ignore_index=True))

    def measured(rows: pd.DataFrame) -> pd.DataFrame:
        frames = [hull(g["x"].to_numpy(), g["y"].to_numpy()) for _, g in rows.groupby("moved")]
        x, y = min(frames, key=lambda f: float(np.ptp(f[0])))
        lon, lat = np.degrees(x / RADIUS), np.degrees(np.arctan(np.sinh(y / RADIUS)))
        flat = max(float(np.hypot(x - a, y - b).max()) for a, b in zip(x, y))
        return pd.DataFrame({by: rows[by].iloc[:1].to_numpy(), "extent_m": [widest_m(lon, lat)], "extent_projected_m": [flat], "hull_km2": [ring_km2(x, y) if len(x) > 2 else 0.0]})

    given = points.select(by, F.col("x").cast("double"), F.col("y").cast("double")).na.drop()
    parts = given.mapInPandas(cut, schema).withColumn("part", F.pmod(F.xxhash64("x", "y"), F.lit(HULL_PARTS)))
    again = parts.groupBy(by, "part").applyInPandas(lambda rows: corners(rows.drop(columns="part")), schema)
    return again.groupBy(by).applyInPandas(measured, f"{head}, extent_m double, extent_projected_m double, hull_km2 double")


def group_metrics(members: DataFrame, points: DataFrame, by: str, near: DataFrame | None = None) -> DataFrame:
    """What groups of components measure on the ground.

    ``members`` has the group, component_id and km2; ``points`` the group's corners (``by``, x, y); ``near`` pairs of components with their
    distance (``ground_distances``). Returns parts, km2, largest_share, group_id, extent_m, extent_projected_m, hull_km2, land_hull_ratio (1 where the hull has no area) and separation_m: how far
    the component that lies most apart is from the one nearest to it in its group. That is 0 for one component, and null where no pair is given.
    Groups were joined over pairs, so the pairs that joined them hold every component's nearest one.
    """
    sums = members.groupBy(by).agg(F.count("*").alias("parts"), F.sum("km2").alias("km2"), F.max("km2").alias("largest"))
    named = group_id(members, by, "component_id", "isl_g_")
    out = sums.withColumn("largest_share", F.coalesce(F.try_divide("largest", "km2"), F.lit(0.0))).drop("largest").join(named, by).join(group_extents(points, by), by, "left")
    out = out.withColumn("land_hull_ratio", F.when(F.col("hull_km2") > 0, F.col("km2") / F.col("hull_km2")).otherwise(1.0))
    if near is None:
        return out.withColumn("separation_m", F.when(F.col("parts") == 1, 0.0))
    each = near.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p"), "distance_m", "ground_m").select("p.*", "distance_m", "ground_m")
    of = lambda c, g: members.select(F.col("component_id").alias(c), F.col(by).alias(g))
    same = each.join(of("a", by), "a").join(of("b", "other"), "b").where(F.col(by) == F.col("other"))
    apart = same.groupBy(by, "a").agg(F.min(F.struct("distance_m", "ground_m"))["ground_m"].alias("m")).groupBy(by).agg(F.max("m").alias("separation_m"))
    return out.join(apart, by, "left").withColumn("separation_m", F.when(F.col("parts") == 1, 0.0).otherwise(F.col("separation_m")))
