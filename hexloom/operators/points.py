"""Places and the hexes that hold them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.functions.projection import to_mercator, to_wgs84
from hexloom.tables import written


def place_points(points: DataFrame, grid: GridSpec) -> DataFrame:
    """Points (lon, lat) with their projected place, their cell, the cell's id and middle, and the distance to that."""
    x, y = to_mercator(F.col("lon"), F.col("lat"))
    out = points.withColumns({"x": x, "y": y})
    q, r = grid.cell(F.col("x"), F.col("y"))
    out = out.withColumns({"q": q, "r": r})
    cx, cy = grid.centre(F.col("q"), F.col("r"))
    out = out.withColumns({"hex_id": grid.hex_id(F.col("q"), F.col("r")), "centre_x": cx, "centre_y": cy})
    lon, lat = to_wgs84(F.col("centre_x"), F.col("centre_y"))
    return out.withColumns({"centre_lon": lon, "centre_lat": lat, "to_centre_m": F.hypot(F.col("x") - F.col("centre_x"), F.col("y") - F.col("centre_y"))})


def hex_summary(placed: DataFrame) -> DataFrame:
    """For each cell its number of places, and id and name of the largest one (of ties the one with the smaller id)."""
    first = F.min(F.struct(F.col("population").isNull().alias("unknown"), (-F.col("population")).alias("order"), "id", "name"))
    return placed.groupBy("hex_id").agg(F.count("*").alias("city_count"), first.alias("first")).select("hex_id", "city_count", F.col("first.id").alias("primary_city_id"), F.col("first.name").alias("primary_city_name"))


def with_hex_info(placed: DataFrame, info: DataFrame) -> DataFrame:
    """Places with the columns of their cell in ``info`` (key hex_id); cells without a row leave nulls."""
    return placed.join(info, "hex_id", "left")


def group_sizes(placed: DataFrame) -> DataFrame:
    """Each place with the number of places in its cell and whether it shares it."""
    n = F.count("*").over(Window.partitionBy("hex_id"))
    return placed.withColumn("cities_in_same_hex", n).withColumn("shares_hex", n > 1)


def first_width(points: DataFrame, most: float) -> float:
    """The width of a square cell that would hold one of the points (x, y) if they lay evenly in their box; ``most`` at most."""
    box = points.agg((F.max("x") - F.min("x")).alias("w"), (F.max("y") - F.min("y")).alias("h"), F.count("x").alias("n")).first()
    if not box["n"] or box["n"] < 2:
        return float(most)
    # Points along a line lie apart by its length over their number.
    width = max(math.sqrt(box["w"] * box["h"] / box["n"]), max(box["w"], box["h"]) / box["n"])
    return min(float(most), width) if width > 0 else float(most)


def nearest_other(points: DataFrame, cell_m: float) -> DataFrame:
    """For each point (id, name, x, y) the nearest other one (nearest_id, nearest_name, nearest_m); of ties the smaller id.

    Points fall into square cells, of ``cell_m`` or less where points lie closer. A point looks at its own cell and the eight around; where
    that finds one within a cell's width it is the nearest, otherwise the width grows fourfold for the points left over.
    Every round is a hash join on cells; the last one, with one cell, leaves nothing over. Points at
    one place are first reduced to one row with its two smallest ids, so copies don't multiply.
    """
    place = points.groupBy("x", "y").agg(F.slice(F.array_sort(F.collect_set(F.struct("id", "name"))), 1, 2).alias("here"))
    place = place.withColumn("here", F.slice("here", 1, 2))
    # Several points at one place are each other's nearest.
    crowded = place.where(F.size("here") > 1).select("x", "y", "here")
    same = points.join(crowded, ["x", "y"]).select(
        "id", F.when(F.col("id") == F.col("here")[0]["id"], F.col("here")[1]).otherwise(F.col("here")[0]).alias("found"), F.lit(0.0).alias("m")
    )
    alone = place.where(F.size("here") == 1)
    asked = points.join(alone.select("x", "y"), ["x", "y"], "left_semi").select("id", "x", "y")
    spread = place.agg((F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y"))).alias("w"), F.count("*").alias("n")).first()
    out, width = same, first_width(place, cell_m)
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    while (spread["n"] or 0) > 1:
        step = lambda c: F.floor(F.col(c) / width)  # noqa: B023, E731
        looking = asked.select("id", "x", "y", around.alias("d")).select("id", "x", "y", (step("x") + F.col("d.a")).alias("cx"), (step("y") + F.col("d.b")).alias("cy"))
        there = place.select(step("x").alias("cx"), step("y").alias("cy"), F.col("x").alias("ox"), F.col("y").alias("oy"), F.col("here")[0].alias("found"))
        m = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
        near = looking.join(there, ["cx", "cy"]).where(F.col("id") != F.col("found.id")).withColumn("m", m)
        best = near.groupBy("id").agg(F.min(F.struct("m", "found")).alias("best")).select("id", "best.found", "best.m").where(F.col("m") <= width)
        best = written(best, "nearest")
        out = out.unionByName(best)
        if width > spread["w"]:
            break
        asked = written(asked.join(best.select("id"), "id", "left_anti"), "nearest-left")
        if asked.isEmpty():
            break
        width *= 4
    found = out.select("id", F.col("found.id").alias("nearest_id"), F.col("found.name").alias("nearest_name"), F.col("m").alias("nearest_m"))
    return points.join(found, "id", "left")


def collision_summary(placed: DataFrame, thresholds: list[int]) -> DataFrame:
    """For all places and for those from each population on: places, those that share a cell, shared cells, population and names there.

    The places of a cell are joined by "+", the largest first; cells are joined by "; " in the order of that text.
    """
    spark = placed.sparkSession
    levels = spark.createDataFrame([("overall", None), *[(f"population_ge_{t}", t) for t in thresholds]], "level string, least bigint")
    each = placed.join(F.broadcast(levels), F.col("least").isNull() | (F.col("population") >= F.col("least")))
    order = F.array_sort(F.collect_list(F.struct((-F.col("population")).alias("p"), F.col("id"), F.col("name"))))
    hexes = each.groupBy("level", "hex_id").agg(F.count("*").alias("n"), F.sum("population").alias("p"), F.array_join(F.transform(order, lambda c: c["name"]), "+").alias("names"))
    shared = F.col("n") > 1
    out = hexes.groupBy("level").agg(
        F.sum("n").alias("city_count"), F.sum(F.when(shared, F.col("n")).otherwise(0)).alias("cities_sharing_hex_count"), F.count_if(shared).alias("city_hex_collision_count"),
        F.sum(F.when(shared, F.col("p")).otherwise(0)).alias("collision_population_sum"), F.array_join(F.array_sort(F.collect_list(F.when(shared, F.col("names")))), "; ").alias("collision_city_names"),
    )
    return levels.select("level").join(out, "level", "left").na.fill(0).na.fill("")


def nearest_within(points: DataFrame, targets: DataFrame, limit_m: float, key: str = "id", target: str = "target") -> DataFrame:
    """For each point (key, x, y) the nearest target (target, x, y) up to ``limit_m`` away (of ties the smaller), with its distance; nulls if there is none.

    Cells begin as wide as targets lie apart and grow fourfold, up to the limit, for points that find none within a cell's width. Targets
    at one place are one row, the smallest.
    """
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    place = targets.groupBy(F.col("x").alias("ox"), F.col("y").alias("oy")).agg(F.min(target).alias(target))
    asked, width = points.select(key, "x", "y"), first_width(targets, limit_m)
    out = None
    while True:
        step = lambda c: F.floor(F.col(c) / width)  # noqa: B023, E731
        looking = asked.select(key, "x", "y", around.alias("d")).select(key, "x", "y", (step("x") + F.col("d.a")).alias("cx"), (step("y") + F.col("d.b")).alias("cy"))
        there = place.select(step("ox").alias("cx"), step("oy").alias("cy"), "ox", "oy", target)
        m = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
        best = looking.join(there, ["cx", "cy"]).withColumn("distance_m", m).where(F.col("distance_m") <= width).groupBy(key).agg(F.min(F.struct("distance_m", target)).alias("b"))
        best = best.select(key, F.col(f"b.{target}").alias(target), F.col("b.distance_m").alias("distance_m"))
        if width < limit_m:
            best = written(best, "nearest-within")
        out = best if out is None else out.unionByName(best)
        if width >= limit_m:
            return points.join(out, key, "left")
        asked = written(asked.join(best.select(key), key, "left_anti"), "nearest-within-left")
        if asked.isEmpty():
            return points.join(out, key, "left")
        width = min(4 * width, float(limit_m))


def size_rank(value: Column) -> Column:
    """Order of magnitude of a population, for thresholds."""
    return F.floor(F.log10(F.greatest(value, F.lit(1)))).cast("int")
