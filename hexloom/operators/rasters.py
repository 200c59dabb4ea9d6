"""Pixel tables: mosaics, neighbourhoods and zonal statistics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.functions.projection import to_mercator

METRES_A_DEGREE = 111320.0
#: Land-cover codes and names.
COVER = {10: "tree", 20: "shrub", 30: "grassland", 40: "cropland", 50: "built_up", 60: "bare_sparse", 70: "snow_ice", 80: "water", 90: "herbaceous_wetland", 95: "mangroves", 100: "moss_lichen"}
#: Climate codes in the order of their numbers from 1.
CLIMATES = "Af Am Aw BWh BWk BSh BSk Csa Csb Csc Cwa Cwb Cwc Cfa Cfb Cfc Dsa Dsb Dsc Dsd Dwa Dwb Dwc Dwd Dfa Dfb Dfc Dfd ET EF".split()


def mosaic(pixels: DataFrame, priority: list[str], values: list[str], nodata: Column | None = None) -> DataFrame:
    """One row for each (row, col): the values of the pixel that was laid last, by ``priority``; pixels for which ``nodata`` holds lay nothing."""
    if nodata is not None:
        pixels = pixels.where(~F.coalesce(nodata, F.lit(False)))
    top = F.struct(*priority, *[v for v in values if v not in priority])
    return pixels.groupBy("row", "col").agg(F.max(top).alias("top")).select("row", "col", *[F.col(f"top.{v}").alias(v) for v in values])


def filled(target: DataFrame, pixels: DataFrame, values: dict) -> DataFrame:
    """The target's (row, col) with the pixels' values, or the given ones where no pixel is."""
    joined = target.join(pixels, ["row", "col"], "left")
    return joined.select(*target.columns, *[F.coalesce(v, F.lit(fill)).alias(v) for v, fill in values.items()])


def sample_at(points: DataFrame, pixels: DataFrame, west: float, north: float, degrees: float, values: list[str]) -> DataFrame:
    """Points (lon, lat) with the values of the pixel that holds them; nulls outside."""
    at = points.withColumns({"col": F.floor((F.col("lon") - west) / degrees), "row": F.floor((north - F.col("lat")) / degrees)})
    return at.join(pixels.select("row", "col", *values), ["row", "col"], "left")


def hex_of_pixels(pixels: DataFrame, grid: GridSpec) -> DataFrame:
    """Pixels (lon, lat of their middle) with the cell (q, r) that holds the middle."""
    x, y = to_mercator(F.col("lon"), F.col("lat"))
    q, r = grid.cell(x, y)
    return pixels.withColumns({"q": q, "r": r})


def _beside(pixels: DataFrame, value: str) -> DataFrame:
    """Each pixel with the values above, below, left and right of it, null where there is no pixel."""
    row, col = Window.partitionBy("row").orderBy("col"), Window.partitionBy("col").orderBy("row")

    def at(w, step: int, axis: str) -> Column:
        shift = F.lag if step < 0 else F.lead
        there = shift(axis, 1).over(w) == F.col(axis) + step
        return F.when(there, shift(value, 1).over(w))

    return pixels.withColumns({"left": at(row, -1, "col"), "right": at(row, 1, "col"), "up": at(col, -1, "row"), "down": at(col, 1, "row")})


def slope(pixels: DataFrame, degrees: float, value: str = "elev", lat: str = "lat") -> DataFrame:
    """Pixels with slope_deg: central differences, one-sided ones at an edge, east-west spacing shrunk by the latitude's cosine."""
    dy = degrees * METRES_A_DEGREE
    dx = dy * F.greatest(F.cos(F.radians(lat)), F.lit(0.05))
    each = _beside(pixels, value)

    def change(before: str, after: str) -> Column:
        a, b, here = F.col(before), F.col(after), F.col(value)
        return F.when(a.isNotNull() & b.isNotNull(), (b - a) / 2).when(b.isNotNull(), b - here).when(a.isNotNull(), here - a).otherwise(0.0)

    return each.withColumn("slope_deg", F.degrees(F.atan(F.hypot(change("left", "right") / dx, change("up", "down") / dy)))).drop("left", "right", "up", "down")


def ruggedness(pixels: DataFrame, value: str = "elev") -> DataFrame:
    """Pixels with ruggedness: the mean absolute difference to the eight pixels around; beyond an edge the nearest pixel counts.

    Every pixel tells its value to the nine places around it, so one aggregation does the work of eight joins.
    """
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]
    told = pixels.select(F.explode(F.array(*[F.struct((F.col("row") + a).alias("row"), (F.col("col") + b).alias("col"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(value).alias("v")) for a, b in steps])).alias("t")).select("t.*")
    seen = {(a, b): F.max(F.when((F.col("a") == a) & (F.col("b") == b), F.col("v"))) for a, b in steps}
    around = told.groupBy("row", "col").agg(*[c.alias(f"v{a}{b}") for (a, b), c in seen.items()]).where(F.col("`v00`").isNotNull())
    v = lambda a, b: F.col(f"`v{a}{b}`")
    # Where a corner is missing, the edge's pixel stands for it: the one in the same column, then in the same row.
    pick = lambda a, b: F.coalesce(v(a, b), v(a, 0), v(0, b), v(0, 0))
    total = sum((F.abs(v(0, 0) - pick(a, b)) for a, b in steps if (a, b) != (0, 0)), F.lit(0.0))
    return pixels.join(around.select("row", "col", (total / 8).alias("ruggedness")), ["row", "col"])


def zonal_elevation(pixels: DataFrame, by: list[str], valid: Column) -> DataFrame:
    """For each zone: elevation mean, least, most and range, slope mean, 90th percentile and most, mean ruggedness, and the part without data."""
    ok = lambda c: F.when(valid, F.col(c))
    return pixels.groupBy(*by).agg(
        F.avg(ok("elev")).alias("elevation_mean_m"), F.min(ok("elev")).alias("elevation_min_m"), F.max(ok("elev")).alias("elevation_max_m"),
        (F.max(ok("elev")) - F.min(ok("elev"))).alias("elevation_range_m"), F.avg(ok("slope_deg")).alias("slope_mean_deg"),
        F.percentile(ok("slope_deg"), F.lit(0.9)).alias("slope_p90_deg"), F.max(ok("slope_deg")).alias("slope_max_deg"), F.avg(ok("ruggedness")).alias("terrain_roughness"),
        (1 - F.count_if(valid) / F.count("*")).alias("dem_nodata_fraction"),
    )


def zonal_cover(pixels: DataFrame, by: list[str], code: Column, codes: dict[int, str]) -> DataFrame:
    """For each zone the part of its valid pixels with each code, and the part of all that has no code of the table."""
    known = code.isin(list(codes))
    valid = F.count_if(known)
    parts = [F.coalesce(F.try_divide(F.count_if(code == k), valid), F.lit(0.0)).alias(f"lc_{name}_fraction") for k, name in codes.items()]
    return pixels.groupBy(*by).agg(*parts, (1 - F.coalesce(valid, F.lit(0)) / F.count("*")).alias("landcover_nodata_fraction"))


def zonal_mode(pixels: DataFrame, by: list[str], code: str) -> DataFrame:
    """For each zone its commonest code above zero, of ties the lowest; zero if there is none."""
    counts = pixels.groupBy(*by, code).agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col(code) > 0, F.struct("n", (-F.col(code)).alias("k"))))
    return counts.groupBy(*by).agg(F.coalesce(-best["k"], F.lit(0)).cast("bigint").alias("mode"))


def region_terrain(elevation: DataFrame, cover: DataFrame, climate: DataFrame, nearest_climate: DataFrame | None, by: list[str]) -> DataFrame:
    """Zonal statistics joined; a zone without elevation is at sea level and flat; one without climate takes the nearest pixel's."""
    out = elevation.join(cover, by, "full").join(climate.withColumnRenamed("mode", "climate"), by, "full")
    flat = ["elevation_mean_m", "elevation_min_m", "elevation_max_m", "elevation_range_m", "slope_mean_deg", "slope_p90_deg", "slope_max_deg", "terrain_roughness"]
    out = out.na.fill(0.0, flat).na.fill(1.0, ["dem_nodata_fraction", "landcover_nodata_fraction"])
    if nearest_climate is not None:
        out = out.join(nearest_climate.select(*by, F.col("climate").alias("near")), by, "left").withColumn("climate", F.when(F.coalesce("climate", F.lit(0)) == 0, F.col("near")).otherwise(F.col("climate"))).drop("near")
    return out


def tile_names(min_lon: float, min_lat: float, max_lon: float, max_lat: float, step: int, spark, name) -> DataFrame:
    """The tiles of ``step`` degrees that a box meets: south, west and the name that ``name(south, west)`` gives."""
    lats = F.sequence(F.lit(math.floor(min_lat / step) * step), F.lit((math.ceil(max_lat / step) - 1) * step), F.lit(step))
    lons = F.sequence(F.lit(math.floor(min_lon / step) * step), F.lit((math.ceil(max_lon / step) - 1) * step), F.lit(step))
    tiles = spark.range(1).select(F.explode(lats).alias("south")).select("south", F.explode(lons).alias("west"))
    return tiles.withColumn("tile", name(F.col("south"), F.col("west")))


def degree_name(south: Column, west: Column, lat_width: int = 2, lon_width: int = 3) -> Column:
    """N35E139 and the like."""
    ns, ew = F.when(south >= 0, "N").otherwise("S"), F.when(west >= 0, "E").otherwise("W")
    return F.concat(ns, F.lpad(F.abs(south).cast("string"), lat_width, "0"), ew, F.lpad(F.abs(west).cast("string"), lon_width, "0"))
