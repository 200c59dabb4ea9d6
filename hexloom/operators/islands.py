"""Islands that the grid loses, administrative tables, and points bound to hexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec, within
from hexloom.functions.ids import hashed_id
from hexloom.functions.predicates import cleaned
from hexloom.functions.projection import WORLD


def lost(components: DataFrame) -> DataFrame:
    """Components with whether the grid loses them: they have hexes, none of them terrestrial, don't touch the clip box and are covered."""
    return components.withColumn("is_lost", (F.col("hexes") > 0) & ~F.col("represented") & ~F.col("touches_clip_boundary") & (F.col("coverage") >= 0.98))


def in_analysis_frame(components: DataFrame, crosses: Column) -> DataFrame:
    """Rings in a frame that is whole across the date line: those with their middle in the west move one world width east."""
    middle = (F.array_min("xs") + F.array_max("xs")) / 2
    return components.withColumn("xs", F.when(crosses & (middle < 0), F.transform("xs", lambda x: x + WORLD)).otherwise(F.col("xs")))


def group_units(members: DataFrame, least_km2: float, guard: float, forced: DataFrame, ignored: DataFrame) -> DataFrame:
    """The decision for each group (group_id, component_id, km2): preserved whole, preserved by its largest part, or dropped.

    Forced groups are kept and ignored ones dropped whatever their size; a group below the least area is dropped; one whose
    largest part has at least ``guard`` of the area is preserved as that part.
    """
    sums = members.groupBy("group_id").agg(F.sum("km2").alias("km2"), F.max("km2").alias("largest"), F.count("*").alias("parts"), hashed_id("grp_", F.array_join(F.array_sort(F.collect_list(F.col("component_id").cast("string"))), ",")).alias("unit_id"))
    flags = sums.join(forced.select("group_id", F.lit(True).alias("forced")), "group_id", "left").join(ignored.select("group_id", F.lit(True).alias("ignored")), "group_id", "left")
    kept = F.coalesce("forced", F.lit(False)) | (F.col("km2") >= least_km2)
    decision = F.when(F.coalesce("ignored", F.lit(False)) | ~kept, "DROPPED").when((F.col("parts") > 1) & (F.col("largest") >= guard * F.col("km2")), "LARGEST_PART").otherwise("WHOLE")
    return flags.select("group_id", "unit_id", "parts", "km2", "largest", decision.alias("decision"))


def preservation_summary(units: DataFrame, by: str) -> DataFrame:
    """For each region its groups, preserved ones, area in all, preserved and dropped; the last two add up to the first."""
    kept = F.col("decision") != "DROPPED"
    return units.groupBy(by).agg(F.count("*").alias("groups"), F.count_if(kept).alias("preserved"), F.sum("km2").alias("km2"), F.sum(F.when(kept, F.col("km2")).otherwise(0.0)).alias("preserved_km2"), F.sum(F.when(kept, 0.0).otherwise(F.col("km2"))).alias("dropped_km2"))


def primary_hex(shares: DataFrame, by: str) -> DataFrame:
    """For each component its hex with the most area (to the square millimetre), then the nearest middle, then the smaller hex. Needs area_m2, distance_m, hex_id."""
    w = Window.partitionBy(by).orderBy(F.desc(F.round("area_m2", 6)), "distance_m", "hex_id")
    return shares.withColumn("k", F.row_number().over(w)).where("k = 1").drop("k")


def mercator_ratio(units: DataFrame) -> DataFrame:
    """Projected over ground area of each unit beside one over the squared cosine of its latitude, and how far they are apart."""
    expected = 1 / F.pow(F.cos(F.radians("lat")), 2)
    return units.withColumns({"ratio": F.col("projected_km2") / F.col("ground_km2"), "expected": expected}).withColumn("off", F.abs(F.col("ratio") / F.col("expected") - 1))


def admin0(raw: DataFrame) -> DataFrame:
    """Countries with their id, from the source's number or else from a hash of the shape; sentinels are null."""
    number = cleaned(F.col("source_id")).try_cast("bigint")
    by_shape = F.concat(F.lit("adm0_h"), F.substring(F.sha1(F.col("shape").cast("string")), 1, 12))
    return raw.withColumns({"reference_id": F.coalesce(F.concat(F.lit("adm0_"), number.cast("string")), by_shape), "name": cleaned(F.col("name"))})


def with_parent(children: DataFrame, parents: DataFrame, code: str) -> DataFrame:
    """Children with their parent by a code, and why there is none."""
    found = children.join(parents.select(F.col(code), F.col("reference_id").alias("parent_id")), code, "left")
    reason = F.when(F.col(code).isNull(), "NO_PARENT_CODE").when(F.col("parent_id").isNull(), F.concat(F.lit("UNKNOWN_PARENT_CODE:"), code))
    return found.withColumn("parent_missing_reason", reason)


def nearest_hex(points: DataFrame, hexes: DataFrame, grid: GridSpec, steps: int, limit_m: float) -> DataFrame:
    """Each point (id, x, y) with the nearest hex (q, r) of a set, up to a distance between it and the hex's middle; its own cell comes first.

    Candidates are the cells within ``steps`` of the point's cell. Each cell with points is met once with those around it, as one short list, so no
    point becomes several rows. Nulls if there is none.
    """
    q, r = grid.cell(F.col("x"), F.col("y"))
    at = points.withColumns({"_q": q, "_r": r})
    around = at.select("_q", "_r").distinct().withColumn("c", F.explode(within(F.col("_q"), F.col("_r"), steps))).select("_q", "_r", "c.q", "c.r")
    lists = around.join(hexes.select("q", "r"), ["q", "r"]).groupBy("_q", "_r").agg(F.collect_set(F.struct("q", "r")).alias("_near"))

    def measured(c: Column) -> Column:
        cx, cy = grid.centre(c["q"], c["r"])
        own = (c["q"] == F.col("_q")) & (c["r"] == F.col("_r"))
        return F.struct(F.when(own, 0.0).otherwise(F.hypot(F.col("x") - cx, F.col("y") - cy)).alias("distance_m"), c["q"].alias("q"), c["r"].alias("r"))

    best = F.array_min(F.filter(F.transform("_near", measured), lambda m: m["distance_m"] <= limit_m))
    out = at.join(lists, ["_q", "_r"], "left").withColumn("_b", best)
    return out.select(*points.columns, "_b.q", "_b.r", "_b.distance_m")


def bind_to_land(points: DataFrame, hexes: DataFrame, grid: GridSpec, steps: int, limit_m: float) -> DataFrame:
    """Points on land hexes: the one they are in, else the nearest within a limit, else UNRESOLVED."""
    bound = nearest_hex(points, hexes, grid, steps, limit_m)
    return bound.withColumn("method", F.when(F.col("distance_m").isNull(), "UNRESOLVED").when(F.col("distance_m") == 0, "TERRESTRIAL_HEX").otherwise("NEAREST_TERRESTRIAL"))


def region_of_points(points: DataFrame, region_hexes: DataFrame, grid: GridSpec) -> DataFrame:
    """Each point with the first region (by region_order) whose hexes hold it, else OUT_OF_REGION_COVERAGE."""
    q, r = grid.cell(F.col("x"), F.col("y"))
    met = points.withColumns({"q": q, "r": r}).join(region_hexes, ["q", "r"], "left")
    first = met.groupBy("id").agg(F.min_by("region", "region_order").alias("region"))
    return first.withColumn("region", F.coalesce("region", F.lit("OUT_OF_REGION_COVERAGE")))


def touching(sets: DataFrame) -> DataFrame:
    """Pairs of sets of cells (set_id, q, r; the smaller id first) that share a cell or have neighbouring ones."""
    wide = sets.withColumn("c", F.explode(within(F.col("q"), F.col("r"), 1))).select(F.col("set_id").alias("a"), F.col("c.q").alias("q"), F.col("c.r").alias("r")).distinct()
    return wide.join(sets.select(F.col("set_id").alias("b"), "q", "r"), ["q", "r"]).where("a < b").select("a", "b").distinct()
