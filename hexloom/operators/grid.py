"""Generating hexes, chunks and the graph of hex edges."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec


def hexes_covering(spark: SparkSession, grid: GridSpec, min_x: float, min_y: float, max_x: float, max_y: float) -> DataFrame:
    """All cells (q, r) whose middle lies in the box widened by one circumradius. Rows are made where they are used."""
    pad, f, s = grid.side, grid.flat_to_flat, grid.side
    lo, hi = (min_x - pad, min_y - pad), (max_x + pad, max_y + pad)
    if lo[0] > hi[0] or lo[1] > hi[1]:
        return spark.createDataFrame([], "q bigint, r bigint")
    pointy = grid.orientation == "pointy"
    # The outer axis runs over rows of constant height (pointy) or width (flat), the inner one along a row.
    outer, inner = (1, 0) if pointy else (0, 1)
    origin = (grid.origin_x, grid.origin_y)
    first = math.floor((lo[outer] - origin[outer]) / (1.5 * s))
    last = math.ceil((hi[outer] - origin[outer]) / (1.5 * s))
    rows = spark.range(first, last + 1).withColumnRenamed("id", "a")
    half = F.col("a") / 2.0
    start = F.floor((lo[inner] - origin[inner]) / f - half)
    stop = F.ceil((hi[inner] - origin[inner]) / f - half)
    cells = rows.select("a", F.explode(F.sequence(start, stop)).alias("b"))
    cells = cells.select(*([F.col("b").alias("q"), F.col("a").alias("r")] if pointy else [F.col("a").alias("q"), F.col("b").alias("r")]))
    x, y = grid.centre(F.col("q"), F.col("r"))
    return cells.where(x.between(lo[0], hi[0]) & y.between(lo[1], hi[1]))


def chunk_grid(spark: SparkSession, west: float, south: float, east: float, north: float, step: float, prefix: str = "euc") -> DataFrame:
    """An extent of degrees as chunks of ``step`` degrees: chunk_id, ix, iy, its box, and whether it is in the last column or row."""
    nx, ny = math.ceil((east - west) / step - 1e-9), math.ceil((north - south) / step - 1e-9)
    cells = spark.range(nx * ny).select((F.col("id") % nx).cast("int").alias("ix"), F.floor(F.col("id") / nx).cast("int").alias("iy"))
    return cells.select(
        F.format_string(f"{prefix}_%02d_%02d", "ix", "iy").alias("chunk_id"), "ix", "iy",
        (west + F.col("ix") * step).alias("min_lon"), (south + F.col("iy") * step).alias("min_lat"),
        F.least(F.lit(float(east)), west + (F.col("ix") + 1) * step).alias("max_lon"), F.least(F.lit(float(north)), south + (F.col("iy") + 1) * step).alias("max_lat"),
        (F.col("ix") == nx - 1).alias("last_column"), (F.col("iy") == ny - 1).alias("last_row"),
    )


def in_chunk(lon: Column, lat: Column, west: float, south: float, step: float, nx: int, ny: int) -> tuple[Column, Column]:
    """The one chunk (ix, iy) of a place: boxes are open at their upper ends but for the extent's own; null outside."""
    ix, iy = F.floor((lon - west) / step), F.floor((lat - south) / step)
    ix = F.when(lon == west + nx * step, nx - 1).otherwise(ix)
    iy = F.when(lat == south + ny * step, ny - 1).otherwise(iy)
    inside = ix.between(0, nx - 1) & iy.between(0, ny - 1)
    return F.when(inside, ix).cast("int"), F.when(inside, iy).cast("int")


def hexes_of_boxes(boxes: DataFrame, grid: GridSpec) -> DataFrame:
    """The cells (q, r) whose middle lies in each box (min_x, min_y, max_x, max_y and whatever else it has), its borders included. Null boxes have none."""
    pointy = grid.orientation == "pointy"
    axes = ("x", grid.origin_x), ("y", grid.origin_y)
    (inner, inner_at), (outer, outer_at) = axes if pointy else axes[::-1]
    step, wide = 1.5 * grid.side, grid.flat_to_flat
    low, high = F.ceil((F.col(f"min_{outer}") - outer_at) / step - 1e-9), F.floor((F.col(f"max_{outer}") - outer_at) / step + 1e-9)
    rows = boxes.where(low <= high).withColumn("a", F.explode(F.sequence(low, high)))
    half = F.col("a") / 2.0
    low, high = F.ceil((F.col(f"min_{inner}") - inner_at) / wide - half - 1e-9), F.floor((F.col(f"max_{inner}") - inner_at) / wide - half + 1e-9)
    cells = rows.where(low <= high).withColumn("b", F.explode(F.sequence(low, high)))
    return cells.withColumns({"q": F.col("b" if pointy else "a"), "r": F.col("a" if pointy else "b")}).drop("a", "b")


def chunk_boxes(spark: SparkSession, box: tuple[float, float, float, float], nx: int, ny: int) -> DataFrame:
    """A projected box (min_x, min_y, max_x, max_y) cut into chunks: chunk_id, its box, and whether it is in the last column or row."""
    wide, high = (box[2] - box[0]) / nx, (box[3] - box[1]) / ny
    cells = spark.range(nx * ny).select((F.col("id") % nx).alias("ix"), F.floor(F.col("id") / nx).alias("iy"))
    return cells.select(
        F.format_string("c_%03d_%03d", "ix", "iy").alias("chunk_id"), (box[0] + F.col("ix") * wide).alias("min_x"), (box[1] + F.col("iy") * high).alias("min_y"),
        F.when(F.col("ix") == nx - 1, box[2]).otherwise(box[0] + (F.col("ix") + 1) * wide).alias("max_x"), F.when(F.col("iy") == ny - 1, box[3]).otherwise(box[1] + (F.col("iy") + 1) * high).alias("max_y"),
        (F.col("ix") == nx - 1).alias("last_column"), (F.col("iy") == ny - 1).alias("last_row"),
    )


def hexes_of_chunks(chunks: DataFrame, grid: GridSpec) -> DataFrame:
    """The cells of each chunk by their middle: boxes are open at their upper ends but for those of the last column and row (chunk_id, q, r)."""
    cells = hexes_of_boxes(chunks, grid)
    x, y = grid.centre(F.col("q"), F.col("r"))
    return cells.where((F.col("last_column") | (x < F.col("max_x"))) & (F.col("last_row") | (y < F.col("max_y")))).select("chunk_id", "q", "r")


def seam_faults(whole: DataFrame, chunked: DataFrame) -> DataFrame:
    """One row: cells of the whole, those that no chunk has, those that several have, and those of chunks alone."""
    both = whole.select("q", "r", F.lit(1).alias("w")).join(chunked.groupBy("q", "r").agg(F.count("*").alias("n")), ["q", "r"], "full")
    return both.agg(
        F.count("w").alias("hexes"), F.count_if(F.col("n").isNull()).alias("missing"), F.count_if(F.col("n") > 1).alias("doubled"), F.count_if(F.col("w").isNull()).alias("strays"),
    )


def without_dateline(boxes: DataFrame) -> DataFrame:
    """Boxes of degrees (west, south, east, north) that cross the date line (west above east) as two boxes, one on each side."""
    crosses = F.col("west") > F.col("east")
    sides = F.when(crosses, F.array(F.struct(F.col("west").alias("a"), F.lit(180.0).alias("b")), F.struct(F.lit(-180.0).alias("a"), F.col("east").alias("b")))).otherwise(F.array(F.struct(F.col("west").alias("a"), F.col("east").alias("b"))))
    return boxes.withColumn("side", F.explode(sides)).withColumns({"west": F.col("side.a"), "east": F.col("side.b")}).drop("side")


def edge_graph(hexes: DataFrame, grid: GridSpec) -> DataFrame:
    """The sides of a set of pointy cells, each once: edge_id, its two nodes in lattice units, hex_a below hex_b (null on the border).

    A corner is named by whole numbers: in units of half a width and half a side a cell's middle is
    (2q + r, 3r) and its corners are (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2), (1, -1) from there.
    """
    if grid.orientation != "pointy":
        raise ValueError("edge graphs are made for pointy grids")
    around = [(1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2)]
    cx, cy = 2 * F.col("q") + F.col("r"), 3 * F.col("r")
    sides = []
    for k in range(6):
        (ax, ay), (bx, by) = around[k], around[(k + 1) % 6]
        a, b = F.struct((cx + ax).alias("x"), (cy + ay).alias("y")), F.struct((cx + bx).alias("x"), (cy + by).alias("y"))
        sides.append(F.struct(F.least(a, b).alias("n1"), F.greatest(a, b).alias("n2")))
    each = hexes.select("q", "r", F.explode(F.array(*sides)).alias("side"), grid.hex_id(F.col("q"), F.col("r")).alias("hex"))
    edges = each.groupBy("side").agg(F.min("hex").alias("hex_a"), F.when(F.count("*") > 1, F.max("hex")).alias("hex_b"))
    return edges.select(
        F.concat(F.lit("e_"), "hex_a", F.lit("_"), F.coalesce("hex_b", F.lit("OUT"))).alias("edge_id"),
        "side.n1", "side.n2", "hex_a", "hex_b",
    )


def node_xy(grid: GridSpec, node: Column) -> tuple[Column, Column]:
    """Projected place of a node of the edge graph."""
    return grid.origin_x + node["x"] * (grid.flat_to_flat / 2), grid.origin_y + node["y"] * (grid.side / 2)


def edge_measures(edges: DataFrame, grid: GridSpec) -> DataFrame:
    """Edges with their midpoint, length and direction in degrees (0 to 360, from node 1 to node 2)."""
    (x1, y1), (x2, y2) = node_xy(grid, F.col("n1")), node_xy(grid, F.col("n2"))
    return edges.select(
        "*", ((x1 + x2) / 2).alias("mid_x"), ((y1 + y2) / 2).alias("mid_y"), F.hypot(x2 - x1, y2 - y1).alias("length_m"),
        F.pmod(F.degrees(F.atan2(y2 - y1, x2 - x1)), F.lit(360.0)).alias("direction_deg"),
    )


def generated_coastline(hexes: DataFrame, is_land: Column, grid: GridSpec) -> DataFrame:
    """The edges between a land cell and a cell of the set that is none; the set's own border is no coast."""
    flags = hexes.select(grid.hex_id(F.col("q"), F.col("r")).alias("hex"), is_land.alias("land"))
    edges = edge_graph(hexes, grid).where(F.col("hex_b").isNotNull())
    a, b = flags.select(F.col("hex").alias("hex_a"), F.col("land").alias("land_a")), flags.select(F.col("hex").alias("hex_b"), F.col("land").alias("land_b"))
    return edges.join(a, "hex_a").join(b, "hex_b").where(F.col("land_a") != F.col("land_b")).drop("land_a", "land_b")
