"""Small classifications, comparisons and gates over joined results."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.operators.components import components
from hexloom.operators.extents import hull
from hexloom.operators.ranks import ranked, with_percentiles
from hexloom.tables import written


def coverage_class(reference_only: Column, own_only: Column, area: Column, absolute: float, relative: float) -> Column:
    """MATCHED, UNDER (reference only), OVER (own only) or BIDIRECTIONAL, with the larger of an absolute and a relative tolerance."""
    limit = F.greatest(F.lit(absolute), area * relative)
    under, over = reference_only > limit, own_only > limit
    return F.when(under & over, "BIDIRECTIONAL").when(under, "UNDER").when(over, "OVER").otherwise("MATCHED")


def coverage_quality(ratio: Column, full: float = 0.98, partial: float = 0.5) -> Column:
    """NONE, FULL, PARTIAL or LOW by the part of a cell that is covered; null counts as nothing."""
    return F.when(F.coalesce(ratio, F.lit(0.0)) <= 0, "NONE").when(ratio >= full, "FULL").when(ratio >= partial, "PARTIAL").otherwise("LOW")


def coast_change(before: DataFrame, after: DataFrame, threshold: float) -> DataFrame:
    """Cells (hex_id, land_class, land_fraction) of two authorities with the kind of change between them."""
    b = before.select("hex_id", F.col("land_class").alias("old_class"), F.col("land_fraction").alias("old_fraction"))
    a = after.select("hex_id", "land_class", "land_fraction")
    kind = (
        F.when((F.col("old_class") == "land") & (F.col("land_class") == "water"), "LAND_TO_WATER")
        .when((F.col("old_class") == "water") & (F.col("land_class") == "land"), "WATER_TO_LAND")
        .when(F.abs(F.col("land_fraction") - F.col("old_fraction")) > threshold, "FRACTION_SHIFT")
    )
    return b.join(a, "hex_id").withColumn("change", kind).where("change is not null")


def fraction_histogram(cells: DataFrame, by: str, value: str, edges: list[float]) -> DataFrame:
    """Counts of values in fixed buckets (closed below, open above, the last one closed) for each group and for ALL, by a rollup."""
    bucket = F.least(F.lit(len(edges) - 2), sum((F.when(F.col(value) >= e, 1).otherwise(0) for e in edges[1:]), F.lit(0)))
    each = cells.where(F.col(value).between(edges[0], edges[-1])).select(F.col(by).cast("string").alias("landmass"), bucket.alias("bucket"))
    rolled = each.cube("landmass", "bucket").agg(F.count("*").alias("hexes"), F.grouping("landmass").alias("all"), F.grouping("bucket").alias("every"))
    return rolled.where("every = 0").select(F.when(F.col("all") == 1, "ALL").otherwise(F.col("landmass")).alias("landmass"), "bucket", "hexes")


def gap_summary(cells: DataFrame, by: str) -> DataFrame:
    """For each landmass its cells with land, authorised and controlled ones, the withheld ones and their share, and the median and largest fraction withheld."""
    withheld = F.col("authorised") & ~F.col("controlled")
    land = cells.where("land_fraction > 0")
    sums = land.groupBy(by).agg(
        F.count("*").alias("hexes"), F.count_if("authorised").alias("authorised"), F.count_if("controlled").alias("controlled"), F.count_if(withheld).alias("withheld"),
        F.try_divide(F.count_if(withheld), F.count_if("authorised")).alias("withheld_share"), F.max(F.when(withheld, F.col("land_fraction"))).alias("largest_withheld"),
    )
    kept = [c for c in sums.columns if c != "largest_withheld"]
    return with_percentiles(sums, land.where(withheld), by, "land_fraction", {"median_withheld": 0.5}).select(*kept, "median_withheld", "largest_withheld")


def conservation(parts: DataFrame, totals: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """For each key the sum of parts against its total, the difference, and whether it is within a tolerance; keys of either side are kept."""
    summed = parts.groupBy(key).agg(F.sum(value).alias("parts"))
    out = summed.join(totals.select(key, F.col(value).alias("total")), key, "full")
    difference = F.coalesce("parts", F.lit(0.0)) - F.coalesce("total", F.lit(0.0))
    return out.withColumn("difference", difference).withColumn("conserved", F.abs("difference") <= tolerance)


def distortion(shares: DataFrame, won: DataFrame) -> DataFrame:
    """For each holder the area of its source that it lost (omission), that of others that it won (commission) and both together.

    ``shares`` has hex_id, holder, km2; ``won`` has hex_id, holder: who holds the cell.
    """
    each = shares.join(won.withColumnRenamed("holder", "winner"), "hex_id", "left")
    lost = each.groupBy("holder").agg(F.sum("km2").alias("source_km2"), F.sum(F.when(F.col("winner").eqNullSafe(F.col("holder")), 0.0).otherwise(F.col("km2"))).alias("omission_km2"))
    gained = each.where((F.col("winner") != F.col("holder"))).groupBy(F.col("winner").alias("holder")).agg(F.sum("km2").alias("commission_km2"))
    out = lost.join(gained, "holder", "full").na.fill(0.0)
    return out.withColumn("symmetric_km2", F.col("omission_km2") + F.col("commission_km2"))


def representation_status(hexes: Column, omission_share: Column, components: Column) -> Column:
    """How a holder fares on the grid: none of its cells left, coarse borders, an enclave at risk, or well."""
    return F.when(hexes == 0, "ZERO_HEX_LOSS").when(components > 1, "ENCLAVE_AT_RISK").when(omission_share > 0.25, "BORDER_COARSE").otherwise("GOOD")


def top_and_above(df: DataFrame, value: str, key: str, n: int, threshold: float) -> DataFrame:
    """The n rows with the largest values and all above a threshold, ranked over range partitions. Keys are unique."""
    top = df.orderBy(F.desc(value), key).limit(n).select(key)
    chosen = df.join(top, key, "left_semi").unionByName(df.where(F.col(value) > threshold)).dropDuplicates([key])
    return ranked(chosen, F.desc(value), F.col(key))


def best_with_margin(df: DataFrame, by: str, key: str, value: str) -> DataFrame:
    """For each group the key with the smallest value and how much smaller it is than the next."""
    w = Window.partitionBy(by).orderBy(value, key)
    return df.withColumns({"k": F.row_number().over(w), "margin": F.lead(value).over(w) - F.col(value)}).where("k = 1").drop("k")


def expectations(actual: DataFrame, expected: DataFrame, key: str = "metric") -> DataFrame:
    """Expected values of metrics beside actual ones, and whether each is met; a metric that is missing is not met."""
    return expected.withColumnRenamed("value", "expected").join(actual.withColumnRenamed("value", "actual"), key, "left").withColumn("met", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


def components_of_edges(edges: DataFrame, name: str = "components") -> DataFrame:
    """For every node of an edge table (a, b) the smallest node of its component: node, component. Edges with a null end count for nothing."""
    given = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u is not null and v is not null").distinct(), name)
    found = components(given, name)
    nodes = given.select(F.col("u").alias("node")).union(given.select("v")).distinct()
    return nodes.join(found, F.col("node") == F.col("u"), "left").select("node", F.coalesce("v", "node").alias("component"))


#: Ends of edges that a tile of clusters has at most, and how often the widest tile is halved.
TILE_ENDS, HALVINGS = 400_000, 20


def _judged_in_tile(edges: pd.DataFrame, clusters: pd.DataFrame) -> pd.DataFrame:
    """What a tile can say of its edges: clusters that join another (kind 0: c into other), pairs refused (1), and the new corners of those that grew (2).

    Edges come in order. One that leaves the tile (q is -1) holds its cluster back, and so does an edge to a cluster that is held back; whatever else
    comes is the first edge left of both its clusters.
    """
    row = {c: k for k, c in enumerate(clusters["c"])}
    into = dict.fromkeys(row)
    shape = {c: np.array([x, y], float) for c, x, y in zip(clusters["c"], clusters["xs"], clusters["ys"])}
    caps = clusters["cap"].to_numpy()
    held: set[int] = set()
    refused: dict[int, set[int]] = {}
    grown: set[int] = set()

    def root(c: int) -> int:
        top = c
        while into[top] is not None:
            top = into[top]
        while c != top:
            into[c], c = top, into[c]
        return top

    edges = edges.sort_values(["d", "a", "b"])
    for p, q in zip(edges["p"].tolist(), edges["q"].tolist()):
        p = root(p)
        if q < 0:
            held.add(p)
            continue
        q = root(q)
        if p == q or q in refused.get(p, ()):
            continue
        if p in held or q in held:
            held.update((p, q))
            continue
        one, two = shape[p], shape[q]
        if np.any(np.hypot(one[0][:, None] - two[0], one[1][:, None] - two[1]) > caps[row[p]]):
            refused.setdefault(p, set()).add(q)
            refused.setdefault(q, set()).add(p)
            continue
        p, q = min(p, q), max(p, q)
        into[q] = p
        shape[p] = np.stack(hull(*np.concatenate([one, two], axis=1)))
        grown.add(p)
        for c in refused.pop(q, ()):
            refused[c].discard(q)
            refused[c].add(p)
            refused.setdefault(p, set()).add(c)
    out = [(0, c, root(c), None, None) for c in row if into[c] is not None]
    out += [(1, p, q, None, None) for p, others in refused.items() for q in others if p < q]
    out += [(2, c, c, *shape[c].tolist()) for c in grown if into[c] is None]
    return pd.DataFrame(out, columns=["kind", "c", "other", "xs", "ys"])


def _tiles(clusters: DataFrame, left: DataFrame, box: tuple[float, float, float], turn: int, most: int) -> DataFrame:
    """The tile (k, tx, ty) of each cluster that has an edge: the widest that has no more than ``most`` ends of edges.

    Tiles are halved from four times the whole extent down. With each turn all borders move a third of a tile, so a pair is inside one tile of its size in one of three turns.
    """
    x0, y0, width = box
    ends = left.select(F.explode(F.array("p", "q")).alias("c")).groupBy("c").agg(F.count("*").alias("ends"))
    middle = lambda c, low: F.coalesce((F.array_min(c) + F.array_max(c)) / 2 - low, F.lit(0.0))
    each = clusters.join(ends, "c").select("c", "ends", middle("xs", x0).alias("x"), middle("ys", y0).alias("y"), F.explode(F.sequence(F.lit(0), F.lit(HALVINGS))).alias("k"))
    at = lambda c: F.floor(F.col(c) / (F.lit(4.0 * width) / F.pow(F.lit(2.0), F.col("k"))) + F.lit(turn % 3 / 3))
    each = each.select("c", "ends", "k", at("x").alias("tx"), at("y").alias("ty"))
    load = F.sum("ends").over(Window.partitionBy("k", "tx", "ty"))
    # What shares a place with too many ends is a tile by itself.
    fits = F.when(F.col("load") <= most, F.struct("k", "tx", "ty"))
    tile = each.withColumn("load", load).groupBy("c").agg(F.coalesce(F.min(fits), F.struct(F.lit(-1).alias("k"), F.col("c").alias("tx"), F.lit(0).cast("long").alias("ty"))).alias("tile"))
    return written(tile.select("c", "tile"), "clusters-tiles")


def capped_clusters(nodes: DataFrame, edges: DataFrame, limit_m: float, diameter_m: float | Callable[[Column], Column]) -> DataFrame:
    """Single-link clusters in ascending order of distance whose diameter stays below a cap: id, cluster (the smallest id).

    ``nodes`` has id, x, y; ``edges`` a, b, distance_m; of equal distances the smaller a, then b, comes first. The result is that
    of joining clusters edge by edge in that order, leaving out an edge whose clusters would be wider than the cap together.
    The cap is a number, or a function from a cluster's id to its cap, which is the same for all that edges connect.

    An edge that is the first one left of both its clusters can be judged before all others, as no earlier one touches either. So in
    each round tiles of the plane, each with a bounded number of edges, judge one after the other all such edges inside them, those that come up by that too.
    A pair that is refused goes with all edges between the two, which can only grow. What lies over a border waits for a round whose tiles lie elsewhere.
    A cluster is kept as the corners of its hull, as the widest pair is among them. Rounds are written tables.
    """
    spark = nodes.sparkSession
    ids = written(ranked(nodes.select("id").distinct(), "id", name="n").select("id", F.col("n").cast("long").alias("n")), "clusters-ids")
    cap = diameter_m(F.col("id")) if callable(diameter_m) else F.lit(float(diameter_m))
    own = written(nodes.join(ids.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id"))).select("id", "n", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), cap.cast("double").alias("cap")), "clusters-nodes")
    number = lambda c, n: ids.select(F.col("id").alias(c), F.col("n").alias(n))
    left = edges.where((F.col("distance_m") <= limit_m) & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("distance_m").cast("double").alias("d"))
    left = left.join(number("a", "p"), "a").join(number("b", "q"), "b").select("p", "q", F.struct("d", F.col("p").alias("a"), F.col("q").alias("b")).alias("o"))
    left = written(left.groupBy("p", "q").agg(F.min("o").alias("o")), "clusters-edges")
    clusters = written(own.groupBy(F.col("n").alias("c")).agg(F.collect_list("x").alias("xs"), F.collect_list("y").alias("ys"), F.max("cap").alias("cap")), "clusters")
    low = own.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    box = (low[0] or 0.0, low[2] or 0.0, max((low[1] or 0.0) - (low[0] or 0.0), (low[3] or 0.0) - (low[2] or 0.0), 1.0))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tile = ["k", "tx", "ty"]
    joins: DataFrame | None = None
    turn, idle, most = 0, 0, TILE_ENDS
    while not left.isEmpty():
        tiles = _tiles(clusters, left, box, turn, most)
        at = lambda c: tiles.select(F.col("c").alias(c), F.col("tile").alias(f"t{c}"))  # noqa: B023, E731
        tied = left.join(at("p"), "p").join(at("q"), "q")
        inside = tied.where("tp = tq").select("tp.*", "p", "q", "o.*")
        over = tied.where("tp <> tq").select(F.explode(F.array(F.struct(F.col("tp").alias("t"), F.col("p")), F.struct(F.col("tq").alias("t"), F.col("q").alias("p")))).alias("e"), "o")
        over = over.groupBy("e").agg(F.min("o").alias("o")).select("e.t.*", "e.p", F.lit(-1).cast("long").alias("q"), "o.*")
        shapes = clusters.join(tiles, "c").select("tile.*", "c", "xs", "ys", "cap")
        given = inside.unionByName(over).repartition(parts, *tile).groupBy(*tile)
        found = given.cogroup(shapes.repartition(parts, *tile).groupBy(*tile)).applyInPandas(_judged_in_tile, "kind int, c long, other long, xs array<double>, ys array<double>")
        found = written(found, "clusters-judged")
        turn += 1
        if found.isEmpty():  # three times: no tile held the next edge and all that comes before it
            idle, most = (idle + 1, most) if idle < 2 else (0, 4 * most)
            continue
        idle = 0
        moved = found.where("kind = 0").select("c", F.col("other").alias("into"))
        refused = found.where("kind = 1").select(F.col("c").alias("p"), F.col("other").alias("q"))
        joins = moved if joins is None else joins.unionByName(moved)
        for c in ("p", "q"):
            left = left.join(moved.withColumnRenamed("c", c), c, "left").withColumn(c, F.coalesce("into", c)).drop("into")
        left = left.where("p <> q").select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q"), "o").join(refused, ["p", "q"], "left_anti")
        left = written(left.groupBy("p", "q").agg(F.min("o").alias("o")), "clusters-edges")
        new = found.where("kind = 2").select("c", F.col("xs").alias("nx"), F.col("ys").alias("ny"))
        clusters = clusters.join(moved, "c", "left_anti").join(new, "c", "left").select("c", F.coalesce("nx", "xs").alias("xs"), F.coalesce("ny", "ys").alias("ys"), "cap")
        clusters = written(clusters, "clusters")
    if joins is None:
        return own.select("id", F.col("id").alias("cluster"))
    roots = components(joins.select(F.col("c").alias("u"), F.col("into").alias("v")), "clusters-roots")
    whole = own.join(roots, own["n"] == roots["u"], "left").select(own["id"], F.coalesce("v", own["n"]).alias("root"))
    return whole.join(ids.select(F.col("id").alias("cluster"), F.col("n").alias("root")), "root").select("id", "cluster")
