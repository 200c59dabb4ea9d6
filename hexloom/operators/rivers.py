"""River networks: classes, branches, names, edges and confluences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.ids import joined_ids
from hexloom.operators.ranks import percentiles
from hexloom.tables import written

#: Classes from the smallest to the largest, their least discharge in cubic metres a second, and the width law.
CLASSES = ["MINOR", "MEDIUM", "MAJOR", "GREAT"]
THRESHOLDS = {"MINOR": 10.0, "MEDIUM": 50.0, "MAJOR": 300.0, "GREAT": 8000.0}
WIDTH = (7.2, 0.5)
WATER_HEX = ("GREAT", 2500.0)
WATER_EDGE_PENALTY = 25.0


def river_class(discharge: Column, thresholds: dict[str, float] = THRESHOLDS) -> Column:
    """The largest class whose threshold is reached; null below the smallest."""
    order = sorted(thresholds.items(), key=lambda kv: -kv[1])
    return reduce(lambda w, kv: w.when(discharge >= kv[1], kv[0]), order[1:], F.when(discharge >= order[0][1], order[0][0]))


def class_rank(name: Column) -> Column:
    """The place of a class, -1 for none."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, CLASSES)), name), F.lit(0)).cast("int") - 1


def width(discharge: Column, law: tuple[float, float] = WIDTH) -> Column:
    """Estimated width in metres: a factor times a power of the discharge; negative discharges count as none."""
    return law[0] * F.pow(F.greatest(discharge, F.lit(0.0)), law[1])


def representation(cls: Column, width_m: Column, exaggeration: float = 1.0, least: tuple[str, float] = WATER_HEX) -> Column:
    """Whether a river lies on hex edges or fills hexes."""
    wide = (class_rank(cls) >= CLASSES.index(least[0])) & (width_m * exaggeration >= least[1])
    return F.when(wide, "WATER_HEX_RIVER").otherwise("EDGE_RIVER")


def load_reaches(reaches: DataFrame, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """Reaches from the smallest class on, with their class; the filter reaches the scan."""
    return reaches.where(F.col("discharge") >= min(thresholds.values())).withColumn("river_class", river_class(F.col("discharge"), thresholds))


def roots(nodes: DataFrame, key: str, up: str, name: str = "roots") -> DataFrame:
    """For every node the end of its chain of ``up`` links (null: the node is an end), with the number of links, by pointer jumping.

    A chain of n links takes log2(n) rounds; each is a hash join, and is written. Nodes that run into a
    circle are left out after as many rounds as a chain through all nodes would take.
    """
    at = nodes.select(F.col(key).alias("k"), F.coalesce(up, key).alias("to"), F.when(F.col(up).isNull(), 0).otherwise(1).cast("bigint").alias("links"))
    at = written(at, name)
    rounds, total = 0, max(1, at.count())
    while True:
        there = at.select(F.col("k").alias("to"), F.col("to").alias("next"), F.col("links").alias("more"))
        moved = at.join(there, "to").select("k", F.col("next").alias("to"), (F.col("links") + F.col("more")).alias("links"), (F.col("next") != F.col("to")).alias("moved"))
        moved = written(moved, name)
        at, rounds = moved.drop("moved"), rounds + 1
        if moved.where("moved").isEmpty():
            return at.select(F.col("k").alias(key), F.col("to").alias("root"), "links")
        if 2**rounds > 2 * total:
            ends = nodes.where(F.col(up).isNull()).select(F.col(key).alias("to"))
            return at.join(ends, "to", "left_semi").select(F.col("k").alias(key), F.col("to").alias("root"), "links")


def branches(reaches: DataFrame, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """The network cut into branches: maximal chains whose inner reaches have just one reach above them.

    Needs reach_id, next_down (0: none) and discharge. Returns branch_id (by its first reach), reach_ids from
    the top down, discharge, river_class and width of the last reach, and next_down_reach (0 at a mouth or
    where the network leaves the table).
    """
    known = reaches.select(F.col("reach_id").alias("next_down"), F.lit(True).alias("known"))
    linked = reaches.join(known, "next_down", "left").withColumn("next_down", F.when(F.col("known"), F.col("next_down")).otherwise(0)).drop("known")
    above = linked.where("next_down <> 0").groupBy("next_down").agg(F.count("*").alias("n"), F.min("reach_id").alias("above")).withColumnRenamed("next_down", "reach_id")
    each = written(linked.join(above, "reach_id", "left").withColumn("above", F.when(F.col("n") == 1, F.col("above"))).drop("n"), "reaches")
    heads = roots(each, "reach_id", "above", "branch-heads").withColumnRenamed("root", "head")
    rows = each.join(heads, "reach_id")
    path = F.transform(F.array_sort(F.collect_list(F.struct("links", "reach_id"))), lambda s: s["reach_id"])
    last = F.max(F.struct("links", "discharge", "next_down"))
    out = rows.groupBy("head").agg(path.alias("reach_ids"), last.alias("last"))
    discharge = F.col("last.discharge")
    return out.select(
        F.concat(F.lit("br_"), F.col("head").cast("string")).alias("branch_id"), "reach_ids", discharge.alias("discharge"),
        river_class(discharge, thresholds).alias("river_class"), width(discharge).alias("width_m"), F.col("last.next_down").alias("next_down_reach"),
    )


def receivers(table: DataFrame) -> DataFrame:
    """Each branch that flows into another one, with that branch: confluences."""
    members = table.select(F.explode("reach_ids").alias("next_down_reach"), F.col("branch_id").alias("receiver_id"))
    return table.select("branch_id", "next_down_reach").join(members, "next_down_reach")


def names_downstream(table: DataFrame, seeds: DataFrame) -> DataFrame:
    """Names of branches: a seed's name (branch_id, name) goes down from branch to branch up to the next named one.

    Where two names meet, the one with the fewest branches on its way wins, then the smaller name. In round k every branch sends the best name it has
    to the one 2^k branches below and looks twice as far down from then on, so a name that goes down n branches takes log2(n) rounds; each is
    written. A round in which no branch gets a better name is the last, as whatever goes further must pass there. Seeds of null names name nothing.
    """
    first = seeds.where("name is not null").groupBy("branch_id").agg(F.min(F.struct(F.lit(0).alias("steps"), "name")).alias("best"))
    down = receivers(table).select("branch_id", F.col("receiver_id").alias("to"))
    # A named branch takes no other name, so nothing looks at or through it.
    open_ = down.join(first.select(F.col("branch_id").alias("to")), "to", "left_anti")
    at = written(table.select("branch_id").distinct().join(first, "branch_id", "left").join(open_, "branch_id", "left"), "named")
    step, better = 1, True
    while better:
        came = at.where("to is not null and best is not null").groupBy(F.col("to").alias("branch_id")).agg(F.min(F.struct((F.col("best.steps") + step).alias("steps"), F.col("best.name").alias("name"))).alias("came"))
        below = at.where("to is not null").select(F.col("branch_id").alias("to"), F.col("to").alias("beyond"))
        both = at.join(came, "branch_id", "left").join(below, "to", "left")
        gains = F.col("came").isNotNull() & (F.col("best").isNull() | (F.col("came") < F.col("best")))
        at = written(both.select("branch_id", F.when(gains, F.col("came")).otherwise(F.col("best")).alias("best"), F.col("beyond").alias("to"), gains.alias("gains")), "named")
        step, better = 2 * step, not at.where("gains").isEmpty()
    return table.select("branch_id").join(at.select("branch_id", "best.name", "best.steps"), "branch_id", "left")


def reach_open_water(reaches: DataFrame, water: DataFrame) -> DataFrame:
    """For every reach the last one downstream and whether it is among ``water`` (reach_id)."""
    ends = roots(reaches.withColumn("down", F.when(F.col("next_down") != 0, F.col("next_down"))), "reach_id", "down", "river-ends")
    return ends.join(water.select(F.col("reach_id").alias("root"), F.lit(True).alias("open")), "root", "left").select("reach_id", F.col("root").alias("terminal_reach"), "links", F.coalesce("open", F.lit(False)).alias("reaches_water"))


def edge_rows(membership: DataFrame) -> DataFrame:
    """Rows of rivers on edges with their importance, log10 of the discharge plus one."""
    return membership.withColumn("importance", F.log10(F.greatest(F.col("discharge"), F.lit(0.0)) + 1))


def game_edges(membership: DataFrame) -> DataFrame:
    """One row for each edge: sorted ids of its rivers and branches, the river with the largest discharge, largest discharge and width.

    Of equal discharges the smaller river and branch wins.
    """
    top = F.min(F.struct(F.coalesce(-F.col("discharge"), F.lit(float("inf"))).alias("d"), "river_id", "branch_id"))
    return membership.groupBy("edge_id").agg(
        joined_ids(F.col("river_id").cast("string")).alias("river_ids"), joined_ids(F.col("branch_id").cast("string")).alias("branch_ids"), top.alias("top"),
        F.max("discharge").alias("max_discharge"), F.max("width").alias("crossing_width"), F.countDistinct("river_id").alias("river_count"),
    ).select("edge_id", "river_ids", "branch_ids", F.col("top.river_id").alias("dominant_river_id"), "max_discharge", "crossing_width", "river_count")


def hex_rivers(edges: DataFrame) -> DataFrame:
    """For each hex its river edges: their number, largest class and discharge, and the river of that. Needs hex_a, hex_b, river_class, discharge, river_id."""
    each = edges.select(F.explode(F.array("hex_a", "hex_b")).alias("hex_id"), "river_class", "discharge", "river_id").where("hex_id is not null")
    return each.groupBy("hex_id").agg(
        F.count("*").alias("river_edge_count"), F.max_by("river_class", class_rank(F.col("river_class"))).alias("max_river_class"),
        F.max("discharge").alias("max_discharge"), F.min(F.struct(F.coalesce(-F.col("discharge"), F.lit(float("inf"))).alias("d"), "river_id"))["river_id"].alias("primary_river_id"),
    )


def edge_penalty(edges: DataFrame, water: DataFrame, penalty: float = WATER_EDGE_PENALTY) -> DataFrame:
    """Edges with a factor for their cost: the penalty where both hexes are water (hex_id), else 1."""
    a = water.select(F.col("hex_id").alias("hex_a"), F.lit(True).alias("wa"))
    b = water.select(F.col("hex_id").alias("hex_b"), F.lit(True).alias("wb"))
    both = F.coalesce(F.col("wa") & F.col("wb"), F.lit(False))
    return edges.join(a, "hex_a", "left").join(b, "hex_b", "left").withColumn("factor", F.when(both, penalty).otherwise(1.0)).drop("wa", "wb")


def offset_statistics(audit: DataFrame, limits: list[float], value: str = "distance_m") -> DataFrame:
    """Number, mean, median, 95th percentile and most of the offsets, and how many are above each limit."""
    sums = audit.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"), *[F.count_if(F.col(value) > k).alias(f"above_{k:g}") for k in limits])
    # Both have one row at most; without a value there are no percentiles.
    return sums.join(percentiles(audit, [], value, {"median": 0.5, "p95": 0.95}), F.lit(True), "left").select("n", "mean", "median", "p95", "most", *[f"above_{k:g}" for k in limits])


def quality(length_ratio: Column, p95_m: Column, ratio_warn: float, ratio_fail: float, p95_warn: float, p95_fail: float) -> Column:
    """PASS, WARN or FAIL by the length ratio's distance from one and the offset's 95th percentile; N/A without a ratio."""
    off = F.abs(length_ratio - 1)
    fail, warn = (off > ratio_fail) | (p95_m > p95_fail), (off > ratio_warn) | (p95_m > p95_warn)
    return F.when(length_ratio.isNull(), "N/A").when(fail, "FAIL").when(warn, "WARN").otherwise("PASS")


def turns(vertices: DataFrame, line: str, order: str) -> DataFrame:
    """Each inner vertex of a line with the sign of its turn and whether the turn before had the same sign. Needs x, y."""
    w = Window.partitionBy(line).orderBy(order)
    ax, ay = F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)
    bx, by = F.lead("x").over(w) - F.col("x"), F.lead("y").over(w) - F.col("y")
    out = vertices.withColumn("turn", F.signum(ax * by - ay * bx).cast("int")).where("turn is not null")
    return out.withColumn("same_turn", F.coalesce((F.lag("turn").over(w) == F.col("turn")) & (F.col("turn") != 0), F.lit(False)))


def turn_density(vertices: DataFrame, line: str, order: str) -> DataFrame:
    """For each line its length and its turns of 60 degrees for each 100 km; zero for lines of fewer than three places or no length."""
    w = Window.partitionBy(line).orderBy(order)
    legs = vertices.withColumns({"dx": F.lead("x").over(w) - F.col("x"), "dy": F.lead("y").over(w) - F.col("y")}).where("dx is not null")
    legs = legs.withColumn("angle", F.atan2("dy", "dx"))
    change = F.abs(F.col("angle") - F.lag("angle").over(w))
    legs = legs.withColumn("change", F.least(change, 2 * F.pi() - change))
    out = legs.groupBy(line).agg(F.sum(F.hypot("dx", "dy")).alias("length_m"), F.coalesce(F.degrees(F.sum("change")) / 60, F.lit(0.0)).alias("turns"))
    return out.select(line, "length_m", F.when(F.col("length_m") > 0, F.col("turns") / (F.col("length_m") / 100_000)).otherwise(0.0).alias("turns_per_100km"))


def sampled(vertices: DataFrame, line: str, order: str, every_m: float) -> DataFrame:
    """Places along lines at whole multiples of a distance from the start: line, number, x, y."""
    w = Window.partitionBy(line).orderBy(order)
    legs = vertices.withColumns({"nx": F.lead("x").over(w), "ny": F.lead("y").over(w)}).where("nx is not null")
    legs = legs.withColumn("leg", F.hypot(F.col("nx") - F.col("x"), F.col("ny") - F.col("y")))
    legs = legs.withColumn("s0", F.coalesce(F.sum("leg").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).where("leg > 0")
    first, last = F.ceil(F.col("s0") / every_m), F.ceil((F.col("s0") + F.col("leg")) / every_m) - 1
    each = legs.where(first <= last).withColumn("sample", F.explode(F.sequence(first, last)))
    part = (F.col("sample") * every_m - F.col("s0")) / F.col("leg")
    return each.select(line, "sample", (F.col("x") + (F.col("nx") - F.col("x")) * part).alias("x"), (F.col("y") + (F.col("ny") - F.col("y")) * part).alias("y"))
