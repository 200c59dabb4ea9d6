"""Rivers laid on the edges of the hex grid: corridors, tangents, paths, metrics and mouths.

Lines are tables of vertices: the line's key ``branch``, the order ``k`` and a place x, y. Nodes are
corners of cells in the whole numbers of ``grid.edge_graph``. The grid has no border, so each edge
has two hexes. Branches wait for no more than the branch they flow into: all branches of one depth
of the network are laid at once, and the depths follow one another.

Vertices with a null in any of these columns are left out; a line of fewer than two vertices has no
legs and so no path. Equal costs and distances are settled by the smaller node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import lattice
from hexloom.operators.grid import hexes_of_boxes, node_xy
from hexloom.operators.lattice import SIDES
from hexloom.operators.rivers import WATER_EDGE_PENALTY, edge_penalty, roots, turn_density
from hexloom.tables import written

#: Fixed values of the search, in metres or as weights.
CORRIDOR, SCALE, TANGENT_REACH = 15_000.0, 6_000.0, 400.0
DIRECTION_WEIGHT, SAME_TURN = 1.2, 0.6
JUNCTIONS, MOUTH_LIMIT = 3, 20_000.0
RING = ((1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2))
NODE = "struct<x:bigint,y:bigint>"
FLAT = "branch string, step int, x bigint, y bigint, x1 bigint, y1 bigint, x2 bigint, y2 bigint, cost double"
STEPS = f"branch string, step int, node {NODE}, n1 {NODE}, n2 {NODE}, cost double"


def legs(vertices: DataFrame) -> DataFrame:
    """The legs of lines: branch, k, ends (ax, ay) and (bx, by), their length and the way to their start, s0."""
    w = Window.partitionBy("branch").orderBy("k")
    each = vertices.select(F.col("branch").cast("string").alias("branch"), "k", F.col("x").alias("ax"), F.col("y").alias("ay")).dropna()
    each = each.withColumns({"bx": F.lead("ax").over(w), "by": F.lead("ay").over(w)}).where("bx is not null")
    each = each.withColumn("leg", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))
    return each.withColumn("s0", F.sum("leg").over(w) - F.col("leg"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by keys onto all shuffle partitions.

    What follows makes hundreds of rows of each, or searches a graph, so the few bytes here must not be folded into one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def to_leg(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> tuple[Column, Column]:
    """The distance of a place from a leg, and the part of the leg (0 to 1) where it is nearest."""
    dx, dy = bx - ax, by - ay
    long = dx * dx + dy * dy
    t = F.when(long > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - ax) * dx + (py - ay) * dy) / long))).otherwise(0.0)
    return F.hypot(px - ax - t * dx, py - ay - t * dy), t


def crossing(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column], d: tuple[Column, Column]) -> Column:
    """Whether two legs, a to b and c to d, cross inside both."""

    def side(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    return (side(a, b, c) * side(a, b, d) < 0) & (side(c, d, a) * side(c, d, b) < 0)


def between(a: tuple[Column, Column], b: tuple[Column, Column], c: tuple[Column, Column], d: tuple[Column, Column]) -> Column:
    """The distance of two legs, a to b and c to d; zero where they cross."""
    return F.when(crossing(a, b, c, d), 0.0).otherwise(F.least(to_leg(*a, *c, *d)[0], to_leg(*b, *c, *d)[0], to_leg(*c, *a, *b)[0], to_leg(*d, *a, *b)[0]))


def cells_near(vertices: DataFrame, grid: GridSpec, reach: Column) -> DataFrame:
    """Pieces of lines, none longer than three sides, each with the cells (q, r) whose middle is within ``reach`` and a side of it, how far it is (``away``), and the cell where the piece begins.

    Pieces keep the boxes small: a long slanting leg would else meet cells by the square of its length. ``reach`` may use columns of ``vertices``
    that are the same along a line, named ``reach`` here.
    """
    wide = vertices.groupBy(F.col("branch").cast("string").alias("branch")).agg(F.max(reach).alias("reach"))
    each = legs(vertices).join(wide, "branch").withColumn("n", F.greatest(F.lit(1), F.ceil(F.col("leg") / (3 * grid.side))).cast("int"))
    each = spread(each, "branch", "k").withColumn("i", F.explode(F.sequence(F.lit(1), "n")))
    dx, dy = (F.col("bx") - F.col("ax")) / F.col("n"), (F.col("by") - F.col("ay")) / F.col("n")
    ends = {"px": F.col("ax") + dx * (F.col("i") - 1), "py": F.col("ay") + dy * (F.col("i") - 1), "ox": F.col("ax") + dx * F.col("i"), "oy": F.col("ay") + dy * F.col("i")}
    each = each.withColumns(ends).withColumn("s", F.col("s0") + F.col("leg") / F.col("n") * (F.col("i") - 1)).withColumn("piece", F.col("leg") / F.col("n"))
    pad = F.col("reach") + grid.side
    box = {"min_x": F.least("px", "ox") - pad, "max_x": F.greatest("px", "ox") + pad, "min_y": F.least("py", "oy") - pad, "max_y": F.greatest("py", "oy") + pad}
    q, r = grid.cell(F.col("px"), F.col("py"))
    cells = hexes_of_boxes(each.select("branch", "reach", "px", "py", "ox", "oy", "s", "piece", q.alias("start_q"), r.alias("start_r")).withColumns(box), grid)
    middle = grid.centre(F.col("q"), F.col("r"))
    away = to_leg(*middle, F.col("px"), F.col("py"), F.col("ox"), F.col("oy"))[0]
    return cells.withColumn("away", away).where(F.col("away") <= pad + 1e-6)


def places(grid: GridSpec, a: Column, b: Column) -> list[Column]:
    """The places of two nodes, as ux, uy, vx and vy."""
    return [c.alias(n) for c, n in zip((*node_xy(grid, a), *node_xy(grid, b)), ("ux", "uy", "vx", "vy"))]


def corridor(vertices: DataFrame, grid: GridSpec, reach: float = CORRIDOR) -> DataFrame:
    """The edges within ``reach`` of each line: branch, nodes n1 and n2, hex_a, hex_b, the midpoint, its distance from the line, and how far along (s)."""
    if grid.orientation != "pointy":
        raise ValueError("edges are made for pointy grids")
    cx, cy = 2 * F.col("q") + F.col("r"), 3 * F.col("r")
    # Sides as whole numbers about the middle, the smaller node first; the nodes follow from the cell and the side's number.
    ordered = [(*sorted(ends), beyond) for *ends, beyond in SIDES]
    number = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("k", "u1", "v1", "u2", "v2"), (k, *one, *two))]) for k, (one, two, _) in enumerate(ordered)])
    each = cells_near(vertices, grid, F.lit(float(reach))).withColumn("side", F.explode(number)).select("*", "side.*")
    node = lambda u, v: F.struct((cx + u).alias("x"), (cy + v).alias("y"))
    each = each.select("branch", "q", "r", "k", "px", "py", "ox", "oy", "s", "piece", *places(grid, node(F.col("u1"), F.col("v1")), node(F.col("u2"), F.col("v2"))))
    # The middle of a side is at most half a side further off than its nearest place, so most are in or out by it.
    u, v, p, o = [(F.col(f"{c}x"), F.col(f"{c}y")) for c in "uvpo"]
    away, part = to_leg((u[0] + v[0]) / 2, (u[1] + v[1]) / 2, *p, *o)
    each = each.withColumn("mid", F.struct(away.alias("d"), (F.col("s") + part * F.col("piece")).alias("s"))).where(F.col("mid.d") <= reach + grid.side / 2 + 1e-6)
    each = each.withColumn("sure", (F.col("mid.d") <= reach) | crossing(u, v, p, o))
    couple = lambda *places_: F.struct(*[c.alias(f"c{i}") for i, c in enumerate(c for place in places_ for c in place)])
    couples = F.array(couple(u, p, o), couple(v, p, o), couple(p, u, v), couple(o, u, v))
    none = F.array(F.struct(*[F.lit(0.0).alias(f"c{i}") for i in range(6)]))
    each = each.select("branch", "q", "r", "k", "mid", "sure", F.explode(F.when(F.col("sure"), none).otherwise(couples)).alias("c")).select("branch", "q", "r", "k", "mid", "sure", "c.*")
    near = F.col("sure") | (to_leg(*[F.col(f"c{i}") for i in range(6)])[0] <= reach)
    best = each.groupBy("branch", "q", "r", "k").agg(F.max(near).alias("near"), F.min("mid").alias("mid")).where("near")
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("k").cast("int") + 1)
    n1, n2 = (node(*(of([ends[i][c] for ends in ordered]).cast("long") for c in (0, 1))) for i in (0, 1))
    best = best.select("branch", n1.alias("n1"), n2.alias("n2"), "q", "r", *[(F.col(c) + of([ends[2][i] for ends in ordered])).alias(f"{c}2") for i, c in enumerate("qr")], "mid")
    one, two = grid.hex_id(F.col("q"), F.col("r")), grid.hex_id(F.col("q2"), F.col("r2"))
    (ux, uy), (vx, vy) = node_xy(grid, F.col("n1")), node_xy(grid, F.col("n2"))
    return best.select(
        "branch", "n1", "n2", F.least(one, two).alias("hex_a"), F.greatest(one, two).alias("hex_b"),
        ((ux + vx) / 2).alias("mid_x"), ((uy + vy) / 2).alias("mid_y"), F.col("mid.d").alias("distance_m"), F.col("mid.s").alias("s"),
    )


def tangents(vertices: DataFrame, places: DataFrame, key: list[str], reach: float = TANGENT_REACH) -> DataFrame:
    """The direction (tx, ty) of a line about a way along it: from ``reach`` before to ``reach`` after, both within the line.

    ``places`` has branch, s and the ``key`` that tells the places of a line apart. Legs and places of a
    line are sorted together, and each place takes the last leg that has begun: one shuffle, no pairs.
    """
    parts = legs(vertices)
    total = parts.groupBy("branch").agg(F.sum("leg").alias("total"))
    here = F.explode(F.array(*[F.struct(F.lit(e).alias("end"), F.least(F.col("total"), F.greatest(F.lit(0.0), F.col("s") + e * reach)).alias("at")) for e in (-1, 1)]))
    asked = places.join(total, "branch").select("branch", *key, here.alias("w")).select("branch", F.struct(*key).alias("key"), "w.*")
    begun = parts.select("branch", F.col("s0").alias("at"), F.struct("ax", "ay", "bx", "by", "leg", "s0").alias("on"))
    both = begun.unionByName(asked, allowMissingColumns=True)
    w = Window.partitionBy("branch").orderBy("at", F.col("key").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("on", F.last("on", True).over(w)).where("key is not null")
    t = F.when(F.col("on.leg") > 0, (F.col("at") - F.col("on.s0")) / F.col("on.leg")).otherwise(0.0)
    spot = {a: F.col(f"on.a{a}") + (F.col(f"on.b{a}") - F.col(f"on.a{a}")) * t for a in "xy"}
    out = found.withColumns({"px": F.col("end") * spot["x"], "py": F.col("end") * spot["y"]}).groupBy("branch", "key").agg(F.sum("px").alias("tx"), F.sum("py").alias("ty"))
    return out.select("branch", "key.*", "tx", "ty")


def against(grid: GridSpec, start: Column, stop: Column) -> Column:
    """The cosine between an edge from one node to another and the tangent (tx, ty); zero where there is no tangent."""
    (x1, y1), (x2, y2) = node_xy(grid, start), node_xy(grid, stop)
    long = grid.side * F.hypot("tx", "ty")
    return F.when(long > 0, ((x2 - x1) * F.col("tx") + (y2 - y1) * F.col("ty")) / long).otherwise(0.0)


def costs(edges: DataFrame, grid: GridSpec, water: DataFrame, scale: float = SCALE, direction: float = DIRECTION_WEIGHT) -> DataFrame:
    """Edges of corridors with the cost of each direction, ``ahead`` (n1 to n2) and ``back``.

    An edge costs its length, more with its distance from the line, the penalty between two water hexes
    (``water``: hex_id), and more the less it runs along the tangent (tx, ty).
    """
    along = against(grid, F.col("n1"), F.col("n2"))
    base = grid.side * (1 + F.pow(F.col("distance_m") / scale, 2)) * F.col("factor")
    turn = grid.side * direction / 2
    return edge_penalty(edges, water).withColumns({"ahead": base + turn * (1 - along), "back": base + turn * (1 + along)}).drop("factor")


def nearest_nodes(nodes: DataFrame, grid: GridSpec, n: int = 1) -> DataFrame:
    """For each branch the ``n`` of its nodes nearest to (to_x, to_y): branch, node, rank from 1, distance_m."""
    x, y = node_xy(grid, F.col("node"))
    each = nodes.select("branch", "node", F.hypot(x - F.col("to_x"), y - F.col("to_y")).alias("distance_m"))
    rank = F.row_number().over(Window.partitionBy("branch").orderBy("distance_m", "node"))
    return each.withColumn("rank", rank).where(F.col("rank") <= n)


def search(same_turn: float):
    """A function for ``applyInPandas``: the cheapest path of one branch through its corridor, as rows of its nodes in order.

    The group is the corridor of one branch: its size goes with the length of a river between two
    confluences, never with the number of rivers. Wanted: x1, y1, x2, y2 of the nodes (as plain
    numbers), ahead, back and flags start1, start2, goal1, goal2. A state is a directed edge and the turn that led onto it. All states that were bettered
    in a round hand their cost to the edges ahead of them, until none betters another; whatever costs
    as much as the best goal is not followed.
    """

    def path(group: pd.DataFrame) -> pd.DataFrame:
        x1, y1, x2, y2 = (group[c].to_numpy() for c in ("x1", "y1", "x2", "y2"))
        placed = np.lexsort((y2, x2, y1, x1))
        x1, y1, x2, y2 = x1[placed], y1[placed], x2[placed], y2[placed]
        g = {c: group[c].to_numpy()[placed] for c in ("ahead", "back", "start1", "start2", "goal1", "goal2")}
        x, y = np.concatenate([x1, x2]), np.concatenate([y1, y2])
        wide = y.max() - y.min() + 1  # nodes as one number, in the order of x, then y
        names, number = np.unique((x - x.min()) * wide + y - y.min(), return_inverse=True)
        names = np.stack([names // wide + x.min(), names % wide + y.min()], 1)
        xy = names * [3**0.5, 1.0]  # lattice units are half a width and half a side
        one, two = np.split(number.ravel(), 2)
        tail, head, m = np.concatenate([one, two]), np.concatenate([two, one]), len(x1)
        cost = np.concatenate([g["ahead"], g["back"]]).astype(float)
        start = int(np.concatenate([one[g["start1"]], two[g["start2"]]]).min())
        goal = np.zeros(len(names), dtype=bool)
        goal[one[g["goal1"]]] = goal[two[g["goal2"]]] = True
        nodes = [start]
        through, paid = [], [0.0]
        if not goal[start]:
            leaving = np.full((len(names), 3), -1)  # a corner has three edges at most
            order = np.argsort(tail, kind="stable")
            leaving[tail[order], np.arange(2 * m) - np.searchsorted(tail[order], tail[order])] = order
            ahead = leaving[head]
            ahead[(ahead >= 0) & (ahead % m == (np.arange(2 * m) % m)[:, None])] = -1
            step = xy[head] - xy[tail]
            turn = np.sign(step[:, None, 0] * step[ahead][:, :, 1] - step[:, None, 1] * step[ahead][:, :, 0]).astype(int)
            reached, came = np.full(6 * m, np.inf), np.full(6 * m, -1)  # state: 3 * edge + turn + 1
            fresh = 3 * np.flatnonzero(tail == start) + 1
            reached[fresh] = cost[fresh // 3]
            ends = goal[head].repeat(3)
            best = reached[ends].min(initial=np.inf)
            while len(fresh):
                fresh = fresh[(reached[fresh] < best) & ~ends[fresh]]
                source, onto = fresh.repeat(3), ahead[fresh // 3].ravel()
                curl = turn[fresh // 3].ravel()
                total = reached[source] + cost[onto] + same_turn * ((curl != 0) & (curl == source % 3 - 1))
                target = 3 * onto + curl + 1
                keep = np.flatnonzero((onto >= 0) & (total < reached[target]))
                source, target, total = source[keep], target[keep], total[keep]
                order = np.lexsort((source, total, target))
                found = target[order]
                new = np.ones(len(found), bool)
                new[1:] = found[1:] != found[:-1]
                first, fresh = order[new], found[new]
                reached[fresh], came[fresh] = total[first], source[first]
                best = min(best, reached[fresh[ends[fresh]]].min(initial=np.inf))
            if not np.isfinite(best):
                return pd.DataFrame(columns=["branch", "step", "x", "y", "x1", "y1", "x2", "y2", "cost"])
            at = int(np.flatnonzero(ends & (reached == best))[0])
            while at >= 0:
                through.append(at)
                at = int(came[at])
            through.reverse()
            nodes += [int(head[e // 3]) for e in through]
            paid += [float(reached[e]) for e in through]
        sides = np.array([e // 3 % m for e in through], dtype=int)
        out = pd.DataFrame({"branch": group["branch"].iloc[0], "step": np.arange(len(nodes), dtype="int32"), "x": names[nodes, 0], "y": names[nodes, 1]})
        for c, end in (("x1", x1), ("y1", y1), ("x2", x2), ("y2", y2)):
            out[c] = pd.array([None, *end[sides]], dtype="Int64")
        return out.assign(cost=paid)

    return path


def searched(edges: DataFrame, same_turn: float) -> DataFrame:
    """The paths of ``search`` through flagged edges, as steps."""
    # By a number of its own: rows that lie by branch already would be left as they are, and few bytes are folded into one task.
    found = spread(edges.withColumn("lane", F.xxhash64("branch")), "lane").groupBy("lane", "branch").applyInPandas(search(same_turn), FLAT)

    def node(x, y):
        return F.when(F.col(x).isNotNull(), F.struct(F.col(x).alias("x"), F.col(y).alias("y")))

    return found.select("branch", "step", F.struct("x", "y").alias("node"), node("x1", "y1").alias("n1"), node("x2", "y2").alias("n2"), "cost")


def flagged(edges: DataFrame, starts: DataFrame, goals: DataFrame) -> DataFrame:
    """Edges with start1, start2, goal1 and goal2 by (branch, node) tables; branches without a start or a goal are left out."""
    marks = starts.select("branch", "node", F.lit("start").alias("kind")).unionByName(goals.select("branch", "node", F.lit("goal").alias("kind")))
    lists = marks.groupBy("branch").agg(*[F.collect_set(F.when(F.col("kind") == k, F.col("node"))).alias(k) for k in ("start", "goal")])
    lists = lists.where((F.size("start") > 0) & (F.size("goal") > 0))
    return edges.join(lists, "branch").select("branch", *[F.col(f"n{i}.{c}").alias(f"{c}{i}") for i in (1, 2) for c in "xy"], "ahead", "back", *[F.array_contains(k, F.col(f"n{i}")).alias(f"{k}{i}") for k in ("start", "goal") for i in (1, 2)])


def depths(branches: DataFrame) -> DataFrame:
    """Branches (branch, receiver, discharge) with their depth: how many receivers, each laid before its branch, lie below.

    Branches are laid by discharge, the largest first, then by name; a receiver that comes later, or is no branch, forces nothing
    and is null in the result.
    """
    each = branches.select(F.col("branch").cast("string").alias("branch"), F.col("receiver").cast("string").alias("receiver"), F.coalesce("discharge", F.lit(0.0)).alias("discharge"))
    below = each.select(F.col("branch").alias("receiver"), F.struct((-F.col("discharge")).alias("d"), F.col("branch").alias("b")).alias("rank"))
    linked = each.join(below, "receiver", "left")
    earlier = F.col("rank") < F.struct((-F.col("discharge")).alias("d"), F.col("branch").alias("b"))
    linked = written(linked.select("branch", F.when(earlier, F.col("receiver")).alias("receiver")), "receivers")
    deep = roots(linked, "branch", "receiver", "branch-depths").select("branch", F.col("links").cast("int").alias("depth"))
    return linked.join(deep, "branch")


def ends(vertices: DataFrame) -> DataFrame:
    """The first and the last place of each line: branch, from_x, from_y, to_x, to_y."""
    place = F.struct("x", "y")
    each = vertices.select(F.col("branch").cast("string").alias("branch"), "k", "x", "y").dropna()
    out = each.groupBy("branch").agg(F.min_by(place, "k").alias("a"), F.max_by(place, "k").alias("b"))
    return out.select("branch", F.col("a.x").alias("from_x"), F.col("a.y").alias("from_y"), F.col("b.x").alias("to_x"), F.col("b.y").alias("to_y"))


#: Cells about pieces of lines that are looked at together: bounds the memory of a task, whatever a batch holds.
CELLS = 100_000
#: Lines whose tiles of water are looked up together.
LINES = 1_000
LISTS = "branch string, xs array<bigint>, ys array<bigint>, cost array<double>"


def line_lists(vertices: DataFrame) -> DataFrame:
    """Lines as a row each: branch, xs, ys in the order of k. Lines of fewer than two corners are left out."""
    each = vertices.select(F.col("branch").cast("string").alias("branch"), "k", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).dropna()
    rows = each.groupBy("branch").agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("v")).where(F.size("v") > 1)
    return rows.select("branch", F.col("v.x").alias("xs"), F.col("v.y").alias("ys"))


def with_water(lines: DataFrame, water: DataFrame, grid: GridSpec, reach: float) -> DataFrame:
    """Lines (xs, ys) with the water cells (hex_id) about them as ``water``: tiles of 8 by 8 cells with a bit for each, so no line holds a row for each cell."""
    cells = water.select(*[F.regexp_extract("hex_id", pattern, 1).try_cast("bigint").alias(c) for c, pattern in (("q", "_q([+-][0-9]+)_r"), ("r", "_r([+-][0-9]+)$"))]).dropna()
    side = lattice.TILE
    tiles = cells.groupBy(F.floor(F.col("q") / side).alias("tq"), F.floor(F.col("r") / side).alias("tr")).agg(F.expr(f"bit_or(shiftleft(1L, cast(pmod(q, {side}) * {side} + pmod(r, {side}) as int)))").alias("bits"))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = _lists(batch.column("xs")), _lists(batch.column("ys"))
            for first in range(0, len(xs), LINES):
                line, tq, tr = lattice.tiles(lattice.Lines(xs[first : first + LINES], ys[first : first + LINES], grid), reach)
                yield pa.RecordBatch.from_arrays([batch.column("branch").take(pa.array(first + line, pa.int64())), pa.array(tq, pa.int64()), pa.array(tr, pa.int64())], names=["branch", "tq", "tr"])

    met = lines.select("branch", "xs", "ys").mapInArrow(around, "branch string, tq bigint, tr bigint").join(tiles, ["tq", "tr"])
    lists = met.groupBy("branch").agg(F.collect_list(F.struct("tq", "tr", "bits")).alias("water"))
    none = F.array().cast("array<struct<tq:bigint,tr:bigint,bits:bigint>>")
    return lines.join(lists, "branch", "left").withColumn("water", F.coalesce("water", none))


def _lists(column: pa.Array) -> list[np.ndarray]:
    at, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(at, at[1:])]


def _groups(xs: list[np.ndarray], ys: list[np.ndarray], grid: GridSpec, reach: float) -> Iterator[tuple[int, int]]:
    """Ranges of lines whose pieces have about ``CELLS`` cells around them; a longer line is alone."""
    around = (2 * (reach + grid.side) + 3 * grid.side) ** 2 / grid.area
    many = [around * (len(x) + np.hypot(np.diff(x), np.diff(y)).sum() / (3 * grid.side)) for x, y in zip(xs, ys)]
    first, held = 0, 0.0
    for i, n in enumerate(many):
        if i > first and held + n > CELLS:
            yield first, i
            first, held = i, 0.0
        held += n
    if many:
        yield first, len(many)


def lay(grid: GridSpec, reach: float, scale: float, direction: float, same_turn: float, mouths: bool = False):
    """A function for ``mapInArrow``: the cheapest path of each line (branch, xs, ys) through its corridor, as lists of its nodes and costs.

    Corridors are made, searched and left again a group of lines at a time, so no edge is written or sent. Wanted: ``water`` (``with_water``) and ``nodes``, lists of x and y. For rivers
    these are the nodes of the path that a line flows into; a line ends at one of the nearest three that its corridor has, else nearest to its end, and begins nearest to its start.
    For ``mouths`` it is the node where a line begins, and it ends at the first edge of a water cell.
    """

    def group(xs, ys, tq, tr, bits, nx, ny) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        lines = lattice.Lines(xs, ys, grid)
        e = lattice.corridor(lines, reach)
        if not len(e.q):
            return {}
        water = lattice.Water(np.repeat(np.arange(lines.n), [len(t) for t in tq]), *(np.concatenate(c) for c in (tq, tr, bits)))
        here, there = water(e.line, e.q, e.r), water(e.line, e.q + lattice.ENDS[e.k, 4], e.r + lattice.ENDS[e.k, 5])
        base = grid.side * (1 + (e.distance / scale) ** 2) * np.where(here & there, WATER_EDGE_PENALTY, 1.0)
        along = 0.0
        if not mouths:
            tx, ty = lines.tangents(e.line, e.s, TANGENT_REACH)
            (x1, y1), (x2, y2) = lattice.xy(grid, e.x1, e.y1), lattice.xy(grid, e.x2, e.y2)
            long = grid.side * np.hypot(tx, ty)
            with np.errstate(divide="ignore", invalid="ignore"):
                along = np.where(long > 0, ((x2 - x1) * tx + (y2 - y1) * ty) / long, 0.0)
        turn = grid.side * direction / 2
        nodes = lattice.Nodes(e)
        x, y = lattice.xy(grid, nodes.x, nodes.y)
        given = np.repeat(np.arange(lines.n), [len(c) for c in nx]), np.concatenate(nx), np.concatenate(ny)
        known = nodes.find(*given)
        start, goal = np.full(lines.n, -1), np.zeros(len(nodes.x), bool)
        if mouths:
            start[given[0][known >= 0]] = known[known >= 0]
            shore = np.flatnonzero(here | there)
            goal[nodes.number[shore]] = goal[nodes.number[shore + len(e.q)]] = True
        else:
            first = lattice.nearest(nodes.line, nodes.x, nodes.y, np.hypot(x - lines.from_x[nodes.line], y - lines.from_y[nodes.line]), lines.n)
            start[nodes.line[first]] = first
            away = np.hypot(x - lines.to_x[nodes.line], y - lines.to_y[nodes.line])
            forced = np.unique(known[known >= 0])
            forced = forced[np.lexsort((nodes.y[forced], nodes.x[forced], away[forced], nodes.line[forced]))]
            own = nodes.line[forced]
            goal[forced[np.arange(len(own)) - np.searchsorted(own, own) < JUNCTIONS]] = True
            end = lattice.nearest(nodes.line, nodes.x, nodes.y, away, lines.n)
            goal[end[~np.isin(nodes.line[end], own)]] = True
        found = lattice.cheapest(e, base + turn * (1 - along), base + turn * (1 + along), nodes, start, goal, lines.n, same_turn)
        return {k: (nodes.x[at], nodes.y[at], cost) for k, (at, cost) in found.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = _lists(batch.column("xs")), _lists(batch.column("ys"))
            tiles, onto = batch.column("water"), batch.column("nodes")
            lists = [_lists(pa.ListArray.from_arrays(c.offsets, c.values.field(n))) for c, n in ((tiles, "tq"), (tiles, "tr"), (tiles, "bits"), (onto, "x"), (onto, "y"))]
            for a, b in _groups(xs, ys, grid, reach):
                found = group(xs[a:b], ys[a:b], *(c[a:b] for c in lists))
                if found:
                    at = sorted(found)
                    sizes = np.concatenate([[0], np.cumsum([len(found[k][0]) for k in at])])
                    columns = [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate([found[k][i] for k in at]), kind)) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))]
                    yield pa.RecordBatch.from_arrays([batch.column("branch").take(pa.array(a + np.array(at), pa.int64())), *columns], names=["branch", "xs", "ys", "cost"])

    return run


def steps_of(lists: DataFrame) -> DataFrame:
    """Paths as lists (branch, xs, ys, cost) as steps: branch, step from 0, node, n1 and n2 of the edge that led there (null at step 0), cost."""
    node = lambda i: F.struct(F.col("xs")[i].alias("x"), F.col("ys")[i].alias("y"))

    def step(i: Column) -> Column:
        ends = [F.when(i > 0, f(node(i - 1), node(i))) for f in (F.least, F.greatest)]
        return F.struct(i.alias("step"), node(i).alias("node"), ends[0].alias("n1"), ends[1].alias("n2"), F.col("cost")[i].alias("cost"))

    return lists.select("branch", F.explode(F.transform(F.sequence(F.lit(0), F.size("xs") - 1), step)).alias("s")).select("branch", "s.*")


def lists_of(paths: DataFrame) -> DataFrame:
    """Steps of paths as lists of their nodes: branch, xs, ys. Lists stay as they are."""
    if "xs" in paths.columns:
        return paths.select("branch", "xs", "ys")
    rows = paths.groupBy("branch").agg(F.array_sort(F.collect_list(F.struct("step", "node.x", "node.y"))).alias("v"))
    return rows.select("branch", F.col("v.x").alias("xs"), F.col("v.y").alias("ys"))


def snap_lists(vertices: DataFrame, branches: DataFrame, water: DataFrame, grid: GridSpec, reach: float = CORRIDOR, scale: float = SCALE, direction: float = DIRECTION_WEIGHT, same_turn: float = SAME_TURN) -> DataFrame:
    """The paths of ``snap`` as a row each: branch, xs and ys of the nodes, and the cost at each.

    What is written is a row for each branch with its line, its water and later its path; corridors are never rows. Each depth is one written table.
    """
    if grid.orientation != "pointy":
        raise ValueError("edges are made for pointy grids")
    levels = written(depths(branches), "depths")
    rows = with_water(line_lists(vertices), water, grid, reach).join(levels, "branch")
    # Sorted by depth, so that each depth's filter skips the row groups of the others.
    rows = written(rows.repartitionByRange("depth", F.xxhash64("branch")).sortWithinPartitions("depth"), "lines")
    done = None
    deepest = levels.agg(F.max("depth")).first()[0]
    none = F.array().cast("array<struct<x:bigint,y:bigint>>")
    for depth in range(0 if deepest is None else deepest + 1):
        here = rows.where(F.col("depth") == depth)
        if done is None:
            here = here.withColumn("nodes", none)
        else:
            below = done.select(F.col("branch").alias("receiver"), F.arrays_zip(F.col("xs").alias("x"), F.col("ys").alias("y")).alias("nodes"))
            here = here.join(below, "receiver", "left").withColumn("nodes", F.coalesce("nodes", none))
        here = spread(here.select("branch", "xs", "ys", "water", "nodes").withColumn("lane", F.xxhash64("branch")), "lane").drop("lane")
        found = written(here.mapInArrow(lay(grid, reach, scale, direction, same_turn * grid.side), LISTS), "paths")
        done = found if done is None else done.unionByName(found)
    return vertices.sparkSession.createDataFrame([], LISTS) if done is None else done


def snap(vertices: DataFrame, branches: DataFrame, water: DataFrame, grid: GridSpec, reach: float = CORRIDOR, scale: float = SCALE, direction: float = DIRECTION_WEIGHT, same_turn: float = SAME_TURN) -> DataFrame:
    """Paths of branches along hex edges: branch, step from 0, node, n1 and n2 of the edge that led there (null at step 0), cost.

    ``vertices``: lines, simplified to the size of the cells; ``branches``: branch, receiver (null: none),
    discharge; ``water``: hex_id of open water. A branch begins at its corridor's node nearest to its
    line's start. It ends at one of the three nodes nearest to its line's end on the path of the branch it flows into,
    if that was laid before and touches the corridor, else at the node nearest to its line's end.
    A branch that cannot be joined within its corridor has no rows.
    """
    return steps_of(snap_lists(vertices, branches, water, grid, reach, scale, direction, same_turn))


def path_hexes(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The hexes on both sides of each path: branch, hex_id."""
    return paths.join(edges.select("branch", "n1", "n2", "hex_a", "hex_b"), ["branch", "n1", "n2"]).select("branch", F.explode(F.array("hex_a", "hex_b")).alias("hex_id")).distinct()


def path_metrics(paths: DataFrame, vertices: DataFrame, grid: GridSpec, reach: float = CORRIDOR) -> DataFrame:
    """One row for each path: edges and length, offsets from ``vertices`` (mean, median, 90 and 95 %, most), turns, equal turns in a row,
    turns for each 100 km of the path and of the line, their difference, edges against the line (over 120 degrees), and the straight
    distance as part of the length. A path of one node has zeros and an efficiency of one.

    ``vertices`` may be the lines before they were simplified; ``reach`` then must hold what simplifying moved.
    """
    names = [*(f"offset_{c}" for c in ("mean", "median", "p90", "p95", "max")), "straight_m"]
    counts = ["edges", "turns", "same_turns", "reversals"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys, px, py = (_lists(batch.column(c)) for c in ("lx", "ly", "xs", "ys"))
            for a, b in _groups(xs, ys, grid, reach):
                got = lattice.measures(grid, list(zip(px[a:b], py[a:b])), list(zip(xs[a:b], ys[a:b])), reach, TANGENT_REACH)
                columns = [pa.array(got[c], pa.int64()) for c in counts] + [pa.array(np.nan_to_num(got[c], nan=0.0), pa.float64()) for c in names]
                yield pa.RecordBatch.from_arrays([batch.column("branch").slice(a, b - a), *columns], names=["branch", *counts, *names])

    none = F.array().cast("array<double>")
    both = lists_of(paths).join(line_lists(vertices).withColumnsRenamed({"xs": "lx", "ys": "ly"}), "branch", "left").withColumns({"lx": F.coalesce("lx", none), "ly": F.coalesce("ly", none)})
    both = spread(both.withColumn("lane", F.xxhash64("branch")), "lane").drop("lane")
    out = both.mapInArrow(measured, "branch string, " + ", ".join([*(f"{c} bigint" for c in counts), *(f"{c} double" for c in names)]))
    out = out.select("branch", "edges", (F.col("edges") * grid.side).alias("length_m"), *names[:-1], *counts[1:], "straight_m")
    line = turn_density(vertices.withColumn("branch", F.col("branch").cast("string")), "branch", "k").select("branch", F.col("turns_per_100km").alias("line_turns"))
    density = F.when(F.col("length_m") > 0, F.col("turns") / (F.col("length_m") / 100_000)).otherwise(0.0)
    out = out.join(line, "branch", "left").withColumn("turns_per_100km", density)
    straight = F.when(F.col("length_m") > 0, F.col("straight_m") / F.col("length_m")).otherwise(1.0)
    return out.withColumns({"turn_excess": F.col("turns_per_100km") - F.coalesce("line_turns", F.lit(0.0)), "efficiency": straight}).drop("straight_m")


def mouth_gaps(paths: DataFrame, mouths: DataFrame, water: DataFrame, grid: GridSpec, limit: float = MOUTH_LIMIT) -> DataFrame:
    """For each branch of ``mouths`` the nearest middle of a water cell (q, r) from the end of its path, at most ``limit`` away: branch, node, x, y, to_x, to_y, gap_m.

    Ends and cells meet in squares of ``limit``, where each end looks into nine; a square holds as many cells as fit into it, no more.
    """
    ends_ = lists_of(paths).select("branch", F.struct(F.element_at("xs", -1).alias("x"), F.element_at("ys", -1).alias("y")).alias("node")) if "xs" in paths.columns else paths.groupBy("branch").agg(F.max_by("node", "step").alias("node"))
    last = ends_.join(mouths.select(F.col("branch").cast("string").alias("branch")), "branch", "left_semi")
    x, y = node_xy(grid, F.col("node"))
    last = last.withColumns({"x": x, "y": y})
    around = F.array(*[F.struct((F.floor(F.col("x") / limit) + i).alias("cx"), (F.floor(F.col("y") / limit) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    wx, wy = grid.centre(F.col("q"), F.col("r"))
    cells = water.select("q", "r", wx.alias("to_x"), wy.alias("to_y")).withColumns({"cx": F.floor(F.col("to_x") / limit), "cy": F.floor(F.col("to_y") / limit)})
    met = last.withColumn("c", F.explode(around)).select("branch", "node", "x", "y", "c.*").join(cells, ["cx", "cy"])
    met = met.withColumn("gap_m", F.hypot(F.col("to_x") - F.col("x"), F.col("to_y") - F.col("y"))).where(F.col("gap_m") <= limit)
    best = met.groupBy("branch").agg(F.min(F.struct("gap_m", "q", "r", "node", "x", "y", "to_x", "to_y")).alias("m"))
    return best.select("branch", "m.node", "m.x", "m.y", "m.to_x", "m.to_y", "m.gap_m")


def extend_mouths(paths: DataFrame, mouths: DataFrame, water: DataFrame, grid: GridSpec, limit: float = MOUTH_LIMIT, scale: float = SCALE) -> DataFrame:
    """Extensions of paths that end inland: steps as of ``snap``, from the path's end (step 0) to the first edge of a water hex.

    ``water`` has q and r. Gaps of at most one width are closed already, those above ``limit`` stay. The way is searched within two widths of the
    straight line to the nearest water. The length of an extension is its steps times a side; it belongs to no line and so to none of ``path_metrics``.
    """
    gaps = written(mouth_gaps(paths, mouths, water, grid, limit).where(F.col("gap_m") > grid.flat_to_flat), "mouth-gaps")
    lines = gaps.select("branch", F.array("x", "to_x").alias("xs"), F.array("y", "to_y").alias("ys"), F.array("node").alias("nodes"))
    reach = 2 * grid.flat_to_flat
    rows = with_water(lines, water.select(grid.hex_id(F.col("q"), F.col("r")).alias("hex_id")), grid, reach).select("branch", "xs", "ys", "water", "nodes")
    rows = spread(rows.withColumn("lane", F.xxhash64("branch")), "lane").drop("lane")
    return steps_of(written(rows.mapInArrow(lay(grid, reach, scale, 0.0, 0.0, True), LISTS), "extensions"))


def wide_river_hexes(vertices: DataFrame, grid: GridSpec, width_m: str, exaggeration: float = 1.0) -> DataFrame:
    """The hexes (branch, q, r) that a line as wide as its column ``width_m`` times ``exaggeration`` touches.

    A cell holds the circle about its middle that touches its sides, so one whose middle is within that circle's radius of the band is touched;
    only those whose middle is further off, by up to a side, are held side by side against the line.
    """
    cx, cy = 2 * F.col("q") + F.col("r"), 3 * F.col("r")
    ring = [{"x": cx + u, "y": cy + v} for u, v in RING]
    each = cells_near(vertices, grid, F.col(width_m) * exaggeration / 2).withColumn("sure", F.col("away") <= F.col("reach") + grid.flat_to_flat / 2 - 1e-6)
    sides = F.array(*[F.struct(*places(grid, ring[i], ring[(i + 1) % 6])) for i in range(6)])
    none = F.array(F.struct(*[F.lit(0.0).alias(c) for c in ("ux", "uy", "vx", "vy")]))
    each = each.withColumn("side", F.explode(F.when(F.col("sure"), none).otherwise(sides))).select("*", "side.*")
    inside = (F.col("start_q") == F.col("q")) & (F.col("start_r") == F.col("r"))
    gap = between((F.col("ux"), F.col("uy")), (F.col("vx"), F.col("vy")), (F.col("px"), F.col("py")), (F.col("ox"), F.col("oy")))
    return each.where(F.col("sure") | inside | (gap <= F.col("reach"))).select("branch", "q", "r").distinct()
