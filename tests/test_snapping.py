"""Rivers on hex edges against plain searches and sums."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import snapping as o

GRID = GridSpec(3000.0)
REACH, SCALE = 6000.0, 3000.0
LINES = {
    "a": [(0, 0), (9000, 4000), (21000, 3000), (30000, 12000)],
    "b": [(20000, 24000), (18000, 15000), (21000, 3000)],
    "c": [(2000, 14000), (9500, 9000), (17500, 14000)],
    "bend": [(40000, 0), (50000, 300), (50500, 6000), (41000, 6500)],
    "dot": [(7, 7)],
    "still": [(60000, 0), (60000, 0)],
}
FLOWS = [("a", None, 90.0), ("b", "a", 50.0), ("c", "b", 10.0), ("bend", "gone", 5.0), ("dot", None, 1.0), ("still", None, 1.0)]


def xy(node):
    return node[0] * GRID.flat_to_flat / 2, node[1] * GRID.side / 2


def off(p, a, b):
    (px, py), (ax, ay), (bx, by) = p, a, b
    long = (bx - ax) ** 2 + (by - ay) ** 2
    t = min(1.0, max(0.0, ((px - ax) * (bx - ax) + (py - ay) * (by - ay)) / long)) if long else 0.0
    return math.dist(p, (ax + t * (bx - ax), ay + t * (by - ay))), t


def locate(line, p):
    """Distance of a place from a line and the way along it."""
    best, s = (math.inf, 0.0), 0.0
    for a, b in zip(line, line[1:]):
        d, t = off(p, a, b)
        best = min(best, (d, s + t * math.dist(a, b)))
        s += math.dist(a, b)
    return best


def at(line, s):
    way = np.cumsum([0.0, *[math.dist(a, b) for a, b in zip(line, line[1:])]])
    s = min(max(s, 0.0), way[-1])
    return np.interp(s, way, [p[0] for p in line]), np.interp(s, way, [p[1] for p in line])


def all_edges():
    """Every edge of a field of cells around the lines, with the cells on both sides."""
    sides = {}
    for q in range(-30, 40):
        for r in range(-14, 24):
            ring = [(2 * q + r + u, 3 * r + v) for u, v in o.RING]
            for i in range(6):
                sides.setdefault(tuple(sorted((ring[i], ring[(i + 1) % 6]))), []).append((q, r))
    return {e: c for e, c in sides.items() if len(c) == 2}


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(b, k, float(x), float(y)) for b, line in LINES.items() for k, (x, y) in enumerate(line)]
    rows += [("a", 99, None, 5.0), ("nulls", 0, None, None), (None, 0, 1.0, 1.0), (None, 1, 9000.0, 1.0)]
    vertices = spark.createDataFrame(rows, "branch string, k int, x double, y double")
    branches = spark.createDataFrame(FLOWS, "branch string, receiver string, discharge double")
    return vertices, branches


@pytest.fixture(scope="module")
def water(spark):
    return spark.createDataFrame([(5, 1), (6, 1), (12, 6), (13, 6)], "q bigint, r bigint")


@pytest.fixture(scope="module")
def paths(spark, tables, water):
    ids = water.select(GRID.hex_id(F.col("q"), F.col("r")).alias("hex_id"))
    found = o.snap(*tables, ids, GRID, REACH, SCALE)
    steps = {}
    for r in found.orderBy("branch", "step").collect():
        steps.setdefault(r.branch, []).append((tuple(r.node), r.cost))
    return found, steps


def touching(line, edges):
    """The edges near a line, by places a metre apart along them (the edge of the corridor within a metre)."""
    out = {}
    for e in edges:
        a, b = xy(e[0]), xy(e[1])
        out[e] = min(locate(line, (a[0] + (b[0] - a[0]) * i / 200, a[1] + (b[1] - a[1]) * i / 200))[0] for i in range(201))
    return out


def test_corridor_holds_the_edges_in_reach(tables):
    got = {}
    for r in o.corridor(tables[0], GRID, REACH).collect():
        got.setdefault(r.branch, {})[tuple(sorted((tuple(r.n1), tuple(r.n2))))] = (r.distance_m, r.s)
    assert set(got) == {"a", "b", "c", "bend", "still"}
    for name in ("b", "bend"):
        near = touching(LINES[name], all_edges())
        assert {e for e, d in near.items() if d <= REACH - 5} <= set(got[name]) <= {e for e, d in near.items() if d <= REACH + 5}
        for e, (d, s) in got[name].items():
            mid = tuple((u + v) / 2 for u, v in zip(xy(e[0]), xy(e[1])))
            assert (d, s) == pytest.approx(locate(LINES[name], mid), abs=1e-6)


def cheapest(name, edges, wet, goals):
    """The cheapest cost of a path through a corridor by a queue of (cost, node, node before, turn)."""
    line, side = LINES[name], GRID.side
    out = {}
    for e in edges:
        mid = tuple((u + v) / 2 for u, v in zip(xy(e[0]), xy(e[1])))
        d, s = locate(line, mid)
        (ax, ay), (bx, by) = at(line, s - 400), at(line, s + 400)
        base = side * (1 + (d / SCALE) ** 2) * (25 if all(c in wet for c in FIELD[e]) else 1)
        for u, v in (e, e[::-1]):
            (x1, y1), (x2, y2) = xy(u), xy(v)
            cos = ((x2 - x1) * (bx - ax) + (y2 - y1) * (by - ay)) / side / math.hypot(bx - ax, by - ay)
            out.setdefault(u, []).append((v, base + side * 1.2 * (1 - cos) / 2))
    start = min(out, key=lambda n: (math.dist(xy(n), line[0]), n))
    usable = [n for n in goals if n in out]
    goal = set(sorted(usable, key=lambda n: (math.dist(xy(n), line[-1]), n))[:3]) or {min(out, key=lambda n: (math.dist(xy(n), line[-1]), n))}
    queue, seen = [(0.0, start, start, 0)], set()
    while queue:
        cost, node, before, turn = heapq.heappop(queue)
        if node in goal:
            return start, goal, cost
        if (node, before, turn) in seen:
            continue
        seen.add((node, before, turn))
        for v, more in out[node]:
            if v != before:
                (x0, y0), (x1, y1), (x2, y2) = xy(before), xy(node), xy(v)
                cross = (x1 - x0) * (y2 - y1) - (y1 - y0) * (x2 - x1)
                curl = 0 if before == node else int(np.sign(cross))
                heapq.heappush(queue, (cost + more + (0.6 * side if curl and curl == turn else 0), v, node, curl))
    return None


FIELD = all_edges()


def test_paths_are_the_cheapest(tables, paths, water):
    wet = {(r.q, r.r) for r in water.collect()}
    near = {}
    for r in o.corridor(tables[0], GRID, REACH).collect():
        near.setdefault(r.branch, []).append(tuple(sorted((tuple(r.n1), tuple(r.n2)))))
    _, steps = paths
    assert set(steps) == {"a", "b", "c", "bend", "still"}
    for name, receiver in (("a", None), ("b", "a"), ("c", "b"), ("bend", None)):
        goals = [n for n, _ in steps[receiver]] if receiver else []
        start, goal, cost = cheapest(name, near[name], wet, goals)
        nodes = [n for n, _ in steps[name]]
        assert nodes[0] == start and nodes[-1] in goal
        assert all(tuple(sorted(e)) in near[name] for e in zip(nodes, nodes[1:]))
        assert steps[name][-1][1] == pytest.approx(cost, rel=1e-9)
    assert len(steps["still"]) == 1 and steps["still"][0][1] == 0


def test_searches_are_dealt_over_all_partitions(spark):
    """Rows that lie by branch already, in a table of a few bytes, are still dealt over all tasks."""
    rows = [(f"b{k}", 0, 0, 1, 1, 1.0, 1.0, True, False, False, True) for k in range(200)]
    edges = spark.createDataFrame(rows, "branch string, x1 bigint, y1 bigint, x2 bigint, y2 bigint, ahead double, back double, start1 boolean, start2 boolean, goal1 boolean, goal2 boolean")
    by_branch = edges.join(edges.select("branch").distinct(), "branch")
    found = o.searched(by_branch.hint("shuffle_hash"), 0.0).withColumn("task", F.spark_partition_id())
    assert found.count() == 400 and found.select("task").distinct().count() > 4


def test_depth_follows_the_larger_branch(spark):
    flows = [("x", "y", 5.0), ("y", "z", 9.0), ("z", "y", 7.0), ("w", "x", 6.0), ("v", None, None)]
    got = {r.branch: (r.receiver, r.depth) for r in o.depths(spark.createDataFrame(flows, "branch string, receiver string, discharge double")).collect()}
    assert got == {"x": ("y", 1), "y": (None, 0), "z": ("y", 1), "w": (None, 0), "v": (None, 0)}


def test_metrics(tables, paths):
    found, steps = paths
    got = {r.branch: r for r in o.path_metrics(found, tables[0], GRID, REACH).collect()}
    assert set(got) == set(steps)
    for name in ("a", "b", "c", "bend"):
        nodes, r = [n for n, _ in steps[name]], got[name]
        places = [xy(n) for n in nodes]
        away = [locate(LINES[name], tuple((u + v) / 2 for u, v in zip(a, b))) for a, b in zip(places, places[1:])]
        move = np.diff(np.array(places), axis=0)
        turn = np.sign(np.round(move[:-1, 0] * move[1:, 1] - move[:-1, 1] * move[1:, 0], 3))
        back = 0
        for (d, s), (dx, dy) in zip(away, move):
            (ax, ay), (bx, by) = at(LINES[name], s - 400), at(LINES[name], s + 400)
            back += (dx * (bx - ax) + dy * (by - ay)) / math.hypot(dx, dy) / math.hypot(bx - ax, by - ay) < -0.5
        d = [x for x, _ in away]
        want = [len(move), len(move) * GRID.side, np.mean(d), np.median(d), np.percentile(d, 90), np.percentile(d, 95), max(d), len(turn), int((turn[:-1] == turn[1:]).sum()), back]
        have = [r.edges, r.length_m, r.offset_mean, r.offset_median, r.offset_p90, r.offset_p95, r.offset_max, r.turns, r.same_turns, r.reversals]
        assert have == pytest.approx(want, rel=1e-9)
        assert r.efficiency == pytest.approx(math.dist(places[0], places[-1]) / r.length_m)
        assert r.turn_excess == pytest.approx(len(turn) / (r.length_m / 1e5) - r.line_turns)
    assert (got["still"].edges, got["still"].length_m, got["still"].efficiency) == (0, 0.0, 1.0)


def test_hexes_of_paths(tables, paths):
    found, steps = paths
    got = {tuple(r) for r in o.path_hexes(found, o.corridor(tables[0], GRID, REACH)).collect()}
    want = {(b, c) for b, path in steps.items() for e in zip(path, path[1:]) for c in FIELD[tuple(sorted((e[0][0], e[1][0])))]}
    assert got == {(b, f"h3000_q{q:+07d}_r{r:+07d}") for b, (q, r) in want}


def test_mouths_reach_water(spark, paths, water):
    found, steps = paths
    mouths = spark.createDataFrame([("a",), ("bend",), ("still",), ("none",)], "branch string")
    gaps = {r.branch: r.gap_m for r in o.mouth_gaps(found, mouths, water, GRID).collect()}
    middles = [(3000.0 * (r.q + r.r / 2), 1.5 * GRID.side * r.r) for r in water.collect()]
    want = {b: min(math.dist(xy(steps[b][-1][0]), m) for m in middles) for b in ("a", "bend", "still")}
    assert gaps == pytest.approx({b: g for b, g in want.items() if g <= o.MOUTH_LIMIT})
    more = {}
    for r in o.extend_mouths(found, mouths, water, GRID).orderBy("branch", "step").collect():
        more.setdefault(r.branch, []).append(tuple(r.node))
    assert more and set(more) == {b for b, g in gaps.items() if g > 3000}
    wet = {(r.q, r.r) for r in water.collect()}
    shore = {n for e, cells in FIELD.items() if wet & set(cells) for n in e}
    for b, nodes in more.items():
        assert nodes[0] == steps[b][-1][0] and nodes[-1] in shore and not shore & set(nodes[:-1])
        assert all(tuple(sorted(e)) in FIELD for e in zip(nodes, nodes[1:]))


def test_wide_rivers(tables):
    got = {}
    for r in o.wide_river_hexes(tables[0].withColumn("width", F.lit(2000.0)), GRID, "width", 2.0).collect():
        got.setdefault(r.branch, set()).add((r.q, r.r))
    for name in ("c", "bend"):
        ring_edges = {e: d for e, d in touching(LINES[name], FIELD).items()}
        near = {}
        for e, d in ring_edges.items():
            for c in FIELD[e]:
                near[c] = min(d, near.get(c, math.inf))
        assert {c for c, d in near.items() if d <= 1995} <= got[name] <= {c for c, d in near.items() if d <= 2005}


def test_wide_rivers_ask_few_cells_for_their_sides(tables):
    """Cells whose own circle the band touches need no sides: with a line 2 km wide on each side few are left, and the cells are those of all sides."""
    lines = tables[0].withColumn("width", F.lit(2000.0))
    near = o.cells_near(lines, GRID, F.lit(2000.0)).select("q", "r", "px", "py", "ox", "oy", "away").collect()
    assert all(abs(r.away - math.hypot(*closest(r))) < 1e-6 for r in near)
    asked = [r for r in near if r.away > 2000.0 + GRID.flat_to_flat / 2 - 1e-6]
    assert 0 < len(asked) < len(near) / 4
    got = {(r.branch, r.q, r.r) for r in o.wide_river_hexes(lines, GRID, "width", 2.0).collect()}
    sure = {(r.branch, r.q, r.r) for r in o.cells_near(lines, GRID, F.lit(2000.0)).where(F.col("away") <= 2000.0 + GRID.flat_to_flat / 2 - 1e-6).collect()}
    assert sure <= got


def closest(r):
    """From a cell's middle to the nearest place of a piece."""
    cx, cy = GRID.flat_to_flat * (r.q + r.r / 2), 1.5 * GRID.side * r.r
    dx, dy = r.ox - r.px, r.oy - r.py
    t = min(1.0, max(0.0, ((cx - r.px) * dx + (cy - r.py) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
    return cx - r.px - t * dx, cy - r.py - t * dy


def test_empty_tables(spark, tables, water):
    none, few = tables[0].limit(0), tables[1].limit(0)
    ids = water.limit(0).select(GRID.hex_id(F.col("q"), F.col("r")).alias("hex_id"))
    for v, b in ((none, few), (none, tables[1]), (tables[0], few)):
        found = o.snap(v, b, ids, GRID, REACH, SCALE)
        assert found.isEmpty() and o.path_metrics(found, v, GRID).isEmpty() and o.extend_mouths(found, b, water, GRID).isEmpty()
