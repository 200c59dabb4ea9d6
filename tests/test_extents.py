"""Distances and extents on the ground against plain searches, names down long chains, ids of any type."""

import math
import random

import numpy as np
import pytest

from hexloom.functions.geodesy import geodesic_m, ring_km2
from hexloom.functions.projection import HALF_EXTENT, RADIUS, WORLD
from hexloom.operators import evidence, extents, points, rivers

SEGMENTS = "line_id string, x1 double, y1 double, x2 double, y2 double"


def ground(ax, ay, bx, by):
    lat = lambda y: np.degrees(np.arctan(np.sinh(y / RADIUS)))
    return float(geodesic_m(np.degrees([ax / RADIUS]), lat(np.array([ay])), np.degrees([bx / RADIUS]), lat(np.array([by])))[0])


def foot(px, py, s):
    x1, y1, x2, y2 = s
    dx, dy = x2 - x1, y2 - y1
    t = 0.0 if dx == dy == 0 else max(0.0, min(1.0, ((px - x1) * dx + (py - y1) * dy) / (dx * dx + dy * dy)))
    return x1 + t * dx, y1 + t * dy


def crossing(s, o):
    side = lambda s, x, y: np.sign((s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0]))
    return side(s, o[0], o[1]) * side(s, o[2], o[3]) < 0 and side(o, s[0], s[1]) * side(o, s[2], s[3]) < 0


def between(s, o):
    """Distance in the projection and the two places that have it, over all turns of the world."""
    best = (math.inf, None)
    for turn in (-WORLD, 0.0, WORLD):
        m = (o[0] + turn, o[1], o[2] + turn, o[3])
        if crossing(s, m):
            return 0.0, (s[0], s[1], s[0], s[1])
        for a, b in ((s, m), (m, s)):
            for x, y in ((a[0], a[1]), (a[2], a[3])):
                fx, fy = foot(x, y, b)
                best = min(best, (math.hypot(x - fx, y - fy), (x, y, fx, fy)))
    return best


def test_vincenty_against_a_published_line():
    # Flinders Peak to Buninyong, on the GRS 80 ellipsoid.
    degrees = lambda d, m, s: d + m / 60 + s / 3600
    got = geodesic_m([degrees(144, 25, 29.52440)], [-degrees(37, 57, 3.72030)], [degrees(143, 55, 35.38390)], [-degrees(37, 39, 10.15610)])
    assert got[0] == pytest.approx(54972.271, abs=0.001)


def test_area_of_a_quarter_of_a_hemisphere():
    top = RADIUS * math.log(math.tan(math.pi / 4 + math.radians(89.999) / 2))
    x = RADIUS * math.pi / 2
    assert ring_km2(np.array([0, x, x, 0]), np.array([0, 0, top, top]), 4000) == pytest.approx(510065621.724 / 8, rel=1e-4)


@pytest.mark.parametrize(("limit", "lat"), [(9_000.0, 0.0), (40_000.0, 58.0), (3_000.0, -81.0)])
def test_distances_on_both_sides_of_the_date_line(spark, limit, lat):
    """Shapes in a square around 180 degrees, some written as beyond it, at several latitudes."""
    rng = random.Random(int(limit))
    scale = 1 / math.cos(math.radians(lat))
    y0, half = RADIUS * math.asinh(math.tan(math.radians(lat))), 12 * limit * scale
    shapes = {}
    for k in range(90):
        x, y, size = HALF_EXTENT + rng.uniform(-half, half), y0 + rng.uniform(-half, half), half / 12
        x = x - WORLD if x > HALF_EXTENT + size / 2 else x
        at = [(x, y), (x + rng.uniform(-size, size), y + rng.uniform(-size, size)), (x + rng.uniform(-size, size), y + rng.uniform(-size, size))]
        shapes[f"s{k:02d}"] = [(*at[0], *at[1]), (*at[1], *at[2])] if k % 5 else [(*at[0], *at[0])]
    shapes["s99"] = shapes["s03"]
    rows = [(k, *s) for k, v in shapes.items() for s in v]
    table = spark.createDataFrame([*rows, ("null", None, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 0.0, 0.0)], SEGMENTS)
    want = {}
    names = sorted(shapes)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            d, p = min(between(s, o) for s in shapes[a] for o in shapes[b])
            m = 0.0 if d == 0 else ground(*p)
            if m <= limit:
                want[a, b] = (d, m)
    got = {(r.a, r.b): (r.distance_m, r.ground_m) for r in extents.ground_distances(table, limit).collect()}
    assert len(want) > 20 and any(abs(shapes[a][0][0] - shapes[b][0][0]) > HALF_EXTENT for a, b in want)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-3) for k in want)
    two = {(r.a, r.b): r.ground_m for r in extents.ground_distances(table.where("line_id < 's30'"), limit, table.where("line_id >= 's30'")).collect()}
    assert two.keys() == {k for k in want if k[0] < "s30" <= k[1]}
    assert extents.ground_distances(table.where("false"), limit).count() == 0


def test_extent_is_the_widest_of_all_pairs(spark):
    rng = random.Random(5)
    rows = [(f"g{g}", rng.uniform(-1, 1) * 10**g, 7e6 + rng.uniform(-1, 1) * 10**g) for g in range(3, 7) for _ in range(150)]
    over = [("line", (HALF_EXTENT - 5000.0 * k) * (1 if k > 0 else -1) - (0 if k > 0 else 10000.0 * k), 4e6 + 900.0 * k * k) for k in range(-6, 7) if k]
    table = spark.createDataFrame([*rows, *over, ("one", 5.0, 5.0), ("one", 5.0, 5.0), (None, 1.0, 1.0), ("none", None, 1.0)], "g string, x double, y double")
    got = {r.g: r for r in extents.group_extents(table.repartition(5), "g").collect()}
    assert got.keys() == {"g3", "g4", "g5", "g6", "line", "one"}
    for name, r in got.items():
        own = [(x + WORLD if name == "line" and x < 0 else x, y) for g, x, y in [*rows, *over, ("one", 5.0, 5.0)] if g == name]
        x, y = np.array(own).T
        lon, lat = np.degrees(x / RADIUS), np.degrees(np.arctan(np.sinh(y / RADIUS)))
        i, j = np.nonzero((x[:, None] != x) | (y[:, None] != y))
        assert r.extent_m == pytest.approx(geodesic_m(lon[i], lat[i], lon[j], lat[j]).max(initial=0.0), abs=1e-3)
        assert r.extent_projected_m == pytest.approx(max(math.dist(p, q) for p in own for q in own), abs=1e-6)
    assert got["line"].extent_m < 100_000 and got["one"].hull_km2 == 0
    assert extents.group_extents(table.where("false"), "g").count() == 0


def test_group_metrics_with_separation(spark):
    """Three squares of a kilometre in a row on the equator, 2 and 5 km apart, and one alone."""
    at = {"a": 0.0, "b": 3000.0, "c": 9000.0, "z": 500_000.0}
    ring = lambda x: [(x, 0.0), (x + 1000, 0.0), (x + 1000, 1000.0), (x, 1000.0)]
    sides = [(k, *p, *q) for k, x in at.items() for p, q in zip(ring(x), ring(x)[1:] + ring(x)[:1])]
    members = spark.createDataFrame([("g", "a", 1.0), ("g", "b", 1.0), ("g", "c", 2.0), ("h", "z", 1.0)], "g string, component_id string, km2 double")
    corners = spark.createDataFrame([("h" if k == "z" else "g", *p) for k, x in at.items() for p in ring(x)], "g string, x double, y double")
    near = extents.ground_distances(spark.createDataFrame(sides, SEGMENTS), 6000.0)
    got = {r.g: r for r in extents.group_metrics(members, corners, "g", near).collect()}
    assert got["g"].separation_m == pytest.approx(ground(4000.0, 0.0, 9000.0, 0.0), rel=1e-6) and got["h"].separation_m == 0
    assert (got["g"].parts, got["g"].km2, got["g"].largest_share) == (3, 4.0, 0.5)
    assert got["g"].extent_m == pytest.approx(ground(0.0, 0.0, 10000.0, 1000.0), abs=0.5)
    assert got["g"].hull_km2 == pytest.approx(10.0 * 0.9933, rel=1e-3) and got["g"].land_hull_ratio == pytest.approx(4 / got["g"].hull_km2)
    assert {r.g: r.separation_m for r in extents.group_metrics(members, corners, "g").collect()} == {"g": None, "h": 0.0}


def test_names_run_down_a_long_chain_in_few_rounds(spark, monkeypatch):
    rounds = []
    real = rivers.written
    monkeypatch.setattr(rivers, "written", lambda df, name: rounds.append(name) or real(df, name))
    n = 10_000
    table = spark.range(n).selectExpr("concat('br_', id) as branch_id", "array(id) as reach_ids", f"if(id = {n - 1}, 0, id + 1) as next_down_reach").where("branch_id <> 'br_0'")
    seeds = spark.createDataFrame([("br_1", "long"), ("br_7000", "short"), ("br_50", None)], "branch_id string, name string")
    got = {r.branch_id: (r.name, r.steps) for r in rivers.names_downstream(table, seeds).collect()}
    assert got == {f"br_{k}": ("long", k - 1) if k < 7000 else ("short", k - 7000) for k in range(1, n)}
    assert len(rounds) <= 15


def test_names_in_random_networks_and_circles(spark):
    rng = random.Random(3)
    n = 400
    down = {k: rng.choice([0, *range(max(1, k - 6), k)]) for k in range(2, n)} | {1: 0} | {n: n + 1, n + 1: n + 2, n + 2: n}
    seeds = {k: rng.choice("xyz") for k in rng.sample(range(1, n), 40)} | {n + 1: "round"}
    table = spark.createDataFrame([(f"br_{k:04d}", [k], d) for k, d in down.items()], "branch_id string, reach_ids array<long>, next_down_reach long")
    best = {k: (0, v) for k, v in seeds.items()}
    for k in seeds:
        at, steps = down[k], 1
        while at and at not in seeds:
            best[at] = min(best.get(at, (math.inf, "")), (steps, seeds[k]))
            at, steps = down[at], steps + 1
    given = spark.createDataFrame([(f"br_{k:04d}", v) for k, v in seeds.items()], "branch_id string, name string")
    got = {int(r.branch_id[3:]): (r.steps, r.name) for r in rivers.names_downstream(table, given).collect()}
    assert got == {k: best.get(k, (None, None)) for k in down}
    assert {r.name for r in rivers.names_downstream(table, given.where("false")).collect()} == {None}


def test_branches_with_text_ids_go_on_to_edges_hexes_and_cities(spark):
    reaches = spark.createDataFrame([(1, 3, 60.0), (2, 3, 60.0), (3, 0, 150.0)], "reach_id long, next_down long, discharge double")
    member = rivers.branches(reaches).selectExpr("'e1' as edge_id", "branch_id", "concat('river_', branch_id) as river_id", "if(branch_id = 'br_3', null, discharge) as discharge", "width_m as width")
    edge = rivers.game_edges(member).first()
    assert (edge.dominant_river_id, edge.river_count, edge.branch_ids) == ("river_br_1", 3, "br_1|br_2|br_3")
    at = member.selectExpr("'h1' as hex_a", "'h2' as hex_b", "'MEDIUM' as river_class", "discharge", "river_id")
    assert {(r.hex_id, r.primary_river_id) for r in rivers.hex_rivers(at).collect()} == {("h1", "river_br_1"), ("h2", "river_br_1")}
    cities = spark.createDataFrame([("h", "b", "Bb", 5), ("h", "a", "Aa", 5), ("h", "0", "No", None)], "hex_id string, id string, name string, population long")
    assert points.hex_summary(cities).first()[:] == ("h", 3, "a", "Aa")


def test_continuity_authority_carries_a_shape(spark):
    columns = "evidence_id string, subject_id string, source_id string, assertion_type string, valid_from string, valid_to string, locator string, confidence string, geometry_authority string, political_authority string"
    facts = [("e1", "s", "r", "GEOMETRY", "1800-01-01", "1850-01-01", "p. 1", "HIGH", "YES", "NO"), ("e2", "s", "r", "TERRITORIAL_CONTINUITY", "1840-01-01", "1880-01-01", "p. 2", "HIGH", "NO", "NO")]
    table = spark.createDataFrame(facts, columns)
    need = evidence.requirements(spark).where("evidence_role = 'GEOMETRY_SHAPE'").first()
    table = table.replace("GEOMETRY", need.types[0], ["assertion_type"])
    features = spark.createDataFrame([("f", "s", need.feature_role)], "feature_id string, subject_id string, feature_role string")
    links = spark.createDataFrame([("f", "e1", "GEOMETRY_SHAPE"), ("f", "e2", evidence.CONTINUITY)], "feature_id string, evidence_id string, evidence_role string")
    registry = spark.createDataFrame([("r", "PRIMARY")], "source_id string, authority_level string")
    carried = lambda t: "SHAPE_NOT_CARRIED_TO_DAY" not in {r.violation for r in evidence.evaluate(features, links, t, registry, "1870-01-01")[0].collect()}
    assert not carried(table)
    assert carried(table.selectExpr("*", "if(evidence_id = 'e2', 'YES', null) as continuity_authority"))


def test_distances_of_wanted_pairs(spark):
    """Only the pairs that are asked for, by a join that sends no table whole to the driver, however small its file is."""
    rows = [(k, 1000.0 * k, 0.0, 1000.0 * k, 10.0) for k in range(6)]
    lines = spark.createDataFrame(rows, "line_id long, x1 double, y1 double, x2 double, y2 double")
    others = lines.selectExpr("line_id + 50 as line_id", "x1 + 100 as x1", "y1", "x2 + 100 as x2", "y2")
    got = extents.ground_distances(lines, 5000.0, others, "line_id_b = line_id + 50")
    assert sorted((r["a"], r["b"], round(r["distance_m"], 6)) for r in got.collect()) == [(k, k + 50, 100.0) for k in range(6)]
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert extents.ground_distances(lines, 5000.0, others).count() == 35
