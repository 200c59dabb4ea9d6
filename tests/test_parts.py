"""Parts of rings in cells against a clip of the whole ring by every cell of its box."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import parts as pt
from hexloom.operators import spatial as sp

GRID = GridSpec(1000.0)


def star(rng, cx, cy, size, n):
    """A simple ring with ``n`` corners at random distances around a place."""
    turn = np.sort(rng.uniform(0, 2 * np.pi, n))
    far = rng.uniform(0.3, 1, n) * size
    return cx + far * np.cos(turn), cy + far * np.sin(turn)


def by_brute_force(x, y):
    h = pt.Hexagons(GRID)
    i0, i1, j0, j1 = h.around(x.min(), y.min(), x.max(), y.max())
    found = {}
    for i in range(i0 - 1, i1 + 2):
        for j in range(j0 - 1, j1 + 2):
            area = abs(pt.ring_area(*pt.clip_convex(x, y, *h.whole(i, j))))
            if area > 1e-6:
                found[h.names(i, j)] = area
    return found


@pytest.fixture(scope="module")
def shapes():
    rng = np.random.default_rng(7)
    out = [star(rng, rng.uniform(-9e4, 9e4), rng.uniform(-9e4, 9e4), 10 ** rng.uniform(1.5, 4.3), int(rng.integers(3, 60))) for _ in range(25)]
    out.append((np.array([-2e4, 2e4, 2e4, -2e4]), np.array([-1.5e4, -1.5e4, 1.5e4, 1.5e4])))
    return out


def frame(spark, shapes, extra=()):
    rows = [(f"f{k}", False, x.tolist(), y.tolist()) for k, (x, y) in enumerate(shapes)]
    return spark.createDataFrame([*rows, *extra], "feature_id string, is_hole boolean, xs array<double>, ys array<double>")


def test_areas_in_hexes(spark, shapes):
    got = {}
    for r in sp.feature_hexes(frame(spark, shapes), GRID).collect():
        if r.area_m2 > 1e-6:
            got.setdefault(r.feature_id, {})[r.q, r.r] = r.area_m2
    for k, (x, y) in enumerate(shapes):
        assert got[f"f{k}"] == pytest.approx(by_brute_force(x, y), rel=1e-7, abs=1e-5)


def test_rings_without_parts_and_holes(spark):
    nan, inf = float("nan"), float("inf")
    hole = [("a", True, [100.0, 300.0, 300.0, 100.0, 100.0], [100.0, 100.0, 300.0, 300.0, 100.0]), (None, False, [0.0, 10.0, 10.0], [0.0, 0.0, 10.0])]
    bad = [("b", False, None, None), ("c", False, [0.0, 1.0], [0.0, 1.0]), ("d", False, [0.0, None, 5.0], [0.0, 1.0, 5.0]), ("e", False, [0.0, nan, 5.0], [0.0, 1.0, 5.0]), ("f", False, [0.0, inf, 5.0], [0.0, 1.0, 5.0]), ("g", False, [0.0, 1.0, 2.0], [0.0, 1.0]), ("h", False, [], []), ("i", False, [5.0, 5.0, 5.0], [1.0, 2.0, 3.0])]
    df = frame(spark, [(np.array([-5e3, 5e3, 5e3, -5e3]), np.array([-5e3, -5e3, 5e3, 5e3]))], [*hole, *bad]).withColumn("feature_id", F.when(F.col("feature_id") == "f0", "a").otherwise(F.col("feature_id")))
    got = {r.feature_id: r.m for r in sp.feature_hexes(df, GRID).groupBy("feature_id").agg(F.sum("area_m2").alias("m")).collect()}
    assert got == {"a": pytest.approx(1e8 - 4e4), None: pytest.approx(50)}
    assert sp.feature_hexes(df.limit(0), GRID).count() == 0


def test_null_whole_ids_stay_whole(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big, False, [0.0, 5e3, 5e3], [0.0, 0.0, 5e3]), (None, False, [0.0, 5e3, 5e3], [0.0, 0.0, 5e3])], "feature_id bigint, is_hole boolean, xs array<double>, ys array<double>")
    assert {r.feature_id for r in sp.feature_hexes(df, GRID).collect()} == {big, None}


def test_points_against_whole_rings(spark, shapes):
    rng = np.random.default_rng(3)
    px, py = rng.uniform(-1e5, 1e5, 4000), rng.uniform(-1e5, 1e5, 4000)
    points = spark.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(zip(px, py))], "id int, x double, y double")
    got = {(r.id, r.feature_id) for r in sp.points_in_polygons(points, frame(spark, shapes), 700.0).collect()}
    expected = set()
    for k, (x, y) in enumerate(shapes):
        x2, y2 = np.roll(x, -1), np.roll(y, -1)
        crossed = ((y > py[:, None]) != (y2 > py[:, None])) & (px[:, None] < (x2 - x) * (py[:, None] - y) / np.where(y2 == y, 1, y2 - y) + x)
        expected |= {(int(i), f"f{k}") for i in np.flatnonzero(crossed.sum(1) % 2)}
    assert got == expected and expected


def test_sides_of_cells_belong_to_the_upper_cell(spark):
    square = [(np.array([0.0, 2000.0, 2000.0, 0.0]), np.array([0.0, 0.0, 2000.0, 2000.0]))]
    places = [(0, 0.0, 0.0, True), (1, 1000.0, 1000.0, True), (2, 1000.0, 0.0, True), (3, 0.0, 1000.0, True), (4, 2000.0, 500.0, False), (5, 500.0, 2000.0, False), (6, 1000.0, 1999.0, True)]
    points = spark.createDataFrame([p[:3] for p in places], "id int, x double, y double")
    got = {r.id for r in sp.points_in_polygons(points, frame(spark, square), 1000.0).collect()}
    assert got == {p[0] for p in places if p[3]}


def test_a_long_ring(spark):
    """100,000 corners over about 40,000 hexes: each cell gets its own part, and the areas add up."""
    n = 100_000
    turn = 2 * np.pi * np.arange(n) / n
    far = 1e5 * (1 + 0.05 * np.sin(900 * turn))
    ring = [(far * np.cos(turn), far * np.sin(turn))]
    got = sp.feature_hexes(frame(spark, ring), GRID).agg(F.sum("area_m2").alias("m"), F.count("*").alias("n")).first()
    assert got.m == pytest.approx(pt.ring_area(*ring[0]), rel=1e-9) and got.n > 30_000
    widest = pt.hex_parts(frame(spark, ring), ["feature_id"], GRID).agg(F.max(F.size("xs"))).first()[0]
    assert widest < 1000
    assert sp.ring_faults(frame(spark, ring)).count() == 0


def test_overlaps_and_unions(spark, shapes):
    rng = np.random.default_rng(11)
    near = [star(rng, rng.uniform(0, 8e3), rng.uniform(0, 8e3), 4e3, 20) for _ in range(6)]
    got = {(r.a, r.b): r.overlap_m2 for r in sp.overlaps(frame(spark, near), GRID).collect()}
    for i in range(6):
        for j in range(i + 1, 6):
            both = pt.ring_area(*near[i]) + pt.ring_area(*near[j]) - sp.union_area([near[i], near[j]])
            assert got.get((f"f{i}", f"f{j}"), 0.0) == pytest.approx(both, rel=1e-6, abs=1e-2)
    copies = frame(spark, [*near, *near])
    assert sp.union_in_hexes(copies, GRID).agg(F.sum("area_m2")).first()[0] == pytest.approx(sp.union_area(near), rel=1e-9)


def test_crossing_sides():
    rng = np.random.default_rng(5)
    for _ in range(200):
        x, y = rng.integers(0, 12, 7).astype(float), rng.integers(0, 12, 7).astype(float)
        x2, y2 = np.roll(x, -1), np.roll(y, -1)
        turn = lambda a, b, c, d, e, f: np.sign((c - a) * (f - b) - (d - b) * (e - a))
        brute = any(
            turn(x[i], y[i], x2[i], y2[i], x[j], y[j]) * turn(x[i], y[i], x2[i], y2[i], x2[j], y2[j]) < 0
            and turn(x[j], y[j], x2[j], y2[j], x[i], y[i]) * turn(x[j], y[j], x2[j], y2[j], x2[i], y2[i]) < 0
            for i in range(7) for j in range(i)
        )
        assert sp._crosses(x, y) == brute


def test_lakes_memberships_and_components(spark, shapes):
    """What a hex and a feature get from their shares, against sums over the clips of whole rings."""
    some = shapes[:12] + shapes[:1]  # one shape twice, so that ties of area are met
    each = {f"f{k}": by_brute_force(*s) for k, s in enumerate(some)}
    cells = {c for v in each.values() for c in v}
    shares = sp.feature_hexes(frame(spark, some), GRID).where("area_m2 > 1e-6")
    lakes = {(r.q, r.r): r for r in sp.hex_lakes(shares, GRID).collect()}
    found = {(r.feature_id, r.q, r.r): r for r in sp.memberships(shares, GRID).collect()}
    assert set(lakes) == cells and set(found) == {(f, *c) for f, v in each.items() for c in v}
    for c in cells:
        own = {f: v[c] for f, v in each.items() if c in v}
        assert lakes[c].lake_fraction == pytest.approx(min(1, sum(own.values()) / GRID.area), rel=1e-6, abs=1e-9)
        assert lakes[c].lake_ids == "|".join(sorted(own))
        most = max(own.values())
        near = {f for f, m in own.items() if m > most - 1e-5}
        assert lakes[c].primary_lake in near and [f for f in own if found[(f, *c)].is_dominant] == [lakes[c].primary_lake]
        if "f0" in near and "f12" in near:
            assert lakes[c].primary_lake != "f12"  # copies: the smaller id
        for f, m in own.items():
            assert found[(f, *c)].share_of_covered == pytest.approx(m / sum(own.values()), rel=1e-4) and found[(f, *c)].share_of_hex == pytest.approx(m / GRID.area, rel=1e-4, abs=1e-12)
    land = sp.land_classes(shares.select("q", "r").distinct(), shares, GRID, 0.3)
    is_land = {c: sum(v.get(c, 0) for v in each.values()) / GRID.area >= 0.3 for c in cells}
    assert {(r.q, r.r): r.land_class == "land" for r in land.collect()} == is_land
    for r in sp.component_stats(shares, land).collect():
        own = each[r.feature_id]
        assert r.hexes == len(own) and r.area_m2 == pytest.approx(sum(own.values())) and r.represented == any(is_land[c] for c in own)
        assert own[tuple(r.primary_hex)] == pytest.approx(max(own.values()))


def test_only_cells_with_several_borders_are_united_in_python(spark, monkeypatch):
    """Two boxes that fill most of their cells: the rows of a cell go to Python as one batch, not as one group each, and cells held whole add up."""
    from hexloom.functions.hexgrid import GridSpec
    from hexloom.operators import spatial

    grid = GridSpec(1000.0)
    rows = [(1, [0.0, 20_000.0, 20_000.0, 0.0], [0.0, 0.0, 9_000.0, 9_000.0]), (1, [-300.0, 12_000.0, 12_000.0, -300.0], [-700.0, -700.0, 5_000.0, 5_000.0]), (2, [5e4, 5.1e4, 5.1e4, 5e4], [0.0, 0.0, 700.0, 700.0])]
    table = spark.createDataFrame([(k, False, x, y) for k, x, y in rows], "k int, is_hole boolean, xs array<double>, ys array<double>")
    plan = spatial.union_in_hexes(table, grid, ["k"])
    assert "FlatMapGroupsInPandas" not in plan._jdf.queryExecution().toString()
    got = {r.k: r.m for r in plan.groupBy("k").agg({"area_m2": "sum"}).withColumnRenamed("sum(area_m2)", "m").collect()}
    assert abs(got[1] - (20_000 * 9_000 + 12_300 * 5_700 - 12_000 * 5_000)) < 1e-3 and abs(got[2] - 700_000) < 1e-6
