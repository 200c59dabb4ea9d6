"""Invariants of the grid, the kernels and the ids."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.functions import ids
from hexloom.functions.geodesy import dateline_safe, geodesic, haversine
from hexloom.functions.hexgrid import GridSpec, neighbours, steps_between, within
from hexloom.functions.predicates import band_confidence, confidence_rank, ramp, worst_confidence
from hexloom.functions.projection import to_mercator, to_wgs84
from hexloom.operators import checks, control, grid as g, spatial as sp
from hexloom.operators.points import nearest_other, place_points


@pytest.mark.parametrize("spec", [GridSpec(6000.0), GridSpec(750.0, "flat", 10.0, -20.0), GridSpec(33.5)])
def test_cells_and_centres(spark, spec):
    cells = spark.range(-20, 20).select(F.col("id").alias("q")).crossJoin(spark.range(-20, 20).select(F.col("id").alias("r")))
    x, y = spec.centre(F.col("q"), F.col("r"))
    q, r = spec.cell(x + spec.side * 0.4, y - spec.side * 0.4)
    assert cells.where((q != F.col("q")) | (r != F.col("r"))).count() == 0
    near = cells.limit(1).select(F.explode(neighbours(F.col("q"), F.col("r"))).alias("n"), "q", "r")
    assert near.where(steps_between(F.col("n.q"), F.col("n.r"), F.col("q"), F.col("r")) == 1).count() == 6
    assert [cells.limit(1).select(F.size(within(F.col("q"), F.col("r"), k))).first()[0] for k in (0, 1, 2)] == [1, 7, 19]


def test_grid_spec_refuses_nonsense():
    for bad in (dict(flat_to_flat=0), dict(flat_to_flat=1.0, orientation="round")):
        with pytest.raises(ValueError):
            GridSpec(**bad)
    assert GridSpec(6000.0).token == "6000" and GridSpec(33.5).token == "33.5"


@pytest.mark.parametrize("orientation", ["pointy", "flat"])
def test_hexes_covering_tile_the_box(spark, orientation):
    spec = GridSpec(1000.0, orientation)
    cells = {(r.q, r.r) for r in g.hexes_covering(spark, spec, -5000, -4000, 7000, 6000).collect()}
    r = random.Random(1)
    points = spark.createDataFrame([(r.uniform(-5000, 7000), r.uniform(-4000, 6000)) for _ in range(500)], "x double, y double")
    q, s = spec.cell(F.col("x"), F.col("y"))
    assert {(p.q, p.r) for p in points.select(q.alias("q"), s.alias("r")).collect()} <= cells


def test_projection_and_distances(spark):
    rows = [(0.0, 0.0), (139.7, 35.6), (-180.0, -70.0), (179.99, 84.0)]
    df = spark.createDataFrame(rows, "lon double, lat double").select("lon", "lat", *[c.alias(n) for n, c in zip("xy", to_mercator(F.col("lon"), F.col("lat")))])
    lon, lat = to_wgs84(F.col("x"), F.col("y"))
    assert df.where((F.abs(lon - F.col("lon")) > 1e-9) | (F.abs(lat - F.col("lat")) > 1e-9)).count() == 0
    pairs = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (139.7, 35.6, 135.5, 34.7), (5.0, 50.0, 5.0, 50.0), (0.0, 0.0, 179.8, 0.1)], "a double, b double, c double, d double")
    got = [r[0] for r in pairs.select(geodesic("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(111319.491, abs=0.01) and got[1] == pytest.approx(110574.389, abs=0.01) and got[3] == 0
    flat = [r[0] for r in pairs.select(haversine(*map(F.col, "abcd"))).collect()]
    assert got[2] == pytest.approx(flat[2], rel=0.006) and got[4] == pytest.approx(flat[4], rel=0.006)
    west, east = to_mercator(F.lit(-179.9), F.lit(10.0)), to_mercator(F.lit(179.9), F.lit(10.0))
    assert spark.range(1).select(dateline_safe(*west, *east)).first()[0] == pytest.approx(21928, rel=0.01)


def test_edges_are_shared_once(spark):
    cells = spark.createDataFrame([(0, 0), (1, 0), (0, 1)], "q bigint, r bigint")
    edges = g.edge_graph(cells, GridSpec(100.0)).collect()
    assert len(edges) == 15 and sum(e.hex_b is not None for e in edges) == 3
    assert all(e.hex_b is None or e.hex_a < e.hex_b for e in edges) and len({e.edge_id for e in edges if e.hex_b}) == 3
    measured = g.edge_measures(g.edge_graph(cells, GridSpec(100.0)), GridSpec(100.0)).collect()
    assert all(m.length_m == pytest.approx(100 / math.sqrt(3)) for m in measured)


def test_nearest_other_with_copies(spark):
    rows = [(1, "a", 0.0, 0.0), (2, "b", 0.0, 0.0), (3, "c", 0.0, 0.0), (4, "d", 900.0, 0.0), (5, "e", 1e6, 1e6)]
    df = spark.createDataFrame(rows, "id bigint, name string, x double, y double")
    got = {r.id: (r.nearest_id, r.nearest_m) for r in nearest_other(df, 50.0).collect()}
    assert got[1] == (2, 0) and got[2] == (1, 0) and got[3] == (1, 0) and got[4] == (1, 900) and got[5][0] == 4
    assert [r.nearest_id for r in nearest_other(df.where("id = 5"), 50.0).collect()] == [None]


def test_union_area():
    box = lambda x, y, w, h: (np.array([x, x + w, x + w, x], float), np.array([y, y, y + h, y + h], float))
    assert sp.union_area([box(0, 0, 2, 2), box(1, 1, 2, 2), box(0, 0, 2, 2)]) == pytest.approx(7)
    assert sp.union_area([box(0, 0, 1, 1), box(5, 5, 1, 1)]) == pytest.approx(2)
    tilted = (np.array([0.0, 2, 4, 2]), np.array([2.0, 0, 2, 4]))
    assert sp.union_area([tilted, box(0, 0, 4, 4)]) == pytest.approx(16) and sp.union_area([tilted]) == pytest.approx(8)
    assert sp.union_area([]) == 0


def test_clipping_a_concave_ring_and_a_hole(spark):
    rings = spark.createDataFrame([(1, False, [0.0, 4000.0, 4000.0, 2000.0, 0.0], [0.0, 0.0, 4000.0, 1000.0, 4000.0]), (1, True, [1500.0, 2500.0, 2500.0, 1500.0], [200.0, 200.0, 700.0, 700.0])], "feature_id int, is_hole boolean, xs array<double>, ys array<double>")
    for spec in (GridSpec(700.0), GridSpec(5000.0)):
        assert sp.feature_hexes(rings, spec).agg(F.sum("area_m2")).first()[0] == pytest.approx(16e6 - 6e6 - 0.5e6)


def test_same_result_at_any_number_of_partitions(spark):
    points = spark.createDataFrame([(k, f"n{k % 7}", 139 + (k * 37 % 100) / 50, 35 + (k * 53 % 100) / 60, k * 11 % 97) for k in range(400)], "id bigint, name string, lon double, lat double, population bigint")
    from hexloom.operators.points import hex_summary

    found = []
    for n in ("1", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(sorted(map(tuple, hex_summary(place_points(points.repartition(int(n)), GridSpec(6000.0))).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found[0] == found[1]


def test_confidence(spark):
    df = spark.createDataFrame([("a", "HIGH"), ("a", "MEDIUM"), ("b", "HIGH"), ("b", "nonsense"), ("c", None)], "k string, v string")
    assert {r.k: r.w for r in df.groupBy("k").agg(worst_confidence(F.col("v")).alias("w")).collect()} == {"a": "MEDIUM", "b": "UNKNOWN", "c": "UNKNOWN"}
    assert [r[0] for r in df.select(confidence_rank(F.col("v"))).collect()] == [3, 2, 3, 0, 0]
    got = spark.range(1).select(ramp(F.lit(5.0), 0, 10), ramp(F.lit(-5.0), 0, 10), band_confidence(F.lit(2.5), [2.5, 6.0], F.lit(1))).first()
    assert tuple(got) == (0.5, 0.0, 0.0)


def control_tables(spark):
    canonical = spark.createDataFrame([("s", "T", "1", "a", "CONTROLLED", "src"), ("s", "T", "2", "b", "CONTROLLED", "src")], "scenario_id string, target_type string, target_id string, controller string, status string, source_id string")
    provenance = canonical.selectExpr("scenario_id", "target_type", "target_id", "'promo_0' as promotion_id", "'x' as stage", "source_id")
    log = spark.createDataFrame([("promo_0", "s", "x", "PROMOTED", "2024-01-01", 2, 2, 0, None)], "promotion_id string, scenario_id string, stage string, promotion_status string, promoted string, promoted_rows bigint, controlled bigint, unresolved bigint, supersedes string")
    return canonical, provenance, log


def test_promotion_is_idempotent_and_refuses_collisions(spark):
    canonical, provenance, log = control_tables(spark)
    new = spark.createDataFrame([("T", "3", "c", "UNRESOLVED")], "target_type string, target_id string, controller string, status string")
    once = control.promote(canonical, provenance, log, new, "s", "st", "src2", "2024-02-01")
    again = control.promote(*once[:3], new, "s", "st", "src2", "2024-02-01")
    assert once[0].count() == again[0].count() == 3 and again[2].count() == 2
    assert tuple(once[3].first())[1:] == (1, 0) and tuple(again[3].first())[1:] == (0, 1)
    clash = spark.createDataFrame([("T", "2", "c", "CONTROLLED")], new.schema)
    with pytest.raises(ValueError, match="another promotion"):
        control.promote(canonical, provenance, log, clash, "s", "st", "src2", "2024-02-01")
    with pytest.raises(ValueError, match="several rows"):
        control.promote(canonical, provenance, log, new.unionByName(new), "s", "st", "src2", "2024-02-01")
    with pytest.raises(ValueError, match="reviewed"):
        control.promote(canonical, provenance, log, new, "s", "st", "src2", "2024-02-01", review_status="STAGED")


def test_missing_control_is_not_neutral(spark):
    targets = spark.createDataFrame([("1", "u"), ("9", "u"), ("9", "v"), ("9", None)], "target_id string, unit string")
    canonical, *_ = control_tables(spark)
    coverage = spark.createDataFrame([("u", "COMPLETE"), ("v", "PARTIAL")], "unit string, coverage string")
    got = sorted(r.status for r in control.resolve_status(targets, canonical, coverage).collect())
    assert got == ["CONTROLLED", "UNCONTROLLED", "UNKNOWN_COVERAGE_INCOMPLETE", "UNKNOWN_COVERAGE_INCOMPLETE"]
    with pytest.raises(Exception, match="incomplete coverage"):
        control.resolve_status(targets, canonical, coverage, strict=True).collect()


def test_intervals_with_gaps(spark):
    rows = [("a", "2000-01-01", "2005-01-01"), ("a", "2005-01-01", "2010-01-01"), ("b", "2000-01-01", "2004-01-01"), ("b", "2005-01-01", "2010-01-01"), ("c", "UNKNOWN", "2010-01-01"), ("d", None, None), ("e", "1990-01-01", "2011-01-01")]
    df = spark.createDataFrame(rows, "k string, valid_from string, valid_to string")
    got = {r.k: r.covered for r in control.covers_without_gap(df, ["k"], F.lit("2001-01-01"), F.lit("2009-01-01")).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False, "e": True}


def test_hash_ignores_the_order_of_rows_only(spark):
    df = spark.range(50).select("id", (F.col("id") % 7).alias("v"))
    one, two = (ids.frame_hash(d).first()["content_sha256"] for d in (df, df.orderBy(F.desc("id")).repartition(5)))
    assert one == two != ids.frame_hash(df.where("id <> 3")).first()["content_sha256"]
    assert ids.frame_hash(df.union(df)).first()["rows"] == 100


def test_capped_clusters(spark):
    nodes = spark.createDataFrame([(k, 100.0 * k, 0.0) for k in range(6)], "id bigint, x double, y double")
    edges = spark.createDataFrame([(k, k + 1, 100.0) for k in range(5)], "a bigint, b bigint, distance_m double")
    got = {r.id: r.cluster for r in checks.capped_clusters(nodes, edges, 150.0, 250.0).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}
