"""Queries over their whole table against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hexloom.operators import authority, checks, extents
from hexloom.operators import spatial as kernels
from hexloom.plans import registry, spatial, terrain
from hexloom.sources import tables

registry.load()


def union_find(edges):
    over = {}

    def top(x):
        over.setdefault(x, x)
        while over[x] != x:
            over[x] = over[over[x]]
            x = over[x]
        return x

    for a, b in edges:
        p, q = sorted((top(a), top(b)))
        over[q] = p
    return Counter(top(x) for x in over)


def test_components_of_all_rows(spark, tmp_path):
    rows = [(1, 1, 1), (2, 1, 30), (2, 2, 40), (7, 5, 2), (8, 5, 50), (9, 6, 50), (9, 6, 50)]
    spark.createDataFrame(rows, "l_partkey long, l_suppkey long, l_quantity long").write.parquet(f"{tmp_path}/lineitem.parquet")
    run = lambda d: {r.component: r.nodes for r in registry.QUERIES["g07_components"](spark, d).collect()}
    assert run(tmp_path) == {1: 4, 7: 3, 9: 2}
    sf = "/root/testdata/sf0.001"
    edges = [(r.a, r.b) for r in spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_partkey as a", "1000000 + l_suppkey as b").collect()]
    assert run(sf) == dict(union_find(edges))


def test_whole_grid_is_filled(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.row, r.col): r.elev for r in registry.QUERIES["s11_filled"](spark, sf).collect()}
    laid = {(r.row, r.col): round(r.elev, 4) for r in terrain.laid(spark, sf).collect()}
    assert got == {(i, j): laid.get((i, j), 0.0) for i in range(512) for j in range(512)}


def union_area(boxes):
    xs, ys = sorted({x for b in boxes for x in b[:2]}), sorted({y for b in boxes for y in b[2:]})
    cells = ((x0, x1, y0, y1) for x0, x1 in zip(xs, xs[1:]) for y0, y1 in zip(ys, ys[1:]))
    return sum((x1 - x0) * (y1 - y0) for x0, x1, y0, y1 in cells if any(a <= x0 and x1 <= b and c <= y0 and y1 <= d for a, b, c, d in boxes))


def test_union_of_all_features(spark):
    sf = "/root/testdata/sf0.001"
    pairs = defaultdict(list)
    for r in spatial.boxes(spark, sf).collect():
        pairs[r.feature_id // 2] += [(r.cx - r.hx, r.cx + r.hx, r.cy - r.hy, r.cy + r.hy), (r.cx - 100, r.cx + r.hx * 1.5, r.cy - 50, r.cy + r.hy * 1.2)]
    got = {r.pair: r.area_m2 for r in registry.QUERIES["j06_union_in_hexes"](spark, sf).collect()}
    assert got == pytest.approx({p: union_area(b) for p, b in pairs.items()}, rel=1e-6)


def kruskal(points, edges, limit, cap):
    own = {i: i for i, _, _ in points}
    groups = {i: [i] for i in own}
    at = {i: (x, y) for i, x, y in points}
    for m, a, b in sorted(edges):
        p, q = own[a], own[b]
        if m > limit or p == q:
            continue
        both = groups[p] + groups[q]
        if max(math.dist(at[i], at[j]) for i in both for j in both) <= cap:
            for i in groups.pop(q):
                own[i] = p
            groups[p] = both
    return {i: min(groups[p]) for i, p in own.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_capped_clusters_against_edge_by_edge(spark, seed):
    r = random.Random(seed)
    points = [(i, r.random() * 60 + (100 if i % 7 == 0 else 0), r.random() * 60) for i in range(90)] + [(95, 500.0, 500.0)]
    edges = [(round(math.dist(a[1:], b[1:])), a[0], b[0]) for a in points for b in points if a[0] < b[0] and math.dist(a[1:], b[1:]) < 14]  # many ties
    nodes = spark.createDataFrame(points, "id long, x double, y double")
    df = spark.createDataFrame([(a, b, float(m)) for m, a, b in edges], "a long, b long, distance_m double")
    got = {row.id: row.cluster for row in checks.capped_clusters(nodes, df, 12.0, 25.0).collect()}
    assert got == kruskal(points, edges, 12.0, 25.0)
    assert {row.id: row.cluster for row in checks.capped_clusters(nodes, df.where("a < 0"), 12.0, 25.0).collect()} == {i: i for i, _, _ in points}


def test_binding_of_holders_to_cells(spark):
    sf = "/root/testdata/sf0.001"
    nation = {r.s_suppkey: r.s_nationkey for r in spark.read.parquet(f"{sf}/supplier.parquet").collect()}
    boxes = [(nation[r.feature_id], r.cx - r.hx, r.cy - r.hy, r.cx + r.hx, r.cy + r.hy) for r in spatial.boxes(spark, sf).collect()]
    side = 6000 / math.sqrt(3)
    got = registry.QUERIES["j29_hex_binding"](spark, sf).collect()
    assert len(got) > 5
    for row in got:
        q, r = (int(x) for x in re.findall(r"[qr]([+-]\d+)", row.hex_id))
        cx, cy = 6000 * (q + r / 2), 1.5 * side * r
        hexagon = [np.array([cx + side * math.cos(math.radians(60 * k - 30)) for k in range(6)]), np.array([cy + side * math.sin(math.radians(60 * k - 30)) for k in range(6)])]
        land = defaultdict(list)
        for n, x0, y0, x1, y1 in boxes:
            land[n].append(kernels.clip_convex(np.array([x0, x1, x1, x0]), np.array([y0, y0, y1, y1]), *hexagon))
        areas = {n: kernels.union_area([p for p in parts if len(p[0]) > 2]) for n, parts in land.items()}
        areas = sorted(((m, -n) for n, m in areas.items() if m > 1e-6), reverse=True)
        assert row.polity_id == -areas[0][1] and row.area_m2 == pytest.approx(areas[0][0], abs=0.2) and row.holders == len(areas)
        assert row.runner_up == pytest.approx(areas[1][0] if len(areas) > 1 else 0.0, abs=0.2)


def test_unchanged_files_are_not_read(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / n).write_text(n)
    first = tables.file_manifest(spark, str(tmp_path))
    known = spark.createDataFrame(first.withColumn("sha256", first["path"]).collect(), first.schema)  # hashes that no file has
    (tmp_path / "c").write_text("c")
    again = {r.path[-1]: r.sha256 for r in tables.file_manifest(spark, str(tmp_path), known).collect()}
    assert again["a"].endswith("/a") and again["b"].endswith("/b") and len(again["c"]) == 64
    assert tables.file_manifest(spark, str(tmp_path), tables.file_manifest(spark, str(tmp_path))).count() == 3


def test_empty_and_null_rows_of_authority_tables(spark):
    cells = spark.createDataFrame([], "hex_id string, owner string")
    assert authority.anchored_owners(cells).count() == 0
    assert authority.gates(spark.createDataFrame([(None,)], "n long"), [("g", "n", ">=", 0)]).first()["passed"] is False
    hulls = spark.createDataFrame([(1, 0.0, 0.0), (1, 3.0, 4.0), (1, 1.0, 1.0), (2, 5.0, 5.0), (2, 5.0, 5.0), (None, 1.0, 1.0), (3, None, 1.0)], "g long, x double, y double")
    assert {r.g: r.extent_projected_m for r in extents.group_extents(hulls, "g").collect()} == {1: 5.0, 2: 0.0}
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 50.0, 0.0)], "id long, x double, y double")
    none = spark.createDataFrame([], "case_id long, x double, y double, radius_m double")
    assert authority.outside_exclusions(places, none).count() == 2
