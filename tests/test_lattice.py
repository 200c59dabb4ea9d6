"""Paths of many branches at once against the search of one corridor, and what is written for them."""

import numpy as np
from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import lattice
from hexloom.operators import snapping as o

GRID = GridSpec(3000.0)
REACH, SCALE = 6000.0, 3000.0


def rivers(spark, n):
    g = np.random.default_rng(7)
    rows = [(str(b), k, float(x), float(y)) for b in range(n) for k, (x, y) in enumerate(np.cumsum(g.normal(0, 5000, (6, 2)), 0) + g.uniform(-40_000, 40_000, 2))]
    vertices = spark.createDataFrame(rows, "branch string, k int, x double, y double")
    branches = spark.createDataFrame([(str(b), str(b // 3) if b else None, 1.0 / (b + 1)) for b in range(n)], "branch string, receiver string, discharge double")
    q, r = GRID.cell(F.col("x"), F.col("y"))
    return vertices, branches, vertices.where("k = 2").select(GRID.hex_id(q, r).alias("hex_id")).unionByName(vertices.where("k = 3").select(GRID.hex_id(q, r).alias("hex_id"))).distinct()


def test_groups_of_lines_have_the_paths_of_single_corridors(spark, monkeypatch):
    """Corridors, tangents, costs and searches of whole groups are those of the tables of edges and the search of one branch."""
    vertices, _, water = rivers(spark, 24)
    alone = vertices.select("branch").distinct().select("branch", F.lit(None).cast("string").alias("receiver"), F.lit(1.0).alias("discharge"))
    edges = o.corridor(vertices, GRID, REACH)
    edges = o.costs(edges.join(o.tangents(vertices, edges, ["n1", "n2"]), ["branch", "n1", "n2"]), GRID, water, SCALE)
    nodes = edges.select("branch", F.explode(F.array("n1", "n2")).alias("node")).distinct().join(o.ends(vertices), "branch")
    starts = o.nearest_nodes(nodes.withColumns({"to_x": F.col("from_x"), "to_y": F.col("from_y")}), GRID)
    want = o.searched(o.flagged(edges, starts, o.nearest_nodes(nodes, GRID)), o.SAME_TURN * GRID.side)
    rows = lambda df: sorted((r.branch, r.step, tuple(r.node), r.n1 and tuple(r.n1), r.n2 and tuple(r.n2), round(r.cost, 5)) for r in df.collect())
    want = rows(want)
    assert len({r[0] for r in want}) == 24
    for cells in (1, 4000, 10**9):
        monkeypatch.setattr(o, "CELLS", cells)
        assert rows(o.snap(vertices, alone, water, GRID, REACH, SCALE)) == want


def test_no_edge_of_a_corridor_is_written(spark, monkeypatch):
    """Every table between rounds has at most a row for each branch."""
    sizes = []

    def counted(df, name):
        out = written(df, name)
        sizes.append((name, out.count()))
        return out

    written = o.written
    monkeypatch.setattr(o, "written", counted)
    vertices, branches, water = rivers(spark, 20)
    paths = o.snap_lists(vertices, branches, water, GRID, REACH, SCALE)
    assert o.path_metrics(paths, vertices, GRID, REACH).count() == 20
    assert o.extend_mouths(paths, branches, vertices.select(F.floor(F.col("x") / 9000).alias("q"), F.floor(F.col("y") / 9000).alias("r")).distinct(), GRID).count() >= 0
    assert {"lines", "paths", "extensions"} <= {n for n, _ in sizes} and max(n for _, n in sizes) <= 20


def test_edges_that_follow_turn_both_ways():
    assert lattice.AFTER[..., 2].min() >= 0 and (lattice.AFTER[:, :, 0] != lattice.AFTER[:, :, 1]).any(axis=2).all()
