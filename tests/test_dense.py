"""Searches where points and shapes lie many times closer than the limit: a row meets what is around it, not all within the limit."""

import numpy as np

from hexloom.operators import points as p
from hexloom.operators import spatial as sp


def spread(seed: int, n: int, side: float) -> list[tuple]:
    g = np.random.default_rng(seed)
    return [(i, float(x), float(y)) for i, (x, y) in enumerate(g.uniform(0, side, (n, 2)))]


def test_width_follows_the_density(spark):
    df = spark.createDataFrame(spread(1, 400, 1000.0), "id long, x double, y double")
    assert 40 < p.first_width(df, 1e6) < 60
    assert p.first_width(df, 7.0) == 7.0
    assert p.first_width(df.limit(1), 5.0) == 5.0


def test_nearest_within_of_dense_targets(spark):
    targets, asked = spread(2, 3000, 1000.0), [*spread(3, 200, 1000.0), (900, 1000.0 + 450, 500.0), (901, 5000.0, 0.0), (902, None, 1.0)]
    # The first target once more, with a larger and with a smaller name.
    targets = [(i + 10, x, y) for i, x, y in targets] + [(99_999, *targets[0][1:]), (1, *targets[0][1:])]
    out = p.nearest_within(spark.createDataFrame(asked, "id long, x double, y double"), spark.createDataFrame(targets, "target long, x double, y double"), 600.0)
    got = {r["id"]: (r["target"], r["distance_m"]) for r in out.collect()}
    at = np.array([t[1:] for t in targets])
    for i, x, y in asked:
        m = np.hypot(at[:, 0] - x, at[:, 1] - y) if x is not None else np.array([np.inf])
        if m.min() > 600:
            assert got[i] == (None, None)
        else:
            best = min(t[0] for t, d in zip(targets, m) if d == m.min())
            assert got[i][0] == best and abs(got[i][1] - m.min()) < 1e-9
    assert len(got) == len(asked)


def test_nearest_segment_of_dense_lines(spark):
    g = np.random.default_rng(4)
    a, b = g.uniform(0, 1000, (300, 2)), g.uniform(0, 1000, (300, 2))
    lines = [(i, *map(float, (*u, *v))) for i, (u, v) in enumerate(zip(a, b))] + [(400, 100.0, 2000.0, 100.0, 2500.0), (401, 3000.0, 7.0, 3400.0, 7.0)]
    asked = [*spread(5, 500, 1000.0), (900, 300.0, 2300.0), (901, 3200.0, 590.0), (902, 9000.0, 0.0)]
    out = sp.nearest_segment(spark.createDataFrame(asked, "id long, x double, y double"), spark.createDataFrame(lines, "line_id long, x1 double, y1 double, x2 double, y2 double"), 600.0)
    got = {r["id"]: (r["line_id"], r["distance_m"]) for r in out.collect()}
    s = np.array([v[1:] for v in lines])
    d = s[:, 2:] - s[:, :2]
    for i, x, y in asked:
        t = np.clip(((x - s[:, 0]) * d[:, 0] + (y - s[:, 1]) * d[:, 1]) / (d**2).sum(axis=1), 0, 1)
        m = np.hypot(x - s[:, 0] - t * d[:, 0], y - s[:, 1] - t * d[:, 1])
        assert got[i] == (None, None) if m.min() > 600 else (got[i][0] == lines[int(m.argmin())][0] and abs(got[i][1] - m.min()) < 1e-9)
    assert len(got) == len(asked)


def test_features_over_a_full_cell_are_left_out(spark):
    """Of 40 features over one place only those before the first that fills the cell meet a point; parts that are no box, a hole and two parts of one feature keep their rule."""
    box = lambda k, x0, y0, x1, y1, hole=False: (k, hole, [x0, x1, x1, x0], [y0, y0, y1, y1])
    rings = [box(k, -5.0, -5.0, 25.0, 25.0) for k in range(10, 50)]
    rings += [box(3, 0.0, 0.0, 8.0, 8.0), box(3, 2.0, 2.0, 6.0, 6.0, True), (5, False, [0.0, 9.0, 0.0], [0.0, 0.0, 9.0]), box(7, 10.0, 0.0, 11.0, 2.0), box(7, 12.0, 0.0, 13.0, 2.0)]
    df = spark.createDataFrame(rings, "feature_id long, is_hole boolean, xs array<double>, ys array<double>")
    places = [(0, 1.0, 1.0), (1, 4.0, 4.0), (2, 7.0, 7.5), (3, 9.5, 9.5), (4, 10.5, 1.0), (5, 11.5, 1.0), (6, 12.5, 1.0), (7, 40.0, 1.0), (8, 0.0, 0.0), (9, 8.0, 8.0)]
    at = spark.createDataFrame(places, "id long, x double, y double")
    first = {r["id"]: r["feature_id"] for r in sp.first_polygon(at, df, 10.0).collect()}
    assert first == {0: 3, 1: 5, 2: 3, 3: 10, 4: 7, 5: 10, 6: 7, 7: None, 8: 3, 9: 10}
    pairs = sorted((r["id"], r["feature_id"]) for r in sp.points_in_polygons(at, df, 10.0).collect())
    every = list(range(10, 50))
    want = {0: [3, 5], 1: [5], 2: [3], 3: [], 4: [7], 5: [], 6: [7], 8: [3, 5], 9: []}
    assert pairs == sorted((i, f) for i, own in want.items() for f in own + every)
    cells = sp._cells_of_features(df, 10.0).where("cx = 0 and cy = 0")
    assert cells.where("is_full").count() == 40 and cells.where("not is_box").count() == 2
