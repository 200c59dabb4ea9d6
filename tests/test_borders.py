"""Points on the sides of polygons, on and off the borders of the cells in which they meet."""

import pytest

from hexloom.operators import spatial as sp

box = lambda k, x0, y0, x1, y1, hole=False: (k, hole, [x0, x1, x1, x0], [y0, y0, y1, y1])
RINGS = [
    box(1, 2.0, 2.0, 18.0, 18.0),
    box(2, 10.0, 10.0, 20.0, 20.0),  # its sides are borders of cells
    box(3, 0.0, 0.0, 30.0, 30.0), box(3, 5.0, 5.0, 10.0, 25.0, True),
    (4, False, [0.0, 40.0, 0.0], [0.0, 0.0, 40.0]),
    (5, False, [2.0, 28.0, 28.0, 15.0, 10.0, 5.0, 2.0], [2.0, 2.0, 28.0, 28.0, 12.0, 28.0, 28.0]),  # a notch whose tip is on a border
]
PLACES = [(float(x), float(y)) for x in (0, 1, 2, 5, 7, 10, 12, 18, 20, 25, 30, 40) for y in (0, 2, 5, 8, 10, 12, 18, 20, 25, 30)]


def inside(feature, x, y):
    """By the even-odd rule, and on no side."""
    odd = False
    for _, _, xs, ys in (r for r in RINGS if r[0] == feature):
        for ax, ay, bx, by in zip(xs, ys, xs[1:] + xs[:1], ys[1:] + ys[:1]):
            if (bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
                return False
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


@pytest.fixture(scope="module")
def tables(spark):
    rings = spark.createDataFrame(RINGS, "feature_id long, is_hole boolean, xs array<double>, ys array<double>")
    return spark.createDataFrame([(i, *p) for i, p in enumerate(PLACES)], "id long, x double, y double"), rings


@pytest.mark.parametrize("cell", [10.0, 7.0, 100.0])
def test_a_place_on_a_side_is_outside(tables, cell):
    want = sorted((i, f) for i, p in enumerate(PLACES) for f in range(1, 6) if inside(f, *p))
    assert want and sorted((r.id, r.feature_id) for r in sp.points_in_polygons(*tables, cell, True).collect()) == want
    first = {r.id: r.feature_id for r in sp.first_polygon(*tables, cell, True).collect()}
    assert first == {i: min((f for j, f in want if j == i), default=None) for i in range(len(PLACES))}


def test_a_place_on_a_side_is_near(tables):
    got = {(r.x, r.y): (r.feature_id, r.method, r.distance_m) for r in sp.bind_points(*tables, 10.0, 3.0, True).join(tables[0], "id").collect()}
    assert got[(2.0, 20.0)] == (3, "CONTAINS", 0.0) and got[(0.0, 5.0)] == (3, "NEAREST", 0.0) and got[(40.0, 0.0)] == (4, "NEAREST", 0.0)
