"""Overlaps of many features, of two layers, and cuts of rings with few corners."""

import numpy as np

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import parts
from hexloom.operators import spatial as sp

SCHEMA = "feature_id long, is_hole boolean, xs array<double>, ys array<double>"


def box(k, x0, y0, x1, y1):
    return k, False, [x0, x1, x1, x0], [y0, y0, y1, y1]


def test_overlaps_of_two_layers(spark):
    """Only pairs of a feature of each table, also where names are alike; boxes by their sides, a triangle by its outline."""
    one = spark.createDataFrame([box(1, 0.0, 0.0, 950.0, 730.0), box(2, 10.0, 10.0, 1000.0, 1000.0)], SCHEMA)
    two = spark.createDataFrame([box(1, 500.0, 500.0, 1200.0, 1300.0), (3, False, [0.0, 100.0, 0.0], [0.0, 0.0, 100.0]), box(4, 2000.0, 0.0, 2100.0, 10.0)], SCHEMA)
    got = {(r["a"], r["b"]): r["overlap_m2"] for r in sp.overlaps(one, GridSpec(100.0), 1.0, two).collect()}
    want = {(1, 1): 450.0 * 230.0, (2, 1): 500.0**2, (1, 3): 5000.0, (2, 3): 80.0**2 / 2}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-6 for k, v in want.items())


def test_cells_are_as_wide_as_simple_rings(spark):
    grid = GridSpec(10.0)
    assert sp._overlap_width(spark.createDataFrame([box(1, 0.0, 0.0, 40.0, 20.0)], SCHEMA), grid) == 30.0
    turn = np.linspace(0, 6, 50)
    assert sp._overlap_width(spark.createDataFrame([(1, False, np.cos(turn).tolist(), np.sin(turn).tolist())], SCHEMA), grid) == 10.0


def test_few_corners_are_cut_like_many(monkeypatch):
    """The lists give the numbers that the arrays give, to the last digit."""
    g = np.random.default_rng(9)
    hexagon = parts.Hexagons(GridSpec(30.0)).whole(0, 0)
    for _ in range(300):
        n = int(g.integers(3, 9))
        x, y = g.uniform(-25, 25, n), g.uniform(-25, 25, n)
        frame = (-10.0, -12.5, *g.uniform(-5, 15, 2))
        monkeypatch.setattr(parts, "FEW", 24)
        few = parts.cut_to_box(x, y, frame), parts.clip_convex(x, y, *hexagon)
        monkeypatch.setattr(parts, "FEW", 0)
        many = parts.cut_to_box(x, y, frame), parts.clip_convex(x, y, *hexagon)
        for a, b in zip(few, many):
            assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()


def test_boxes_meet_as_blocks(spark, monkeypatch):
    """Boxes of many sizes beside a triangle, a closed box, a feature of two boxes and a hole, in small blocks: each pair once, with the area of the whole; links tie the same components."""
    monkeypatch.setattr(sp, "BOXES", 16)
    g = np.random.default_rng(3)
    rows = [box(k, float(x), float(y), float(x + w), float(y + h)) for k, (x, y, w, h) in enumerate(np.stack([*g.uniform(-500, 500, (2, 150)), *g.exponential(30, (2, 150)) + 1], 1))]
    rows += [box(200, -600.0, -600.0, 0.0, 600.0), box(201, 90.0, 90.0, 99.0, 99.0), box(201, 10.0, 10.0, 20.0, 20.0), (202, False, [0.0, 100.0, 0.0], [0.0, 0.0, 100.0])]
    rows += [(203, False, [5.0, 50.0, 50.0, 5.0, 5.0], [5.0, 5.0, 50.0, 50.0, 5.0]), (1, True, [0.0, 1.0, 1.0], [0.0, 0.0, 1.0])]
    rows += [(204, False, [0.0, 9.0, None, 0.0], [0.0, 0.0, 9.0, 9.0]), (205, False, [0.0, 9.0, 9.0, 0.0], [0.0, 9.0, 0.0, 9.0]), (None, False, [0.0, 9.0, 9.0, 0.0], [0.0, 0.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = sp.overlaps(df, GridSpec(100.0), 1.0).collect()
    got = {(r["a"], r["b"]): r["overlap_m2"] for r in out}
    plain = {k: (min(x), max(x), min(y), max(y)) for k, hole, x, y in rows if not hole and k not in (201, 202, 204, 205, None)}
    area = lambda p, q: max(0.0, min(p[1], q[1]) - max(p[0], q[0])) * max(0.0, min(p[3], q[3]) - max(p[2], q[2]))
    want = {(a, b): area(plain[a], plain[b]) for a in plain for b in plain if a < b and area(plain[a], plain[b]) > 1}
    for k, p in plain.items():
        both = area(p, (90.0, 99.0, 90.0, 99.0)) + area(p, (10.0, 20.0, 10.0, 20.0))
        if both > 1:
            want[(min(k, 201), max(k, 201))] = both
    simple = {k: v for k, v in got.items() if not {202, 205} & set(k)}
    assert len(out) == len(got) and simple.keys() == want.keys() and all(abs(simple[k] - v) < 1e-6 for k, v in want.items())
    assert abs(got[(202, 203)] - (45.0**2 - (max(0, 50 + 50 - 100)) ** 2 / 2)) < 1e-6

    def parts(pairs):
        of = {}
        for a, b in pairs:
            for k in (a, b):
                of.setdefault(k, {k})
            if of[a] is not of[b]:
                of[a] |= of[b]
                for k in of[b]:
                    of[k] = of[a]
        return {frozenset(v) for v in of.values()}

    links = [(r["a"], r["b"]) for r in sp.overlaps(df, GridSpec(100.0), 1.0, links=True).collect()]
    assert parts(links) == parts(got) and any(len(p) > 5 for p in parts(got))


def test_links_are_few(spark):
    """A hundred boxes over one place are tied by about as many links, not by all their pairs."""
    df = spark.createDataFrame([box(k, 0.0, 0.0, 10.0 + k, 10.0) for k in range(100)], SCHEMA)
    assert sp.overlaps(df, GridSpec(100.0)).count() == 4950
    assert 99 <= sp.overlaps(df, GridSpec(100.0), links=True).count() <= 400
