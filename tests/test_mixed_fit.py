import math
import random

import numpy as np
import pytest

from hexloom.operators.georeference import applied
from hexloom.operators.mixed_fit import fit_mixed
from hexloom.operators.simplify import simplified

POINTS = "sheet string, px double, py double, lon double, lat double"
STROKES = "sheet string, px double, py double, axis string, value double, frame string"
LON = [8.0, 0.004, -0.001, 2e-7, -3e-7, 1e-7]
LAT = [47.0, 0.0007, -0.003, 1e-7, 2e-7, -2e-7]
OFFSET = 17.66667


def at(c, x, y, terms):
    return sum(a * t for a, t in zip(c[:terms], (1, x, y, x * x, x * y, y * y)))


def sheets(seed=4):
    """Exact sheets: one with strokes of both frames, one with control points alone, one with too little, one on a line, one of strokes alone."""
    r = random.Random(seed)
    place = lambda: (r.uniform(0, 4000), r.uniform(0, 3000))
    points, strokes = [], []
    for sheet, terms, n in (("a", 3, 3), ("b", 3, 9), ("short", 3, 2), ("square", 6, 9)):
        for _ in range(n):
            x, y = place()
            points.append((sheet, x, y, at(LON, x, y, terms), at(LAT, x, y, terms)))
    points += [("line", float(k), 2.0 * k, 8.0 + k, 47.0) for k in range(8)]
    for sheet, terms in (("a", 3), ("square", 6), ("strokes", 3)):
        for k in range(14):
            x, y = place()
            axis = "lon" if k % 2 else "lat"
            frame = "PLATE" if k % 4 == 1 else "GREENWICH" if k % 4 == 3 else None
            value = at(LON, x, y, terms) + OFFSET * (frame == "PLATE") if axis == "lon" else at(LAT, x, y, terms)
            strokes.append((sheet, x, y, axis, value, frame))
    points.append(("b", None, 1.0, 1.0, 1.0))
    strokes += [("b", 1.0, 1.0, "height", 5.0, None), ("b", 1.0, 1.0, "lon", None, "PLATE")]
    return points, strokes


@pytest.mark.parametrize("model", ["AFFINE", "POLYNOMIAL_2"])
def test_known_sheets_are_recovered(spark, model):
    points, strokes = sheets()
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(strokes, STROKES)
    fits = fit_mixed(p, s, model)
    got = {r.sheet: r for r in fits.collect()}
    good = {"AFFINE": {"a", "b", "strokes"}, "POLYNOMIAL_2": {"b", "square"}}[model]
    assert set(got) == {"a", "b", "short", "line", "square", "strokes"}
    assert all(got[k].status == "FITTED" for k in good)
    assert got["line"].status == "NOT_FITTABLE" and got["short"].status == "UNDERDETERMINED" and got["line"].params is None
    assert (got["a"].n_gcp, got["a"].n_lon, got["a"].n_lat, got["b"].n_lon) == (3, 7, 7, 0)
    for k in good & {"a", "square", "strokes"}:
        assert abs(got[k].plate_offset_deg - OFFSET) < 1e-9
    assert got["b"].plate_offset_deg is None
    for r in applied(p.where("sheet in ('a', 'b', 'square') and px is not null"), fits, model).collect():
        if r.sheet in good:
            assert abs(r.fit_lon - r.lon) < 1e-9 and abs(r.fit_lat - r.lat) < 1e-9


def test_against_dense_least_squares(spark):
    r = random.Random(9)
    points = [("s", r.uniform(0, 900), r.uniform(0, 700), r.uniform(5, 9), r.uniform(40, 50)) for _ in range(12)]
    strokes = [("s", r.uniform(0, 900), r.uniform(0, 700), r.choice(["lon", "lat"]), r.uniform(5, 50), r.choice(["PLATE", "GREENWICH"])) for _ in range(30)]
    got = fit_mixed(spark.createDataFrame(points, POINTS), spark.createDataFrame(strokes, STROKES), "POLYNOMIAL_2")
    design = lambda x, y: [1, x, y, x * x, x * y, y * y]
    lon = [(design(x, y) + [0], v) for _, x, y, v, _ in points] + [(design(x, y) + [f == "PLATE"], v) for _, x, y, a, v, f in strokes if a == "lon"]
    lat = [(design(x, y), v) for _, x, y, _, v in points] + [(design(x, y), v) for _, x, y, a, v, _ in strokes if a == "lat"]
    want = [np.linalg.lstsq(np.array([a for a, _ in rows], float), np.array([b for _, b in rows]), rcond=None)[0] for rows in (lon, lat)]
    assert abs(got.first().plate_offset_deg - want[0][6]) < 1e-8
    places = spark.createDataFrame([("s", float(x), float(y), 0.0, 0.0) for x in (0, 450, 900) for y in (0, 700)], POINTS)
    for q in applied(places, got, "POLYNOMIAL_2").collect():
        assert abs(q.fit_lon - np.dot(design(q.px, q.py), want[0][:6])) < 1e-7 and abs(q.fit_lat - np.dot(design(q.px, q.py), want[1])) < 1e-7


def test_tied_models_and_empty_tables(spark):
    p, s = spark.createDataFrame([], POINTS), spark.createDataFrame([], STROKES)
    assert fit_mixed(p, s, "AFFINE").count() == 0
    with pytest.raises(ValueError):
        fit_mixed(p, s, "PROJECTIVE")


def farthest_rule(line, tolerance):
    """The plain recursive version."""
    if len(line) < 3:
        return line
    (_, ax, ay), (_, bx, by) = line[0], line[-1]

    def away(p):
        dx, dy = bx - ax, by - ay
        t = min(1.0, max(0.0, ((p[1] - ax) * dx + (p[2] - ay) * dy) / (dx * dx + dy * dy))) if dx or dy else 0.0
        return math.hypot(p[1] - ax - t * dx, p[2] - ay - t * dy)

    k = max(range(1, len(line) - 1), key=lambda k: (away(line[k]), -k))
    if away(line[k]) <= tolerance:
        return [line[0], line[-1]]
    return farthest_rule(line[: k + 1], tolerance)[:-1] + farthest_rule(line[k:], tolerance)


@pytest.mark.parametrize("tolerance", [0.0, 25.0, 400.0])
def test_simplified_lines(spark, tolerance):
    r = random.Random(3)
    lines = {}
    for name, n in (("long", 400), ("b", 60), ("two", 2), ("one", 1), ("three", 3)):
        x = y = 0.0
        lines[name] = []
        for k in range(n):
            lines[name].append((k * 2, x, y))
            x, y = x + r.uniform(-20, 60), y + r.uniform(-50, 50)
    lines["ring"] = [(k, 1000 * math.cos(k / 8 * math.pi), 1000 * math.sin(k / 8 * math.pi)) for k in range(17)]
    lines["same"] = [(k, 5.0, 5.0) for k in range(6)]
    rows = [(b, *v) for b, line in lines.items() for v in line] + [("b", 3, None, 1.0), (None, 1, 1.0, 1.0)]
    got = {}
    for v in simplified(spark.createDataFrame(rows, "branch string, k long, x double, y double"), tolerance).collect():
        got.setdefault(v.branch, []).append((v.k, v.x, v.y))
    assert {b: sorted(v) for b, v in got.items()} == {b: farthest_rule(line, tolerance) for b, line in lines.items()}
    assert len(got["same"]) == 2 and len(got["one"]) == 1
