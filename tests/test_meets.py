"""Shapes that come close, whole ones and ones cut to cells, against plain searches."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from hexloom.operators import extents, meets, spatial
from tests.test_extents import SEGMENTS, between, ground


def plain(shapes, a, b):
    return min(between(s, o) for s in shapes[a] for o in shapes[b])


@pytest.fixture(scope="module")
def shapes():
    """Crowded triangles in two groups, a line across all of them and one with many sides."""
    rng = random.Random(11)
    out = {}
    for k in range(60):
        x, y, size = rng.uniform(0, 90_000), 4e6 + rng.uniform(0, 60_000), rng.uniform(300, 4000)
        at = [(x, y), (x + size, y + rng.uniform(0, size)), (x, y + size)]
        out[f"t{k:02d}"] = [(*p, *q) for p, q in zip(at, at[1:] + at[:1])]
    out["u_long"] = [(-5_000.0, 4e6 - 2_000.0, 95_000.0, 4e6 + 61_000.0)]
    wave = [(900.0 * k, 4e6 + 30_000 + 4_000 * math.sin(k)) for k in range(101)]
    out["v_many"] = [(*p, *q) for p, q in zip(wave, wave[1:])]
    return out


def test_pairs_are_those_of_a_plain_search(spark, shapes):
    table = spark.createDataFrame([(k, *s) for k, v in shapes.items() for s in v], SEGMENTS)
    got = [(r.a, r.b, r.d) for r in meets.close_shapes(table, table, 3000.0, pairs="below").collect()]
    names = sorted(shapes)
    want = {(a, b): d for i, a in enumerate(names) for b in names[i + 1 :] if (d := plain(shapes, a, b)[0]) <= 3000}
    assert len(got) == len(want) > 50 and {(a, b): d for a, b, d in got} == pytest.approx(want, abs=1e-6)
    assert {k[1] for k in want} >= {"u_long", "v_many"}


def test_nearest_in_group_is_that_of_a_plain_search(spark, shapes):
    group = lambda k: "g" if k < "t40" else "h"
    table = spark.createDataFrame([(k, *s, group(k)) for k, v in shapes.items() for s in v], f"{SEGMENTS}, g string")
    best = {}
    for r in extents.nearest_in_group(table, 40_000.0, "g").collect():
        best[r.a] = min(best.get(r.a, (math.inf, 0.0)), (r.distance_m, r.ground_m))
    for a in shapes:
        d, p = min(plain(shapes, a, b) for b in shapes if b != a and group(a) == group(b))
        assert best[a] == pytest.approx((d, 0.0 if d == 0 else ground(*p)), abs=1e-3)


def test_blocks_pass_on_only_pairs_within_reach(spark):
    """A block of a thousand places against another is one row to Python; the join of sides gave a million."""
    rows = [(k, 7.0 * k, 0.0, 7.0 * k, 0.0) for k in range(1000)]
    table = spark.createDataFrame(rows, SEGMENTS.replace("string", "bigint"))
    seen = meets.close_shapes(table, table, 10_000.0, pairs="other", nearest=True)
    assert seen.count() <= 4 * 2000 and seen.where("d <> 7").count() <= 20
    assert spatial.within_distance_pairs(spark.createDataFrame([], "feature_id bigint, is_hole boolean, xs array<double>, ys array<double>"), 5.0).count() == 0


def test_a_batch_of_blocks_is_measured_a_bounded_number_of_sides_at_a_time(monkeypatch):
    sides = pa.struct([(c, pa.float64()) for c in meets.COORDINATES])
    piece = pa.struct([("line_id", pa.int64()), *((c, pa.float64()) for c in meets.PIECE[1:-1]), ("sides", pa.list_(sides))])
    block = [{"line_id": k, "reach": 1e9, "bx0": 0.0, "bx1": 1.0, "by0": 0.0, "by1": 1.0, "sides": [{"x1": float(k), "y1": 0.0, "x2": float(k), "y2": 1.0}] * 4} for k in range(100)]
    one = pa.array([block], pa.list_(piece))
    seen = []
    real = meets._nearest_places
    monkeypatch.setattr(meets, "PAIRS", 5000)
    monkeypatch.setattr(meets, "_nearest_places", lambda o, f, i, j: seen.append(16 * len(i)) or real(o, f, i, j))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), *((n, pa.float64()) for n in ("d", "px", "py", "qx", "qy"))])
    found = pa.Table.from_batches(list(meets._met(iter([pa.record_batch([one, one], ["o", "f"])]), schema, "below", False)))
    assert max(seen) <= 5000 and found.num_rows == 4950
    assert np.allclose(found["d"].to_numpy(), found["b"].to_numpy() - found["a"].to_numpy())
