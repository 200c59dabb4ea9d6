import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.llm.queries import op12_whitening
from hexloom.llm.whitening import COMPONENTS, bidiagonalise, whiten


def dense(width):
    """A product over one matrix in memory, as tasks make it over their rows."""

    def over(x):
        def product(short, a):
            made = x @ np.c_[short, a]
            against = made.T @ made[:, -1]
            return against[:-1], against[-1], x.T @ made[:, -1]

        return product

    return over


@pytest.mark.parametrize("rows, width, count, kind", [(300, 40, 32, "random"), (50, 200, 20, "random"), (400, 300, 8, "decay"), (30, 30, 12, "equal"), (10, 1, 1, "random"), (3, 12, 5, "random"), (200, 50, 30, "steep")])
def test_bidiagonalisation(rows, width, count, kind):
    r = np.random.default_rng(rows)
    x = r.standard_normal((rows, width))
    if kind == "decay":
        x = x * 0.93 ** np.arange(width)
    if kind == "steep":
        x = x * 10 ** -np.linspace(0, 8, width)
    if kind == "equal":  # one singular value thirty times
        x = np.linalg.qr(x)[0]
    vectors, values, steps = bidiagonalise(dense(width)(x), width, min(count, width))
    want = np.linalg.svd(x, compute_uv=False)
    assert len(values) == min(count, rows, width)
    want = want[: len(values)]
    assert np.abs(values - want).max() <= 1e-12 * want[0] and steps <= width
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs((x.T @ (x @ vectors.T)).T - values[:, None] ** 2 * vectors).max() < 1e-11 * want[0] ** 2
    if kind == "decay":
        assert steps < width / 2


def by_hand(rows):
    """Whole numbers, exact deviations, and whitened entries of rows, by a full decomposition."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)
    return n, deviations, centred @ v[:, order] / np.sqrt(np.maximum(e[order], 1e-300)), e[order] / e.sum()


def compare(got, keys, rows, count):
    n, deviations, whitened, explained = by_hand(rows)
    assert len(got) == n * count and set(got.n) == {n} and (got.identity_error < 1e-9).all() and got.identity_error.nunique() == 1
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[keys].to_numpy()
    for k in range(count):
        sign = np.sign(table[:, k] @ whitened[:, k])
        assert np.abs(table[:, k] * sign - whitened[:, k]).max() < 1e-7
    assert got.drop_duplicates("vec_id").set_index("vec_id").loc[keys].deviation.tolist() == deviations
    per = got.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.abs(per / explained[:count] - 1).max() < 1e-9


def test_query_against_a_full_decomposition(spark):
    sf = "/root/testdata/sf0.01"
    got = op12_whitening(spark, sf).toPandas()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").where("embedding is not null").collect()
    good = [r for r in rows if all(c is not None and math.isfinite(c) for c in r.embedding)]
    compare(got, [r.vec_id for r in good], [r.embedding for r in good], COMPONENTS)


SCHEMA = "vec_id long, embedding array<float>, n string, x string"


def test_edges(spark):
    r = np.random.default_rng(4)
    rows = [(k, r.standard_normal(3).tolist(), "a", "b") for k in range(40)]
    bad = [(100, None, "a", "b"), (101, [1.0, None, 2.0], "a", "b"), (102, [math.nan, 0.0, 0.0], "a", "b"), (103, [math.inf, 0.0, 0.0], "a", "b")]
    compare(whiten(spark.createDataFrame(rows + bad, SCHEMA)).toPandas(), list(range(40)), [x[1] for x in rows], 3)
    short = [(200, [0.5], "a", "b"), (None, [0.25, 0.5], "a", "b"), (7, rows[7][1], "a", "b")]  # ends in zeros, null key, repeated row
    got = whiten(spark.createDataFrame(rows + short, SCHEMA)).toPandas()
    assert len(got) == 43 * 3 and set(got.n) == {43} and len(got[got.vec_id == 7]) == 6 and got.vec_id.isna().sum() == 3
    n, deviations, *_ = by_hand([x[1] for x in rows] + [[0.5, 0.0, 0.0], [0.25, 0.5, 0.0], rows[7][1]])
    assert set(got[got.vec_id == 200].deviation) == {deviations[40]}


def test_components_without_deviation(spark):
    make = lambda rows: spark.createDataFrame([(k, v, "", "") for k, v in enumerate(rows)], SCHEMA)
    assert whiten(make([[1.0, 2.0]] * 5)).count() == 0 and whiten(make([])).count() == 0 and whiten(make([[], []])).count() == 0
    line = whiten(make([[float(k), 2.0 * k, 5.0] for k in range(6)])).toPandas()
    assert set(line.component) == {1} and abs(line.explained - 1).max() < 1e-12 and len(line) == 6
    # Four corners: one eigenvalue four times over.
    corners = whiten(make([[float(k == j) for j in range(5)] for k in range(5)])).toPandas()
    assert set(corners.component) == {1, 2, 3, 4} and (corners.identity_error < 1e-12).all() and np.abs(corners.explained - 0.25).max() < 1e-12


def test_vast_entries(spark):
    rows = [(1, [1e300, 0.0], "", ""), (2, [-1e300, 1.0], "", ""), (3, [0.0, 2.0], "", "")]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, x string")).toPandas()
    assert got.deviation.isna().any() and np.isfinite(got.whitened).all()


def test_columns(spark):
    df = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "vec_id string, embedding array<float>")
    assert whiten(df).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whiten(df.where(F.lit(False))).count() == 0
