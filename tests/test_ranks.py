"""Ranks and percentiles over ranges against the sorted whole."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hexloom.functions.geodesy import geodesic
from hexloom.operators import authority, checks, georeference, ranks, rivers


def test_percentiles_of_large_small_and_null_groups(spark):
    rng = random.Random(2)
    values = {"big": [rng.choice([rng.gauss(0, 50), 7.0]) for _ in range(5000)], "same": [4.0] * 900, "two": [1.0, 2.0], "one": [9.0], None: [1.0, 5.0, 6.0]}
    rows = [(g, v, 0) for g, vs in values.items() for v in vs] + [("big", None, 0), ("nulls", None, 0)]
    table = spark.createDataFrame(rows, "g string, v double, block int")
    shares = {"p0": 0.0, "median": 0.5, "p75": 0.75, "p95": 0.95, "p100": 1.0}
    got = {r.g: r[1:] for r in ranks.percentiles(table, ["g"], "v", shares).collect()}
    assert got.keys() == values.keys()
    for g, vs in values.items():
        assert got[g] == pytest.approx([np.quantile(vs, p) for p in shares.values()], abs=1e-9)
    all_ = [v for vs in values.values() for v in vs]
    assert ranks.percentiles(table, [], "v", {"p": 0.3}).first().p == pytest.approx(np.quantile(all_, 0.3), abs=1e-9)
    assert ranks.percentiles(table.where("false"), ["g"], "v", shares).count() == 0


def test_ranks_of_a_whole_table(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(40)) for k in range(3000)]
    got = {r.k: r.place for r in ranks.ranked(spark.createDataFrame(rows, "k int, v int"), "v", "k", name="place").collect()}
    assert got == {k: i + 1 for i, (k, v) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    top = checks.top_and_above(spark.createDataFrame(rows, "k int, v int"), "v", "k", 5, 37)
    want = sorted((-v, k) for k, v in rows if v > 37)
    assert [(r.k, r["rank"]) for r in top.orderBy("rank").collect()] == [(k, i + 1) for i, (_, k) in enumerate(want)]


def test_statistics_without_values(spark):
    none = spark.createDataFrame([(None, "a")], "distance_m double, zone string")
    assert rivers.offset_statistics(none, [10.0]).first()[:] == (0, None, None, None, None, 0)
    zones = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 3.0), ("c", None)], "zone string, m double")
    assert {(r.zone, r.n, r.is_worst) for r in authority.worst_zone(zones, "zone", "m").collect()} == {("a", 2, False), ("b", 1, True), ("c", 0, False)}


def test_groups_of_several_columns_and_nulls(spark):
    rows = [("a", 1, 1.0), ("a", 1, 4.0), ("a", None, 7.0), (None, 1, 2.0), (None, 1, 2.0), ("b", 2, None)]
    df = spark.createDataFrame(rows, "g string, h int, v double")
    sums = df.groupBy("g", "h").agg(F.count("v").alias("n"))
    got = {(r.g, r.h): (r.n, r.median) for r in ranks.with_percentiles(sums, df, ["g", "h"], "v", {"median": 0.5}).collect()}
    assert got == {("a", 1): (2, 2.5), ("a", None): (1, 7.0), (None, 1): (2, 2.0), ("b", 2): (0, None)}


def test_medians_of_prime_meridians(spark):
    """The score of each candidate is the median of all its distances, a whole set of places in one group."""
    rng = np.random.default_rng(2)
    places = [(float(a) - 2.3 + float(e), float(b), float(a)) for a, b, e in zip(rng.uniform(0, 20, 301), rng.uniform(40, 50, 301), rng.normal(0, 0.05, 301))]
    df = spark.createDataFrame(places, "map_lon double, lat double, ref_lon double").withColumn("ref_lat", F.col("lat"))
    candidates = {"PARIS": 2.337229, "FERRO": -17.666, "GREENWICH": 0.0}
    got = {r.meridian: (r.median_m, r.rank) for r in georeference.meridian_scores(df, candidates).collect()}
    d = lambda off: df.select(geodesic(F.col("map_lon") + off, F.col("lat"), F.col("ref_lon"), F.col("lat")).alias("d")).toPandas()["d"].median()
    assert {k: v[0] for k, v in got.items()} == pytest.approx({k: d(v) for k, v in candidates.items()})
    assert [got[k][1] for k in ("PARIS", "GREENWICH", "FERRO")] == [1, 2, 3]
    assert georeference.meridian_scores(df.limit(0), candidates).count() == 0


def test_percentiles_deal_values_over_tasks_by_their_number(spark, monkeypatch):
    """No task gets more than a few blocks' rows, be they of one group, of many, or one value; the percentiles are those of the whole."""
    rows = [(k % 3, float(k * 7919 % 1013)) for k in range(3000)] + [(9, 5.0)] * 200 + [(k + 100, float(k)) for k in range(50)]
    df = spark.createDataFrame(rows, "g int, v double")
    tables = []
    keep = ranks.written
    monkeypatch.setattr(ranks, "written", lambda t, name: tables.append(keep(t, name)) or tables[-1])
    monkeypatch.setattr(ranks, "BLOCK_ROWS", 100)
    got = {r.g: (r.low, r.mid) for r in ranks.percentiles(df, ["g"], "v", {"low": 0.1, "mid": 0.5}).collect()}
    values = {}
    for g, v in rows:
        values.setdefault(g, []).append(v)
    assert set(got) == set(values)
    for g, some in values.items():
        assert got[g] == pytest.approx(tuple(np.percentile(some, [10, 50])))
    blocks = tables[-1].groupBy("block").count().collect()
    assert len(blocks) > 10 and max(r["count"] for r in blocks) <= 400
