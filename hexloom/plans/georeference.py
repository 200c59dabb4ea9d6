"""Queries on map sheets: each supplier is a sheet, its line items are control points."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.operators import georeference as g
from hexloom.operators.mixed_fit import fit_mixed

from .registry import register

POINTS = "cast(l_suppkey as bigint) as sheet, cast(l_orderkey as bigint) * 8 + l_linenumber as id, cast(l_quantity as double) as px, cast(l_extendedprice as double) / 1000 as py, 0.01e0 * l_quantity + 0.002e0 * (l_extendedprice / 1000) + l_discount as lon, 40 + 0.003e0 * l_quantity - 0.004e0 * (l_extendedprice / 1000) + l_tax as lat, cast(l_partkey as bigint) as part"
HEAD = f"with points as (select {POINTS} from lineitem)"


def points(s, d):
    s.read.parquet(f"{d}/lineitem.parquet").createOrReplaceTempView("_sheets")
    return s.sql(f"select {POINTS} from _sheets")


AFFINE = HEAD + """, m as (select sheet, avg(px) as mx, avg(py) as my, avg(lon) as ml, avg(lat) as ma, count(*) as n from points group by sheet),
c as (select p.sheet, px - mx as u, py - my as v, lon - ml as l, lat - ma as a from points p join m on m.sheet = p.sheet),
s as (select sheet, sum(u * u) as uu, sum(u * v) as uv, sum(v * v) as vv, sum(u * l) as ul, sum(v * l) as vl, sum(u * a) as ua, sum(v * a) as va from c group by sheet),
f as (select s.sheet, n, mx, my, ml, ma, (ul * vv - vl * uv) / (uu * vv - uv * uv) as lx, (vl * uu - ul * uv) / (uu * vv - uv * uv) as ly, (ua * vv - va * uv) / (uu * vv - uv * uv) as ax, (va * uu - ua * uv) / (uu * vv - uv * uv) as ay from s join m on m.sheet = s.sheet)"""


def r01(s, d):
    fits = g.fit(points(s, d), "AFFINE")
    p, h = F.col("params"), F.col("shift")
    return fits.select("sheet", F.col("n_fit").alias("n"), F.round(p[1] / h[2], 8).alias("lon_x"), F.round(p[2] / h[3], 8).alias("lon_y"), F.round(p[4] / h[2], 8).alias("lat_x"), F.round(p[5] / h[3], 8).alias("lat_y"))


register("r01_fit_affine", r01, AFFINE + " select sheet, n, round(lx, 8) as lon_x, round(ly, 8) as lon_y, round(ax, 8) as lat_x, round(ay, 8) as lat_y from f")
register("r03_apply_affine", lambda s, d: g.applied(points(s, d), g.fit(points(s, d), "AFFINE"), "AFFINE").select("sheet", "id", "part", F.round("fit_lon", 7).alias("fit_lon"), F.round("fit_lat", 7).alias("fit_lat")), AFFINE + " select p.sheet, p.id, p.part, round(ml + lx * (px - mx) + ly * (py - my), 7) as fit_lon, round(ma + ax * (px - mx) + ay * (py - my), 7) as fit_lat from points p join f on f.sheet = p.sheet")
compared = lambda s, d: g.compare_models(points(s, d), F.col("part") % 4 == 0)
register("r04_compare_models", lambda s, d: compared(s, d).select("sheet", "model", "status", "n_fit", "n_holdout", F.round("fit_rms_m", 3).alias("fit_rms_m"), F.round("holdout_rms_m", 3).alias("holdout_rms_m")))
register("t07_select_model", lambda s, d: g.select_model(compared(s, d)))
register("t08_select_stable_model", lambda s, d: g.select_model(compared(s, d).withColumn("far_m", F.when(F.col("model") == "AFFINE", 90_000.0).otherwise(F.col("holdout_rms_m"))), independent="far_m"))
register("r05_jacobian", lambda s, d: g.jacobian(g.fit(points(s, d), "AFFINE"), "AFFINE", (0.0, 0.0, 50.0, 100.0), 6).select("sheet", *[F.round(c, 3).alias(c) for c in ("x_min", "x_max", "y_min", "y_max")], "folding"))
register("r06_condition", lambda s, d: g.fit(points(s, d), "POLYNOMIAL_2").select("sheet", "status", F.round("condition", 4).alias("condition")))
register("a34_residual_statistics", lambda s, d: (lambda o: o.select("sheet", "n", *[F.round(c, 6).alias(c) for c in o.columns[2:]]))(g.statistics(points(s, d), ["sheet"], "px")), HEAD + " select sheet, count(*) as n, round(sqrt(avg(px * px)), 6) as rms, round(quantile_cont(px, 0.5), 6) as median, round(quantile_cont(px, 0.75), 6) as p75, round(quantile_cont(px, 0.9), 6) as p90, round(quantile_cont(px, 0.95), 6) as p95, max(px) as most from points group by sheet")
register("w12_frozen_split", lambda s, d: g.frozen_split(s.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey as id", "c_nationkey as zone"), F.col("id") % 17 == 0).select("id", "role"), "with p as (select c_custkey as id, c_nationkey as zone from customer), k as (select id, row_number() over (order by zone, id) - 1 as k from p where id % 17 <> 0) select id, case k % 5 when 3 then 'MODEL_SELECTION_HOLDOUT' when 4 then 'BLIND_VALIDATION' else 'FIT' end as role from k union all select id, 'EXCLUDED' from p where id % 17 = 0")
register("f33_to_greenwich", lambda s, d: points(s, d).select("id", "part", F.round(g.to_greenwich(F.col("lon"), F.when(F.col("id") % 2 == 0, "PARIS").otherwise("FERRO")), 9).alias("lon")), HEAD + " select id, part, round(lon + case when id % 2 = 0 then 2.337229e0 else -17.666667e0 end, 9) as lon from points")
register("f34_line_intersection", lambda s, d: (lambda xy: points(s, d).select("id", "part", F.round(xy[0], 5).alias("x"), F.round(xy[1], 5).alias("y")))(g.intersection((F.lit(0.0), F.lit(0.0)), (F.col("px"), F.col("py")), (F.lit(0.0), F.lit(10.0)), (F.col("px"), F.lit(10.0)))), HEAD + ", l as (select *, case when abs(px * py) >= 1e-12 then px * py end as d from points) select id, part, round(10 * px * px / d, 5) as x, round(10e0 * px * py / d, 5) as y from l")
register("r08_uncertainty", lambda s, d: points(s, d).select("id", "part", F.round(g.uncertainty(F.col("px"), F.when(F.col("id") % 3 != 0, F.col("py")), F.lit(2.0)), 6).alias("u")), HEAD + " select id, part, round(sqrt(px * px + case when id % 3 <> 0 then py * py else 0 end + 4), 6) as u from points")
register("r07_meridian_scores", lambda s, d: g.meridian_scores(points(s, d).select((F.col("lon") - 2.337229 + F.col("px") / 1e5).alias("map_lon"), "lat", F.col("lon").alias("ref_lon"), F.col("lat").alias("ref_lat")), g.MERIDIANS).select("meridian", F.col("rank").cast("bigint"), F.round("median_m", 2).alias("median_m")))


def strokes(s, d):
    """Each control point's place once more, as a stroke of the border: longitudes from Greenwich and from the plate's own meridian, and latitudes."""
    value = F.when(F.col("part") % 3 == 2, F.col("lat") + 0.01 * F.col("px")).when(F.col("part") % 3 == 1, F.col("lon") + 17.5 + 0.02 * F.col("py")).otherwise(F.col("lon") - 0.03)
    return points(s, d).select("sheet", "px", "py", F.when(F.col("part") % 3 == 2, "lat").otherwise("lon").alias("axis"), value.alias("value"), F.when(F.col("part") % 3 == 1, "PLATE").otherwise("GREENWICH").alias("frame"))


def r02(s, d):
    fits = fit_mixed(points(s, d), strokes(s, d), "AFFINE")
    p, h = F.col("params"), F.col("shift")
    return fits.select("sheet", "n_gcp", "n_lon", "n_lat", "status", F.round("plate_offset_deg", 6).alias("plate_offset_deg"), *[F.round(p[k] / h[2 + j], 7).alias(n) for k, j, n in ((1, 0, "lon_x"), (2, 1, "lon_y"), (4, 0, "lat_x"), (5, 1, "lat_y"))])


# With an offset of their own, plate longitudes have an intercept of their own: slopes come from the deviations within the two kinds, the offset from their means.
register(
    "r02_fit_mixed",
    r02,
    HEAD + """, e as (select sheet, 'lon' as axis, 0 as plate, px, py, lon as v, 1 as gcp from points union all select sheet, 'lat', 0, px, py, lat, 1 from points
  union all select sheet, case when part % 3 = 2 then 'lat' else 'lon' end, case when part % 3 = 1 then 1 else 0 end, px, py,
    case part % 3 when 2 then lat + 0.01e0 * px when 1 then lon + 17.5e0 + 0.02e0 * py else lon - 0.03e0 end, 0 from points),
m as (select sheet, axis, plate, avg(px) as mx, avg(py) as my, avg(v) as mv from e group by all),
c as (select e.sheet, e.axis, e.gcp, px - mx as u, py - my as w, v - mv as t from e join m on m.sheet = e.sheet and m.axis = e.axis and m.plate = e.plate),
f as (select sheet, axis, count(*) - sum(gcp) as n, sum(gcp) as g, (sum(u * t) * sum(w * w) - sum(w * t) * sum(u * w)) / (sum(u * u) * sum(w * w) - sum(u * w) * sum(u * w)) as sx,
  (sum(w * t) * sum(u * u) - sum(u * t) * sum(u * w)) / (sum(u * u) * sum(w * w) - sum(u * w) * sum(u * w)) as sy from c group by all)
select a.sheet, a.g as n_gcp, a.n as n_lon, b.n as n_lat, 'FITTED' as status, round((p.mv - a.sx * p.mx - a.sy * p.my) - (q.mv - a.sx * q.mx - a.sy * q.my), 6) as plate_offset_deg,
  round(a.sx, 7) as lon_x, round(a.sy, 7) as lon_y, round(b.sx, 7) as lat_x, round(b.sy, 7) as lat_y
from f a join f b on b.sheet = a.sheet and b.axis = 'lat' join m p on p.sheet = a.sheet and p.axis = 'lon' and p.plate = 1 join m q on q.sheet = a.sheet and q.axis = 'lon' and q.plate = 0 where a.axis = 'lon'""",
)
