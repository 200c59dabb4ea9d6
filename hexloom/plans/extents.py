"""Queries on distances and extents on the ground: shapes around suppliers' places, also set on the date line and at other latitudes."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.geodesy import geodesic, haversine
from hexloom.functions.projection import HALF_EXTENT, RADIUS, WORLD
from hexloom.operators import extents as e
from hexloom.operators.spatial import ground_areas, segments_of

from .authority import PT, placed, rounded
from .registry import register
from .spatial import HEAD, boxes

#: What is taken off the shapes' x so that the middle of them lies on the date line.
TO_DATELINE = 15_550_000.0 - HALF_EXTENT


def vincenty(source: str, result: str = "measured", rounds: int = 12) -> str:
    """DuckDB tables that give ``source`` (lon1, lat1, lon2, lat2) a column m, its distance on the ellipsoid, as ``result``."""
    n = f"{result}_"
    tables = [f"{n}v0 as materialized (select *, atan((1 - 1 / 298.257223563e0) * tan(radians(lat1))) as u1, atan((1 - 1 / 298.257223563e0) * tan(radians(lat2))) as u2, radians(lon2 - lon1) as l, radians(lon2 - lon1) as lam from {source})"]
    for k in range(rounds):
        tables.append(
            f"{n}s{k} as materialized (select *, sqrt(power(cos(u2) * sin(lam), 2) + power(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) as ss, sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) as cs from {n}v{k}),"
            f"{n}a{k} as materialized (select *, atan2(ss, cs) as sg, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(ss, 0), 0) as sa from {n}s{k}),"
            f"{n}c{k} as materialized (select *, 1 - sa * sa as c2, coalesce(cs - 2 * sin(u1) * sin(u2) / nullif(1 - sa * sa, 0), 0) as cm, 1 / 298.257223563e0 / 16 * (1 - sa * sa) * (4 + 1 / 298.257223563e0 * (4 - 3 * (1 - sa * sa))) as c from {n}a{k}),"
            f"{n}v{k + 1} as materialized (select * exclude (ss, cs, sg, sa, c2, cm, c, lam), l + (1 - c) / 298.257223563e0 * sa * (sg + c * ss * (cm + c * cs * (2 * cm * cm - 1))) as lam" + (f", ss, cs, sg, c2, cm from {n}c{k})" if k == rounds - 1 else f" from {n}c{k})")
        )
    b = "6378137e0 * (1 - 1 / 298.257223563e0)"
    tables.append(f"{n}w as materialized (select *, c2 * (power(6378137e0, 2) - power({b}, 2)) / power({b}, 2) as w from {n}v{rounds})")
    tables.append(f"{n}big as materialized (select *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) as aa, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) as bb from {n}w)")
    tables.append(f"{result} as (select * exclude (u1, u2, l, lam, ss, cs, sg, c2, cm, w, aa, bb), {b} * aa * (sg - bb * ss * (cm + bb / 4 * (cs * (2 * cm * cm - 1) - bb / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))) as m from {n}big)")
    return ", ".join(tables)


def ground_km2(sides: str, key: str, result: str) -> str:
    """DuckDB tables that give each ``key`` of ``sides`` (x, y, x2, y2: the way round a shape) the area km2 on the ellipsoid inside, as ``result``."""
    e2 = "(2 / 298.257223563e0 - power(1 / 298.257223563e0, 2))"
    return f"""{result}_parts as (select {key}, (x2 - x) / 6378137e0 * case when part in (0, 32) then 0.5e0 else 1 end / 32 as dx, sin(atan(sinh((y + (y2 - y) * part / 32e0) / 6378137e0))) as s, sqrt({e2}) as e from {sides}, range(33) t(part)),
{result} as (select {key}, abs(sum(dx * (1 - e * e) * (s / (1 - e * e * s * s) + ln((1 + e * s) / (1 - e * s)) / (2 * e)))) * power(6378137e0, 2) / 2 / 1e6 as km2 from {result}_parts group by 1)"""


LON, LAT = "degrees({0} / 6378137e0)", "degrees(atan(sinh({0} / 6378137e0)))"

register(
    "f07_distances",
    lambda s, d: placed(s, d).select("id", F.round(haversine(F.col("lon"), F.col("lat"), F.lit(139.7), F.lit(35.7)), 3).alias("sphere_m"), F.round(geodesic(F.col("lon"), F.col("lat"), F.lit(139.7), F.lit(35.7)), 3).alias("ellipsoid_m")),
    PT + ", places as (select id, lon as lon1, lat as lat1, 139.7e0 as lon2, 35.7e0 as lat2 from points), " + vincenty("places")
    + " select id, round(2 * 6371008.8e0 * asin(sqrt(power(sin(radians(35.7e0 - lat1) / 2), 2) + cos(radians(lat1)) * cos(radians(35.7e0)) * power(sin(radians(139.7e0 - lon1) / 2), 2))), 3) as sphere_m, round(m, 3) as ellipsoid_m from measured",
)


def diamonds(s, d, shift: float = 0.0):
    """A rhombus inside each supplier's box, ``shift`` metres further west; those that lie east of the date line then come back at the other end of the world."""
    at = boxes(s, d).withColumn("cx", F.col("cx") - shift).withColumn("cx", F.when(F.col("cx") > HALF_EXTENT, F.col("cx") - WORLD).otherwise(F.col("cx")))
    return at.selectExpr("feature_id", "false as is_hole", "array(cx - hx, cx, cx + hx, cx) as xs", "array(cy, cy - hy, cy, cy + hy) as ys", "cx", "cy")


DIAMONDS = HEAD + """, corners as materialized (select feature_id, unnest([0, 1, 2, 3]) as k, unnest([cx - hx, cx, cx + hx, cx]) as x, unnest([cy, cy - hy, cy, cy + hy]) as y from boxes),
sides as (select c.*, n.x as x2, n.y as y2 from corners c join corners n on n.feature_id = c.feature_id and n.k = (c.k + 1) % 4),
legs as (select c.feature_id as a, s.feature_id as b, c.x, c.y, s.x as x1, s.y as y1, s.x2 - s.x as dx, s.y2 - s.y as dy from corners c join sides s on c.feature_id <> s.feature_id),
params as (select *, greatest(0, least(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) as t from legs),
ends as (select least(a, b) as a, greatest(a, b) as b, x as px, y as py, x1 + t * dx as qx, y1 + t * dy as qy, sqrt((x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2) as d from params),
crossed as (select distinct s.feature_id as a, o.feature_id as b from sides s join sides o on s.feature_id < o.feature_id
  where ((s.x2 - s.x) * (o.y - s.y) - (s.y2 - s.y) * (o.x - s.x)) * ((s.x2 - s.x) * (o.y2 - s.y) - (s.y2 - s.y) * (o.x2 - s.x)) < 0
    and ((o.x2 - o.x) * (s.y - o.y) - (o.y2 - o.y) * (s.x - o.x)) * ((o.x2 - o.x) * (s.y2 - o.y) - (o.y2 - o.y) * (s.x2 - o.x)) < 0),
nearest as materialized (select a, b, min(d) as d, arg_min(struct_pack(px, py, qx, qy), d) as p from ends group by a, b),
pairs as (select n.a, n.b, c.a is not null as meets, d, """ + ", ".join(f"{f.format('p.' + v)} as {n}" for f, v, n in ((LON, "px", "lon1"), (LAT, "py", "lat1"), (LON, "qx", "lon2"), (LAT, "qy", "lat2"))) + """ from nearest n left join crossed c on c.a = n.a and c.b = n.b), """ + vincenty("pairs") + """,
near as materialized (select a, b, case when meets then 0 else d end as distance_m, case when meets then 0 else m end as ground_m from measured)"""
#: 20 km on the ground.
LIMIT = 20_000.0
WITHIN = DIAMONDS + " select a, b, round(distance_m, 3) as distance_m, round(ground_m, 3) as ground_m from near where ground_m <= 20000"


def near(s, d, shift: float = 0.0):
    return rounded(e.ground_distances(segments_of(diamonds(s, d, shift)), LIMIT), 3, "distance_m", "ground_m")


register("f08_ground_distances", near, WITHIN)
# The same shapes on both sides of the date line have the same distances.
register("f09_dateline_distances", lambda s, d: near(s, d, TO_DATELINE), WITHIN)
register(
    "f10_group_extents",
    lambda s, d: rounded(e.group_extents(placed(s, d).withColumn("group", F.col("id") % 40), "group"), 3, "extent_m", "extent_projected_m").select("group", "extent_m", "extent_projected_m"),
    PT + ', pairs as (select x.id % 40 as "group", sqrt((x.x - y.x) ** 2 + (x.y - y.y) ** 2) as d, x.lon as lon1, x.lat as lat1, y.lon as lon2, y.lat as lat2 from placed x join placed y on x.id % 40 = y.id % 40 and x.id <= y.id), '
    + vincenty("pairs") + ' select "group", round(coalesce(max(m), 0), 3) as extent_m, round(max(d), 3) as extent_projected_m from measured group by 1',
)


def a19(s, d):
    """Shapes whose centres share a square of 100 km are a group."""
    shapes = diamonds(s, d).withColumn("group", F.concat_ws("_", F.floor(F.col("cx") / 100_000), F.floor(F.col("cy") / 100_000)))
    corners = shapes.select("group", F.explode(F.arrays_zip(F.col("xs").alias("x"), F.col("ys").alias("y"))).alias("c")).select("group", "c.x", "c.y")
    members = shapes.select("group", "feature_id").join(ground_areas(shapes), "feature_id").select("group", F.col("feature_id").alias("component_id"), F.col("ground_km2").alias("km2"))
    sides = segments_of(shapes).join(members.select(F.col("component_id").alias("line_id"), "group"), "line_id")
    out = e.group_metrics(members, corners, "group", e.nearest_in_group(sides, 2 * LIMIT, "group"))
    return rounded(out, 3, "km2", "extent_m", "extent_projected_m", "hull_km2", "separation_m").select(
        "group", "group_id", "parts", "km2", F.round("largest_share", 6).alias("largest_share"), "extent_m", "extent_projected_m", "hull_km2", F.round("land_hull_ratio", 6).alias("land_hull_ratio"), "separation_m"
    )


register(
    "a19_group_metrics",
    a19,
    DIAMONDS + ", " + ground_km2("sides", "feature_id", "areas") + """, g as (select feature_id, concat_ws('_', cast(floor(cx / 100000) as bigint), cast(floor(cy / 100000) as bigint)) as "group", km2 from boxes join areas using (feature_id)),
sums as (select "group", count(*) as parts, sum(km2) as km2, max(km2) / sum(km2) as largest_share, 'isl_g_' || substr(sha1(string_agg(cast(feature_id as varchar), '|' order by cast(feature_id as varchar))), 1, 12) as group_id from g group by 1),
ways as (select a, b, distance_m, ground_m from near where ground_m <= 40000 union all select b, a, distance_m, ground_m from near where ground_m <= 40000),
closest as (select p."group", b.a, arg_min(b.ground_m, b.distance_m) as m from ways b join g p on p.feature_id = b.a join g q on q.feature_id = b.b and q."group" = p."group" group by 1, 2),
apart as (select "group", max(m) as separation_m from closest group by 1),
spots as materialized (select distinct g."group", c.x, c.y from corners c join g using (feature_id)),
wide as (select p."group", sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) as d, """ + ", ".join(f"{f.format(v)} as {n}" for f, v, n in ((LON, "p.x", "lon1"), (LAT, "p.y", "lat1"), (LON, "q.x", "lon2"), (LAT, "q.y", "lat2")))
    + """ from spots p join spots q on q."group" = p."group" and (p.x, p.y) < (q.x, q.y)), """ + vincenty("wide", "spans") + """,
reach as (select "group", max(m) as extent_m, max(d) as extent_projected_m from spans group by 1),
rim as materialized (select p."group", p.x, p.y, q.x as x2, q.y as y2 from spots p join spots q on q."group" = p."group" and (p.x, p.y) <> (q.x, q.y) join spots o on o."group" = p."group"
  group by all having min((q.x - p.x) * (o.y - p.y) - (q.y - p.y) * (o.x - p.x)) > -1e-3),
""" + ground_km2("rim", '"group"', "hulls") + """
select "group", group_id, parts, round(sums.km2, 3) as km2, round(largest_share, 6) as largest_share, round(extent_m, 3) as extent_m, round(extent_projected_m, 3) as extent_projected_m,
  round(hulls.km2, 3) as hull_km2, round(sums.km2 / hulls.km2, 6) as land_hull_ratio, case when sums.parts = 1 then 0 else round(separation_m, 3) end as separation_m
from sums join reach using ("group") join hulls using ("group") left join apart using ("group")""",
)


def q04(s, d):
    """Each supplier's square of a given size on the ground, set on the equator and on three other latitudes, and how far its area and the gap to a second one are from what they were made with."""
    side = "(1000 + abs(s_acctbal))"
    laid = s.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey", f"{side} as side", "explode(array(0, 35, 60, 75)) as lat").selectExpr("s_suppkey * 100 + lat as id", "s_suppkey", "lat", "cast(side as double) as side", f"{RADIUS!r}D * ln(tan(pi() / 4 + radians(lat) / 2)) as y", "side / cos(radians(lat)) / 2 as h")
    ring = lambda t, x: t.selectExpr("id as feature_id", "false as is_hole", f"array({x} - h, {x} + h, {x} + h, {x} - h) as xs", "array(y - h, y - h, y + h, y + h) as ys")
    # Squares of one supplier stand a side apart, those of different ones in columns of their own.
    x = "(cast(s_suppkey % 2000 as double) - 1000) * 15000"
    one, two = ring(laid, x), ring(laid, f"({x} + 4 * h)").withColumn("feature_id", F.col("feature_id") + 50)
    gaps = e.ground_distances(segments_of(one), 25_000.0, segments_of(two), "line_id_b = line_id + 50").select(F.col("a").alias("id"), "ground_m")
    all_ = laid.join(ground_areas(one).withColumnRenamed("feature_id", "id"), "id").join(gaps, "id", "left")
    square = F.pow(F.col("side"), 2) / 1e6
    return all_.select("s_suppkey", "lat", (F.abs(F.col("ground_km2") / square - 1) < 0.02).alias("area_holds"), F.coalesce(F.abs(F.col("ground_m") / F.col("side") - 1) < 0.02, F.lit(False)).alias("gap_holds"))


register("q04_latitude_invariance", q04, "select s_suppkey, unnest([0, 35, 60, 75]) as lat, true as area_holds, true as gap_holds from supplier")
