"""Queries on polygons and lines: boxes around suppliers' places."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.operators import spatial as sp
from hexloom.tables import written

from .registry import register

GRID = GridSpec(6000.0)
BOX = "cast(s_suppkey as bigint) as feature_id, 15400000e0 + ((s_suppkey * 7919) % 30011) * 10e0 as cx, 4200000e0 + ((s_suppkey * 10473) % 29989) * 10e0 as cy, 500e0 + abs(s_acctbal) as hx, 300e0 + abs(s_acctbal) * 0.7e0 as hy"
HEAD = f"with boxes as (select {BOX} from supplier), b as (select feature_id, cx - hx as x0, cy - hy as y0, cx + hx as x1, cy + hy as y1 from boxes)"


def boxes(s, d):
    return s.read.parquet(f"{d}/supplier.parquet").selectExpr(*[c.strip() for c in BOX.split(", ")])


def rings(s, d):
    return boxes(s, d).selectExpr("feature_id", "false as is_hole", "array(cx - hx, cx + hx, cx + hx, cx - hx) as xs", "array(cy - hy, cy - hy, cy + hy, cy + hy) as ys")


def segments(s, d):
    return sp.segments_of(rings(s, d))


shares = lambda s, d: sp.feature_hexes(rings(s, d), GRID)
register("j03_area_is_kept", lambda s, d: shares(s, d).groupBy("feature_id").agg(F.round(F.sum("area_m2"), 2).alias("area_m2")), HEAD + " select feature_id, round(4 * hx * hy, 2) as area_m2 from boxes")


def classed(s, d):
    """The areas of the boxes in the cells, made once, and the cells with their land class."""
    own = written(shares(s, d), "shares")
    return own, sp.land_classes(own.select("q", "r").distinct(), own, GRID, 0.3)


register("j03_land_classes", lambda s, d: classed(s, d)[1].select("q", "r", F.round("land_fraction", 6).alias("land_fraction"), "land_class", "is_coastal"))
register("j07_hex_lakes", lambda s, d: sp.hex_lakes(shares(s, d), GRID).withColumn("lake_fraction", F.round("lake_fraction", 6)))
register("j08_memberships", lambda s, d: sp.memberships(shares(s, d), GRID).groupBy("q", "r").agg(F.round(F.sum("share_of_covered"), 6).alias("covered"), F.count_if("is_dominant").alias("dominants")).groupBy("covered", "dominants").count())
register("j09_component_stats", lambda s, d: sp.component_stats(*classed(s, d)).select("feature_id", "hexes", F.round("area_m2", 2).alias("area_m2"), "represented", F.col("primary_hex.q").alias("q"), F.col("primary_hex.r").alias("r")))
register("j04_length_is_kept", lambda s, d: sp.line_in_hexes(segments(s, d), GRID).groupBy("line_id").agg(F.round(F.sum("length_m"), 3).alias("length_m")), HEAD + " select feature_id as line_id, round(4 * (hx + hy), 3) as length_m from boxes")
def j06(s, d):
    """The union of the boxes of two suppliers and of a second box of each."""
    second = boxes(s, d).selectExpr("feature_id", "false as is_hole", "array(cx - 100, cx + hx * 1.5, cx + hx * 1.5, cx - 100) as xs", "array(cy - 50, cy - 50, cy + hy * 1.2, cy + hy * 1.2) as ys")
    pair = F.floor(F.col("feature_id") / 2)
    return sp.union_in_hexes(rings(s, d).unionByName(second).withColumn("pair", pair), GRID, ["pair"]).groupBy("pair").agg(F.round(F.sum("area_m2"), 1).alias("area_m2"))


#: The union by the slabs between all borders of a pair's boxes.
UNION_SQL = """, two as (select cast(floor(feature_id / 2) as bigint) as pair, cx - hx as x0, cx + hx as x1, cy - hy as y0, cy + hy as y1 from boxes
  union all select cast(floor(feature_id / 2) as bigint), cx - 100, cx + hx * 1.5e0, cy - 50, cy + hy * 1.2e0 from boxes),
xs as (select pair, x as a, lead(x) over (partition by pair order by x) as b from (select distinct pair, unnest([x0, x1]) as x from two)),
ys as (select pair, y as a, lead(y) over (partition by pair order by y) as b from (select distinct pair, unnest([y0, y1]) as y from two))
select xs.pair, round(sum((xs.b - xs.a) * (ys.b - ys.a)), 1) as area_m2 from xs join ys on ys.pair = xs.pair
where exists (select 1 from two t where t.pair = xs.pair and t.x0 <= xs.a and xs.b <= t.x1 and t.y0 <= ys.a and ys.b <= t.y1) group by xs.pair"""
register("j06_union_in_hexes", j06, HEAD + UNION_SQL)


def places(s, d):
    return s.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey as id", "15400000e0 + ((c_custkey * 5077) % 30011) * 10e0 as x", "4200000e0 + ((c_custkey * 6301) % 29989) * 10e0 as y")


PLACES = HEAD + ", places as (select c_custkey as id, 15400000e0 + ((c_custkey * 5077) % 30011) * 10e0 as x, 4200000e0 + ((c_custkey * 6301) % 29989) * 10e0 as y from customer)"
register("j15_points_in_polygons", lambda s, d: sp.points_in_polygons(places(s, d), rings(s, d), 10_000.0, True), PLACES + " select p.id, b.feature_id from places p join b on p.x > x0 and p.x < x1 and p.y > y0 and p.y < y1")
register("w13_first_polygon", lambda s, d: sp.first_polygon(places(s, d), rings(s, d), 10_000.0, True).select("id", "feature_id"), PLACES + " select p.id, min(b.feature_id) as feature_id from places p left join b on p.x > x0 and p.x < x1 and p.y > y0 and p.y < y1 group by p.id")
DIST = "sqrt(power(greatest(x0 - x, 0, x - x1), 2) + power(greatest(y0 - y, 0, y - y1), 2))"
register(
    "j15_bind_points",
    lambda s, d: sp.bind_points(places(s, d), rings(s, d), 10_000.0, 8_000.0, True).select("id", "feature_id", "method", F.round("distance_m", 4).alias("distance_m")),
    PLACES + f", f as (select p.id, min(b.feature_id) as feature_id from places p join b on p.x > x0 and p.x < x1 and p.y > y0 and p.y < y1 group by p.id), n as (select p.id, b.feature_id, {DIST} as m, row_number() over (partition by p.id order by {DIST}, b.feature_id) as k from places p join b on {DIST} <= 8000 where p.id not in (select id from f)) select p.id, coalesce(f.feature_id, n.feature_id) as feature_id, case when f.id is not null then 'CONTAINS' when n.id is not null then 'NEAREST' else 'UNRESOLVED' end as method, case when f.id is not null then 0 else round(n.m, 4) end as distance_m from places p left join f on f.id = p.id left join n on n.id = p.id and n.k = 1",
)
register(
    "j05_distance_to_coast",
    lambda s, d: sp.nearest_segment(places(s, d), segments(s, d), 12_000.0).select("id", "line_id", F.round("distance_m", 4).alias("distance_m")),
    PLACES + ", m as (select p.id, b.feature_id, case when x > x0 and x < x1 and y > y0 and y < y1 then least(x - x0, x1 - x, y - y0, y1 - y) else " + DIST + " end as m from places p cross join b), k as (select *, row_number() over (partition by id order by m, feature_id) as k from m where m <= 12000) select p.id, k.feature_id as line_id, round(k.m, 4) as distance_m from places p left join k on k.id = p.id and k.k = 1",
)
register(
    "j28_within_distance_pairs",
    lambda s, d: sp.within_distance_pairs(rings(s, d), 9_000.0).select("a", "b", F.round("distance_m", 3).alias("distance_m")),
    HEAD + ", p as (select a.feature_id as a, b.feature_id as b, greatest(a.x0 - b.x1, b.x0 - a.x1, 0) as dx, greatest(a.y0 - b.y1, b.y0 - a.y1, 0) as dy, (a.x0 > b.x0 and a.x1 < b.x1 and a.y0 > b.y0 and a.y1 < b.y1) as ain, least(a.x0 - b.x0, b.x1 - a.x1, a.y0 - b.y0, b.y1 - a.y1) as ai, (b.x0 > a.x0 and b.x1 < a.x1 and b.y0 > a.y0 and b.y1 < a.y1) as bin, least(b.x0 - a.x0, a.x1 - b.x1, b.y0 - a.y0, a.y1 - b.y1) as bi from b a join b b on a.feature_id < b.feature_id), d as (select a, b, case when ain then ai when bin then bi else sqrt(dx * dx + dy * dy) end as m from p) select a, b, round(m, 3) as distance_m from d where m <= 9000",
)
register("p18_touches_clip", lambda s, d: sp.touches_clip(rings(s, d), (15410000.0, 4210000.0, 15690000.0, 4490000.0), 500.0), HEAD + " select feature_id, x0 <= 15410500 or y0 <= 4210500 or x1 >= 15689500 or y1 >= 4489500 as touches_clip_boundary from b")
register("p31_without_clip_edges", lambda s, d: sp.without_clip_edges(segments(s, d).select("line_id", F.greatest("x1", F.lit(15450000.0)).alias("x1"), "y1", F.greatest("x2", F.lit(15450000.0)).alias("x2"), "y2"), (15450000.0, 0.0, 9e9, 9e9)).groupBy("line_id").agg(F.count("*").alias("sides")), HEAD + " select feature_id as line_id, cast(case when x1 <= 15450001 then 0 when x0 <= 15450001 then 3 else 4 end as bigint) as sides from b where x1 > 15450001")
register("f40_ring_faults", lambda s, d: sp.ring_faults(boxes(s, d).selectExpr("feature_id", "case when feature_id % 3 = 0 then array(cx, cx + hx, cx, cx + hx) when feature_id % 3 = 1 then array(cx, cx + hx) else array(cx, cx + hx, cx + hx, cx) end as xs", "case when feature_id % 3 = 0 then array(cy, cy + hy, cy + hy, cy - hy) when feature_id % 3 = 1 then array(cy, cy) else array(cy, cy, cy + hy, cy + hy) end as ys")), HEAD + " select feature_id, case when feature_id % 3 = 0 then 'CROSSES_ITSELF' else 'TOO_FEW_CORNERS' end as fault from boxes where feature_id % 3 < 2")

Q = "(0.9933056200098587e0 * (s{0} / (1 - 0.0066943799901413165e0 * s{0} * s{0}) + ln((1 + 0.08181919084262149e0 * s{0}) / (1 - 0.08181919084262149e0 * s{0})) / (2 * 0.08181919084262149e0)))"
register("f06_ground_areas", lambda s, d: sp.ground_areas(rings(s, d)).select("feature_id", F.round("ground_km2", 4).alias("ground_km2")), HEAD + ", l as (select feature_id, x0, x1, sin(atan(sinh(y0 / 6378137e0))) as s0, sin(atan(sinh(y1 / 6378137e0))) as s1 from b) select feature_id, round(6378137e0 * 6378137e0 / 2 * (" + Q.format(1) + " - " + Q.format(0) + ") * (x1 - x0) / 6378137e0 / 1e6, 4) as ground_km2 from l")


def wide(s, d):
    """Boxes three times as large, many of which overlap."""
    return boxes(s, d).selectExpr("feature_id", "false as is_hole", "array(cx - 3 * hx, cx + 3 * hx, cx + 3 * hx, cx - 3 * hx) as xs", "array(cy - 3 * hy, cy - 3 * hy, cy + 3 * hy, cy + 3 * hy) as ys")


OVERLAPS = HEAD + ", w as (select feature_id, cx - 3 * hx as x0, cx + 3 * hx as x1, cy - 3 * hy as y0, cy + 3 * hy as y1 from boxes), o as (select a.feature_id as a, b.feature_id as b, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) as m from w a join w b on a.feature_id < b.feature_id and a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1)"
register("j19_overlaps", lambda s, d: sp.overlaps(wide(s, d), GRID, 1.0).select("a", "b", F.round("overlap_m2", -1).alias("overlap_m2")), OVERLAPS + " select a, b, round(m, -1) as overlap_m2 from o where m > 1")
register("j20_large_overlaps", lambda s, d: sp.overlaps(wide(s, d), GRID, 1e7).select("a", "b"), OVERLAPS + " select a, b from o where m > 1e7")
register("m10_land_fragments", lambda s, d: sp.land_fragments(*classed(s, d), GRID).select("fragment_id", "hex_id", "subject", F.round("area_m2", 2).alias("area_m2")))
