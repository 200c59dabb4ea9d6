"""Queries on places and hexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.geodesy import hex_ground_area_km2
from hexloom.functions.hexgrid import GridSpec, neighbours
from hexloom.functions.projection import to_mercator, to_wgs84
from hexloom.operators import grid as g
from hexloom.operators import points as p

from .registry import register
from .standins import PLACED_SQL, cte, stand_in

GRID = GridSpec(6000.0)
HEAD = cte("points") + PLACED_SQL


def placed(spark, sf_dir):
    return p.place_points(stand_in(spark, sf_dir, "points"), GRID)


def cells(spark, sf_dir):
    """The distinct cells that hold a place."""
    return placed(spark, sf_dir).select("q", "r").distinct()


def r3(*names):
    return [F.round(n, 3).alias(n) for n in names]


register(
    "j01_points_to_hex",
    lambda s, d: placed(s, d).select("id", "q", "r", "hex_id", *r3("centre_x", "centre_y", "to_centre_m")),
    HEAD + "select id, q, r, hex_id, round(centre_x, 3) as centre_x, round(centre_y, 3) as centre_y, round(sqrt((x - centre_x) * (x - centre_x) + (y - centre_y) * (y - centre_y)), 3) as to_centre_m from placed",
)


def f01(s, d):
    x, y = to_mercator(F.col("lon"), F.col("lat"))
    lon, lat = to_wgs84(F.col("x"), F.col("y"))
    return stand_in(s, d, "points").select("id", x.alias("x"), y.alias("y")).select("id", *r3("x", "y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


register("f01_mercator_round_trip", f01, HEAD + "select id, round(x, 3) as x, round(y, 3) as y, round(lon, 6) as lon, round(lat, 6) as lat from placed")
register("f04_hex_ids", lambda s, d: placed(s, d).select("hex_id", "q", "r").distinct(), HEAD + "select distinct hex_id, q, r from placed")
register(
    "f05_neighbours",
    lambda s, d: cells(s, d).select("q", "r", F.explode(neighbours(F.col("q"), F.col("r"))).alias("n")).select("q", "r", F.col("n.q").alias("nq"), F.col("n.r").alias("nr")),
    HEAD + "select c.q, c.r, c.q + v.dq as nq, c.r + v.dr as nr from (select distinct q, r from placed) c cross join (values (1, 0), (1, -1), (0, -1), (-1, 0), (-1, 1), (0, 1)) v(dq, dr)",
)
register(
    "f05_corners",
    lambda s, d: cells(s, d).select("q", "r", F.posexplode(GRID.corners(F.col("q"), F.col("r"))).alias("corner", "at")).select("q", "r", F.col("corner").cast("bigint"), F.round("at.x", 2).alias("x"), F.round("at.y", 2).alias("y")),
    HEAD + "select q, r, cast(k as bigint) as corner, round(6000 * (q + r / 2e0) + 6000 / sqrt(3e0) * cos(radians(-30e0 + 60 * k)), 2) as x, round(1.5e0 * 6000 / sqrt(3e0) * r + 6000 / sqrt(3e0) * sin(radians(-30e0 + 60 * k)), 2) as y from (select distinct q, r from placed) cross join range(6) t(k)",
)
register(
    "a07_hex_city_summary",
    lambda s, d: p.hex_summary(placed(s, d)),
    HEAD + ", k as (select *, row_number() over (partition by hex_id order by population desc, id) as n from placed) select hex_id, count(*) as city_count, max(id) filter (n = 1) as primary_city_id, max(name) filter (n = 1) as primary_city_name from k group by hex_id",
)
register(
    "j02_city_hex_info",
    lambda s, d: p.with_hex_info(placed(s, d).select("id", "hex_id"), p.hex_summary(placed(s, d))).select("id", "hex_id", "city_count", "primary_city_id"),
    HEAD + ", k as (select *, row_number() over (partition by hex_id order by population desc, id) as n from placed) select id, hex_id, count(*) over (partition by hex_id) as city_count, first_value(id) over (partition by hex_id order by n) as primary_city_id from k",
)
register(
    "w06_cities_in_same_hex",
    lambda s, d: p.group_sizes(placed(s, d)).select("id", "cities_in_same_hex", "shares_hex"),
    HEAD + "select id, count(*) over (partition by hex_id) as cities_in_same_hex, count(*) over (partition by hex_id) > 1 as shares_hex from placed",
)
register(
    "j11_nearest_other_city",
    lambda s, d: p.nearest_other(placed(s, d).select("id", "name", "x", "y"), 3000.0).select("id", "nearest_id", "nearest_name", *r3("nearest_m")),
    HEAD + ", n as (select a.id, b.id as nearest_id, b.name as nearest_name, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as m from placed a join placed b on a.id <> b.id), k as (select *, row_number() over (partition by id order by m, nearest_id) as rn from n) select id, nearest_id, nearest_name, round(m, 3) as nearest_m from k where rn = 1",
)
register(
    "a01_collision_summary",
    lambda s, d: p.collision_summary(placed(s, d), [100_000, 500_000]),
    HEAD + """, levels as (select * from (values ('overall', null), ('population_ge_100000', 100000), ('population_ge_500000', 500000)) v(level, least)),
h as (select level, hex_id, count(*) as n, sum(population) as p, string_agg(name, '+' order by population desc, id) as names from placed join levels on least is null or population >= least group by all)
select level, cast(sum(n) as bigint) as city_count, cast(sum(case when n > 1 then n else 0 end) as bigint) as cities_sharing_hex_count, count(*) filter (n > 1) as city_hex_collision_count,
cast(sum(case when n > 1 then p else 0 end) as bigint) as collision_population_sum, coalesce(string_agg(names, '; ' order by names) filter (n > 1), '') as collision_city_names from h group by level""",
)

BOX_SQL = "select min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from placed"


def box(s, d):
    return placed(s, d).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()


register(
    "p01_hexes_covering_box",
    lambda s, d: g.hexes_covering(s, GRID, *box(s, d)),
    HEAD + f""", b as ({BOX_SQL}), s as (select 6000 / sqrt(3e0) as side),
rr as (select unnest(range(cast(floor((y0 - side) / (1.5e0 * side)) as bigint), cast(ceil((y1 + side) / (1.5e0 * side)) as bigint) + 1)) as r, x0 - side as lx, x1 + side as hx, y0 - side as ly, y1 + side as hy, side from b, s),
cc as (select r, unnest(range(cast(floor(lx / 6000 - r / 2e0) as bigint), cast(ceil(hx / 6000 - r / 2e0) as bigint) + 1)) as q, lx, hx, ly, hy, side from rr)
select q, r from cc where 6000 * (q + r / 2e0) between lx and hx and 1.5e0 * side * r between ly and hy""",
)
register(
    "p02_chunk_grid",
    lambda s, d: g.chunk_grid(s, 138.5, 34.5, 141.5, 37.5, 0.7).join(
        stand_in(s, d, "points").select(*[c.alias(n) for n, c in zip(("ix", "iy"), g.in_chunk(F.col("lon"), F.col("lat"), 138.5, 34.5, 0.7, 5, 5))]).groupBy("ix", "iy").count(), ["ix", "iy"], "left"
    ).select("chunk_id", F.col("ix").cast("bigint"), F.col("iy").cast("bigint"), F.round("max_lon", 6).alias("max_lon"), F.round("max_lat", 6).alias("max_lat"), "last_column", "last_row", F.coalesce("count", F.lit(0)).alias("points")),
    cte("points") + """, c as (select id as k, id % 5 as ix, id // 5 as iy from range(25) t(id)), n as (select cast(floor((lon - 138.5e0) / 0.7e0) as bigint) as ix, cast(floor((lat - 34.5e0) / 0.7e0) as bigint) as iy, count(*) as n from points group by all)
select printf('euc_%02d_%02d', c.ix, c.iy) as chunk_id, c.ix, c.iy, round(least(141.5e0, 138.5e0 + (c.ix + 1) * 0.7e0), 6) as max_lon, round(least(37.5e0, 34.5e0 + (c.iy + 1) * 0.7e0), 6) as max_lat, c.ix = 4 as last_column, c.iy = 4 as last_row, coalesce(n, 0) as points from c left join n on n.ix = c.ix and n.iy = c.iy""",
)
EDGES_SQL = """, hx as (select distinct q, r, hex_id from placed),
sides as (select h.hex_id as hex, 2 * h.q + h.r + v.ax as ax, 3 * h.r + v.ay as ay, 2 * h.q + h.r + v.bx as bx, 3 * h.r + v.bz as byy from hx h cross join (values (1, -1, 1, 1), (1, 1, 0, 2), (0, 2, -1, 1), (-1, 1, -1, -1), (-1, -1, 0, -2), (0, -2, 1, -1)) v(ax, ay, bx, bz)),
norm as (select hex, case when (ax, ay) < (bx, byy) then ax else bx end as x1, case when (ax, ay) < (bx, byy) then ay else byy end as y1, case when (ax, ay) < (bx, byy) then bx else ax end as x2, case when (ax, ay) < (bx, byy) then byy else ay end as y2 from sides),
edges as (select x1, y1, x2, y2, min(hex) as hex_a, case when count(*) > 1 then max(hex) end as hex_b from norm group by all)
"""
register(
    "g01_edge_graph",
    lambda s, d: g.edge_graph(cells(s, d), GRID).select("edge_id", F.col("n1.x").alias("x1"), F.col("n1.y").alias("y1"), F.col("n2.x").alias("x2"), F.col("n2.y").alias("y2"), "hex_a", "hex_b"),
    HEAD + EDGES_SQL + "select 'e_' || hex_a || '_' || coalesce(hex_b, 'OUT') as edge_id, x1, y1, x2, y2, hex_a, hex_b from edges",
)
register(
    "f31_edge_measures",
    lambda s, d: g.edge_measures(g.edge_graph(cells(s, d), GRID), GRID).select("edge_id", F.round("mid_x", 2).alias("mid_x"), F.round("mid_y", 2).alias("mid_y"), F.round("length_m", 2).alias("length_m"), F.round("direction_deg", 2).alias("direction_deg")),
    HEAD + EDGES_SQL + """, m as (select 'e_' || hex_a || '_' || coalesce(hex_b, 'OUT') as edge_id, x1 * 3000e0 as ax, y1 * (6000 / sqrt(3e0) / 2) as ay, x2 * 3000e0 as bx, y2 * (6000 / sqrt(3e0) / 2) as byy from edges)
select edge_id, round((ax + bx) / 2, 2) as mid_x, round((ay + byy) / 2, 2) as mid_y, round(sqrt((bx - ax) ** 2 + (byy - ay) ** 2), 2) as length_m, round(case when degrees(atan2(byy - ay, bx - ax)) < 0 then degrees(atan2(byy - ay, bx - ax)) + 360 else degrees(atan2(byy - ay, bx - ax)) end, 2) as direction_deg from m""",
)
register(
    "f39_generated_coastline",
    lambda s, d: g.generated_coastline(cells(s, d), (F.col("q") + F.col("r")) % 3 != 0, GRID).select("edge_id", "hex_a", "hex_b"),
    HEAD + EDGES_SQL + "select 'e_' || a.hex_id || '_' || b.hex_id as edge_id, e.hex_a, e.hex_b from edges e join hx a on a.hex_id = e.hex_a join hx b on b.hex_id = e.hex_b where ((a.q + a.r) % 3 <> 0) <> ((b.q + b.r) % 3 <> 0)",
)


def j12(s, d):
    every = placed(s, d)
    targets = every.where("id % 7 = 0").select(F.col("id").alias("target"), "x", "y")
    return p.nearest_within(every.where("id % 7 <> 0").select("id", "x", "y"), targets, 20_000.0).select("id", "target", *r3("distance_m"))


register(
    "j12_nearest_within",
    j12,
    HEAD + ", n as (select a.id, b.id as target, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) as m from placed a join placed b on a.id % 7 <> 0 and b.id % 7 = 0), k as (select *, row_number() over (partition by id order by m, target) as rn from n where m <= 20000) select p.id, k.target, round(k.m, 3) as distance_m from placed p left join k on k.id = p.id and k.rn = 1 where p.id % 7 <> 0",
)
register(
    "f35_hex_ground_area",
    lambda s, d: cells(s, d).select("q", "r", F.round(hex_ground_area_km2(6000.0, to_wgs84(*GRID.centre(F.col("q"), F.col("r")))[1]), 4).alias("km2")),
    HEAD + "select distinct q, r, round(sqrt(3e0) / 2 * 36 * power(cos(atan(sinh(1.5e0 * 6000 / sqrt(3e0) * r / 6378137e0))), 2), 4) as km2 from placed",
)
