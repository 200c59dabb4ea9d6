"""Queries on classes, audits, bindings, summaries and gates of cells and places."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.functions.ids import hashed_id
from hexloom.functions.projection import to_wgs84
from hexloom.operators import authority as a
from hexloom.operators import grid as g
from hexloom.operators import islands as i
from hexloom.operators import rasters, spatial
from hexloom.operators.checks import components_of_edges
from hexloom.operators.control import dominant
from hexloom.operators.points import nearest_within, place_points
from hexloom.sources import tables as t
from hexloom.tables import fresh_dir, written

from .registry import register
from .spatial import DIST, HEAD, OVERLAPS, PLACES, boxes, places, rings, wide
from .standins import PLACED_SQL, cte, stand_in

GRID = GridSpec(6000.0)
LAY, HOLD, CO = cte("layers"), cte("holdings"), cte("control")
PT = cte("points") + PLACED_SQL


def lay(s, d):
    return stand_in(s, d, "layers")


def hold(s, d):
    """The summed area of each holder in each cell."""
    return stand_in(s, d, "holdings").groupBy("hex_id", "polity_id").agg(F.sum("km2").alias("km2"))


HELD = HOLD + ", held as (select hex_id, polity_id, sum(km2) as km2 from holdings group by all)"


def control(s, d):
    return stand_in(s, d, "control")


def placed(s, d):
    return place_points(stand_in(s, d, "points"), GRID)


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


# Cells

register(
    "s02_populations",
    lambda s, d: stand_in(s, d, "points").select("id", t.cleaned_population(F.when(F.col("id") % 5 == 0, "n/a").when(F.col("id") % 5 == 1, None).otherwise(F.col("population").cast("string"))).alias("population")),
    PT + " select id, case when id % 5 < 2 then 0 else population end as population from points",
)
register(
    "s05_lakes",
    lambda s, d: boxes(s, d).withColumn("area_km2", F.col("hx") * F.col("hy") * 4 / 1e6).where("area_km2 >= 60").select("feature_id", F.round("area_km2", 6).alias("area_km2")),
    "select cast(s_suppkey as bigint) as feature_id, round((500e0 + abs(s_acctbal)) * (300e0 + abs(s_acctbal) * 0.7e0) * 4 / 1e6, 6) as area_km2 from supplier where (500e0 + abs(s_acctbal)) * (300e0 + abs(s_acctbal) * 0.7e0) * 4 / 1e6 >= 60",
)


def s09(s, d):
    """Cover tiles of the places' extent with the number of places in each."""
    tiles = rasters.tile_names(138.5, 34.5, 141.5, 37.5, 3, s, rasters.degree_name)
    third = lambda c: (F.floor(F.col(c) / 3) * 3).cast("int")
    there = stand_in(s, d, "points").groupBy(third("lat").alias("south"), third("lon").alias("west")).count()
    return tiles.join(there, ["south", "west"], "left").select("tile", F.coalesce("count", F.lit(0)).alias("points"))


register(
    "s09_cover_tiles",
    s09,
    PT + """, n as (select cast(floor(lat / 3) * 3 as bigint) as s, cast(floor(lon / 3) * 3 as bigint) as w, count(*) as n from points group by all)
select printf('N%02dE%03d', a.s, b.w) as tile, coalesce(n.n, 0) as points from (values (33), (36)) a(s) cross join (values (138), (141)) b(w) left join n on n.s = a.s and n.w = b.w""",
)
register("s17_snapshot_by_id", lambda s, d: t.by_id(control(s, d), "controller", "Brand#11").select("target_id", "status"), CO + " select target_id, status from control where controller = 'Brand#11'")


def p03(s, d):
    ix, iy = g.in_chunk(F.col("lon"), F.col("lat"), 138.0, 34.0, 0.5, 7, 7)
    return stand_in(s, d, "points").select("id", ix.cast("bigint").alias("ix"), iy.cast("bigint").alias("iy"))


register("p03_chunk_of_points", p03, PT + " select id, cast(floor((lon - 138e0) / 0.5e0) as bigint) as ix, cast(floor((lat - 34e0) / 0.5e0) as bigint) as iy from points")
register(
    "p05_dateline_boxes",
    lambda s, d: rounded(g.without_dateline(boxes(s, d).selectExpr("feature_id", "170e0 + feature_id % 8 as west", "-10e0 as south", "case when feature_id % 8 > 5 then -183e0 + feature_id % 8 else 174e0 + feature_id % 8 end as east", "10e0 as north")), 6, "west", "east").select("feature_id", "west", "east"),
    """with b as (select cast(s_suppkey as bigint) as feature_id, s_suppkey % 8 as k from supplier)
select feature_id, 170e0 + k as west, 174e0 + k as east from b where k <= 5 union all select feature_id, 170e0 + k, 180e0 from b where k > 5 union all select feature_id, -180e0, -183e0 + k from b where k > 5""",
)
register(
    "p06_land_class",
    lambda s, d: rounded(a.classes_of_fraction(lay(s, d).select("hex_id", "land_fraction"), 0.35), 6, "water_fraction", "wrong_fraction").select("hex_id", "water_fraction", "land_class", "is_coastal", "wrong_fraction"),
    LAY + """ select hex_id, round(1 - land_fraction, 6) as water_fraction, case when land_fraction >= 0.35e0 then 'land' else 'water' end as land_class, land_fraction > 0 and land_fraction < 1 as is_coastal,
round(case when land_fraction >= 0.35e0 then 1 - land_fraction else land_fraction end, 6) as wrong_fraction from layers""",
)
register(
    "p07_masks",
    lambda s, d: a.with_masks(lay(s, d).select("hex_id", (F.col("land_class") == "land").alias("is_land"), F.when(F.col("climate") % 3 == 0, "LAKE").otherwise("NONE").alias("water_type"))).select("hex_id", "coast_land_mask", "is_water_hex", "is_terrestrial_hex"),
    LAY + " select hex_id, land_class = 'land' as coast_land_mask, climate % 3 = 0 as is_water_hex, climate % 3 <> 0 as is_terrestrial_hex from layers",
)


def p10(s, d):
    cells = lay(s, d).select("hex_id", (F.col("hex_id") % 2 == 0).alias("was_land"), (F.col("hex_id") % 3 == 0).alias("is_land"), F.col("urban_fraction").alias("nodata_fraction"), F.when(F.col("hex_id") % 15 != 0, F.col("elevation_range_m")).alias("elevation"), "tree_fraction")
    fresh = lay(s, d).select("hex_id", F.when(F.col("hex_id") % 7 != 0, F.col("shrub_fraction")).alias("tree_fraction"), F.lit(1.0).alias("elevation"))
    return a.resampled(cells, fresh, ["tree_fraction", "elevation"], 0.5).select("hex_id", "resampled", "tree_fraction", "elevation")


register(
    "p10_resampled",
    p10,
    LAY + """, r as (select *, hex_id % 2 <> 0 and hex_id % 3 = 0 and (urban_fraction > 0.5e0 or hex_id % 15 = 0) as due from layers)
select hex_id, due as resampled, case when due and hex_id % 7 <> 0 then shrub_fraction else tree_fraction end as tree_fraction, case when due then 1e0 when hex_id % 15 <> 0 then elevation_range_m end as elevation from r""",
)


def p30(s, d):
    cells = lay(s, d).select("hex_id", (F.col("climate") % 4).alias("landmass"), (F.col("land_fraction") > 0.3).alias("authorised"))
    held = control(s, d).where("price > 1000").select(F.col("target_id").alias("hex_id"), "status")
    return a.gap_counts(cells, held, lay(s, d).where("tree_fraction > 0.6").select("hex_id"), "landmass")


register(
    "p30_gap_counts",
    p30,
    "with layers as (" + LAY.split("layers as (", 1)[1].rsplit(")", 1)[0] + "), " + CO.removeprefix("with ") + """, h as (select l.hex_id, l.climate % 4 as landmass, l.land_fraction > 0.3e0 as authorised, l.tree_fraction > 0.6e0 as fragment, c.status
from layers l left join control c on c.target_id = l.hex_id and c.price > 1000)
select landmass, count(*) filter (status = 'CONTROLLED') as controlled, count(*) filter (status = 'UNRESOLVED') as unresolved, count(*) filter (status is null and authorised and fragment) as recovered,
count(*) filter (status is null and authorised and not fragment) as gap, count(*) filter (status is null and not authorised) as unknown from h group by 1""",
)


def a14(s, d):
    held = hold(s, d)
    units = held.groupBy(F.col("polity_id").alias("unit_id")).agg(F.sum("km2").alias("projected_km2")).withColumn("ground_km2", F.col("projected_km2") * 0.5)
    return rounded(a.cell_overlays(lay(s, d), held.withColumnsRenamed({"polity_id": "unit_id", "km2": "area_km2"}), units), 6, "overlay_km2")


register(
    "a14_cell_overlays",
    a14,
    "with layers as (" + LAY.split("layers as (", 1)[1].rsplit(")", 1)[0] + "), " + HELD.removeprefix("with ") + """, units as (select polity_id, sum(km2) as km2 from held group by 1),
k as (select h.hex_id, h.polity_id, h.km2 * 0.5e0 as here, row_number() over (partition by h.hex_id order by u.km2 desc, h.polity_id) as k from held h join units u using (polity_id)),
s as (select hex_id, count(*) as n, sum(here) as km2, max(polity_id) filter (k = 1) as first from k group by 1)
select l.hex_id, s.n is not null as has_overlay, coalesce(s.n, 0) as overlays, round(coalesce(s.km2, 0), 6) as overlay_km2, s.first as primary_unit from layers l left join s using (hex_id)""",
)


def j39(s, d):
    sums = hold(s, d).groupBy("hex_id").agg(F.count("*").alias("river_edges"), F.max("km2").alias("max_discharge"))
    return a.with_helpers(lay(s, d).select("hex_id"), sums.where("river_edges > 5"))


register(
    "j39_helpers",
    j39,
    "with layers as (" + LAY.split("layers as (", 1)[1].rsplit(")", 1)[0] + "), " + HELD.removeprefix("with ") + """, s as (select hex_id, count(*) as n, max(km2) as m from held group by 1 having count(*) > 5)
select l.hex_id, coalesce(s.n, 0) as river_edges, coalesce(s.m, 0) as max_discharge from layers l left join s using (hex_id)""",
)
register(
    "m14_anchored_owners",
    lambda s, d: a.anchored_owners(placed(s, d).select("hex_id", F.when(F.col("id") % 11 != 0, F.concat(F.lit("crown"), (F.col("population") % 3).cast("string"))).alias("owner"))),
    PT + """, o as (select hex_id, 'crown' || (population % 3) as owner from placed where id % 11 <> 0)
select hex_id, count(*) as anchors, count(distinct owner) as owners, case when count(distinct owner) = 1 then min(owner) end as owner, case when count(distinct owner) = 1 then 'OWNED' else 'REFUSED_MIXED' end as decision from o group by 1""",
)
register(
    "a39_world_hexes",
    lambda s, d: s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("bigint").alias("id"), a.world_hexes(3**0.5 / 2 * F.pow((F.col("n_nationkey") + 1) * 1000.0, F.lit(2)), 40075016.68557849).alias("hexes")),
    "select cast(n_nationkey as bigint) as id, cast(round(40075016.68557849e0 ** 2 / (sqrt(3e0) / 2 * ((n_nationkey + 1) * 1000e0) ** 2)) as bigint) as hexes from nation",
)

# Status of components, samples and pairs

register(
    "p21_component_status",
    lambda s, d: lay(s, d).select("hex_id", a.component_status(F.when(F.col("climate") % 6 == 0, "SUBHEX_OVERLAY"), F.col("hex_id") % 3 == 0, F.col("hex_id") % 5 == 0, F.when(F.col("hex_id") % 4 != 0, F.col("hex_id") % 7 != 0)).alias("status")),
    LAY + """ select hex_id, case when climate % 6 = 0 then 'SUBHEX_OVERLAY' when hex_id % 3 = 0 then 'TERRESTRIAL_HEX' when hex_id % 5 = 0 then 'CLIP_FRAGMENT' when hex_id % 4 <> 0 and hex_id % 7 = 0 then 'OUT_OF_COVERAGE' else 'UNGROUPED' end as status from layers""",
)


def j14(s, d):
    """Every place as a coast sample: the nearest cell of two sets of cells, within four steps, and the cause that follows."""
    every = placed(s, d)
    to = lambda cells, name: i.nearest_hex(every.select("id", "x", "y"), cells.select("q", "r").distinct(), GRID, 3, 1e9).select("id", F.col("distance_m").alias(name))
    out = to(every.where("population >= 300000"), "to_land_m").join(to(every.where("population < 600000"), "to_water_m"), "id")
    cause = a.outlier_cause(F.coalesce("to_land_m", F.lit(1e9)), F.coalesce("to_water_m", F.lit(1e9)), (F.col("id") % 10) * 1e7, 6000.0, GRID.area)
    return rounded(out.withColumn("cause", cause), 3, "to_land_m", "to_water_m")


STEPS = "greatest(abs(p.q - c.q), abs(p.r - c.r), abs(p.q - c.q + p.r - c.r)) <= 3"
TO_CELL = "case when p.q = c.q and p.r = c.r then 0 else sqrt((p.x - c.centre_x) ** 2 + (p.y - c.centre_y) ** 2) end"
register(
    "j14_outlier_causes",
    j14,
    PT + f""", land as (select distinct q, r, centre_x, centre_y from placed where population >= 300000), water as (select distinct q, r, centre_x, centre_y from placed where population < 600000),
l as (select p.id, min({TO_CELL}) as m from placed p join land c on {STEPS} group by 1), w as (select p.id, min({TO_CELL}) as m from placed p join water c on {STEPS} group by 1),
e as (select p.id, l.m as lm, w.m as wm, coalesce(l.m, 1e9) as lc, coalesce(w.m, 1e9) as wc from placed p left join l using (id) left join w using (id))
select id, round(lm, 3) as to_land_m, round(wm, 3) as to_water_m, case when lc > 9000 and (id % 10) * 1e7 < sqrt(3e0) / 2 * 36e6 then 'SMALL_ISLAND_LOST' when lc > 9000 then 'NARROW_PENINSULA' when wc > 9000 then 'NARROW_INLET' else 'HEX_MAJORITY_QUANTISATION' end as cause from e""",
)
register(
    "p28_topology_status",
    lambda s, d: lay(s, d).select("hex_id", a.topology_status(F.col("tree_fraction") - 0.5, F.col("urban_fraction") * 10, F.lit(4.0)).alias("status")),
    LAY + " select hex_id, case when tree_fraction - 0.5e0 > 0.01 then 'OVERLAP' when urban_fraction * 10 <= 4 then 'WITHIN_UNCERTAINTY' else 'GAP' end as status from layers",
)
register(
    "p29_active_records",
    lambda s, d: a.active(control(s, d).withColumn("audit_record_status", F.when(F.col("size") % 4 == 0, "SUPERSEDED").otherwise("ACTIVE"))).select("target_id"),
    CO + " select target_id from control where size % 4 <> 0",
)


def j34(s, d):
    """Each supplier's box as an old overlay; the boxes of the places' cells it holds by their middle are the new units."""
    found = spatial.points_in_polygons(places(s, d), rings(s, d), 10_000.0, True)
    units = s.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey as unit_id", "abs(c_acctbal) as ground_km2")
    return rounded(a.before_after(boxes(s, d).selectExpr("feature_id as old_id"), found.selectExpr("feature_id as old_id", "id as unit_id"), units), 4, "new_km2")


register(
    "j34_before_after",
    j34,
    PLACES + """, m as (select b.feature_id as old_id, count(*) as n, string_agg(cast(p.id as varchar), '|' order by cast(p.id as varchar)) as ids, sum(abs(c.c_acctbal)) as km2 from places p join b on p.x > x0 and p.x < x1 and p.y > y0 and p.y < y1 join customer c on c.c_custkey = p.id group by 1)
select b.feature_id as old_id, coalesce(n, 0) as new_units, coalesce(ids, '') as new_ids, round(coalesce(km2, 0), 4) as new_km2, case when n is null then 'EXCLUDED' when n = 1 then 'PRESERVED' else 'SPLIT' end as status from b left join m on m.old_id = b.feature_id""",
)


def j43(s, d):
    """Which box holds the most places, seen as anchors; a landmass holds twelve."""
    found = spatial.points_in_polygons(places(s, d), rings(s, d), 10_000.0, True)
    return rounded(a.landmass_identity(boxes(s, d).selectExpr("feature_id as component_id", "round(4 * hx * hy / 1e6, 6) as km2"), found.selectExpr("feature_id as component_id", "id as anchor"), 12), 6, "km2")


register(
    "j43_landmass_identity",
    j43,
    PLACES + """, c as (select feature_id, round((x1 - x0) * (y1 - y0) / 1e6, 6) as km2 from b), z as (select feature_id, round(4 * hx * hy / 1e6, 6) as km2 from boxes),
m as (select b.feature_id, count(*) as held, string_agg(cast(p.id as varchar), '|' order by cast(p.id as varchar)) as anchors from places p join b on p.x > x0 and p.x < x1 and p.y > y0 and p.y < y1 group by 1)
select z.feature_id as component_id, z.km2, (select count(*) from z o where o.km2 > z.km2) as larger, m.held, m.anchors, m.held = 12 as is_landmass from z join m using (feature_id)""",
)

# Administrative tables and bindings


def nations(s, d):
    return s.read.parquet(f"{d}/nation.parquet").selectExpr("n_nationkey as code", "case when n_nationkey % 3 = 0 then '-99' else cast(n_nationkey as string) end as source_id", "n_name as name", "n_name as shape")


register("j24_countries", lambda s, d: i.admin0(nations(s, d)).select("code", "reference_id", "name"), "select n_nationkey as code, case when n_nationkey % 3 = 0 then 'adm0_h' || substr(sha1(n_name), 1, 12) else 'adm0_' || n_nationkey end as reference_id, n_name as name from nation")


def j25(s, d):
    units = s.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey as unit_id", "case when s_suppkey % 10 = 0 then '-99' else cast(s_nationkey as string) end as country_code", "cast(s_suppkey % 25 as string) as sovereign_code")
    return a.country_hierarchy(units, i.admin0(nations(s, d)).withColumn("code", F.col("code").cast("string"))).select("unit_id", "country_code", "relationship", "reference_id")


register(
    "j25_country_hierarchy",
    j25,
    """with u as (select s_suppkey as unit_id, case when s_suppkey % 10 <> 0 then cast(s_nationkey as varchar) end as country_code, cast(s_suppkey % 25 as varchar) as sovereign_code from supplier)
select unit_id, country_code, case when country_code = sovereign_code then 'MAP_UNIT_OF_COUNTRY' else 'MAP_UNIT_OF_DEPENDENT_TERRITORY' end as relationship,
case when n_nationkey % 3 = 0 then 'adm0_h' || substr(sha1(n_name), 1, 12) else 'adm0_' || n_nationkey end as reference_id from u left join nation on cast(n_nationkey as varchar) = country_code""",
)
register(
    "j27_disputed_areas",
    lambda s, d: a.disputed_areas(nations(s, d).withColumns({"kind": F.when(F.col("code") % 2 == 0, F.lit("-99")).otherwise("Disputed"), "class": F.lit("Admin")})).select("dispute_id", "name", "source_number", "classification", "decides"),
    """select case when n_nationkey % 3 = 0 then 'disp_h' || substr(sha1(n_name), 1, 12) else 'disp_' || n_nationkey end as dispute_id, n_name as name, case when n_nationkey % 3 <> 0 then cast(n_nationkey as bigint) end as source_number,
case when n_nationkey % 2 = 0 then 'Admin' else 'Disputed' end as classification, false as decides from nation""",
)
register(
    "w03_dominant_admin",
    lambda s, d: a.dominant_admin(hold(s, d).select("hex_id", "km2", F.when(F.col("polity_id") % 3 != 0, F.col("polity_id") % 4).alias("source_id"), F.col("polity_id").alias("reference_id"))).select("hex_id", "reference_id"),
    HELD + ", k as (select hex_id, polity_id, row_number() over (partition by hex_id order by km2 desc, coalesce(case when polity_id % 3 <> 0 then cast(polity_id % 4 as varchar) end, ''), polity_id) as k from held) select hex_id, polity_id as reference_id from k where k = 1",
)


def bound(s, d, limit):
    return spatial.bind_points(places(s, d), rings(s, d), 10_000.0, limit, True)


def bound_sql(limit: int, n: str) -> str:
    """The SQL of ``bound`` as the tables f, n and bound with a suffix."""
    return f""", f{n} as (select p.id, min(b.feature_id) as feature_id from places p join b on p.x > x0 and p.x < x1 and p.y > y0 and p.y < y1 group by p.id),
n{n} as (select p.id, b.feature_id, {DIST} as m, row_number() over (partition by p.id order by {DIST}, b.feature_id) as k from places p join b on {DIST} <= {limit} where p.id not in (select id from f{n})),
bound{n} as (select p.id, coalesce(f.feature_id, n.feature_id) as feature_id, case when f.id is not null then 'CONTAINS' when n.id is not null then 'NEAREST' else 'UNRESOLVED' end as method, case when f.id is not null then 0 else n.m end as m
from places p left join f{n} f on f.id = p.id left join n{n} n on n.id = p.id and n.k = 1)"""


def named(s, d):
    return s.read.parquet(f"{d}/customer.parquet").selectExpr("c_custkey as id", "c_name as name", "cast(round(abs(c_acctbal)) as bigint) as population")


register(
    "j22_settlements",
    lambda s, d: a.settlements(named(s, d), bound(s, d, 8000.0), bound(s, d, 2000.0)).select("settlement_id", "name", "admin0", "method0", "distance0_m", "admin1", "method1"),
    PLACES + bound_sql(8000, "0") + bound_sql(2000, "1") + """ select 'setl_' || p.id as settlement_id, c_name as name, z.feature_id as admin0, z.method as method0, round(z.m, 1) as distance0_m, o.feature_id as admin1, o.method as method1
from places p join customer on c_custkey = p.id join bound0 z on z.id = p.id join bound1 o on o.id = p.id""",
)
register(
    "j23_ports",
    lambda s, d: a.ports(named(s, d).drop("population"), bound(s, d, 5000.0)).select("port_id", "admin0", "method0", "port_type"),
    PLACES + bound_sql(5000, "0") + " select 'port_' || p.id as port_id, z.feature_id as admin0, z.method as method0, cast(null as varchar) as port_type from places p join bound0 z on z.id = p.id",
)
register(
    "a37_binding_counts",
    lambda s, d: bound(s, d, 5000.0).groupBy("method").agg(F.count("*").alias("places")),
    PLACES + bound_sql(5000, "0") + " select method, count(*) as places from bound0 group by 1",
)
register(
    "j33_overlay_at_points",
    lambda s, d: rounded(bound(s, d, 3000.0).where("method <> 'UNRESOLVED'"), 4, "distance_m").select("id", "feature_id", "distance_m"),
    PLACES + bound_sql(3000, "0") + " select id, feature_id, round(m, 4) as distance_m from bound0 where method <> 'UNRESOLVED'",
)


def j17(s, d):
    every = placed(s, d)
    water = every.groupBy("q", "r").agg(F.when(F.max("population") >= 800_000, "OCEAN").otherwise("LAKE").alias("water_type"), F.max("population").alias("p")).where("p >= 500000")
    near = i.nearest_hex(every.select("id", "x", "y"), water.select("q", "r"), GRID, 2, 9000.0)
    return rounded(a.water_access(near, water), 4, "distance_m").select("id", "q", "r", "distance_m", "water_type")


register(
    "j17_water_access",
    j17,
    PT + f""", c as (select q, r, centre_x, centre_y, max(population) as p from placed group by all having max(population) >= 500000),
m as (select p.id, c.q, c.r, c.p as pop, {TO_CELL} as m from placed p join c on {STEPS.replace('<= 3', '<= 2')}), k as (select *, row_number() over (partition by id order by m, q, r) as k from m where m <= 9000)
select p.id, k.q, k.r, round(k.m, 4) as distance_m, case when k.pop >= 800000 then 'OCEAN' when k.pop is not null then 'LAKE' end as water_type from placed p left join k on k.id = p.id and k.k = 1""",
)


def j42(s, d):
    wanted = s.read.parquet(f"{d}/nation.parquet").selectExpr("n_name as candidate").union(named(s, d).where("population < 500").select("name"))
    return a.settlement_catalogue(wanted, named(s, d).withColumn("plain_name", F.lower("name"))).select("candidate", "present", "id")


register("j42_catalogue", j42, "select n_name as candidate, false as present, cast(null as bigint) as id from nation union all select c_name, true, cast(c_custkey as bigint) from customer where round(abs(c_acctbal)) < 500")
register(
    "j36_unmapped_subjects",
    lambda s, d: a.unmapped_subjects(control(s, d).select("target_id", F.col("size").alias("subject_id")), s.read.parquet(f"{d}/nation.parquet").selectExpr("cast(n_nationkey as bigint) as subject_id")).select("target_id", "reason"),
    CO + " select target_id, 'UNMAPPED_SUBJECT:' || size as reason from control where size not in (select n_nationkey from nation)",
)


def m04(s, d):
    audit = hold(s, d).groupBy("polity_id").agg(F.sum("km2").alias("source_km2"), F.count("*").alias("n")).withColumn("representation_status", F.when(F.col("n") % 3 == 0, "ZERO_HEX_LOSS").otherwise("GOOD"))
    snapshot = control(s, d).select((F.col("target_id") % 100).alias("polity_id"), F.col("target_id").alias("feature_id"), F.when(F.col("target_id") % 4 != 0, F.concat(F.lit("e"), F.col("target_id").cast("string"))).alias("evidence_ids"))
    return a.overlay_candidates(audit, snapshot).select("candidate_id", "polity_id", "source_km2", "feature_id", "status")


register(
    "m04_overlay_candidates",
    m04,
    "with control as (" + CO.split("control as (", 1)[1].rsplit(")", 1)[0] + "), " + HELD.removeprefix("with ") + """, u as (select polity_id, sum(km2) as km2, count(*) as n from held group by 1 having count(*) % 3 = 0), f as (select target_id % 100 as polity_id, min(target_id) as feature_id from control group by 1)
select 'hpo_' || u.polity_id as candidate_id, u.polity_id, u.km2 as source_km2, f.feature_id, case when f.feature_id % 4 <> 0 then 'REVIEW_REQUIRED' else 'WITHOUT_PROVENANCE' end as status from u left join f using (polity_id)""",
)
register(
    "m13_outside_exclusions",
    lambda s, d: a.outside_exclusions(places(s, d), boxes(s, d).selectExpr("feature_id as case_id", "cx as x", "cy as y", "hx as radius_m")).select("id"),
    PLACES + " select id from places p where not exists (select 1 from boxes c where sqrt((p.x - c.cx) ** 2 + (p.y - c.cy) ** 2) <= c.hx)",
)

# Summaries


def j13(s, d):
    """How far the samples of one source, the boxes' middles, are from the other's, the places, in three sets."""
    near = nearest_within(boxes(s, d).selectExpr("feature_id as id", "cx as x", "cy as y"), places(s, d).withColumnRenamed("id", "target"), 60_000.0)
    return near.withColumn("set", F.col("id") % 3)


J13 = PLACES + ", n as (select c.feature_id as id, min(sqrt((p.x - c.cx) ** 2 + (p.y - c.cy) ** 2)) as m from boxes c join places p on sqrt((p.x - c.cx) ** 2 + (p.y - c.cy) ** 2) <= 60000 group by 1)"
register("j13_source_to_source", lambda s, d: rounded(j13(s, d).where("distance_m is not null"), 4, "distance_m").select("id", "distance_m"), J13 + " select id, round(m, 4) as distance_m from n")
register(
    "a17_error_statistics",
    lambda s, d: rounded(a.error_statistics(j13(s, d), "set", "distance_m"), 3, "mean_m", "median_m", "p90_m", "p95_m", "max_m"),
    J13 + " select id % 3 as set, count(*) as samples, round(avg(m), 3) as mean_m, round(quantile_cont(m, 0.5), 3) as median_m, round(quantile_cont(m, 0.9), 3) as p90_m, round(quantile_cont(m, 0.95), 3) as p95_m, round(max(m), 3) as max_m from n group by 1",
)
register(
    "a21_group_audit",
    lambda s, d: rounded(a.group_audit(hold(s, d).groupBy("hex_id").agg(F.sum("km2").alias("km2"), F.max("km2").alias("largest"), F.count("*").alias("parts")).withColumn("region", F.col("hex_id") % 5), "region"), 6, "largest_share"),
    HELD + ", g as (select hex_id, sum(km2) as km2, max(km2) as largest, count(*) as parts from held group by 1) select hex_id % 5 as region, count(*) as groups, count(*) filter (parts > 1) as joined, max(km2) as largest_km2, quantile_cont(km2, 0.5) as median_km2, round(max(largest / km2), 6) as largest_share from g group by 1",
)


def a26(s, d):
    from hexloom.operators.checks import distortion

    shares = hold(s, d).withColumnRenamed("polity_id", "holder")
    raw = dominant(shares, "hex_id", "holder", "km2").select("hex_id", "holder")
    authority = raw.withColumn("holder", F.when(F.col("hex_id") % 4 == 0, F.lit(1)).otherwise(F.col("holder")))
    return a.both_distortions(distortion(shares, raw), distortion(shares, authority))


register(
    "a26_both_distortions",
    a26,
    HELD + """, k as (select *, first_value(polity_id) over (partition by hex_id order by km2 desc, polity_id) as w from held), e as (select 'RAW_WINNER' as basis, hex_id, polity_id as holder, km2, w from k union all select 'AUTHORITATIVE', hex_id, polity_id, km2, case when hex_id % 4 = 0 then 1 else w end from k),
x as (select basis, holder, sum(km2) as source_km2, sum(case when w = holder then 0 else km2 end) as omission_km2 from e group by all), y as (select basis, w as holder, sum(km2) as commission_km2 from e where w <> holder group by all)
select basis, holder, coalesce(source_km2, 0) as source_km2, coalesce(omission_km2, 0) as omission_km2, coalesce(commission_km2, 0) as commission_km2, coalesce(omission_km2, 0) + coalesce(commission_km2, 0) as symmetric_km2 from x full join y using (basis, holder)""",
)


def a31(s, d):
    cells = lay(s, d).withColumn("landmass", F.col("climate") % 6)
    return rounded(a.recovery_summary(cells.where("land_fraction > 0.2"), cells.where("land_fraction > 0.5"), cells.where("land_fraction > 0.7").withColumn("km2", F.col("tree_fraction")), "landmass"), 6, "recovered_km2")


register(
    "a31_recovery_summary",
    a31,
    LAY + """ select climate % 6 as landmass, count(*) filter (land_fraction > 0.2e0) as gap, count(*) filter (land_fraction > 0.5e0) as candidates, count(*) filter (land_fraction > 0.7e0) as produced,
round(coalesce(sum(tree_fraction) filter (land_fraction > 0.7e0), 0), 6) as recovered_km2, count(*) filter (land_fraction > 0.2e0) - count(*) filter (land_fraction > 0.7e0) as unrecovered from layers group by 1 having count(*) filter (land_fraction > 0.2e0) > 0""",
)
register(
    "a32_counts_by_subject",
    lambda s, d: a.counts_by_subject(control(s, d), control(s, d).select("target_id", F.col("kind").alias("subject_ids")), ["STEEL", "BRASS", "SMALL"]),
    CO + """, m as (select target_id, status, 'STEEL' as subject from control where contains(kind, 'STEEL') union all select target_id, status, 'BRASS' from control where contains(kind, 'BRASS') union all select target_id, status, 'SMALL' from control where contains(kind, 'SMALL'))
select subject, count(*) filter (status = 'CONTROLLED') as controlled, count(*) filter (status = 'UNRESOLVED') as unresolved from m group by 1""",
)


def a36(s, d):
    shares = spatial.feature_hexes(rings(s, d), GRID)
    fractions = shares.select((F.col("area_m2") / GRID.area).alias("land_fraction"))
    return rounded(a.area_agreement(boxes(s, d).selectExpr("4 * hx * hy as area_m2"), fractions, GRID.area, 1e-3), 0, "reference_m2", "cells_m2").select("reference_m2", "cells_m2", "agrees")


register("a36_area_agreement", a36, "select round(sum(4 * (500e0 + abs(s_acctbal)) * (300e0 + abs(s_acctbal) * 0.7e0)), 0) as reference_m2, round(sum(4 * (500e0 + abs(s_acctbal)) * (300e0 + abs(s_acctbal) * 0.7e0)), 0) as cells_m2, true as agrees from supplier")
SHARES = HELD + ", t as (select hex_id, sum(case when polity_id % 40 = 0 then 0 else km2 end) / sum(km2) as f from held group by 1)"


def a38(s, d):
    shares = hold(s, d).withColumn("kept", F.when(F.col("polity_id") % 40 == 0, 0.0).otherwise(F.col("km2")))
    return rounded(a.share_sums(shares, "kept", "km2", 0.985, 1.02), 9, "least", "most")


register("a38_share_sums", a38, SHARES + " select count(*) as hexes, round(min(f), 9) as least, round(max(f), 9) as most, count(*) filter (f < 0.985e0 or f > 1.02e0) as outside from t")


def m11(s, d):
    held = hold(s, d)
    totals = held.groupBy("hex_id").agg(F.sum(F.when(F.col("polity_id") % 50 != 0, F.col("km2")).otherwise(0.0)).alias("km2"))
    return a.mixed_fragments(totals, held, "hex_id", 0.5).select("hex_id", "polity_id", "total_km2", "other_km2", "conserved")


register(
    "m11_mixed_fragments",
    m11,
    HELD + ", t as (select hex_id, sum(km2) as parts, sum(case when polity_id % 50 <> 0 then km2 else 0 end) as total, count(*) as n from held group by 1) select hex_id, polity_id, total as total_km2, total - km2 as other_km2, abs(parts - total) <= 0.5 as conserved from held join t using (hex_id) where n > 1",
)
register(
    "r09_worst_zone",
    lambda s, d: rounded(a.worst_zone(hold(s, d).withColumn("zone", F.col("hex_id") % 6), "zone", "km2"), 6, "p90"),
    HELD + ", z as (select hex_id % 6 as zone, count(*) as n, round(quantile_cont(km2, 0.9), 6) as p90 from held group by 1) select *, zone = (select zone from z order by p90 desc, zone limit 1) as is_worst from z",
)

# Comparisons and gates

register(
    "u03_chunks_equal_whole",
    lambda s, d: a.table_differences(lay(s, d).select("hex_id", "land_fraction"), lay(s, d).where("hex_id % 97 <> 0").select("hex_id", (F.col("land_fraction") + F.when(F.col("hex_id") % 13 == 0, 0.01).otherwise(1e-9)).alias("land_fraction")), "hex_id", ["land_fraction"], 1e-6),
    LAY + " select count(*) filter (hex_id % 97 <> 0) as common, count(*) filter (hex_id % 97 = 0) as only_first, cast(0 as bigint) as only_second, count(*) filter (hex_id % 97 <> 0 and hex_id % 13 = 0) as differing from layers",
)
register(
    "u12_without_later_stages",
    lambda s, d: a.without_later_stages(control(s, d), control(s, d).where("size % 6 = 0"), control(s, d).where("price > 1500")).select("target_id"),
    CO + " select target_id from control where size % 6 <> 0 and price <= 1500",
)


def m08(s, d):
    masks = [hold(s, d).where(f"polity_id % {n} <> 0").groupBy("hex_id").agg(F.sum("km2").alias("km2")) for n in (40, 50)]
    return a.mask_difference(*masks, "hex_id", 1e-6)


register(
    "m08_mask_difference",
    m08,
    HELD + ", m as (select hex_id, sum(case when polity_id % 40 <> 0 then km2 else 0 end) as a, sum(case when polity_id % 50 <> 0 then km2 else 0 end) as b from held group by 1) select sum(abs(a - b)) as difference_km2, sum(abs(a - b)) <= 1e-6 as one_source from m",
)


def gate_query(metrics, rules):
    return lambda s, d: a.gates(metrics(s, d), rules)


def geography(s, d):
    return lay(s, d).agg(F.count("*").alias("hexes"), (F.count("*") - F.countDistinct("hex_id")).alias("repeated"), F.count_if((F.col("land_fraction") < 0) | (F.col("land_fraction") > 1)).alias("bad_fractions"), F.count_if(F.col("climate") == 99).alias("unknown_climates"))


GEO = LAY + ", m as (select count(*) as hexes, count(*) - count(distinct hex_id) as repeated, count(*) filter (land_fraction < 0 or land_fraction > 1) as bad, count(*) filter (climate = 99) as unknown from layers)"


def gate_sql(*rows: tuple[str, str, str, float]) -> str:
    return " union all ".join(f"select '{n}' as gate, cast({m} as double) as actual, cast({b} as double) as bound, {m} {sign} {b} as passed from m" for n, m, sign, b in rows)


register(
    "q09_geography_gates",
    gate_query(geography, [("grid_has_cells", "hexes", ">=", 1), ("ids_are_unique", "repeated", "=", 0), ("fractions_in_bounds", "bad_fractions", "=", 0), ("climates_are_known", "unknown_climates", "<=", 0)]),
    GEO + " " + gate_sql(("grid_has_cells", "hexes", ">=", 1), ("ids_are_unique", "repeated", "=", 0), ("fractions_in_bounds", "bad", "=", 0), ("climates_are_known", "unknown", "<=", 0)),
)


def hydro(s, d):
    m = stand_in(s, d, "membership")
    return m.agg((F.count("*") - F.countDistinct("edge_id", "branch_id", "river_id")).alias("repeated"), F.percentile("width", F.lit(0.95)).alias("p95"), F.max("discharge").alias("most"))


register(
    "q10_hydro_gates",
    gate_query(hydro, [("edges_are_unique", "repeated", "=", 0), ("width_p95", "p95", "<=", 45), ("discharge_in_bounds", "most", "<=", 1e6)]),
    cte("membership") + ", m as (select count(*) - count(distinct (edge_id, branch_id, river_id)) as repeated, quantile_cont(width, 0.95) as p95, max(discharge) as most from membership) " + gate_sql(("edges_are_unique", "repeated", "=", 0), ("width_p95", "p95", "<=", 45), ("discharge_in_bounds", "most", "<=", 1e6)),
)


def scenario(s, d):
    c = control(s, d)
    again = hashed_id("ctl_", F.col("target_id"), F.col("status"))
    return c.withColumn("id", again).agg((F.count("*") - F.countDistinct("id")).alias("ids_not_reproduced"), F.count_if(~F.col("status").isin("CONTROLLED", "UNRESOLVED")).alias("unknown_statuses"), F.count_if((F.col("status") == "UNRESOLVED") & (F.col("size") > 45)).alias("unresolved_large"))


register(
    "q13_scenario_gates",
    gate_query(scenario, [("ids_reproduce", "ids_not_reproduced", "=", 0), ("statuses_are_known", "unknown_statuses", "=", 0), ("large_ones_are_resolved", "unresolved_large", "<=", 1)]),
    CO + ", m as (select count(*) - count(distinct target_id || '|' || status) as i, count(*) filter (status not in ('CONTROLLED', 'UNRESOLVED')) as u, count(*) filter (status = 'UNRESOLVED' and size > 45) as l from control) " + gate_sql(("ids_reproduce", "i", "=", 0), ("statuses_are_known", "u", "=", 0), ("large_ones_are_resolved", "l", "<=", 1)),
)


def q07(s, d):
    links = lay(s, d).select(F.col("hex_id").alias("feature_id"), (F.col("hex_id") * 7 % 500).alias("evidence_id"), F.element_at(F.array(*map(F.lit, ("A", "B", "C"))), (F.col("hex_id") % 3 + 1).cast("int")).alias("evidence_role"))
    return a.link_faults(links, lay(s, d).where("climate <> 5").select(F.col("hex_id").alias("feature_id")), s.read.parquet(f"{d}/nation.parquet").selectExpr("cast(n_nationkey as bigint) as evidence_id"), ["A", "B"])


register(
    "q07_link_faults",
    q07,
    LAY + ", l as (select hex_id as feature_id, hex_id * 7 % 500 as evidence_id, hex_id % 3 as role, climate from layers) select feature_id, evidence_id, 'UNKNOWN_ROLE' as fault from l where role = 2 union all select feature_id, evidence_id, 'ORPHAN_FEATURE' from l where climate = 5 union all select feature_id, evidence_id, 'ORPHAN_EVIDENCE' from l where evidence_id not in (select n_nationkey from nation)",
)
register(
    "q14_coverage_contract",
    lambda s, d: a.coverage_contract(lay(s, d).select((F.col("hex_id") % 60).alias("chunk_id")).distinct(), control(s, d).select((F.col("target_id") % 50).alias("unit_id"), "status", (F.col("size") > 20).alias("conditions")), ["CONTROLLED", "COMPLETE"]),
    "with layers as (" + LAY.split("layers as (", 1)[1].rsplit(")", 1)[0] + "), " + CO.removeprefix("with ") + ", u as (select target_id % 50 as unit_id, status from control) select (select count(*) from (select distinct hex_id % 60 as c from layers) where c not in (select unit_id from u)) as chunks_without_unit, (select count(*) from (select unit_id from u group by 1 having count(*) > 1)) as repeated_units, count(*) filter (status = 'UNRESOLVED') as unknown_statuses, cast(0 as bigint) as complete_without_conditions from u",
)
register(
    "q18_area_bounds",
    lambda s, d: rounded(a.area_bounds(lay(s, d).select(F.col("tree_fraction").alias("matched"), F.col("urban_fraction").alias("under"), F.col("shrub_fraction").alias("over"), (F.col("tree_fraction") + F.col("urban_fraction")).alias("coast"), (F.col("tree_fraction") + F.col("shrub_fraction") * F.when(F.col("hex_id") % 50 == 0, 0.5).otherwise(1.0)).alias("admin"))), 6, "coast_error", "admin_error"),
    LAY + " select 0e0 as coast_error, round(max(case when hex_id % 50 = 0 then shrub_fraction * 0.5e0 else 0 end), 6) as admin_error, cast(0 as bigint) as bad_values from layers",
)
register(
    "q20_both_sides",
    lambda s, d: a.both_sides(placed(s, d).select("hex_id", (F.col("x") - 15_580_000).alias("x"), (F.col("population") > 900_000).alias("is_dominant"), F.lit("FJI").alias("admin_id")).groupBy("hex_id", "is_dominant", "admin_id").agg(F.min("x").alias("x")).groupBy("hex_id", "admin_id").agg(F.min("x").alias("x"), F.bool_or("is_dominant").alias("is_dominant")), "FJI"),
    PT + ", c as (select hex_id, min(x - 15580000) as x, bool_or(population > 900000) as d from placed group by 1) select count(*) filter (x < 0) as west, count(*) filter (x > 0) as east, bool_or(d) as one_admin from c",
)
register(
    "q02_catalogue_scores",
    lambda s, d: rounded(a.catalogue_scores(lay(s, d).select(F.when(F.col("climate") % 3 == 0, "OVERLAY").otherwise("HEX").alias("expected"), F.when(F.col("hex_id") % 4 == 0, "OVERLAY").otherwise("HEX").alias("delivered"))), 9, "recall"),
    LAY + ", c as (select climate % 3 = 0 as e, hex_id % 4 = 0 as d from layers) select count(*) as places, count(*) filter (e = d) as exact, round(count(*) filter (e and d) / count(*) filter (e), 9) as recall, count(*) filter (d and not e) as false_overlays from c",
)
register(
    "t04_three_nearest",
    lambda s, d: a.nearest_k(hold(s, d), "hex_id", 3, "km2", "polity_id").select("hex_id", "polity_id", F.col("rank").cast("bigint")),
    HELD + ", k as (select hex_id, polity_id, row_number() over (partition by hex_id order by km2, polity_id) as rank from held) select hex_id, polity_id, rank from k where rank <= 3",
)
register("t05_nearest_node", lambda s, d: a.nearest_k(hold(s, d), "polity_id", 1, "km2", "hex_id").select("polity_id", "hex_id"), HELD + ", k as (select *, row_number() over (partition by polity_id order by km2, hex_id) as k from held) select polity_id, hex_id from k where k = 1")
register(
    "f17_group_ids",
    lambda s, d: a.group_id(hold(s, d), "hex_id", "polity_id", "isl_g_"),
    HELD + " select hex_id, 'isl_g_' || substr(sha1(string_agg(cast(polity_id as varchar), '|' order by cast(polity_id as varchar))), 1, 12) as group_id from held group by 1",
)
MM = "cast(round((cx {0} hx) * 1000) as bigint) || ',' || cast(round((cy {1} hy) * 1000) as bigint)"
register(
    "f11_shape_hashes",
    lambda s, d: boxes(s, d).selectExpr("feature_id", "case when feature_id % 2 = 0 then array(cx - hx, cx + hx, cx + hx, cx - hx) else array(cx + hx, cx - hx, cx - hx, cx + hx, cx + hx) end as xs", "case when feature_id % 2 = 0 then array(cy - hy, cy - hy, cy + hy, cy + hy) else array(cy + hy, cy + hy, cy - hy, cy - hy, cy + hy) end as ys").select("feature_id", a.shape_hash(F.col("xs"), F.col("ys")).alias("hash")),
    "with boxes as (select cast(s_suppkey as bigint) as feature_id, 15400000e0 + ((s_suppkey * 7919) % 30011) * 10e0 as cx, 4200000e0 + ((s_suppkey * 10473) % 29989) * 10e0 as cy, 500e0 + abs(s_acctbal) as hx, 300e0 + abs(s_acctbal) * 0.7e0 as hy from supplier) select feature_id, sha1("
    + " || ';' || ".join(MM.format(*x) for x in ("--", "+-", "++", "-+")) + ") as hash from boxes",
)
register(
    "f13_source_ids",
    lambda s, d: control(s, d).select("target_id", hashed_id("gsrc_", F.col("kind")).alias("source_id"), hashed_id("hev_", F.col("controller"), F.col("kind")).alias("evidence_id")),
    CO + " select target_id, 'gsrc_' || substr(sha1(kind), 1, 12) as source_id, 'hev_' || substr(sha1(controller || '|' || kind), 1, 12) as evidence_id from control",
)
register(
    "f16_fragment_ids",
    lambda s, d: placed(s, d).select("id", hashed_id("lfr_", F.col("hex_id"), F.col("name"), length=14).alias("fragment_id")),
    PT + " select id, 'lfr_' || substr(sha1(hex_id || '|' || name), 1, 14) as fragment_id from placed",
)
register("f02_centres", lambda s, d: rounded(placed(s, d).select("q", "r", "centre_x", "centre_y").distinct(), 3, "centre_x", "centre_y"), PT + " select distinct q, r, round(centre_x, 3) as centre_x, round(centre_y, 3) as centre_y from placed")
register("f03_cells", lambda s, d: placed(s, d).select("id", "q", "r"), PT + " select id, q, r from placed")


# Rivers, extents and sheets


def branches(s, d):
    return stand_in(s, d, "membership").groupBy("river_id", "branch_id").agg(F.max("discharge").alias("discharge"))


MEM = cte("membership")
register(
    "t06_processing_order",
    lambda s, d: a.processing_order(branches(s, d)).select("river_id", "branch_id", F.col("place").cast("bigint")),
    MEM + ", b as (select river_id, branch_id, max(discharge) as q from membership group by all) select river_id, branch_id, row_number() over (partition by river_id order by q desc, branch_id) as place from b",
)


def audit(s, d):
    return stand_in(s, d, "membership").select("river_id", (F.col("width") * 10).alias("source_m"), (F.col("width") * 10 + F.col("edge_id") % 7).alias("snapped_m"), (F.col("discharge") / 100).alias("offset_m"))


register(
    "a15_snapping_summary",
    lambda s, d: rounded(a.snapping_summary(audit(s, d), "river_id", 1.012, 900.0), 6, "snapped_m", "offset_p95_m", "offset_max_m", "ratio"),
    MEM + """, x as (select river_id, count(*) as edges, sum(width * 10) as source_m, sum(width * 10 + edge_id % 7) as s, quantile_cont(discharge / 100, 0.95) as p, max(discharge / 100) as m from membership group by 1)
select river_id, edges, source_m, round(s, 6) as snapped_m, round(p, 6) as offset_p95_m, round(m, 6) as offset_max_m, round(s / source_m, 6) as ratio,
case when s / source_m > 1.012e0 and p > 900 then 'FAIL' when s / source_m > 1.012e0 or p > 900 then 'WARN' else 'PASS' end as verdict from x""",
)
register(
    "a16_corridor_quality",
    lambda s, d: rounded(a.corridor_quality(stand_in(s, d, "membership").select("river_id", F.col("edge_id").alias("hex_id"), (F.col("width") / 2).alias("area_km2"), F.col("width").alias("line_m"), (F.col("width") * (F.col("edge_id") % 4) / 4).alias("inside_m"), (F.col("discharge") / 50).alias("distance_m")), "river_id"), 6, "inside_share", "distance_p95_m"),
    MEM + " select river_id, count(distinct edge_id) as hexes, sum(width / 2) as area_km2, round(sum(width * (edge_id % 4) / 4) / sum(width), 6) as inside_share, round(quantile_cont(discharge / 50, 0.95), 6) as distance_p95_m from membership group by 1",
)


def g12(s, d):
    """The way around each cell that holds a place, corner by corner, and the cells on both sides of it."""
    cells = placed(s, d).select("q", "r").distinct()
    corner = F.posexplode(F.array(*[F.struct((2 * F.col("q") + F.col("r") + dx).alias("x"), (3 * F.col("r") + dy).alias("y")) for dx, dy in ((1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2), (1, -1))]))
    paths = cells.select(GRID.hex_id(F.col("q"), F.col("r")).alias("path_id"), corner.alias("place", "node"))
    return a.path_hexes(paths, g.edge_graph(cells, GRID)).groupBy("path_id").agg(F.count("*").alias("hexes"))


register(
    "g12_path_hexes",
    g12,
    PT + ", c as (select distinct hex_id, q, r from placed) select c.hex_id as path_id, count(*) as hexes from c join c o on greatest(abs(c.q - o.q), abs(c.r - o.r), abs(c.q - o.q + c.r - o.r)) <= 1 group by 1",
)


def ticks(s, d):
    """Six meridians and six parallels of each supplier's sheet, slanted by the sheet's number."""
    return s.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey as sheet", "explode(sequence(0, 11)) as k").selectExpr(
        "sheet", "case when k < 6 then 'MERIDIAN' else 'PARALLEL' end as kind", "cast(k % 6 as double) as degree", "(k % 6) * 10e0 as first", "(k % 6) * 10e0 + sheet % 5 as second"
    )


def w15(s, d):
    points = s.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_suppkey as sheet", "cast(l_quantity as double) as px", "cast(l_linenumber as double) * 7 as py").distinct()
    return rounded(a.plate_coordinates(points, ticks(s, d), (0.0, 0.0, 50.0, 50.0)), 6, "lon", "lat").select("sheet", "px", "py", "lon", "lat")


register(
    "w15_plate_coordinates",
    w15,
    """with p as (select distinct l_suppkey as sheet, cast(l_quantity as double) as px, cast(l_linenumber as double) * 7 as py from lineitem),
o as (select *, (sheet % 5) * py / 50 as sx, (sheet % 5) * px / 50 as sy from p)
select sheet, px, py, round(greatest(0, least(5, (px - sx) / 10)), 6) as lon, round(greatest(0, least(5, (py - sy) / 10)), 6) as lat from o""",
)
register(
    "q15_changed_groups",
    lambda s, d: a.changed_groups(control(s, d).select("size", "target_id", "status"), control(s, d).select("size", F.when((F.col("size") % 9 == 0) & (F.col("target_id") % 2 == 0), -F.col("target_id")).otherwise(F.col("target_id")).alias("target_id"), "status"), "size"),
    CO + " select size, bool_or(size % 9 = 0 and target_id % 2 = 0 and target_id <> 0) as changed from control group by 1",
)


def q01(s, d):
    values = lay(s, d).select(F.col("hex_id").cast("string").alias("hex_id"), F.lit("land").alias("layer"), F.col("land_class").alias("value"))
    points = named(s, d).select("id", (F.col("id") % 2500).cast("string").alias("hex_id"))
    wanted = points.select("id", F.lit("land").alias("layer"), F.when(F.col("id") % 2 == 0, F.array(F.lit("land"))).otherwise(F.array(F.lit("water"), F.lit("coast"))).alias("allowed"))
    return a.expected_values(points, values, wanted)


register(
    "q01_expected_values",
    q01,
    LAY + " select cast(c_custkey as bigint) as id, 'land' as layer, l.land_class as value, coalesce(case when c_custkey % 2 = 0 then l.land_class = 'land' else l.land_class = 'water' end, false) as met from customer left join layers l on l.hex_id = c_custkey % 2500",
)


def island_metrics(s, d):
    units = hold(s, d).groupBy("hex_id").agg(F.sum("km2").alias("km2"), F.max("km2").alias("largest"))
    return units.agg(F.count_if(F.col("largest") > F.col("km2")).alias("parts_above_whole"), F.count("*").alias("groups"), F.max("km2").alias("largest_km2"))


register(
    "q11_island_gates",
    gate_query(island_metrics, [("parts_within_whole", "parts_above_whole", "=", 0), ("groups_there", "groups", ">=", 1), ("largest_in_bounds", "largest_km2", "<=", 1500)]),
    HELD + ", u as (select hex_id, sum(km2) as km2, max(km2) as largest from held group by 1), m as (select count(*) filter (largest > km2) as p, count(*) as n, max(km2) as k from u) " + gate_sql(("parts_within_whole", "p", "=", 0), ("groups_there", "n", ">=", 1), ("largest_in_bounds", "k", "<=", 1500)),
)


def binding_metrics(s, d):
    return bound(s, d, 5000.0).agg(F.count_if(F.col("method") == "UNRESOLVED").alias("unresolved"), F.count_if((F.col("method") == "CONTAINS") & (F.col("distance_m") > 0)).alias("inside_but_away"), F.max("distance_m").alias("farthest"))


register(
    "q12_binding_gates",
    gate_query(binding_metrics, [("few_unresolved", "unresolved", "<=", 100), ("inside_is_here", "inside_but_away", "=", 0), ("within_limit", "farthest", "<=", 5000)]),
    PLACES + bound_sql(5000, "0") + ", m as (select count(*) filter (method = 'UNRESOLVED') as u, count(*) filter (method = 'CONTAINS' and m > 0) as i, round(max(m), 6) as f from bound0) " + gate_sql(("few_unresolved", "u", "<=", 100), ("inside_is_here", "i", "=", 0), ("within_limit", "f", "<=", 5000)).replace("cast(f as double)", "cast(f as double)"),
)
register(
    "j30_boundary_distance",
    lambda s, d: spatial.nearest_segment(places(s, d), spatial.segments_of(rings(s, d)), 12_000.0).select("id", F.round(F.col("distance_m") * F.cos(F.atan(F.sinh(F.col("y") / 6378137.0))), 3).alias("ground_m")),
    PLACES + f", m as (select p.id, p.y, min(case when x > x0 and x < x1 and y > y0 and y < y1 then least(x - x0, x1 - x, y - y0, y1 - y) else {DIST} end) as m from places p cross join b group by all) select id, case when m <= 12000 then round(m * cos(atan(sinh(y / 6378137e0))), 3) end as ground_m from m",
)


def j29(s, d):
    """The exact land of each holder, a nation's suppliers' boxes united, in each cell, and who has most of it."""
    owned = rings(s, d).join(s.read.parquet(f"{d}/supplier.parquet").selectExpr("cast(s_suppkey as bigint) as feature_id", "cast(s_nationkey as bigint) as polity_id"), "feature_id")
    land = spatial.union_in_hexes(owned, GRID, ["polity_id"]).withColumn("hex_id", GRID.hex_id(F.col("q"), F.col("r")))
    return rounded(dominant(land, "hex_id", "polity_id", "area_m2"), 1, "area_m2", "runner_up", "margin")


register("j29_hex_binding", j29)


# Sources and sinks


def s13(s, d):
    path = fresh_dir(s, "query")
    t.write_banded(rings(s, d), path, 20_000.0)
    bands = s.read.parquet(path).groupBy("band", "reach").agg(F.count("*").alias("rings"))
    return bands.select(F.col("band").cast("bigint"), F.col("reach").cast("bigint"), "rings")


register("s13_banded_cache", s13, HEAD + " select cast(floor(y0 / 20000) as bigint) as band, cast(floor(y1 / 20000) - floor(y0 / 20000) as bigint) as reach, count(*) as rings from b group by all")


def curated(table, columns, schema):
    def run(s, d):
        path = fresh_dir(s, "query")
        s.read.parquet(f"{d}/{table}.parquet").selectExpr(*columns).write.options(header=True, nullValue="").csv(path)
        return t.read_curated(s, path, schema)

    return run


register("s16_registry", curated("nation", ["n_nationkey as id", "n_name as name", "case when n_nationkey % 4 <> 0 then n_regionkey end as region"], "id bigint, name string, region bigint"), "select cast(n_nationkey as bigint) as id, n_name as name, case when n_nationkey % 4 <> 0 then cast(n_regionkey as bigint) end as region from nation")
register("s18_assertions", curated("events", ["event_id as id", "event_type as kind", "user_id as subject"], "id bigint, kind string, subject bigint"), "select cast(event_id as bigint) as id, event_type as kind, cast(user_id as bigint) as subject from events")


def s19(s, d):
    """The hexes of all places as CSV, Parquet and GeoJSON: what each form holds when it is read back."""
    cells = placed(s, d).select("hex_id", "centre_x", "centre_lon", "centre_lat").distinct()
    path = fresh_dir(s, "query")
    t.write_csv(cells, f"{path}/csv")
    cells.write.parquet(f"{path}/parquet")
    t.geojson_lines(cells, t.point_geometry(F.col("centre_lon"), F.col("centre_lat"))).write.text(f"{path}/geojson")
    csv = s.read.schema("hex_id string, centre_x double, centre_lon double, centre_lat double").option("header", True).csv(f"{path}/csv")
    forms = {"csv": csv.select("hex_id"), "parquet": s.read.parquet(f"{path}/parquet").select("hex_id"), "geojson": s.read.text(f"{path}/geojson").select(F.get_json_object("value", "$.properties.hex_id").alias("hex_id"))}
    out = [df.agg(F.lit(n).alias("form"), F.countDistinct("hex_id").alias("hexes"), F.min("hex_id").alias("first")) for n, df in forms.items()]
    return out[0].union(out[1]).union(out[2])


register("s19_hex_outputs", s19, PT + ", c as (select count(distinct hex_id) as n, min(hex_id) as f from placed) select unnest(['csv', 'parquet', 'geojson']) as form, n as hexes, f as first from c")


def s21(s, d):
    """The coast between cells with and without a large place, written as GeoJSON lines and counted again."""
    cells = placed(s, d).groupBy("q", "r").agg((F.max("population") >= 500_000).alias("land"))
    edges = g.generated_coastline(cells, F.col("land"), GRID)
    path = fresh_dir(s, "query")
    (x1, y1), (x2, y2) = g.node_xy(GRID, F.col("n1")), g.node_xy(GRID, F.col("n2"))
    ends = edges.select("edge_id", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))
    (a1, b1), (a2, b2) = to_wgs84(F.col("x1"), F.col("y1")), to_wgs84(F.col("x2"), F.col("y2"))
    t.geojson_lines(ends, t.line_geometry(a1, b1, a2, b2)).write.text(path)
    return s.read.text(path).select(F.get_json_object("value", "$.properties.edge_id").alias("edge_id"), F.get_json_object("value", "$.geometry.type").alias("type"))


register(
    "s21_coast_outputs",
    s21,
    PT + ", c as (select hex_id, q, r, max(population) >= 500000 as land from placed group by all) select 'e_' || least(a.hex_id, b.hex_id) || '_' || greatest(a.hex_id, b.hex_id) as edge_id, 'LineString' as type from c a join c b on a.land and not b.land and greatest(abs(a.q - b.q), abs(a.r - b.r), abs(a.q - b.q + a.r - b.r)) = 1",
)


def s23(s, d):
    path = fresh_dir(s, "query")
    t.write_chunks(hold(s, d).withColumn("chunk_id", F.col("hex_id") % 11), path)
    manifest = t.chunk_manifest(s.read.parquet(path).withColumn("chunk_id", F.col("chunk_id").cast("bigint")), "chunk_id", {"large": F.col("km2") > 60})
    return manifest.select("chunk_id", "rows", "large")


register("s23_chunk_tables", s23, HELD + " select hex_id % 11 as chunk_id, count(*) as rows, count(*) filter (km2 > 60) as large from held group by 1")

# Components, distances and two-way audits

register(
    "p25_outlier_cause",
    lambda s, d: lay(s, d).select("hex_id", a.outlier_cause(F.col("tree_fraction") * 20_000, F.col("urban_fraction") * 20_000, F.col("shrub_fraction") * 6e7, 6000.0, 3e7).alias("cause")),
    LAY + " select hex_id, case when tree_fraction * 20000 > 9000 and shrub_fraction * 6e7 < 3e7 then 'SMALL_ISLAND_LOST' when tree_fraction * 20000 > 9000 then 'NARROW_PENINSULA' when urban_fraction * 20000 > 9000 then 'NARROW_INLET' else 'HEX_MAJORITY_QUANTISATION' end as cause from layers",
)
def j31(s, d):
    """The boxes of a pair of suppliers as land by the coast, a second box of each as land by the admins."""
    pair = F.floor(F.col("feature_id") / 2)
    coast = rings(s, d).withColumn("pair", pair)
    admin = boxes(s, d).selectExpr("feature_id", "false as is_hole", "array(cx - 100, cx + hx * 1.5, cx + hx * 1.5, cx - 100) as xs", "array(cy - 50, cy - 50, cy + hy * 1.2, cy + hy * 1.2) as ys").withColumn("pair", pair)
    area = lambda df, n: spatial.union_in_hexes(df, GRID, ["pair"]).groupBy("pair").agg((F.sum("area_m2") / 1e6).alias(n))
    both = area(coast, "coast").join(area(admin, "admin"), "pair").join(area(coast.unionByName(admin), "either"), "pair")
    return rounded(a.two_way_audit(both, 20.0, 0.05), 4, "coast", "admin", "matched", "under", "over").select("pair", "coast", "admin", "matched", "under", "over", "coverage_class")


register(
    "j31_two_way_audit",
    j31,
    HEAD + """, two as (select cast(floor(feature_id / 2) as bigint) as pair, true as c, cx - hx as x0, cx + hx as x1, cy - hy as y0, cy + hy as y1 from boxes
  union all select cast(floor(feature_id / 2) as bigint), false, cx - 100, cx + hx * 1.5e0, cy - 50, cy + hy * 1.2e0 from boxes),
xs as (select pair, x as a, lead(x) over (partition by pair order by x) as b from (select distinct pair, unnest([x0, x1]) as x from two)),
ys as (select pair, y as a, lead(y) over (partition by pair order by y) as b from (select distinct pair, unnest([y0, y1]) as y from two)),
k as (select xs.pair, (xs.b - xs.a) * (ys.b - ys.a) / 1e6 as m, bool_or(t.c) as c, bool_or(not t.c) as n from xs join ys on ys.pair = xs.pair join two t on t.pair = xs.pair and t.x0 <= xs.a and xs.b <= t.x1 and t.y0 <= ys.a and ys.b <= t.y1 group by xs.pair, xs.a, xs.b, ys.a, ys.b),
v as (select pair, coalesce(sum(m) filter (c), 0) as coast, coalesce(sum(m) filter (n), 0) as admin, coalesce(sum(m) filter (c and n), 0) as matched, coalesce(sum(m) filter (c and not n), 0) as under, coalesce(sum(m) filter (n and not c), 0) as over from k group by 1)
select pair, round(coast, 4) as coast, round(admin, 4) as admin, round(matched, 4) as matched, round(under, 4) as under, round(over, 4) as over,
case when under > greatest(20, coast * 0.05e0) and over > greatest(20, coast * 0.05e0) then 'BIDIRECTIONAL_MISMATCH' when under > greatest(20, coast * 0.05e0) then 'UNDERCOVERED' when over > greatest(20, coast * 0.05e0) then 'OVERCOVERED' else 'MATCHED' end as coverage_class from v""",
)


def j21(s, d):
    """Suppliers' boxes as components, the wide boxes around them, each shifted by one supplier, as admins."""
    shifted = wide(s, d).withColumn("feature_id", F.lit(1_000_000) + F.col("feature_id"))
    pairs = spatial.overlaps(rings(s, d), GRID, 1.0, shifted)
    over = pairs.select(F.col("a").alias("component_id"), (F.col("b") - 1_000_000).alias("admin_id"), F.round(F.col("overlap_m2") / 1e6, 3).alias("km2"))
    over = written(a.largest_overlaps(over), "component-admins")
    centres = boxes(s, d).selectExpr("feature_id as id", "cx as x", "cy as y")
    # Only components that no admin overlaps look for the nearest one.
    left = written(centres.join(over, F.col("id") == F.col("component_id"), "left_anti"), "components-left")
    near = over.select("component_id", F.lit(None).cast("bigint").alias("admin_id"), F.lit(None).cast("double").alias("distance_m"))
    if not left.isEmpty():
        near = near.unionByName(spatial.bind_points(left, wide(s, d), 10_000.0, 8_000.0).selectExpr("id as component_id", "feature_id as admin_id", "distance_m"))
    return a.admin_of_components(over, near).select("component_id", "admin_id", "method")


register(
    "j21_component_admin",
    j21,
    HEAD + """, w as (select feature_id, cx - 3 * hx as x0, cx + 3 * hx as x1, cy - 3 * hy as y0, cy + 3 * hy as y1 from boxes),
o as (select b.feature_id as component_id, w.feature_id as admin_id, round((least(b.x1, w.x1) - greatest(b.x0, w.x0)) * (least(b.y1, w.y1) - greatest(b.y0, w.y0)) / 1e6, 3) as km2 from b join w on b.x0 < w.x1 and w.x0 < b.x1 and b.y0 < w.y1 and w.y0 < b.y1)
select component_id, admin_id, 'LARGEST_INTERSECTION' as method from (select *, row_number() over (partition by component_id order by km2 desc, admin_id) as k from o) where k = 1""",
)


def g08(s, d):
    """Wide boxes that overlap are one component; its area is the sum of its parts'."""
    edges = spatial.overlaps(wide(s, d), GRID, 1.0, links=True)
    areas = boxes(s, d).selectExpr("feature_id as node", "round(36 * hx * hy / 1e6, 6) as km2")
    return rounded(a.component_areas(components_of_edges(edges), areas), 4, "km2")


register(
    "g08_detached_components",
    g08,
    OVERLAPS + """, u as (select a, b from o where m > 1 union all select b, a from o where m > 1), l0 as (select distinct a as node, a as label from u), """
    + ", ".join(f"l{n} as (select u.a as node, min(least(p.label, q.label)) as label from u join l{n - 1} p on p.node = u.b join l{n - 1} q on q.node = u.a group by 1)" for n in range(1, 31))
    + " select coalesce(l30.label, z.feature_id) as component, count(*) as parts, round(sum(round(36 * hx * hy / 1e6, 6)), 4) as km2 from boxes z left join l30 on l30.node = z.feature_id group by 1",
)
