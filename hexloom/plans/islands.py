"""Queries on islands, administrative tables, bound points, evidence bundles and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.functions.projection import WORLD
from hexloom.operators import evidence as e
from hexloom.operators import grid as g
from hexloom.operators import islands as i
from hexloom.operators.points import place_points

from .registry import register
from .standins import PLACED_SQL, cte, stand_in

GRID = GridSpec(6000.0)
LAY, HOLD, CO = cte("layers"), cte("holdings"), cte("control")
PT = cte("points") + PLACED_SQL
lay = lambda s, d: stand_in(s, d, "layers")
hold = lambda s, d: stand_in(s, d, "holdings")
control = lambda s, d: stand_in(s, d, "control")
placed = lambda s, d: place_points(stand_in(s, d, "points"), GRID)

register("p17_lost", lambda s, d: i.lost(lay(s, d).select("hex_id", (F.col("hex_id") % 4).alias("hexes"), (F.col("hex_id") % 3 == 0).alias("represented"), (F.col("hex_id") % 7 == 0).alias("touches_clip_boundary"), (F.col("tree_fraction") + 0.5).alias("coverage"))).select("hex_id", "is_lost"), LAY + " select hex_id, hex_id % 4 > 0 and hex_id % 3 <> 0 and hex_id % 7 <> 0 and tree_fraction + 0.5 >= 0.98 as is_lost from layers")
register("p19_analysis_frame", lambda s, d: i.in_analysis_frame(lay(s, d).select("hex_id", F.array(F.col("hex_id") * 1000.0 - 900_000, F.col("hex_id") * 1000.0 - 899_000).alias("xs")), F.col("hex_id") % 2 == 0).select("hex_id", F.round(F.col("xs")[0], 3).alias("x0")), LAY + f" select hex_id, round(hex_id * 1000e0 - 900000 + case when hex_id % 2 = 0 and hex_id * 1000e0 - 899500 < 0 then {WORLD!r} else 0 end, 3) as x0 from layers")


def groups(s, d):
    members = hold(s, d).groupBy(F.col("hex_id").alias("group_id"), F.col("polity_id").alias("component_id")).agg(F.sum("km2").alias("km2"))
    return i.group_units(members, 700.0, 0.07, s.range(0, 2000, 50).withColumnRenamed("id", "group_id"), s.range(0, 2000, 30).withColumnRenamed("id", "group_id"))


GROUPS = HOLD + """, m as (select hex_id as group_id, polity_id as component_id, sum(km2) as km2 from holdings group by all), s as (select group_id, sum(km2) as km2, max(km2) as largest, count(*) as parts, 'grp_' || substr(sha1(string_agg(cast(component_id as varchar), ',' order by cast(component_id as varchar))), 1, 12) as unit_id from m group by 1),
u as (select *, case when (group_id % 30 = 0 and group_id < 2000) or not ((group_id % 50 = 0 and group_id < 2000) or km2 >= 700) then 'DROPPED' when parts > 1 and largest >= 0.07e0 * km2 then 'LARGEST_PART' else 'WHOLE' end as decision from s)"""
register("p20_group_units", groups, GROUPS + " select group_id, unit_id, parts, km2, largest, decision from u")
register("a20_preservation_summary", lambda s, d: i.preservation_summary(groups(s, d).withColumn("region", F.col("group_id") % 5), "region"), GROUPS + " select group_id % 5 as region, count(*) as groups, count(*) filter (decision <> 'DROPPED') as preserved, sum(km2) as km2, sum(case when decision <> 'DROPPED' then km2 else 0 end) as preserved_km2, sum(case when decision = 'DROPPED' then km2 else 0 end) as dropped_km2 from u group by 1")
register("w04_primary_hex", lambda s, d: i.primary_hex(hold(s, d).groupBy("polity_id", "hex_id").agg(F.sum("km2").alias("area_m2")).withColumn("distance_m", F.col("hex_id") % 13), "polity_id").select("polity_id", "hex_id"), HOLD + ", m as (select polity_id, hex_id, sum(km2) as a from holdings group by all), k as (select *, row_number() over (partition by polity_id order by round(a, 6) desc, hex_id % 13, hex_id) as k from m) select polity_id, hex_id from k where k = 1")
register("a22_mercator_ratio", lambda s, d: i.mercator_ratio(lay(s, d).select("hex_id", (F.col("climate") * 2.0).alias("lat"), (F.col("tree_fraction") + 1).alias("projected_km2"), (F.col("urban_fraction") + 1).alias("ground_km2"))).select("hex_id", F.round("ratio", 9).alias("ratio"), F.round("off", 9).alias("off")), LAY + " select hex_id, round((tree_fraction + 1) / (urban_fraction + 1), 9) as ratio, round(abs((tree_fraction + 1) / (urban_fraction + 1) * power(cos(radians(climate * 2e0)), 2) - 1), 9) as off from layers")


def j26(s, d):
    parents = i.admin0(s.read.parquet(f"{d}/nation.parquet").selectExpr("n_nationkey as code", "case when n_nationkey % 3 = 0 then '-99' else cast(n_nationkey as string) end as source_id", "n_name as name", "n_name as shape"))
    children = s.read.parquet(f"{d}/supplier.parquet").selectExpr("s_suppkey as id", "case when s_suppkey % 10 = 0 then null else s_nationkey + s_suppkey % 2 * 5 end as code")
    return i.with_parent(children, parents, "code").select("id", "parent_id", "parent_missing_reason")


register("j26_with_parent", j26, "with p as (select n_nationkey as code, case when n_nationkey % 3 = 0 then 'adm0_h' || substr(sha1(n_name), 1, 12) else 'adm0_' || n_nationkey end as parent_id from nation), c as (select s_suppkey as id, case when s_suppkey % 10 <> 0 then s_nationkey + s_suppkey % 2 * 5 end as code from supplier) select c.id, p.parent_id, case when c.code is null then 'NO_PARENT_CODE' when p.parent_id is null then 'UNKNOWN_PARENT_CODE:' || c.code end as parent_missing_reason from c left join p on p.code = c.code")


def j16(s, d):
    every = placed(s, d)
    land = every.where("id % 3 = 0").select("q", "r").distinct()
    return i.bind_to_land(every.select("id", "x", "y"), land, GRID, 2, 9_000.0).select("id", "q", "r", "method", F.round("distance_m", 4).alias("distance_m"))


register("j16_bind_to_land", j16, PT + ", l as (select distinct q, r, centre_x, centre_y from placed where id % 3 = 0), m as (select p.id, l.q, l.r, case when p.q = l.q and p.r = l.r then 0 else sqrt((p.x - l.centre_x) ** 2 + (p.y - l.centre_y) ** 2) end as m from placed p join l on greatest(abs(p.q - l.q), abs(p.r - l.r), abs(p.q - l.q + p.r - l.r)) <= 2), k as (select *, row_number() over (partition by id order by m, q, r) as k from m where m <= 9000) select p.id, k.q, k.r, case when m is null then 'UNRESOLVED' when m = 0 then 'TERRESTRIAL_HEX' else 'NEAREST_TERRESTRIAL' end as method, round(m, 4) as distance_m from placed p left join k on k.id = p.id and k.k = 1")
register("j18_region_of_points", lambda s, d: i.region_of_points(placed(s, d).select("id", "x", "y"), placed(s, d).where("id % 2 = 0").select("q", "r", F.concat(F.lit("r"), (F.col("id") % 4).cast("string")).alias("region"), (F.col("id") % 4).alias("region_order")).distinct(), GRID), PT + ", h as (select distinct q, r, id % 4 as o from placed where id % 2 = 0) select p.id, coalesce('r' || min(h.o), 'OUT_OF_REGION_COVERAGE') as region from placed p left join h on h.q = p.q and h.r = p.r group by p.id")
register("j38_touching_sets", lambda s, d: i.touching(placed(s, d).select((F.col("id") % 200).alias("set_id"), "q", "r")), PT + ", s as (select distinct id % 200 as set_id, q, r from placed) select distinct a.set_id as a, b.set_id as b from s a join s b on a.set_id < b.set_id and greatest(abs(a.q - b.q), abs(a.r - b.r), abs(a.q - b.q + a.r - b.r)) <= 1")
register("u01_set_difference", lambda s, d: (lambda a, b: a.exceptAll(b).withColumn("side", F.lit("only_first")).unionByName(b.exceptAll(a).withColumn("side", F.lit("only_second"))))(control(s, d).where("target_id % 2 = 0").select("target_id"), control(s, d).where("target_id % 3 = 0").select("target_id")), CO + " select target_id, case when target_id % 2 = 0 then 'only_first' else 'only_second' end as side from control where (target_id % 2 = 0) <> (target_id % 3 = 0)")
def extent(s, d):
    """The box of all places, in metres."""
    return tuple(placed(s, d).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first())


def u02(s, d):
    """The hexes of the box of all places in 7 by 5 chunks against those of the whole box."""
    box = extent(s, d)
    chunks = g.chunk_boxes(s, box, 7, 5)
    whole = s.createDataFrame([box], "min_x double, min_y double, max_x double, max_y double")
    return g.seam_faults(g.hexes_of_boxes(whole, GRID), g.hexes_of_chunks(chunks, GRID))


#: The hexes whose middle is in the box of all places.
IN_BOX = PT + """, b as (select min(x) as x0, min(y) as y0, max(x) as x1, max(y) as y1 from placed), side as (select 1.5e0 * 6000 / sqrt(3e0) as h),
rr as (select unnest(range(cast(floor(y0 / h) as bigint) - 1, cast(ceil(y1 / h) as bigint) + 2)) as r, h, b.* from b, side),
cc as (select r, unnest(range(cast(floor(x0 / 6000 - r / 2e0) as bigint) - 1, cast(ceil(x1 / 6000 - r / 2e0) as bigint) + 2)) as q, h, x0, y0, x1, y1 from rr),
inside as (select q, r, 6000 * (q + r / 2e0) as x, h * r as y, x0, y0, x1, y1 from cc where 6000 * (q + r / 2e0) between x0 and x1 and h * r between y0 and y1)"""
register("u02_seam_check", u02, IN_BOX + " select count(*) as hexes, cast(0 as bigint) as missing, cast(0 as bigint) as doubled, cast(0 as bigint) as strays from inside")
register(
    "p04_hexes_of_chunks",
    lambda s, d: g.hexes_of_chunks(g.chunk_boxes(s, extent(s, d), 7, 5), GRID).groupBy("chunk_id").agg(F.count("*").alias("hexes")),
    IN_BOX + """ select printf('c_%03d_%03d', least(6, cast(floor((x - x0) / ((x1 - x0) / 7)) as bigint)), least(4, cast(floor((y - y0) / ((y1 - y0) / 5)) as bigint))) as chunk_id,
count(*) as hexes from inside group by 1""",
)
register("u05_union_rows", lambda s, d: control(s, d).where("status = 'CONTROLLED'").select("target_id", "status").unionByName(control(s, d).where("status = 'UNRESOLVED'").select("status", "target_id")), CO + " select target_id, status from control")
register("u07_exact_duplicates", lambda s, d: hold(s, d).dropDuplicates(["hex_id", "polity_id", "km2"]), HOLD + " select distinct hex_id, polity_id, km2 from holdings")
register("u09_recovered", lambda s, d: control(s, d).where("target_id % 2 = 0").join(control(s, d).where("target_id % 3 = 0").select("target_id", F.lit(True).alias("recovered")), "target_id", "left").groupBy(F.coalesce("recovered", F.lit(False)).alias("recovered")).agg(F.count("*").alias("hexes")), CO + " select target_id % 3 = 0 as recovered, count(*) as hexes from control where target_id % 2 = 0 group by 1")
register("j10_two_authorities", lambda s, d: lay(s, d).select("hex_id", "land_fraction").join(lay(s, d).select("hex_id", F.col("tree_fraction").alias("other")), "hex_id").agg(F.count_if(F.abs(F.col("land_fraction") - F.col("other")) > 1e-3).alias("inconsistent"), F.count("*").alias("hexes")), LAY + " select count(*) filter (abs(land_fraction - tree_fraction) > 1e-3) as inconsistent, count(*) as hexes from layers")


def bundles(s, d):
    """Features from parts, evidence from events: a synthetic web of links with every kind of fault."""
    roles = F.array(*[F.lit(r) for r in [*e.REQUIRED, "UNCERTAIN_BOUNDARY"]])
    kinds = F.array(*map(F.lit, ("BOUNDARY_POSITION", "POLITICAL_CONTROL", "DE_JURE_CLAIM", "TERRITORIAL_CONTINUITY")))
    features = control(s, d).select(F.col("target_id").cast("string").alias("feature_id"), (F.col("target_id") % 150).cast("string").alias("subject_id"), F.element_at(roles, (F.col("target_id") % 6 + 1).cast("int")).alias("feature_role"), F.lit("2023-01-01").alias("valid_from"), F.when(F.col("target_id") % 11 == 0, "UNKNOWN").otherwise("2025-01-01").alias("valid_to"), (F.col("target_id") % 9 - 1).cast("double").alias("uncertainty_km"))
    ev = stand_in(s, d, "evidence").withColumn("n", F.col("evidence_id"))
    assertions = ev.select(F.col("n").cast("string").alias("evidence_id"), F.col("subject").cast("string").alias("subject_id"), (F.col("n") % 40).cast("string").alias("source_id"), F.element_at(kinds, (F.col("n") % 4 + 1).cast("int")).alias("assertion_type"), F.when(F.col("n") % 29 == 0, F.col("valid_from")).otherwise("2023-06-01").alias("valid_from"), F.when(F.col("n") % 29 == 0, F.col("valid_to")).otherwise("2024-12-31").alias("valid_to"), F.when(F.col("n") % 101 == 0, "UNKNOWN").otherwise("p. 1").alias("locator"), F.element_at(F.array(*map(F.lit, ("LOW", "MEDIUM", "HIGH"))), (F.col("n") % 3 + 1).cast("int")).alias("confidence"), F.lit("YES").alias("geometry_authority"), F.when(F.col("n") % 41 == 0, "NO").otherwise("YES").alias("political_authority"))
    role = F.when(F.col("n") % 4 == 0, "GEOMETRY_SHAPE").when(F.col("n") % 4 == 3, "TEMPORAL_CONTINUITY").when(F.col("n") % 4 == 2, "CLAIM_STATUS").otherwise("POLITICAL_STATUS")
    links = ev.join(features.select("feature_id", F.col("subject_id").cast("bigint").alias("subject")), "subject").where(F.col("n") % 15 == F.col("feature_id").cast("bigint") % 15).select("feature_id", F.col("n").cast("string").alias("evidence_id"), role.alias("evidence_role"))
    registry = s.range(38).select(F.col("id").cast("string").alias("source_id"), F.when(F.col("id") % 10 == 0, "BLOG").otherwise("ARCHIVE").alias("authority_level"))
    subjects = s.range(140).select(F.col("id").cast("string").alias("subject_id"), F.concat(F.lit("pol_"), F.col("id").cast("string")).alias("polity_id"))
    return features, links, assertions, registry, subjects


def m01(part):
    def run(s, d):
        authorised, rejected = e.compile_snapshot(*bundles(s, d), "2024-01-15", forbidden=("BLOG",))
        return authorised.select("feature_id", "polity_id", "confidence", "roles") if part else rejected.select("feature_id", "reasons")

    return run


#: The web of ``bundles`` and the broken rules of each bundle on the day.
BUNDLES = cte("control", "evidence") + """, f as (select cast(target_id as varchar) as feature_id, target_id as t, cast(target_id % 150 as varchar) as subject_id,
  ['POLITY_EXTERNAL_BOUNDARY', 'DE_FACTO_CONTROL_BOUNDARY', 'DE_JURE_CLAIM_BOUNDARY', 'DISPUTED_BOUNDARY', 'CONSTITUENT_INTERNAL_BOUNDARY', 'UNCERTAIN_BOUNDARY'][target_id % 6 + 1] as feature_role,
  '2023-01-01' as valid_from, case when target_id % 11 = 0 then 'UNKNOWN' else '2025-01-01' end as valid_to, cast(target_id % 9 - 1 as double) as uncertainty_km from control),
a as (select cast(evidence_id as varchar) as evidence_id, evidence_id as n, cast(subject as varchar) as subject_id, subject, evidence_id % 40 as source,
  ['BOUNDARY_POSITION', 'POLITICAL_CONTROL', 'DE_JURE_CLAIM', 'TERRITORIAL_CONTINUITY'][evidence_id % 4 + 1] as assertion_type,
  case when evidence_id % 29 = 0 then valid_from else '2023-06-01' end as valid_from, case when evidence_id % 29 = 0 then valid_to else '2024-12-31' end as valid_to,
  ['LOW', 'MEDIUM', 'HIGH'][evidence_id % 3 + 1] as confidence from evidence),
needs as (select * from (values ('POLITY_EXTERNAL_BOUNDARY', 'POLITICAL_STATUS', ['POLITICAL_CONTROL']), ('DE_FACTO_CONTROL_BOUNDARY', 'POLITICAL_STATUS', ['POLITICAL_CONTROL']),
  ('DE_JURE_CLAIM_BOUNDARY', 'CLAIM_STATUS', ['DE_JURE_CLAIM']), ('DISPUTED_BOUNDARY', 'CONTESTED_STATUS', ['POLITICAL_CONTROL', 'DE_JURE_CLAIM']),
  ('CONSTITUENT_INTERNAL_BOUNDARY', 'POLITICAL_STATUS', ['POLITICAL_CONTROL', 'DE_JURE_CLAIM'])) as v(feature_role, evidence_role, types)
  union all select unnest(['POLITY_EXTERNAL_BOUNDARY', 'DE_FACTO_CONTROL_BOUNDARY', 'DE_JURE_CLAIM_BOUNDARY', 'DISPUTED_BOUNDARY', 'CONSTITUENT_INTERNAL_BOUNDARY']), 'GEOMETRY_SHAPE', ['BOUNDARY_POSITION', 'GEOMETRIC_SUBSTRATE_ONLY']),
u as (select * from f where feature_role <> 'UNCERTAIN_BOUNDARY'),
l as (select u.feature_id, u.feature_role, a.*, ['GEOMETRY_SHAPE', 'POLITICAL_STATUS', 'CLAIM_STATUS', 'TEMPORAL_CONTINUITY'][n % 4 + 1] as evidence_role,
  case when n % 101 = 0 then 'NO_EXACT_LOCATOR' when source >= 38 then 'SOURCE_NOT_REGISTERED' when source % 10 = 0 then 'AUTHORITY_FORBIDDEN' end as broken
  from u join a on a.subject = u.t % 150 and a.n % 15 = u.t % 15),
good as (select * from l where broken is null),
r as (select u.feature_id, needs.evidence_role as wanted, needs.types, good.* exclude (feature_id, feature_role) from u join needs using (feature_role) left join good on good.feature_id = u.feature_id and good.evidence_role = needs.evidence_role where u.feature_id in (select feature_id from l)),
x as (select *, valid_from <= '2024-01-15' and valid_to >= '2024-01-15' as holds, case when not list_contains(types, assertion_type) then 'TYPE_NOT_ALLOWED' when wanted <> 'GEOMETRY_SHAPE' and n % 41 = 0 then 'NO_POLITICAL_AUTHORITY'
  when wanted <> 'GEOMETRY_SHAPE' and not (valid_from <= '2024-01-15' and valid_to >= '2024-01-15') then 'NOT_VALID_ON_DAY' end as fault from r where evidence_id is not null),
off as (select feature_id, evidence_id as shape_id, case when valid_to < '2024-01-15' then valid_to else valid_from end as anchor from x where fault is null and wanted = 'GEOMETRY_SHAPE' and not holds),
spans as (select *, case when assertion_type <> 'TERRITORIAL_CONTINUITY' then 'CONTINUITY_TYPE_NOT_ALLOWED' when n % 41 = 0 then 'CONTINUITY_WITHOUT_AUTHORITY' end as unfit from good where evidence_role = 'TEMPORAL_CONTINUITY'),
ways as (select off.feature_id, shape_id, least(anchor, '2024-01-15') as lo, greatest(anchor, '2024-01-15') as hi, s.valid_from as a, s.valid_to as b from off join spans s on s.feature_id = off.feature_id and s.unfit is null),
reach as (select *, greatest(lo, coalesce(max(b) over (partition by feature_id, shape_id order by a, b rows between unbounded preceding and 1 preceding), lo)) as reached from ways),
carried as (select feature_id, shape_id from reach group by feature_id, shape_id having not bool_or(a > reached and reached < hi) and max(b) >= max(hi)),
broken as (select feature_id, 'ROLE_NOT_CONVERTIBLE' as violation, '' as evidence from f where feature_role = 'UNCERTAIN_BOUNDARY'
  union select feature_id, 'NO_EVIDENCE_LINKED', '' from u where feature_id not in (select feature_id from l) union select feature_id, broken, evidence_id from l where broken is not null
  union select feature_id, 'MISSING_' || wanted, '' from r where evidence_id is null union select feature_id, fault, evidence_id from x where fault is not null
  union select feature_id, unfit, evidence_id from spans where unfit is not null and feature_id in (select feature_id from off)
  union select feature_id, 'SHAPE_NOT_CARRIED_TO_DAY', shape_id from off where (feature_id, shape_id) not in (select (feature_id, shape_id) from carried)),
chosen as (select *, case when t % 150 < 140 then 'pol_' || subject_id end as polity_id from f where valid_to <> 'UNKNOWN'),
reasons as (select feature_id, violation from broken where feature_id in (select feature_id from chosen) union select feature_id, 'SUBJECT_NOT_MAPPED' from chosen where polity_id is null union select feature_id, 'NO_UNCERTAINTY' from chosen where uncertainty_km < 0)"""
register("m01_authorised_snapshot", m01(True), BUNDLES + """, part as (select feature_id, confidence, wanted as role from x where fault is null union all select feature_id, confidence, evidence_role from spans where unfit is null and feature_id in (select feature_id from carried))
select feature_id, any_value(polity_id) as polity_id, ['LOW', 'MEDIUM', 'HIGH'][min(list_position(['LOW', 'MEDIUM', 'HIGH'], confidence))] as confidence, string_agg(distinct role, '|' order by role) as roles
from chosen join part using (feature_id) where feature_id not in (select feature_id from reasons) group by feature_id""")
register("m01_rejected_features", m01(False), BUNDLES + " select feature_id, string_agg(distinct violation, '; ' order by violation) as reasons from reasons group by feature_id")


def q08(s, d):
    """Features with a shape, a source and a locator of their own, some of which lack, and some twice."""
    features, links, assertions, registry, subjects = bundles(s, d)
    t = F.col("feature_id").cast("bigint")
    features = features.withColumns({"geometry_source_id": (t % 41).cast("string"), "source_locator": F.when(t % 23 == 0, "UNKNOWN").when(t % 23 != 1, F.concat(F.lit("sheet "), "feature_id"))})
    features = features.unionByName(features.where(t % 31 == 0))
    x, n = (t % 5000) * 10.0, F.lit(100.0)
    crossed = t % 17 == 1
    corners = lambda *c: F.array(*[x + k for k in c])
    rings = features.where(t % 17 != 0).select("feature_id", F.lit(False).alias("is_hole"), corners(0, n, n, 0).alias("xs"), F.when(crossed, corners(0, n, 0, n)).otherwise(corners(0, 0, n, n)).alias("ys"))
    return e.production_faults(features, rings, links, assertions, registry, subjects, "2024-01-15", forbidden=("BLOG",))


register("q08_production_gates", q08, BUNDLES + """ select feature_id, violation as gate, evidence from broken union select feature_id, 'GEOMETRY_SOURCE_NOT_REGISTERED', cast(t % 41 as varchar) from f where t % 41 >= 38
union select feature_id, 'NO_FEATURE_LOCATOR', case when t % 23 = 0 then 'UNKNOWN' else '' end from f where t % 23 < 2 union select feature_id, 'FEATURE_NOT_VALID_ON_DAY', valid_from || '..' || valid_to from f where valid_to = 'UNKNOWN'
union select feature_id, 'SUBJECT_NOT_MAPPED', subject_id from f where t % 150 >= 140 union select feature_id, 'NO_GEOMETRY', '' from f where t % 17 = 0
union select feature_id, 'GEOMETRY_NOT_VALID', 'CROSSES_ITSELF' from f where t % 17 = 1 union select feature_id, 'FEATURE_TWICE', '2' from f where t % 31 = 0""")
register("q06_assertion_faults", lambda s, d: (lambda b: e.assertion_faults(b[2], b[3], ["BOUNDARY_POSITION", "POLITICAL_CONTROL", "DE_JURE_CLAIM"]))(bundles(s, d)), cte("evidence") + """, a as (select cast(evidence_id as varchar) as evidence_id, subject, evidence_id % 40 as source_id, evidence_id % 4 as kind, case when evidence_id % 29 = 0 then valid_from else '2023-06-01' end as valid_from, case when evidence_id % 29 = 0 then valid_to else '2024-12-31' end as valid_to from evidence)
select evidence_id, 'TYPE' as rule from a where kind = 3 union all select evidence_id, 'DATES' from a where valid_from > valid_to union all select distinct cast(source_id as varchar), 'SOURCE' from a where source_id >= 38 union all select min(evidence_id), 'SAID_TWICE' from a group by subject, source_id, kind, valid_from, valid_to having count(*) > 1""")
