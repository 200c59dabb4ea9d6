"""Queries on classifications, comparisons, components, scans and sinks."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import functions as F

from hexloom.functions.predicates import cleaned, non_negative, truthy
from hexloom.operators import checks as k
from hexloom.operators import rasters
from hexloom.sources import tables as t
from hexloom.tables import shared_dir

from .registry import register
from .standins import cte, stand_in

LAY, HOLD, CO, PT = cte("layers"), cte("holdings"), cte("control"), cte("points")
lay = lambda s, d: stand_in(s, d, "layers")
hold = lambda s, d: stand_in(s, d, "holdings")
place = lambda s: posixpath.join(shared_dir(s).rstrip("/"), f"query-{uuid.uuid4().hex}")

register("p23_coverage_class", lambda s, d: lay(s, d).select("hex_id", k.coverage_class(F.col("tree_fraction"), F.col("urban_fraction"), F.lit(1.0), 0.2, 0.3).alias("cls")), LAY + " select hex_id, case when tree_fraction > 0.3 and urban_fraction > 0.3 then 'BIDIRECTIONAL' when tree_fraction > 0.3 then 'UNDER' when urban_fraction > 0.3 then 'OVER' else 'MATCHED' end as cls from layers")
register("p24_coverage_quality", lambda s, d: lay(s, d).select("hex_id", k.coverage_quality(F.col("tree_fraction")).alias("quality")), LAY + " select hex_id, case when tree_fraction <= 0 then 'NONE' when tree_fraction >= 0.98e0 then 'FULL' when tree_fraction >= 0.5e0 then 'PARTIAL' else 'LOW' end as quality from layers")
register(
    "p09_coast_change",
    lambda s, d: k.coast_change(lay(s, d), lay(s, d).select("hex_id", F.when(F.col("hex_id") % 5 == 0, "water").otherwise("land").alias("land_class"), F.col("tree_fraction").alias("land_fraction")), 0.4).select("hex_id", "change"),
    LAY + ", c as (select hex_id, case when land_class = 'land' and hex_id % 5 = 0 then 'LAND_TO_WATER' when land_class = 'water' and hex_id % 5 <> 0 then 'WATER_TO_LAND' when abs(tree_fraction - land_fraction) > 0.4e0 then 'FRACTION_SHIFT' end as change from layers) select * from c where change is not null",
)
register("p22_cleaned", lambda s, d: lay(s, d).select("hex_id", cleaned(F.when(F.col("hex_id") % 3 == 0, "-99").when(F.col("hex_id") % 3 == 1, "").otherwise(F.col("land_class"))).alias("word"), non_negative(F.col("hex_id") - 100).alias("number")), LAY + " select hex_id, case when hex_id % 3 = 2 then land_class end as word, case when hex_id - 100 >= 0 then cast(hex_id - 100 as double) end as number from layers")
register("f38_truthy", lambda s, d: lay(s, d).select("hex_id", truthy(F.element_at(F.array(F.lit("yes"), F.lit("No"), F.lit("TRUE "), F.lit("1"), F.lit(None).cast("string")), (F.col("hex_id") % 5 + 1).cast("int"))).alias("yes")), LAY + " select hex_id, hex_id % 5 in (0, 2, 3) as yes from layers")
register("a30_fraction_histogram", lambda s, d: k.fraction_histogram(lay(s, d).withColumn("mass", F.col("climate") % 4), "mass", "land_fraction", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]).select("landmass", F.col("bucket").cast("bigint"), "hexes"), LAY + ", b as (select cast(climate % 4 as varchar) as landmass, case when land_fraction >= 0.75e0 then 4 when land_fraction >= 0.5e0 then 3 when land_fraction >= 0.25e0 then 2 when land_fraction >= 0.1e0 then 1 else 0 end as bucket from layers) select coalesce(landmass, 'ALL') as landmass, cast(bucket as bigint) as bucket, count(*) as hexes from b group by grouping sets ((landmass, bucket), (bucket))")
register(
    "a29_gap_summary",
    lambda s, d: (lambda o: o.select("mass", "hexes", "authorised", "controlled", "withheld", F.round("withheld_share", 9).alias("withheld_share"), "median_withheld", "largest_withheld"))(k.gap_summary(lay(s, d).withColumns({"mass": F.col("climate") % 4, "authorised": F.col("hex_id") % 2 == 0, "controlled": F.col("hex_id") % 6 == 0}), "mass")),
    LAY + " select climate % 4 as mass, count(*) as hexes, count(*) filter (hex_id % 2 = 0) as authorised, count(*) filter (hex_id % 6 = 0) as controlled, count(*) filter (hex_id % 2 = 0 and hex_id % 6 <> 0) as withheld, round(count(*) filter (hex_id % 2 = 0 and hex_id % 6 <> 0) / count(*) filter (hex_id % 2 = 0), 9) as withheld_share, quantile_cont(land_fraction, 0.5) filter (hex_id % 2 = 0 and hex_id % 6 <> 0) as median_withheld, max(land_fraction) filter (hex_id % 2 = 0 and hex_id % 6 <> 0) as largest_withheld from layers where land_fraction > 0 group by 1",
)
register("a24_conservation", lambda s, d: k.conservation(hold(s, d), hold(s, d).where("polity_id < 90").groupBy("hex_id").agg(F.sum("km2").alias("km2")), "hex_id", "km2", 0.5).select("hex_id", "parts", "total", "difference", "conserved"), HOLD + ", a as (select hex_id, sum(km2) as parts from holdings group by 1), b as (select hex_id, sum(km2) as total from holdings where polity_id < 90 group by 1) select a.hex_id, parts, total, parts - coalesce(total, 0) as difference, abs(parts - coalesce(total, 0)) <= 0.5 as conserved from a left join b on b.hex_id = a.hex_id")


def a25(s, d):
    from hexloom.operators.control import dominant

    shares = hold(s, d).select("hex_id", F.col("polity_id").alias("holder"), "km2")
    return k.distortion(shares, dominant(shares, "hex_id", "holder", "km2").select("hex_id", "holder"))


WON = HOLD + ", s as (select hex_id, polity_id as holder, sum(km2) as km2 from holdings group by all), k as (select *, first_value(holder) over (partition by hex_id order by km2 desc, holder) as winner from s)"
register("a25_distortion", a25, WON + ", a as (select holder, sum(km2) as source_km2, sum(case when winner = holder then 0 else km2 end) as omission_km2 from k group by 1), b as (select winner as holder, sum(km2) as commission_km2 from k where winner <> holder group by 1) select holder, coalesce(source_km2, 0) as source_km2, coalesce(omission_km2, 0) as omission_km2, coalesce(commission_km2, 0) as commission_km2, coalesce(omission_km2, 0) + coalesce(commission_km2, 0) as symmetric_km2 from a full join b using (holder)")
register("p27_representation", lambda s, d: lay(s, d).select("hex_id", k.representation_status(F.col("hex_id") % 5, F.col("tree_fraction"), F.col("hex_id") % 3).alias("status")), LAY + " select hex_id, case when hex_id % 5 = 0 then 'ZERO_HEX_LOSS' when hex_id % 3 > 1 then 'ENCLAVE_AT_RISK' when tree_fraction > 0.25e0 then 'BORDER_COARSE' else 'GOOD' end as status from layers")
register("t02_top_and_above", lambda s, d: k.top_and_above(s.read.parquet(f"{d}/orders.parquet").selectExpr("o_orderkey as id", "o_totalprice as err"), "err", "id", 20, 498_000.0).select("id", "err", F.col("rank").cast("bigint")), "with k as (select o_orderkey as id, o_totalprice as err, row_number() over (order by o_totalprice desc, o_orderkey) as rank from orders) select id, err, rank from k where rank <= 20 or err > 498000")
register("t09_best_with_margin", lambda s, d: k.best_with_margin(hold(s, d).groupBy("polity_id", "hex_id").agg(F.sum("km2").alias("km2")), "polity_id", "hex_id", "km2").select("polity_id", "hex_id", "km2", "margin"), HOLD + ", s as (select polity_id, hex_id, sum(km2) as km2 from holdings group by all), k as (select *, row_number() over w as k, lead(km2) over w - km2 as margin from s window w as (partition by polity_id order by km2, hex_id)) select polity_id, hex_id, km2, margin from k where k = 1")
register("q16_expectations", lambda s, d: k.expectations(t.metrics_table("r", lay(s, d).agg(F.count("*").alias("hexes"), F.countDistinct("climate").alias("climates"))).select("metric", "value"), s.createDataFrame([("hexes", "2000"), ("climates", "31"), ("lakes", "1")], "metric string, value string")), LAY + ", a as (select cast(count(*) as varchar) as h, cast(count(distinct climate) as varchar) as c from layers) select 'hexes' as metric, '2000' as expected, h as actual, h = '2000' as met from a union all select 'climates', '31', c, c = '31' from a union all select 'lakes', '1', null, false")
def g07(s, d):
    edges = s.read.parquet(f"{d}/lineitem.parquet").selectExpr("l_partkey as a", "1000000 + l_suppkey as b")
    return k.components_of_edges(edges).groupBy("component").agg(F.count("*").alias("nodes"))


#: Labels spread eight steps, more than any node of the given tables is from the smallest one; a test holds the query against union-find.
SPREAD = ", ".join(f"l{n} as (select u.a as node, min(least(p.label, q.label)) as label from u join l{n - 1} p on p.node = u.b join l{n - 1} q on q.node = u.a group by 1)" for n in range(1, 9))
register(
    "g07_components",
    g07,
    f"""with e as (select distinct l_partkey as a, 1000000 + l_suppkey as b from lineitem where l_partkey is not null and l_suppkey is not null),
u as (select a, b from e union all select b, a from e), l0 as (select distinct a as node, a as label from u), {SPREAD}
select label as component, count(*) as nodes from l8 group by 1""",
)


def g09(s, d):
    from hexloom.functions.hexgrid import GridSpec
    from hexloom.operators.points import place_points

    p = place_points(stand_in(s, d, "points"), GridSpec(6000.0)).select("id", "x", "y")
    cell = lambda c: F.floor(F.col(c) / 4000)
    near = F.explode(F.array(*[F.struct(F.lit(a).alias("i"), F.lit(b).alias("j")) for a in (-1, 0, 1) for b in (-1, 0, 1)]))
    a = p.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), near.alias("n")).select("a", "ax", "ay", (F.floor(F.col("ax") / 4000) + F.col("n.i")).alias("cx"), (F.floor(F.col("ay") / 4000) + F.col("n.j")).alias("cy"))
    b = p.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), cell("x").alias("cx"), cell("y").alias("cy"))
    edges = a.hint("merge").join(b, ["cx", "cy"]).where("a < b").withColumn("distance_m", F.round(F.hypot(F.col("ax") - F.col("bx"), F.col("ay") - F.col("by")), 3)).where("distance_m <= 4000")
    return k.capped_clusters(p, edges.select("a", "b", "distance_m"), 4000.0, 9000.0).groupBy("cluster").agg(F.count("*").alias("members"))


register("g09_capped_clusters", g09)


def s01(s, d):
    path = place(s)
    text = lambda c: F.col(c).cast("string")
    fields = [text("id"), F.col("name"), F.col("name"), F.lit("NA"), text("lat"), text("lon"), F.lit("P"), F.lit("PPL"), F.lit("NA"), *[F.lit("") for _ in range(5)], text("population"), F.lit("1"), F.lit("1"), F.lit("x"), F.lit("y")]
    stand_in(s, d, "points").select(F.concat_ws("\t", *fields)).write.text(path)
    return t.read_gazetteer(s, path, (139.0, 35.0, 140.5, 36.5)).select("id", "name", "population", F.round("lon", 6).alias("lon"))


register("s01_gazetteer", s01, PT + " select id, name, population, round(lon, 6) as lon from points where lon between 139 and 140.5 and lat between 35 and 36.5")


def s13(s, d):
    path = place(s)
    rings = s.read.parquet(f"{d}/supplier.parquet").selectExpr("cast(s_suppkey as bigint) as feature_id", "array(s_suppkey * 100e0, s_suppkey * 100e0 + 50, s_suppkey * 100e0) as xs", "array(s_suppkey * 70e0, s_suppkey * 70e0, s_suppkey * 70e0 + 900) as ys")
    t.write_banded(rings.unionByName(rings.where("feature_id % 4 = 0")), path, 1000.0)
    return t.read_banded(s, path, (2000.0, 1000.0, 6000.0, 4000.0), 100.0, 1000.0).select("feature_id")


register("s14_banded_cache", s13, "select cast(s_suppkey as bigint) as feature_id from supplier where s_suppkey * 100 <= 6100 and s_suppkey * 100 + 50 >= 1900 and s_suppkey * 70 <= 4100 and s_suppkey * 70 + 900 >= 900")
register("s08_dem_tiles", lambda s, d: rasters.tile_names(138.2, 34.1, 141.0, 36.5, 1, s, rasters.degree_name).join(stand_in(s, d, "points").select(F.floor("lat").alias("south"), F.floor("lon").alias("west")).groupBy("south", "west").count(), ["south", "west"], "left").select("tile", F.coalesce("count", F.lit(0)).alias("points")), PT + ", n as (select cast(floor(lat) as bigint) as s, cast(floor(lon) as bigint) as w, count(*) as n from points group by all) select printf('N%02dE%03d', a.s, b.w) as tile, coalesce(n, 0) as points from range(34, 37) a(s) cross join range(138, 141) b(w) left join n on n.s = a.s and n.w = b.w")
register("s10_split_expected", lambda s, d: t.split_expected(s.range(0, 3000).withColumnRenamed("id", "target_id"), stand_in(s, d, "control").where("target_id % 2 = 0"), "target_id"), CO + " select r.k as target_id, c.target_id is not null as present from range(3000) r(k) left join control c on c.target_id = r.k and c.target_id % 2 = 0")


def s24(s, d):
    path = place(s)
    cells = lay(s, d).withColumn("chunk_id", F.col("hex_id") % 7)
    t.write_chunks(cells.where("chunk_id < 4"), path)
    todo = t.missing_chunks(cells.select("chunk_id").distinct(), s.read.parquet(path))
    t.write_chunks(cells.join(todo, "chunk_id", "left_semi"), path)
    manifest = t.chunk_manifest(s.read.parquet(path).withColumn("chunk_id", F.col("chunk_id").cast("bigint")), "chunk_id", {"land": F.col("land_class") == "land"})
    return manifest.select("chunk_id", "rows", "land")


register("s24_resumed_chunks", s24, LAY + " select hex_id % 7 as chunk_id, count(*) as rows, count(*) filter (land_class = 'land') as land from layers group by 1")


def s15(s, d):
    path = place(s)
    lay(s, d).select("hex_id", F.when(F.col("hex_id") % 3 == 0, "None").when(F.col("hex_id") % 3 == 1, F.lit(None)).otherwise("x, y").alias("word"), F.col("tree_fraction").alias("f")).write.options(header=True, nullValue="").csv(path)
    return t.read_curated(s, path, "hex_id bigint, word string, f double")


register("s15_curated_csv", s15, LAY + " select hex_id, case hex_id % 3 when 0 then 'None' when 2 then 'x, y' end as word, tree_fraction as f from layers")


def s19(s, d):
    path = place(s)
    t.write_csv(lay(s, d).select("hex_id", "land_class", (F.col("tree_fraction") / 3).alias("third")), path, gzip=True)
    return s.read.schema("hex_id bigint, land_class string, third double").option("header", True).csv(path)


register("s22_gzip_csv", s19, LAY + " select hex_id, land_class, round(tree_fraction / 3, 6) as third from layers")
register("s20_geojson", lambda s, d: t.geojson_lines(stand_in(s, d, "points").select("id"), t.point_geometry(F.col("id") / 8, F.col("id") / 16)).select(F.get_json_object("value", "$.properties.id").cast("bigint").alias("id"), F.get_json_object("value", "$.geometry.coordinates[0]").cast("double").alias("lon"), F.get_json_object("value", "$.type").alias("type")), PT + " select id, id / 8e0 as lon, 'Feature' as type from points")
register("s26_metrics", lambda s, d: t.metrics_table("run1", lay(s, d).agg(F.count("*").alias("hexes"), F.max("hex_id").alias("largest"))), LAY + ", a as (select count(*) as n, max(hex_id) as m from layers) select 'run1' as run_id, 'hexes' as metric, cast(n as varchar) as value from a union all select 'run1', 'largest', cast(m as varchar) from a")


def s25(s, d):
    before = t.file_manifest(s, f"{d}/part.parquet")
    return t.changed_files(before, t.file_manifest(s, f"{d}/part.parquet", before).unionByName(t.file_manifest(s, f"{d}/nation.parquet"))).groupBy("change").agg(F.count("*").alias("files"))


register("s25_changed_files", s25, "select 'ADDED' as change, cast(1 as bigint) as files")
register("s27_canonical_reference", lambda s, d: t.canonical_reference({"control": stand_in(s, d, "control"), "holdings": hold(s, d)}).select("table", "rows"), CO + ", h as (select count(*) as n from lineitem) select 'control' as \"table\", count(*) as rows from control union all select 'holdings', n from h")
register("t01_canonical_order", lambda s, d: t.ordered(lay(s, d).select("hex_id", "land_class"), "hex_id"), LAY + " select hex_id, land_class from layers")
register("a35_totals", lambda s, d: hold(s, d).agg(F.count("*").alias("rows"), F.countDistinct("hex_id").alias("hexes"), (F.count("*") - F.countDistinct("hex_id", "polity_id")).alias("duplicates"), F.count_if(F.col("km2") > 25).alias("large")), HOLD + " select count(*) as rows, count(distinct hex_id) as hexes, count(*) - count(distinct (hex_id, polity_id)) as duplicates, count(*) filter (km2 > 25) as large from holdings")
register("a08_share_sums", lambda s, d: lay(s, d).groupBy("climate").agg(F.count("*").alias("hexes"), F.round(F.sum("land_fraction"), 6).alias("land"), F.round(F.percentile("tree_fraction", F.lit(0.95)), 6).alias("tree_p95")), LAY + " select climate, count(*) as hexes, round(sum(land_fraction), 6) as land, round(quantile_cont(tree_fraction, 0.95), 6) as tree_p95 from layers group by 1")
