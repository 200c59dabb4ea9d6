"""The driver's tables seen as places, pixels, reaches, edges, evidence and control rows, in Spark and as DuckDB text.

Each stand-in is one SELECT that both engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Columns of each stand-in over one table.
SELECTS = {
    "points": ("customer", "c_custkey as id, c_name as name, 138.5e0 + ((c_custkey * 7919) % 30011) / 10004e0 as lon, 34.5e0 + ((c_custkey * 10473) % 29989) / 9997e0 as lat, cast(round(abs(c_acctbal) * 100) as bigint) as population"),
    "pixels": ("lineitem", "cast(l_orderkey % 512 as bigint) as row, cast(l_partkey % 512 as bigint) as col, cast(l_linenumber as bigint) as p1, cast(l_suppkey as bigint) as p2, cast(l_extendedprice as double) as p3, cast(l_extendedprice as double) / 100 as elev, cast(l_suppkey % 12 as bigint) as cover, cast(l_partkey % 31 as bigint) as climate, 139e0 + (l_partkey % 512) * 0.003e0 as lon, 36e0 - (l_orderkey % 512) * 0.003e0 as lat"),
    "reaches": ("orders", "cast(o_orderkey + 1 as bigint) as reach_id, cast(case when o_orderkey % 64 = 0 then 0 else greatest(o_orderkey - o_custkey % 3, cast(floor(o_orderkey / 64) as bigint) * 64 + 1) end as bigint) as next_down, cast(o_totalprice as double) / 1000 as discharge"),
    "membership": ("lineitem", "cast(l_partkey as bigint) as edge_id, cast(l_orderkey as bigint) as branch_id, cast(l_suppkey as bigint) as river_id, cast(l_extendedprice as double) as discharge, cast(l_quantity as double) as width"),
    "holdings": ("lineitem", "cast(l_partkey as bigint) as hex_id, cast(l_suppkey as bigint) as polity_id, cast(l_quantity as double) as km2"),
    "evidence": ("events", "cast(user_id as bigint) as subject, event_type as assertion_type, event_id as evidence_id, cast(cast(ts as date) as string) as valid_from, cast(cast(ts as date) + cast(cast(floor(abs(value)) as int) % 60 as int) as string) as valid_to, cast(event_id % 4 as int) as level"),
    "layers": ("part", "cast(p_partkey as bigint) as hex_id, (p_size % 50) * 0.5e0 as slope_mean_deg, p_size * 0.7e0 as terrain_roughness, (p_partkey % 130) * 10e0 as elevation_range_m, cast(p_partkey % 31 as bigint) as climate, case when p_partkey % 9 = 0 then 'water' else 'land' end as land_class, ((p_partkey * 3) % 101) / 100e0 as land_fraction, ((p_partkey * 7) % 101) / 100e0 as tree_fraction, ((p_partkey * 11) % 101) / 100e0 as shrub_fraction, ((p_partkey * 13) % 101) / 100e0 as grassland_fraction, ((p_partkey * 17) % 101) / 100e0 as cropland_fraction, ((p_partkey * 19) % 101) / 100e0 as urban_fraction, ((p_partkey * 23) % 101) / 100e0 as bare_ground_fraction, ((p_partkey * 29) % 101) / 100e0 as permanent_snow_ice_fraction, ((p_partkey * 31) % 101) / 100e0 as inland_water_fraction, ((p_partkey * 37) % 101) / 100e0 as wetland_fraction, ((p_partkey * 41) % 101) / 100e0 as mangroves_fraction, ((p_partkey * 43) % 101) / 100e0 as moss_lichen_fraction"),
    "control": ("part", "cast(p_partkey as bigint) as target_id, case when p_size % 5 = 0 then 'UNRESOLVED' else 'CONTROLLED' end as status, p_brand as controller, cast(p_size as bigint) as size, cast(p_retailprice as double) as price, p_type as kind"),
}


def stand_in(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns = SELECTS[name]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    view = f"_{table}_{abs(hash(sf_dir))}"
    df.createOrReplaceTempView(view)
    return spark.sql(f"select {columns} from {view}")


def cte(*names: str) -> str:
    """The stand-ins as the begin of a WITH clause."""
    return "with " + ", ".join(f"{n} as (select {SELECTS[n][1]} from {SELECTS[n][0]})" for n in names)


#: Cells of 6 km of the points, after ``points``.
PLACED_SQL = """, projected as (select *, 6378137e0 * radians(lon) as x, 6378137e0 * ln(tan(pi() / 4 + radians(lat) / 2)) as y from points),
fractional as (select *, (sqrt(3e0) / 3 * x - y / 3) / (6000 / sqrt(3e0)) as qf, (2e0 / 3 * y) / (6000 / sqrt(3e0)) as rf from projected),
rounded as (select *, round_even(qf, 0) as q0, round_even(rf, 0) as r0, round_even(-qf - rf, 0) as s0 from fractional),
offs as (select *, abs(q0 - qf) as dq, abs(r0 - rf) as dr, abs(s0 + qf + rf) as ds from rounded),
cells as (select *, cast(case when dq > dr and dq > ds then -r0 - s0 else q0 end as bigint) as q,
  cast(case when not (dq > dr and dq > ds) and dr > ds then -q0 - s0 else r0 end as bigint) as r from offs),
placed as (select *, printf('h6000_q%+07d_r%+07d', q, r) as hex_id, 6000 * (q + r / 2e0) as centre_x, 1.5e0 * (6000 / sqrt(3e0)) * r as centre_y from cells)
"""
