"""Queries on pixels, zonal statistics and terrain layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from hexloom.functions.hexgrid import GridSpec
from hexloom.functions.predicates import ramp
from hexloom.operators import rasters as r
from hexloom.operators import terrain as t

from .registry import register
from .standins import cte, stand_in

GRID = GridSpec(6000.0)
VALUES = ["elev", "cover", "climate", "lat", "lon"]


def laid(s, d):
    """One pixel for each (row, col), the last one laid."""
    return r.mosaic(stand_in(s, d, "pixels"), ["p3", "p1", "p2"], VALUES)


LAID = cte("pixels") + """, laid as (select row, col, arg_max(elev, k) as elev, arg_max(cover, k) as cover, arg_max(climate, k) as climate, any_value(lat) as lat, any_value(lon) as lon
from (select *, (p3, p1, p2, elev, cover, climate) as k from pixels) group by row, col)"""
register("s11_mosaic", lambda s, d: laid(s, d).select("row", "col", F.round("elev", 4).alias("elev"), "cover"), LAID + " select row, col, round(elev, 4) as elev, cover from laid")
register(
    "s11_filled",
    lambda s, d: r.filled(s.range(512).select(F.col("id").alias("row")).crossJoin(s.range(512).select(F.col("id").alias("col"))), laid(s, d), {"elev": 0.0}).select("row", "col", F.round("elev", 4).alias("elev")),
    LAID + " select a.row, b.col, round(coalesce(l.elev, 0), 4) as elev from range(512) a(row) cross join range(512) b(col) left join laid l on l.row = a.row and l.col = b.col",
)
register(
    "s12_sample_raster",
    lambda s, d: r.sample_at(stand_in(s, d, "points"), laid(s, d), 138.9985, 36.0015, 0.003, ["elev", "climate"]).select("id", F.round("elev", 4).alias("elev"), "climate"),
    LAID + """, points as (select c_custkey as id, 138.5e0 + ((c_custkey * 7919) % 30011) / 10004e0 as lon, 34.5e0 + ((c_custkey * 10473) % 29989) / 9997e0 as lat from customer),
att as (select id, cast(floor((lon - 138.9985e0) / 0.003e0) as bigint) as col, cast(floor((36.0015e0 - lat) / 0.003e0) as bigint) as row from points) select id, round(elev, 4) as elev, climate from att left join laid using (row, col)""",
)
register("w10_slope", lambda s, d: r.slope(laid(s, d), 0.003).select("row", "col", F.round("slope_deg", 5).alias("slope_deg")), LAID + """, n as (select l.row, l.col, l.elev as e, l.lat, a.elev as lf, b.elev as rt, c.elev as up, x.elev as dn from laid l left join laid a on a.row = l.row and a.col = l.col - 1 left join laid b on b.row = l.row and b.col = l.col + 1 left join laid c on c.col = l.col and c.row = l.row - 1 left join laid x on x.col = l.col and x.row = l.row + 1),
g as (select *, coalesce((rt - lf) / 2, rt - e, e - lf, 0) as dx, coalesce((dn - up) / 2, dn - e, e - up, 0) as dy from n)
select row, col, round(degrees(atan(sqrt((dx / (333.96e0 * greatest(cos(radians(lat)), 0.05e0))) ** 2 + (dy / 333.96e0) ** 2))), 5) as slope_deg from g""")
register("w11_ruggedness", lambda s, d: r.ruggedness(laid(s, d)).select("row", "col", F.round("ruggedness", 7).alias("ruggedness")), LAID + """, p as (select l.row, l.col, l.elev as e, o.a, o.b, coalesce(n.elev, m.elev, k.elev, l.elev) as v from laid l cross join (values (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)) o(a, b)
left join laid n on n.row = l.row + o.a and n.col = l.col + o.b left join laid m on m.row = l.row + o.a and m.col = l.col left join laid k on k.row = l.row and k.col = l.col + o.b) select row, col, round(sum(abs(e - v)) / 8, 7) as ruggedness from p group by row, col""")

HEXED = LAID + """, pr as (select *, 6378137e0 * radians(lon) as x, 6378137e0 * ln(tan(pi() / 4 + radians(lat) / 2)) as y from laid),
fr as (select *, (sqrt(3e0) / 3 * x - y / 3) / (6000 / sqrt(3e0)) as qf, (2e0 / 3 * y) / (6000 / sqrt(3e0)) as rf from pr), ro as (select *, round_even(qf, 0) as q0, round_even(rf, 0) as r0, round_even(-qf - rf, 0) as s0 from fr),
ofs as (select *, abs(q0 - qf) as dq, abs(r0 - rf) as dr, abs(s0 + qf + rf) as ds from ro),
hexed as (select *, cast(case when dq > dr and dq > ds then -r0 - s0 else q0 end as bigint) as q, cast(case when not (dq > dr and dq > ds) and dr > ds then -q0 - s0 else r0 end as bigint) as r from ofs)"""
hexed = lambda s, d: r.hex_of_pixels(laid(s, d), GRID)
register("a06_hex_of_pixels", lambda s, d: hexed(s, d).select("row", "col", "q", "r"), HEXED + " select row, col, q, r from hexed")
register(
    "a02_zonal_elevation",
    lambda s, d: r.zonal_elevation(hexed(s, d).withColumns({"slope_deg": F.col("elev") / 37, "ruggedness": F.col("elev") / 90}), ["q", "r"], F.col("cover") != 0).select("q", "r", *[F.round(c, 9).alias(c) for c in ("elevation_mean_m", "elevation_min_m", "elevation_max_m", "elevation_range_m", "slope_mean_deg", "slope_p90_deg", "terrain_roughness", "dem_nodata_fraction")]),
    HEXED + """ select q, r, round(avg(elev) filter (cover <> 0), 9) as elevation_mean_m, round(min(elev) filter (cover <> 0), 9) as elevation_min_m, round(max(elev) filter (cover <> 0), 9) as elevation_max_m, round(max(elev) filter (cover <> 0) - min(elev) filter (cover <> 0), 9) as elevation_range_m,
round(avg(elev / 37) filter (cover <> 0), 9) as slope_mean_deg, round(quantile_cont(elev / 37, 0.9) filter (cover <> 0), 9) as slope_p90_deg, round(avg(elev / 90) filter (cover <> 0), 9) as terrain_roughness, round(1 - count(*) filter (cover <> 0) / count(*), 9) as dem_nodata_fraction from hexed group by q, r""",
)
CODES = dict(zip(range(1, 12), r.COVER.values()))
register(
    "a03_zonal_cover",
    lambda s, d: (lambda z: z.select("q", "r", *[F.round(c, 6).alias(c) for c in z.columns[2:]]))(r.zonal_cover(hexed(s, d), ["q", "r"], F.col("cover"), CODES)),
    HEXED + " select q, r, " + ", ".join(f"round(coalesce(count(*) filter (cover = {k}) / nullif(count(*) filter (cover between 1 and 11), 0), 0), 6) as lc_{n}_fraction" for k, n in CODES.items()) + ", round(1 - count(*) filter (cover between 1 and 11) / count(*), 6) as landcover_nodata_fraction from hexed group by q, r",
)
register(
    "a04_climate_mode",
    lambda s, d: r.zonal_mode(hexed(s, d), ["q", "r"], "climate"),
    HEXED + ", c as (select q, r, climate, count(*) as n from hexed group by all), k as (select *, row_number() over (partition by q, r order by case when climate > 0 then n else 0 end desc, climate) as rn from c) select q, r, case when climate > 0 then climate else 0 end as mode from k where rn = 1",
)


def a05(s, d):
    z = hexed(s, d).withColumns({"slope_deg": F.col("elev") / 37, "ruggedness": F.col("elev") / 90})
    terrain = r.region_terrain(r.zonal_elevation(z, ["q", "r"], F.col("cover") > 6), r.zonal_cover(z, ["q", "r"], F.col("cover"), CODES), r.zonal_mode(z, ["q", "r"], "climate"), None, ["q", "r"])
    return terrain.select("q", "r", F.round("elevation_mean_m", 9).alias("elevation_mean_m"), F.round("lc_tree_fraction", 6).alias("lc_tree_fraction"), "climate")


register("a05_region_terrain", a05, HEXED + """, c as (select q, r, climate, count(*) as n from hexed group by all), k as (select *, row_number() over (partition by q, r order by case when climate > 0 then n else 0 end desc, climate) as rn from c),
z as (select q, r, round(coalesce(avg(elev) filter (cover > 6), 0), 9) as elevation_mean_m, round(coalesce(count(*) filter (cover = 1) / nullif(count(*) filter (cover between 1 and 11), 0), 0), 6) as lc_tree_fraction from hexed group by q, r) select z.*, case when k.climate > 0 then k.climate else 0 end as climate from z join k on k.q = z.q and k.r = z.r and k.rn = 1""")

# Layers of the stand-in hexes.
LETTER = "case when climate = 0 then '?' else substr(list_extract([" + ", ".join(f"'{c}'" for c in r.CLIMATES) + "], climate), 1, 1) end"
FLAGS = cte("layers") + f""", flags as (select *, {LETTER} = 'A' as is_tropical, {LETTER} = 'B' as is_arid, climate = 29 as is_tundra_climate, climate = 30 as is_ice_cap_climate from layers)"""
C01 = "least(1e0, greatest(0e0, {}))"


def flagged(s, d):
    return stand_in(s, d, "layers").withColumns(t.climate_flags(F.col("climate")))


register(
    "f19_climate_flags",
    lambda s, d: flagged(s, d).select("hex_id", "climate_zone", "biome_class", "is_tropical", "is_arid", "is_cold", "is_tundra_climate", "is_ice_cap_climate"),
    FLAGS + f""" select hex_id, case when climate = 0 then 'unknown' else list_extract([{", ".join(f"'{c}'" for c in r.CLIMATES)}], climate) end as climate_zone,
case {LETTER} when 'A' then 'tropical' when 'B' then 'arid' when 'C' then 'temperate' when 'D' then 'continental' when 'E' then 'polar' else 'unknown' end as biome_class, is_tropical, is_arid, {LETTER} in ('D', 'E') as is_cold, is_tundra_climate, is_ice_cap_climate from flags""",
)
register("f18_ramp", lambda s, d: stand_in(s, d, "layers").select("hex_id", F.round(ramp(F.col("slope_mean_deg"), 3.0, 20.0), 6).alias("ramp")), cte("layers") + " select hex_id, round(" + C01.format("(slope_mean_deg - 3) / 17e0") + ", 6) as ramp from layers")


def ramp_sql(x, lo, hi):
    return C01.format(f"({x} - {lo}) / {hi - lo}e0")


def scored(s, d):
    names = {"tree": "tree", "shrub": "shrub", "grassland": "grassland", "cropland": "cropland", "built_up": "urban", "bare_sparse": "bare_ground", "snow_ice": "permanent_snow_ice", "herbaceous_wetland": "wetland", "mangroves": "mangroves", "moss_lichen": "moss_lichen"}
    return flagged(s, d).withColumns({f"lc_{k}_fraction": F.col(f"{v}_fraction") for k, v in names.items()}).withColumns(t.face_scores())


SCORES = ["plains", "forest", "rainforest", "tundra", "desert", "wetland", "hills", "mountain", "urban", "permanent_snow_ice"]
DAMP = f"(1 - 0.65e0 * {ramp_sql('slope_mean_deg', 8, 20)})"
SCORES_SQL = FLAGS + f""", scores as (select *, (grassland_fraction + cropland_fraction + 0.6e0 * shrub_fraction + 0.4e0 * moss_lichen_fraction) * {DAMP} * case when is_tundra_climate then 0.3e0 else 1 end as plains_score, tree_fraction * {DAMP} as forest_score,
case when is_tropical then 1.25e0 * tree_fraction * {DAMP} else 0 end as rainforest_score,
case when is_tundra_climate then (1.2e0 * (moss_lichen_fraction + 0.6e0 * grassland_fraction + 0.4e0 * shrub_fraction + 0.3e0 * bare_ground_fraction) + 0.2e0) * (1 - tree_fraction) else 0 end as tundra_score,
1.1e0 * bare_ground_fraction * case when is_arid then 1 else 0.35e0 end as desert_score, 2 * (wetland_fraction + mangroves_fraction) * {DAMP} as wetland_score,
0.9e0 * {C01.format('(slope_mean_deg - 2.5e0) / 4.5e0')} * (1 - {ramp_sql('slope_mean_deg', 12, 20)}) as hills_score,
1.15e0 * ({ramp_sql('slope_mean_deg', 10, 22)} + 0.4e0 * {ramp_sql('terrain_roughness', 8, 25)} + 0.4e0 * {ramp_sql('elevation_range_m', 500, 1200)}) / 1.8e0 as mountain_score,
2.2e0 * urban_fraction as urban_score, 2 * permanent_snow_ice_fraction + case when is_ice_cap_climate then 0.4e0 else 0 end as permanent_snow_ice_score from flags)"""
register("f20_face_scores", lambda s, d: scored(s, d).select("hex_id", *[F.round(f"{n}_score", 9).alias(f"{n}_score") for n in SCORES]), SCORES_SQL + " select hex_id, " + ", ".join(f"round({n}_score, 9) as {n}_score" for n in SCORES) + " from scores")
register(
    "w02_face_winner",
    lambda s, d: scored(s, d).withColumns({f"{n}_score": F.round(f"{n}_score", 6) for n in SCORES}).withColumns(t.face_of_scores([f"{n}_score" for n in SCORES], F.col("land_class") == "water")).select("hex_id", "terrain_face", F.col("terrain_face_id").cast("bigint"), "terrain_face_second", F.round("terrain_face_confidence", 5).alias("terrain_face_confidence")),
    SCORES_SQL + ", u as (select hex_id, land_class, v.k, v.face, round(v.s, 6) as s from scores cross join lateral (values " + ", ".join(f"({k}, '{n.upper()}', {n}_score)" for k, n in enumerate(SCORES)) + """) v(k, face, s)),
o as (select *, row_number() over (partition by hex_id order by s desc, k) as rn from u), w as (select hex_id, any_value(land_class) as lc, max(face) filter (rn = 1) as a, max(s) filter (rn = 1) as sa, max(face) filter (rn = 2) as b, max(s) filter (rn = 2) as sb from o group by hex_id)
select hex_id, case when lc = 'water' then 'WATER' else a end as terrain_face, cast(list_position([""" + ", ".join(f"'{n}'" for n in t.FACES) + """], case when lc = 'water' then 'WATER' else a end) - 1 as bigint) as terrain_face_id, case when lc = 'water' then 'WATER' else b end as terrain_face_second, round(case when lc = 'water' then 1 when sa > 0 then (sa - sb) / sa else 0 end, 5) as terrain_face_confidence from w""",
)
register(
    "f21_movement",
    lambda s, d: (lambda df: df.select("hex_id", *[F.round(c, 6).alias(n) for n, c in t.movement().items()]))(stand_in(s, d, "layers")),
    cte("layers") + " select hex_id, " + ", ".join(f"round({C01.format(x)}, 6) as {n}" for n, x in {
        "foot_mobility": f"1 - 0.6e0 * {ramp_sql('slope_mean_deg', 2, 30)} - 0.5e0 * wetland_fraction - 0.3e0 * permanent_snow_ice_fraction",
        "wheeled_mobility": f"1 - {C01.format('(slope_mean_deg - 1.5e0) / 13.5e0')} - 0.8e0 * wetland_fraction - 0.3e0 * tree_fraction - 0.4e0 * permanent_snow_ice_fraction",
        "tracked_mobility": f"1 - 0.8e0 * {ramp_sql('slope_mean_deg', 2, 20)} - 0.7e0 * wetland_fraction - 0.2e0 * tree_fraction - 0.3e0 * permanent_snow_ice_fraction",
        "visibility": f"1 - {C01.format('0.75e0 * tree_fraction + 0.6e0 * urban_fraction + 0.15e0 * ' + ramp_sql('terrain_roughness', 5, 30))}",
        "concealment": f"0.75e0 * tree_fraction + 0.6e0 * urban_fraction + 0.15e0 * {ramp_sql('terrain_roughness', 5, 30)}",
        "defensive_value": f"0.4e0 * {ramp_sql('slope_mean_deg', 3, 20)} + 0.3e0 * {ramp_sql('terrain_roughness', 5, 30)} + 0.35e0 * urban_fraction + 0.2e0 * tree_fraction",
        "logistics_passability": f"1 - 0.7e0 * {ramp_sql('slope_mean_deg', 2, 30)} - 0.7e0 * wetland_fraction - 0.5e0 * permanent_snow_ice_fraction",
        "construction_suitability": f"1 - 0.8e0 * {ramp_sql('slope_mean_deg', 2, 30)} - 0.9e0 * wetland_fraction - 0.8e0 * permanent_snow_ice_fraction",
        "deployment_capacity": f"1 - 0.7e0 * {ramp_sql('slope_mean_deg', 2, 30)} - 0.8e0 * wetland_fraction - 0.4e0 * tree_fraction",
    }.items()) + " from layers",
)
layered = lambda s, d: t.layered(flagged(s, d))
LAYERED = FLAGS + f""", est as (select *, {C01.format('inland_water_fraction - (1 - land_fraction)')} as inland from flags),
c1 as (select *, case when land_class = 'water' then 'OCEAN' when inland >= 0.5e0 then 'LAKE' else 'NONE' end as water_type, case when land_class = 'water' then 1 else {C01.format('abs(inland - 0.5e0) / 0.5e0')} end as water_confidence,
case when permanent_snow_ice_fraction >= 0.4e0 or (is_ice_cap_climate and permanent_snow_ice_fraction >= 0.2e0) then 'PERMANENT_SNOW_ICE' when wetland_fraction >= 0.35e0 then 'WETLAND' when is_arid and bare_ground_fraction >= 0.5e0 then 'DESERT' when is_tundra_climate then 'TUNDRA' else 'NORMAL' end as sc,
permanent_snow_ice_fraction / 0.4e0 as sm, wetland_fraction / 0.35e0 as wm, case when is_arid then bare_ground_fraction / 0.5e0 else 0 end as dm,
(slope_mean_deg >= 11 and elevation_range_m >= 900) as alt, case when slope_mean_deg >= 11 and elevation_range_m >= 900 then 3 when slope_mean_deg >= 15 then 3 when slope_mean_deg >= 6 then 2 when slope_mean_deg >= 2.5e0 then 1 else 0 end as rb,
case when tree_fraction >= 0.4e0 then case when is_tropical then 'RAINFOREST' else 'FOREST' end else 'OPEN' end as vc, {C01.format('abs(tree_fraction - 0.4e0) / 0.4e0')} as vegetation_confidence,
case when urban_fraction >= 0.65e0 then 3 when urban_fraction >= 0.35e0 then 2 when urban_fraction >= 0.1e0 then 1 else 0 end as db from est),
c2 as (select *, {C01.format("case sc when 'PERMANENT_SNOW_ICE' then sm - 1 when 'WETLAND' then wm - 1 when 'DESERT' then dm - 1 when 'TUNDRA' then 1 - greatest(sm, wm) else 1 - greatest(sm, wm, dm) end")} as surface_confidence,
{C01.format("case rb when 0 then (2.5e0 - slope_mean_deg) / 1.75e0 when 1 then least(slope_mean_deg - 2.5e0, 6 - slope_mean_deg) / 1.75e0 when 2 then least(slope_mean_deg - 6, 15 - slope_mean_deg) / 4.5e0 else (slope_mean_deg - 15) / 4.5e0 end")} as rc0,
{C01.format("case db when 0 then (0.1e0 - urban_fraction) / 0.125e0 when 1 then least(urban_fraction - 0.1e0, 0.35e0 - urban_fraction) / 0.125e0 when 2 then least(urban_fraction - 0.35e0, 0.65e0 - urban_fraction) / 0.15e0 else (urban_fraction - 0.65e0) / 0.15e0 end")} as development_confidence from c1),
c3 as (select *, case when alt then greatest(rc0, 0.5e0) else rc0 end as relief_confidence, case when water_type <> 'NONE' then 'NONE' else sc end as surface_class, case when water_type <> 'NONE' then 'NONE' else list_extract(['FLAT', 'ROLLING', 'HILLS', 'MOUNTAIN'], rb + 1) end as relief_class, case when water_type <> 'NONE' then 'NONE' else vc end as vegetation_class, list_extract(['NONE', 'SETTLED', 'URBAN', 'DENSE_URBAN'], db + 1) as development_class from c2),
c4 as (select *, case when relief_class = 'MOUNTAIN' then 'MOUNTAIN' when relief_class = 'HILLS' and slope_mean_deg >= 8 then 'HILLS' when surface_class in ('DESERT', 'TUNDRA', 'WETLAND') then surface_class when vegetation_class in ('FOREST', 'RAINFOREST') then vegetation_class when relief_class = 'HILLS' then 'HILLS' else 'PLAINS' end as rest,
case when relief_class = 'MOUNTAIN' then relief_confidence when relief_class = 'HILLS' and slope_mean_deg >= 8 then relief_confidence when surface_class in ('DESERT', 'TUNDRA', 'WETLAND') then surface_confidence when vegetation_class in ('FOREST', 'RAINFOREST') then vegetation_confidence when relief_class = 'HILLS' then relief_confidence else surface_confidence end as rest_sure from c3),
c5 as (select *, case when water_type <> 'NONE' then 'WATER' when surface_class = 'PERMANENT_SNOW_ICE' then surface_class else rest end as natural_terrain_face, case when water_type <> 'NONE' then 'WATER' when surface_class = 'PERMANENT_SNOW_ICE' then surface_class when db = 3 then 'URBAN' else rest end as dominant_terrain_face,
{C01.format("case when water_type <> 'NONE' then water_confidence when surface_class = 'PERMANENT_SNOW_ICE' then surface_confidence when db = 3 then development_confidence else rest_sure end")} as dominant_face_confidence from c4)"""
C5 = ["water_confidence", "surface_confidence", "relief_confidence", "vegetation_confidence", "development_confidence"]
register("f22_band_confidence", lambda s, d: layered(s, d).select("hex_id", F.round("development_confidence", 6).alias("development_confidence")), LAYERED + " select hex_id, round(development_confidence, 6) as development_confidence from c5")
register("f23_water_layer", lambda s, d: layered(s, d).select("hex_id", "water_type", F.round("inland_water_est", 6).alias("inland_water_est"), F.round("water_confidence", 6).alias("water_confidence")), LAYERED + " select hex_id, water_type, round(inland, 6) as inland_water_est, round(water_confidence, 6) as water_confidence from c5")
register("f24_surface_layer", lambda s, d: flagged(s, d).withColumns(t.surface_layer()).select("hex_id", "surface_class", F.round("surface_confidence", 6).alias("surface_confidence")), LAYERED + " select hex_id, sc as surface_class, round(surface_confidence, 6) as surface_confidence from c5")
register("f25_relief_layer", lambda s, d: flagged(s, d).withColumns(t.relief_layer()).select("hex_id", "relief_class", F.round("relief_confidence", 6).alias("relief_confidence")), LAYERED + " select hex_id, list_extract(['FLAT', 'ROLLING', 'HILLS', 'MOUNTAIN'], rb + 1) as relief_class, round(relief_confidence, 6) as relief_confidence from c5")
register("f26_vegetation_layer", lambda s, d: flagged(s, d).withColumns(t.vegetation_layer()).select("hex_id", "vegetation_class", F.round("vegetation_confidence", 6).alias("vegetation_confidence")), LAYERED + " select hex_id, vc as vegetation_class, round(vegetation_confidence, 6) as vegetation_confidence from c5")
register("f27_development_layer", lambda s, d: flagged(s, d).withColumns(t.development_layer()).select("hex_id", "development_class"), LAYERED + " select hex_id, development_class from c5")
FACE_ID = "cast(list_position([" + ", ".join(f"'{n}'" for n in t.FACES) + "], {}) - 1 as bigint)"
register("f28_shown_face", lambda s, d: layered(s, d).select("hex_id", "natural_terrain_face", "dominant_terrain_face", F.col("dominant_terrain_face_id").cast("bigint"), F.round("dominant_face_confidence", 6).alias("dominant_face_confidence")), LAYERED + f" select hex_id, natural_terrain_face, dominant_terrain_face, {FACE_ID.format('dominant_terrain_face')} as dominant_terrain_face_id, round(dominant_face_confidence, 6) as dominant_face_confidence from c5")
register("f29_layers", lambda s, d: layered(s, d).select("hex_id", "water_type", "surface_class", "relief_class", "vegetation_class", "development_class"), LAYERED + " select hex_id, water_type, surface_class, relief_class, vegetation_class, development_class from c5")
NAMES = ["water_type", "surface_class", "relief_class", "vegetation_class", "development_class"]
register("a09_layer_counts", lambda s, d: t.layer_counts(layered(s, d), NAMES).select("layer", "value", "n", F.round("pct", 6).alias("pct")), LAYERED + ", l as (" + " union all ".join(f"select '{n}' as layer, {n} as value from c5" for n in NAMES) + ") select layer, value, count(*) as n, round(100e0 * count(*) / sum(count(*)) over (partition by layer), 6) as pct from l group by layer, value")
register("a10_layer_combinations", lambda s, d: t.layer_combinations(layered(s, d), NAMES[1:]).withColumn("share", F.round("share", 6)), LAYERED + " select surface_class, relief_class, vegetation_class, development_class, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from c5 where water_type = 'NONE' group by all")
register("t03_transition_cases", lambda s, d: t.transition_cases(layered(s, d), 0.25).select("hex_id", "dominant_terrain_face", F.round("dominant_face_confidence", 6).alias("dominant_face_confidence")), LAYERED + " select hex_id, dominant_terrain_face, round(dominant_face_confidence, 6) as dominant_face_confidence from c5 where dominant_face_confidence < 0.25")


def p08(s, d):
    kind, claims = t.water_authority(F.col("land_class") == "water", F.col("inland_water_fraction"), F.col("hex_id") % 13 == 0, 0.5)
    return stand_in(s, d, "layers").select("hex_id", kind.alias("water_type"), F.array_join(claims, "|").alias("claims"), (F.size(claims) > 1).alias("conflict"))


register("p08_water_authority", p08, cte("layers") + ", f as (select hex_id, list_filter([case when land_class = 'water' then 'OCEAN' end, case when inland_water_fraction >= 0.5e0 then 'LAKE' end, case when hex_id % 13 = 0 then 'RIVER' end], lambda x: x is not null) as c from layers) select hex_id, coalesce(c[1], 'NONE') as water_type, array_to_string(c, '|') as claims, len(c) > 1 as conflict from f")
register("f37_raw_factors", lambda s, d: flagged(s, d).select("hex_id", t.raw_factors().alias("factors")))
