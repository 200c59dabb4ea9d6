"""Terrain faces and layers of hexes, as expressions over one row's statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.predicates import band, band_confidence, clip01, named_id, ramp
from hexloom.operators.rasters import CLIMATES

# Names in the order of their stable numbers.
FACES = "WATER PLAINS FOREST RAINFOREST TUNDRA DESERT WETLAND HILLS MOUNTAIN URBAN PERMANENT_SNOW_ICE".split()
WATER = "NONE OCEAN LAKE RIVER".split()
SURFACES = "NONE NORMAL TUNDRA DESERT WETLAND PERMANENT_SNOW_ICE".split()
RELIEFS = "NONE FLAT ROLLING HILLS MOUNTAIN".split()
VEGETATIONS = "NONE OPEN FOREST RAINFOREST".split()
DEVELOPMENTS = "NONE SETTLED URBAN DENSE_URBAN".split()
BIOMES = {"A": "tropical", "B": "arid", "C": "temperate", "D": "continental", "E": "polar"}

#: Thresholds of the layers.
LAYERS = {
    "lake_majority": 0.5, "snow_ice": 0.4, "icecap_snow": 0.2, "wetland": 0.35, "desert_bare": 0.5, "slopes": [2.5, 6.0, 15.0],
    "mountain_alt_slope": 11.0, "mountain_alt_relief": 900.0, "forest_tree": 0.4, "urban": [0.1, 0.35, 0.65], "urban_face_from": "DENSE_URBAN", "hills_dominant_slope": 8.0,
}
#: Inputs of scores and measures that are ramps (column, where it is 0, where it is 1).
RAMPS = {
    "damp_slope": ("slope_mean_deg", 8.0, 20.0), "hills_up": ("slope_mean_deg", 2.5, 7.0), "hills_down": ("slope_mean_deg", 12.0, 20.0),
    "mountain_slope": ("slope_mean_deg", 10.0, 22.0), "mountain_rough": ("terrain_roughness", 8.0, 25.0), "mountain_relief": ("elevation_range_m", 500.0, 1200.0),
    "steep": ("slope_mean_deg", 2.0, 30.0), "steep_for_wheels": ("slope_mean_deg", 1.5, 15.0), "steep_for_tracks": ("slope_mean_deg", 2.0, 20.0), "steep_for_attack": ("slope_mean_deg", 3.0, 20.0),
    "rough": ("terrain_roughness", 5.0, 30.0),
}
#: Weights of the face scores by input; the empty name is a constant.
FACE_TERMS = {
    "plains": {"lc_grassland_fraction": 1.0, "lc_cropland_fraction": 1.0, "lc_shrub_fraction": 0.6, "lc_moss_lichen_fraction": 0.4},
    "forest": {"lc_tree_fraction": 1.0}, "rainforest": {"lc_tree_fraction": 1.25},
    "tundra": {"lc_moss_lichen_fraction": 1.2, "lc_grassland_fraction": 0.72, "lc_shrub_fraction": 0.48, "lc_bare_sparse_fraction": 0.36, "": 0.2},
    "desert": {"lc_bare_sparse_fraction": 1.1}, "wetland": {"lc_herbaceous_wetland_fraction": 2.0, "lc_mangroves_fraction": 2.0},
    "hills": {"hills_up": 0.9}, "mountain": {"mountain_slope": 1.15 / 1.8, "mountain_rough": 0.46 / 1.8, "mountain_relief": 0.46 / 1.8},
    "urban": {"lc_built_up_fraction": 2.2}, "permanent_snow_ice": {"lc_snow_ice_fraction": 2.0, "is_ice_cap_climate": 0.4},
}
#: What a score is multiplied by: 1 less an input times a weight, or a flag's factor where it holds and where it does not.
FACE_FACTORS = {
    "plains": [("less", "damp_slope", 0.65), ("flag", "is_tundra_climate", 0.3, 1.0)], "forest": [("less", "damp_slope", 0.65)],
    "rainforest": [("less", "damp_slope", 0.65), ("flag", "is_tropical", 1.0, 0.0)], "tundra": [("less", "lc_tree_fraction", 1.0), ("flag", "is_tundra_climate", 1.0, 0.0)],
    "desert": [("flag", "is_arid", 1.0, 0.35)], "wetland": [("less", "damp_slope", 0.65)], "hills": [("less", "hills_down", 1.0)],
}
#: The constant and the weights of the measures of movement, each clipped to 0 to 1.
MOVEMENT = {
    "foot_mobility": {"": 1, "steep": -0.6, "wetland_fraction": -0.5, "permanent_snow_ice_fraction": -0.3},
    "wheeled_mobility": {"": 1, "steep_for_wheels": -1, "wetland_fraction": -0.8, "tree_fraction": -0.3, "permanent_snow_ice_fraction": -0.4},
    "tracked_mobility": {"": 1, "steep_for_tracks": -0.8, "wetland_fraction": -0.7, "tree_fraction": -0.2, "permanent_snow_ice_fraction": -0.3},
    "concealment": {"tree_fraction": 0.75, "urban_fraction": 0.6, "rough": 0.15},
    "defensive_value": {"steep_for_attack": 0.4, "rough": 0.3, "urban_fraction": 0.35, "tree_fraction": 0.2},
    "logistics_passability": {"": 1, "steep": -0.7, "wetland_fraction": -0.7, "permanent_snow_ice_fraction": -0.5},
    "construction_suitability": {"": 1, "steep": -0.8, "wetland_fraction": -0.9, "permanent_snow_ice_fraction": -0.8},
    "deployment_capacity": {"": 1, "steep": -0.7, "wetland_fraction": -0.8, "tree_fraction": -0.4},
}


def weighted(terms: dict[str, float]) -> Column:
    """The sum of inputs times their weights. An input is a ramp by its name, a flag or a column; the empty name is a constant."""
    def value(name: str) -> Column:
        if name in RAMPS:
            column, low, high = RAMPS[name]
            return ramp(F.col(column), low, high)
        return F.lit(1.0) if not name else F.col(name).cast("double")

    return reduce(lambda a, b: a + b, [value(name) * float(weight) for name, weight in terms.items()])


def climate_flags(code: Column) -> dict[str, Column]:
    """Zone, biome and flags of a climate number (1 to 30; anything else is unknown)."""
    zone = F.coalesce(F.try_element_at(F.array(*map(F.lit, CLIMATES)), F.when(code.between(1, 30), code).cast("int")), F.lit("unknown"))
    letter = F.when(zone != "unknown", F.substring(zone, 1, 1)).otherwise("?")
    biome = reduce(lambda w, kv: w.when(letter == kv[0], kv[1]), BIOMES.items(), F.when(letter == "?", "unknown"))
    return {
        "climate_zone": zone, "biome_class": biome, "is_tropical": letter == "A", "is_arid": letter == "B", "is_cold": letter.isin("D", "E"),
        "is_tundra_climate": zone == "ET", "is_ice_cap_climate": zone == "EF",
    }


def face_scores(terms: dict = FACE_TERMS, factors: dict = FACE_FACTORS) -> dict[str, Column]:
    """The score of each face in ``terms`` from slope_mean_deg, terrain_roughness, elevation_range_m, lc_*_fraction and the climate flags."""
    def factor(kind: str, name: str, *numbers: float) -> Column:
        if kind == "less":
            return 1 - weighted({name: numbers[0]})
        return F.when(F.col(name), numbers[0]).otherwise(numbers[1])

    return {f"{face}_score": reduce(lambda a, b: a * b, [factor(*x) for x in factors.get(face, [])], weighted(of)) for face, of in terms.items()}


def face_of_scores(names: list[str], is_water: Column) -> dict[str, Column]:
    """Winner, runner-up and confidence (their difference over the winner) of score columns; water is WATER; ties go to the earlier score."""
    each = [F.struct((-F.col(n)).alias("s"), F.lit(k).alias("k"), F.lit(n.removesuffix("_score").upper()).alias("face")) for k, n in enumerate(names)]
    order = F.array_sort(F.array(*each))
    one, two = order[0], order[1]
    pick = lambda water, land: F.when(is_water, water).otherwise(land)
    face = pick(F.lit("WATER"), one["face"])
    return {
        "terrain_face": face, "terrain_face_id": named_id(face, FACES), "terrain_face_score": pick(F.lit(1.0), -one["s"]),
        "terrain_face_second": pick(F.lit("WATER"), two["face"]), "terrain_face_second_score": pick(F.lit(0.0), -two["s"]),
        "terrain_face_confidence": pick(F.lit(1.0), F.when(-one["s"] > 0, (two["s"] - one["s"]) / -one["s"]).otherwise(0.0)),
    }


def movement(measures: dict = MOVEMENT) -> dict[str, Column]:
    """Measures of mobility, sight and logistics, 0 to 1; what is not concealed is visible."""
    out = {name: clip01(weighted(terms)) for name, terms in measures.items()}
    return out | {"visibility": clip01(1 - out["concealment"])}


def first_class(prefix: str, names: list[str], rules: list[tuple[str, Column, Column]]) -> dict[str, Column]:
    """The class, its number and its confidence by the first rule (class, test, margin) whose test holds."""
    pick = lambda k: F.coalesce(*[F.when(r[1], F.lit(r[0]) if k == 0 else r[2]) for r in rules])
    return {prefix: pick(0), f"{prefix}_id": named_id(pick(0), names), f"{prefix.split('_')[0]}_confidence": clip01(pick(1))}


def water_layer(t: dict = LAYERS) -> dict[str, Column]:
    """OCEAN by land class; LAKE where the inland water left after the sea's share is the majority; confidence by the margin."""
    inland, least = clip01(F.col("inland_water_fraction") + F.col("land_fraction") - 1), t["lake_majority"]
    margin = F.abs(inland / least - 1)
    rules = [("OCEAN", F.col("land_class") == "water", F.lit(1.0)), ("LAKE", inland >= least, margin), ("NONE", F.lit(True), margin)]
    return first_class("water_type", WATER, rules) | {"inland_water_est": inland}


def surface_layer(t: dict = LAYERS) -> dict[str, Column]:
    """Snow and ice before wetland before desert (in an arid climate alone) before tundra before the ordinary surface."""
    over = {n: F.col(c) / t[limit] for n, c, limit in (("ice", "permanent_snow_ice_fraction", "snow_ice"), ("wet", "wetland_fraction", "wetland"), ("bare", "bare_ground_fraction", "desert_bare"))}
    at_least = lambda c, limit: F.col(c) >= t[limit]
    arid = F.when(F.col("is_arid"), over["bare"]).otherwise(0.0)
    rules = [
        ("PERMANENT_SNOW_ICE", at_least("permanent_snow_ice_fraction", "snow_ice") | (F.col("is_ice_cap_climate") & at_least("permanent_snow_ice_fraction", "icecap_snow")), over["ice"] - 1),
        ("WETLAND", at_least("wetland_fraction", "wetland"), over["wet"] - 1),
        ("DESERT", F.col("is_arid") & at_least("bare_ground_fraction", "desert_bare"), arid - 1),
        ("TUNDRA", F.col("is_tundra_climate"), 1 - F.greatest(over["ice"], over["wet"])),
        ("NORMAL", F.lit(True), 1 - F.greatest(over["ice"], over["wet"], arid)),
    ]
    return first_class("surface_class", SURFACES, rules)


def relief_layer(t: dict = LAYERS) -> dict[str, Column]:
    """By mean slope; a moderately steep hex with much local relief is a mountain too, with a confidence of a half at least."""
    slope, bands = F.col("slope_mean_deg"), t["slopes"]
    high = (slope >= t["mountain_alt_slope"]) & (F.col("elevation_range_m") >= t["mountain_alt_relief"])
    last = len(bands)
    rules = [(RELIEFS[last + 1], high, F.greatest(band_confidence(slope, bands, F.lit(last)), F.lit(0.5)))]
    rules += [(RELIEFS[k + 1], band(slope, bands) == k, band_confidence(slope, bands, F.lit(k))) for k in range(last + 1)]
    return first_class("relief_class", RELIEFS, rules)


def vegetation_layer(t: dict = LAYERS) -> dict[str, Column]:
    """Forest by tree cover, rainforest in a tropical climate; the density stays beside the class."""
    tree = F.col("tree_fraction")
    name = F.when(tree >= t["forest_tree"], F.when(F.col("is_tropical"), "RAINFOREST").otherwise("FOREST")).otherwise("OPEN")
    return {"vegetation_class": name, "vegetation_class_id": named_id(name, VEGETATIONS), "vegetation_density": tree, "vegetation_confidence": clip01(F.abs(tree - t["forest_tree"]) / t["forest_tree"])}


def development_layer(t: dict = LAYERS) -> dict[str, Column]:
    """By the built-up fraction."""
    number = band(F.col("urban_fraction"), t["urban"])
    name = F.element_at(F.array(*map(F.lit, DEVELOPMENTS)), (number + 1).cast("int"))
    return {"development_class": name, "development_class_id": named_id(name, DEVELOPMENTS), "development_confidence": band_confidence(F.col("urban_fraction"), t["urban"], number)}


def shown_face(with_development: bool, t: dict = LAYERS) -> tuple[Column, Column]:
    """The face that stands for a hex and its confidence: the first of a chain of tests that holds."""
    relief, surface, veg = F.col("relief_class"), F.col("surface_class"), F.col("vegetation_class")
    tests = [(F.col("water_type") != "NONE", F.lit("WATER"), "water"), (surface == "PERMANENT_SNOW_ICE", F.lit("PERMANENT_SNOW_ICE"), "surface")]
    if with_development:
        tests.append((F.col("development_class_id") >= DEVELOPMENTS.index(t["urban_face_from"]), F.lit("URBAN"), "development"))
    tests += [
        (relief == "MOUNTAIN", F.lit("MOUNTAIN"), "relief"),
        ((relief == "HILLS") & (F.col("slope_mean_deg") >= t["hills_dominant_slope"]), F.lit("HILLS"), "relief"),
        (surface.isin("DESERT", "TUNDRA", "WETLAND"), surface, "surface"),
        (veg.isin("FOREST", "RAINFOREST"), veg, "vegetation"),
        (relief == "HILLS", F.lit("HILLS"), "relief"),
        (F.lit(True), F.lit("PLAINS"), "surface"),
    ]
    face = reduce(lambda w, x: w.when(x[0], x[1]), tests[1:], F.when(tests[0][0], tests[0][1]))
    sure = reduce(lambda w, x: w.when(x[0], F.col(f"{x[2]}_confidence")), tests[1:], F.when(tests[0][0], F.col(f"{tests[0][2]}_confidence")))
    return face, clip01(sure)


def layered(hexes: DataFrame, water_type: Column | None = None, t: dict = LAYERS) -> DataFrame:
    """All layers and the natural and dominant face. ``water_type`` replaces the estimated water; a water hex has no other layers but development."""
    if water_type is None:
        out = hexes.withColumns(water_layer(t))
    else:
        out = hexes.withColumns({"water_type": water_type, "water_type_id": named_id(water_type, WATER), "water_confidence": F.lit(1.0)})
    out = out.withColumns(surface_layer(t) | relief_layer(t) | vegetation_layer(t) | development_layer(t))
    wet = F.col("water_type") != "NONE"
    for name in ("surface_class", "relief_class", "vegetation_class"):
        out = out.withColumns({f"{name}_id": F.when(wet, 0).otherwise(F.col(f"{name}_id")), name: F.when(wet, "NONE").otherwise(F.col(name))})
    natural, _ = shown_face(False, t)
    dominant, sure = shown_face(True, t)
    out = out.withColumns({"natural_terrain_face": natural, "dominant_terrain_face": dominant, "dominant_face_confidence": sure})
    return out.withColumns({"natural_terrain_face_id": named_id(F.col("natural_terrain_face"), FACES), "dominant_terrain_face_id": named_id(F.col("dominant_terrain_face"), FACES)})


def water_authority(ocean: Column, lake_fraction: Column, river: Column, lake_threshold: float) -> tuple[Column, Column]:
    """The water type of a hex that several sources claim (OCEAN before LAKE before RIVER), and all claims."""
    claims = F.filter(
        F.array(F.when(ocean, "OCEAN"), F.when(F.coalesce(lake_fraction >= lake_threshold, F.lit(False)), "LAKE"), F.when(river, "RIVER")), lambda c: c.isNotNull()
    )
    return F.when(F.size(claims) > 0, claims[0]).otherwise("NONE"), claims


def layer_counts(hexes: DataFrame, layers: list[str]) -> DataFrame:
    """Layer, value, number of hexes and percentage of all."""
    long = hexes.select(F.explode(F.array(*[F.struct(F.lit(n).alias("layer"), F.col(n).cast("string").alias("value")) for n in layers])).alias("x")).select("x.*")
    counts = long.groupBy("layer", "value").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("layer")))


def layer_combinations(hexes: DataFrame, layers: list[str]) -> DataFrame:
    """Combinations of layers on land, with their number and share."""
    land = hexes.where(F.col("water_type") == "NONE")
    total = land.agg(F.count("*").alias("total"))
    return land.groupBy(*layers).agg(F.count("*").alias("n")).join(F.broadcast(total), F.lit(True)).withColumn("share", F.col("n") / F.col("total")).drop("total")


def transition_cases(hexes: DataFrame, threshold: float, confidence: str = "dominant_face_confidence") -> DataFrame:
    """Hexes whose face is in doubt, the most doubtful first."""
    return hexes.where(F.col(confidence) < threshold).orderBy(confidence)


def raw_factors() -> Column:
    """The numbers behind a face as a text."""
    return F.format_string(
        "tree=%.2f open=%.2f urban=%.2f wet=%.2f bare=%.2f inwater=%.2f slope=%.1fdeg rough=%.1fm climate=%s", "tree_fraction", F.col("grassland_fraction") + F.col("cropland_fraction"),
        "urban_fraction", "wetland_fraction", "bare_ground_fraction", "inland_water_fraction", "slope_mean_deg", "terrain_roughness", "climate_zone",
    )
