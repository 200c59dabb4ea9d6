"""Fitting map sheets to the ground: every sheet and model at once, by sums of products and one small solve for each."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.functions.geodesy import geodesic
from hexloom.operators.ranks import with_percentiles

#: Models from the simplest to the most complex, and their numbers of unknowns.
MODELS = {"AFFINE": 3, "PROJECTIVE": 8, "POLYNOMIAL_2": 6}
#: Longitudes of prime meridians east of Greenwich.
MERIDIANS = {"GREENWICH": 0.0, "PARIS": 2.337229, "FERRO": -17.666667}


def to_greenwich(lon: Column, meridian: Column, table: dict[str, float] = MERIDIANS) -> Column:
    """A longitude read off a map, counted from Greenwich; an unknown meridian is an error."""
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    offset = F.try_element_at(known, meridian)
    return lon + F.coalesce(offset, F.raise_error(F.concat(F.lit("unknown prime meridian "), meridian)).cast("double"))


def intersection(p1, p2, p3, p4) -> tuple[Column, Column]:
    """Where the lines p1 p2 and p3 p4 (pairs of columns) meet; nulls for parallel lines."""
    (x1, y1), (x2, y2), (x3, y3), (x4, y4) = p1, p2, p3, p4
    d = (x1 - x2) * (y3 - y4) - (y1 - y2) * (x3 - x4)
    d = F.when(F.abs(d) >= 1e-12, d)
    a, b = x1 * y2 - y1 * x2, x3 * y4 - y3 * x4
    return (a * (x3 - x4) - (x1 - x2) * b) / d, (a * (y3 - y4) - (y1 - y2) * b) / d


def _terms(model: str) -> list[Column]:
    x, y, one = F.col("u"), F.col("v"), F.lit(1.0)
    return {"AFFINE": [one, x, y], "POLYNOMIAL_2": [one, x, y, x * x, x * y, y * y]}[model]


def fit(points: DataFrame, model: str, by: str = "sheet") -> DataFrame:
    """For each sheet the model's parameters from its control points (px, py, lon, lat): params, n, status and the design's condition.

    Pixels and degrees are first centred and scaled for each sheet, so that the sums of products stay well conditioned; the
    scale is part of the parameters. Too few points are a status, not an error.
    """
    scale = points.groupBy(by).agg(F.avg("px").alias("mx"), F.avg("py").alias("my"), F.greatest(F.coalesce(F.stddev_pop("px"), F.lit(0.0)), F.lit(1e-9)).alias("sx"), F.greatest(F.coalesce(F.stddev_pop("py"), F.lit(0.0)), F.lit(1e-9)).alias("sy"), F.avg("lon").alias("ml"), F.avg("lat").alias("ma"))
    each = points.join(scale, by).withColumns({"u": (F.col("px") - F.col("mx")) / F.col("sx"), "v": (F.col("py") - F.col("my")) / F.col("sy"), "l": F.col("lon") - F.col("ml"), "a": F.col("lat") - F.col("ma")})
    if model == "PROJECTIVE":
        u, v, l, a, o, z = (F.col("u"), F.col("v"), F.col("l"), F.col("a"), F.lit(1.0), F.lit(0.0))
        rows = F.array(F.struct(F.array(u, v, o, z, z, z, -u * l, -v * l).alias("d"), l.alias("t")), F.struct(F.array(z, z, z, u, v, o, -u * a, -v * a).alias("d"), a.alias("t")))
        wide = each.select(by, "mx", "my", "sx", "sy", "ml", "ma", F.explode(rows).alias("r"))
        terms, targets, least = [F.col("r.d")[k] for k in range(8)], [F.col("r.t")], 8
    else:
        wide, terms, targets, least = each, _terms(model), [F.col("l"), F.col("a")], MODELS[model]
    k, sides_n = len(terms), len(targets)
    gram = [F.sum(terms[i] * terms[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
    sides = [F.sum(terms[i] * t).alias(f"b{i}_{n}") for i in range(k) for n, t in enumerate(targets)]
    sums = wide.groupBy(by, "mx", "my", "sx", "sy", "ml", "ma").agg(F.count("*").alias("n"), *gram, *sides)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf.to_dict("records"):
            g = np.zeros((k, k))
            for i in range(k):
                for j in range(i, k):
                    g[i, j] = g[j, i] = r[f"g{i}_{j}"]
            b = np.array([[r[f"b{i}_{n}"] for n in range(sides_n)] for i in range(k)])
            values = np.linalg.eigvalsh(g)
            usable = r["n"] >= least and values[0] > 1e-12 * max(values[-1], 1e-300)
            params = np.linalg.solve(g, b).T.ravel().tolist() if usable else None
            shift = [float(r[c]) for c in ("mx", "my", "sx", "sy", "ml", "ma")]
            points_ = r["n"] // 2 if model == "PROJECTIVE" else r["n"]
            out.append((r[by], model, points_, "FITTED" if usable else "NOT_FITTABLE", params, shift, float(np.sqrt(values[-1] / values[0])) if values[0] > 0 else None))
        return pd.DataFrame(out, columns=[by, "model", "n_fit", "status", "params", "shift", "condition"])

    kind = points.schema[by].dataType.simpleString()
    schema = f"{by} {kind}, model string, n_fit bigint, status string, params array<double>, shift array<double>, condition double"
    return sums.withColumn("part", F.pmod(F.xxhash64(by), F.lit(64))).groupBy("part").applyInPandas(lambda pdf: solve(pdf.drop(columns="part")), schema)


def applied(points: DataFrame, fits: DataFrame, model: str, by: str = "sheet") -> DataFrame:
    """Points (px, py) with the fitted lon and lat (fit_lon, fit_lat); nulls where the sheet has no fit."""
    joined = points.join(fits.select(by, "params", "shift"), by, "left")
    s, p = F.col("shift"), F.col("params")
    joined = joined.withColumns({"u": (F.col("px") - s[0]) / s[2], "v": (F.col("py") - s[1]) / s[3]})
    if model == "PROJECTIVE":
        den = p[6] * F.col("u") + p[7] * F.col("v") + 1
        lon, lat = (p[0] * F.col("u") + p[1] * F.col("v") + p[2]) / den, (p[3] * F.col("u") + p[4] * F.col("v") + p[5]) / den
    else:
        terms = _terms(model)
        lon, lat = (sum((p[n * len(terms) + k] * t for k, t in enumerate(terms)), F.lit(0.0)) for n in (0, 1))
    return joined.withColumns({"fit_lon": lon + s[4], "fit_lat": lat + s[5]}).drop("params", "shift", "u", "v")


def residuals(points: DataFrame, fits: DataFrame, model: str, by: str = "sheet") -> DataFrame:
    """Points with their ground distance in metres to where the fit puts them."""
    return applied(points, fits, model, by).withColumn("residual_m", geodesic(F.col("lon"), F.col("lat"), F.col("fit_lon"), F.col("fit_lat")))


def statistics(df: DataFrame, by: list[str], value: str = "residual_m") -> DataFrame:
    """Number, root mean square, median, percentiles 75, 90 and 95 and most, for each group."""
    sums = df.groupBy(*by).agg(F.count(value).alias("n"), F.sqrt(F.avg(F.col(value) * F.col(value))).alias("rms"), F.max(value).alias("most"))
    return with_percentiles(sums, df, by, value, {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95}).select(*by, "n", "rms", "median", "p75", "p90", "p95", "most")


def compare_models(points: DataFrame, held_out: Column, by: str = "sheet", models: tuple[str, ...] = ("AFFINE", "PROJECTIVE", "POLYNOMIAL_2")) -> DataFrame:
    """For each sheet and model its status and the errors on the fit and the held-out points."""
    out = None
    for m in models:
        fits = fit(points.where(~held_out), m, by)
        errors = residuals(points.withColumn("held", held_out), fits, m, by)
        side = lambda h, name: F.sqrt(F.avg(F.when(F.col("held") == h, F.col("residual_m") * F.col("residual_m")))).alias(name)
        scored = errors.groupBy(by).agg(side(False, "fit_rms_m"), side(True, "holdout_rms_m"), F.count_if("held").alias("n_holdout"))
        part = fits.select(by, "model", "status", "n_fit").join(scored, by)
        out = part if out is None else out.unionByName(part)
    return out


def select_model(audit: DataFrame, by: str = "sheet", independent: str | None = None, limit_m: float = 50_000.0) -> DataFrame:
    """For each sheet the simplest model whose held-out error is within a tenth of the best; with ``independent``, models whose error there is above a limit don't count."""
    usable = audit.where((F.col("status") == "FITTED") & F.col("holdout_rms_m").isNotNull())
    if independent:
        usable = usable.where(F.col(independent) <= limit_m)
    near = usable.withColumn("best", F.min("holdout_rms_m").over(Window.partitionBy(by))).where(F.col("holdout_rms_m") <= 1.1 * F.col("best"))
    order = F.array_position(F.array(*map(F.lit, MODELS)), F.col("model"))
    return near.groupBy(by).agg(F.min_by("model", order).alias("model"))


def frozen_split(points: DataFrame, excluded: Column, zone: str = "zone", key: str = "id") -> DataFrame:
    """Each point's role by its place in the order of zone and key, five to a turn: three FIT, one selection holdout, one blind; excluded ones take no place.

    The order within a zone and the number of points in the zones before give the place, so no task sorts all points.
    """
    use = points.withColumn("out", excluded)
    sizes = use.where("not out").groupBy(zone).agg(F.count("*").alias("n"))
    before = Window.orderBy(zone).rowsBetween(Window.unboundedPreceding, -1)  # a row for each zone
    first = sizes.select(zone, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = use.where("not out").withColumn("k", F.row_number().over(Window.partitionBy(zone).orderBy(key)) - 1).join(first, zone)
    slot = (F.col("first") + F.col("k")) % 5
    role = F.when(slot == 3, "MODEL_SELECTION_HOLDOUT").when(slot == 4, "BLIND_VALIDATION").otherwise("FIT")
    return placed.select(*points.columns, role.alias("role")).unionByName(use.where("out").select(*points.columns, F.lit("EXCLUDED").alias("role")))


def jacobian(fits: DataFrame, model: str, field: tuple[float, float, float, float], n: int, by: str = "sheet") -> DataFrame:
    """For each sheet the least and most ground metres of a pixel in x and y over a field of n by n places, and whether the map folds."""
    x0, y0, x1, y1 = field
    at = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = fits.where("status = 'FITTED'").select(by).withColumn("i", at).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    places = grid.withColumns({"px0": x0 + F.col("i") * ((x1 - x0) / (n - 1)), "py0": y0 + F.col("j") * ((y1 - y0) / (n - 1))})
    moved = places.select(by, "i", "j", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), (F.col("px0") + dx).alias("px"), (F.col("py0") + dy).alias("py")) for k, dx, dy in ((0, 0.0, 0.0), (1, 1.0, 0.0), (2, 0.0, 1.0))])).alias("m")).select(by, "i", "j", "m.*")
    here = applied(moved, fits, model, by).groupBy(by, "i", "j").agg(*[F.max(F.when(F.col("k") == k, F.col(f"fit_{c}"))).alias(f"{c}{k}") for k in range(3) for c in ("lon", "lat")])
    g = lambda k: geodesic(F.col("lon0"), F.col("lat0"), F.col(f"lon{k}"), F.col(f"lat{k}"))
    det = (F.col("lon1") - F.col("lon0")) * (F.col("lat2") - F.col("lat0")) - (F.col("lon2") - F.col("lon0")) * (F.col("lat1") - F.col("lat0"))
    each = here.withColumns({"dx": g(1), "dy": g(2), "sign": F.when(det != 0, F.signum(det))})
    return each.groupBy(by).agg(F.min("dx").alias("x_min"), F.max("dx").alias("x_max"), F.min("dy").alias("y_min"), F.max("dy").alias("y_max"), (F.countDistinct("sign") > 1).alias("folding"))


def uncertainty(*terms: Column) -> Column:
    """Root of the sum of squares; missing terms count for nothing."""
    return F.sqrt(sum((F.coalesce(t * t, F.lit(0.0)) for t in terms), F.lit(0.0)))


def meridian_scores(places: DataFrame, candidates: dict[str, float]) -> DataFrame:
    """For each prime meridian the median ground distance of map places (map_lon, lat) to the reference (ref_lon, lat), its rank and the margin to the next."""
    spark = places.sparkSession
    table = F.broadcast(spark.createDataFrame(list(candidates.items()), "meridian string, offset double"))
    d = geodesic(F.col("map_lon") + F.col("offset"), F.col("lat"), F.col("ref_lon"), F.col("ref_lat"))
    scored = with_percentiles(table, places.crossJoin(table).select("meridian", d.alias("d")), "meridian", "d", {"median_m": 0.5}).where("median_m is not null").select("meridian", "median_m")
    w = Window.orderBy("median_m", "meridian")  # a row for each candidate
    return scored.withColumns({"rank": F.row_number().over(w), "margin_m": F.lead("median_m").over(w) - F.col("median_m")})
