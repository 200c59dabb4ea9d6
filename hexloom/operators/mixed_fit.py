"""Fitting map sheets with their border graduations: strokes that give one coordinate alone beside control points that give both.

A stroke at the border of a plate says the longitude there, or the latitude, and nothing of the other. It is one equation in the system
of its own coordinate. Longitudes that are counted from the plate's own meridian have an unknown in common, the
meridian's offset, which is solved for with the rest. Longitudes and latitudes are two systems of normal equations for each sheet, made by
sums of products in one aggregation; only models that keep the two apart can be fitted so.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexloom.operators.georeference import MODELS, _terms

#: Models whose longitude and latitude have no unknown in common.
SEPARABLE = ("AFFINE", "POLYNOMIAL_2")
#: Part of the largest eigenvalue of the normal equations at which the smallest counts as none.
SINGULAR = 1e-12


def fit_mixed(points: DataFrame, graduations: DataFrame, model: str, by: str = "sheet") -> DataFrame:
    """For each sheet the model's parameters from control points (px, py, lon, lat) and graduations (px, py, axis, value, frame).

    ``axis`` is lon or lat; ``frame`` is PLATE for a longitude counted from the plate's meridian, anything else, null too, for Greenwich.
    Returns ``by``, model, n_gcp, n_lon, n_lat (graduations of each axis), status, params and shift (as ``georeference.fit``, so that ``applied``
    takes them), plate_offset_deg (plate longitude less Greenwich longitude; null without such graduations) and condition.

    status is FITTED, UNDERDETERMINED (fewer equations than unknowns in one of the systems) or NOT_FITTABLE (the equations don't determine the unknowns, as with
    all places on one line); then params are null. A sheet of graduations alone has a row too. Rows with a null in a place, a value or the sheet, or
    with another axis, are left out; repeated rows weigh as often as they are there. A model that ties the coordinates together is an error.
    """
    if model not in SEPARABLE:
        raise ValueError(f"{model} ties longitude and latitude together; a graduation gives one of them alone")
    k = MODELS[model]
    place = [F.col("px").cast("double").alias("px"), F.col("py").cast("double").alias("py")]
    one = lambda axis, value, plate, mark: F.struct(F.lit(axis).alias("axis"), value.cast("double").alias("value"), plate.alias("plate"), F.lit(mark).alias("gcp"))
    both = F.explode(F.array(one("lon", F.col("lon"), F.lit(0.0), True), one("lat", F.col("lat"), F.lit(0.0), True)))
    known = points.select(F.col(by).alias("sheet"), *place, F.col("lon"), F.col("lat")).dropna(subset=["px", "py", "lon", "lat"]).select("sheet", "px", "py", both.alias("e")).select("sheet", "px", "py", "e.*")
    plate = F.when((F.col("frame") == "PLATE") & (F.col("axis") == "lon"), 1.0).otherwise(0.0)
    strokes = graduations.where(F.col("axis").isin("lon", "lat")).select(F.col(by).alias("sheet"), *place, "axis", F.col("value").cast("double").alias("value"), plate.alias("plate"), F.lit(False).alias("gcp")).dropna(subset=["px", "py", "value"])
    rows = known.unionByName(strokes)

    # Centred and scaled places keep the sums well conditioned; values are taken from the mean of those of their own kind.
    spread = lambda c: F.greatest(F.coalesce(F.stddev_pop(c), F.lit(0.0)), F.lit(1e-9))
    mean = lambda axis: F.coalesce(F.avg(F.when(F.col("gcp") & (F.col("axis") == axis), F.col("value"))), F.avg(F.when(F.col("axis") == axis, F.col("value"))), F.lit(0.0))
    scale = rows.groupBy("sheet").agg(F.avg("px").alias("mx"), F.avg("py").alias("my"), spread("px").alias("sx"), spread("py").alias("sy"), mean("lon").alias("ml"), mean("lat").alias("ma"))
    each = rows.join(scale, "sheet")
    each = each.withColumns({"u": (F.col("px") - F.col("mx")) / F.col("sx"), "v": (F.col("py") - F.col("my")) / F.col("sy"), "t": F.col("value") - F.when(F.col("axis") == "lon", F.col("ml")).otherwise(F.col("ma"))})
    terms = [*_terms(model), F.col("plate")]
    gram = [F.sum(terms[i] * terms[j]).alias(f"g{i}_{j}") for i in range(k + 1) for j in range(i, k + 1)]
    sides = [F.sum(terms[i] * F.col("t")).alias(f"b{i}") for i in range(k + 1)]
    sums = each.groupBy("sheet", "axis", "mx", "my", "sx", "sy", "ml", "ma").agg(F.count("*").alias("n"), F.count_if("gcp").alias("n_gcp"), *gram, *sides)

    def solve(r: dict | None) -> tuple[str, list | None, float | None, float | None]:
        """Status, parameters, offset and condition of one system."""
        if r is None:
            return "UNDERDETERMINED", None, None, None
        g = np.zeros((k + 1, k + 1))
        for i in range(k + 1):
            for j in range(i, k + 1):
                g[i, j] = g[j, i] = r[f"g{i}_{j}"]
        b = np.array([r[f"b{i}"] for i in range(k + 1)])
        size = k + 1 if g[k, k] > 0 else k
        if r["n"] < size:
            return "UNDERDETERMINED", None, None, None
        g, b = g[:size, :size], b[:size]
        weight = 1 / np.sqrt(np.maximum(np.diag(g), 1e-300))  # columns of one length
        g, b = g * np.outer(weight, weight), b * weight
        values = np.linalg.eigvalsh(g)
        if values[0] <= SINGULAR * values[-1]:
            return "NOT_FITTABLE", None, None, None
        p = np.linalg.solve(g, b)
        p = (p + np.linalg.solve(g, b - g @ p)) * weight
        return "FITTED", p[:k].tolist(), float(p[k]) if size > k else None, float(np.sqrt(values[-1] / values[0]))

    def solve_all(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for sheet, g in pdf.groupby("sheet", sort=False):
            system = {r["axis"]: r for r in g.to_dict("records")}
            any_ = next(iter(system.values()))
            lon, lat = solve(system.get("lon")), solve(system.get("lat"))
            status = next((s for s in ("UNDERDETERMINED", "NOT_FITTABLE") if s in (lon[0], lat[0])), "FITTED")
            fine = status == "FITTED"
            count = lambda a: int(system[a]["n"] - system[a]["n_gcp"]) if a in system else 0  # noqa: B023, E731
            gcp = max(int(r["n_gcp"]) for r in system.values())
            shift = [float(any_[c]) for c in ("mx", "my", "sx", "sy", "ml", "ma")]
            out.append((sheet, model, gcp, count("lon"), count("lat"), status, lon[1] + lat[1] if fine else None, shift, lon[2] if fine else None, max(lon[3], lat[3]) if fine else None))
        return pd.DataFrame(out, columns=["sheet", "model", "n_gcp", "n_lon", "n_lat", "status", "params", "shift", "plate_offset_deg", "condition"])

    kind = rows.schema["sheet"].dataType.simpleString()
    schema = f"sheet {kind}, model string, n_gcp bigint, n_lon bigint, n_lat bigint, status string, params array<double>, shift array<double>, plate_offset_deg double, condition double"
    solved = sums.withColumn("part", F.pmod(F.xxhash64("sheet"), F.lit(64))).groupBy("part").applyInPandas(lambda pdf: solve_all(pdf), schema)
    return solved.withColumnRenamed("sheet", by)
