"""Scans and sinks: fixed schemas, partitioned caches, manifests and resumable chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The columns of a gazetteer file, in order.
GAZETTEER = (
    "geonameid bigint, name string, asciiname string, alternatenames string, latitude double, longitude double, feature_class string, feature_code string, country_code string, cc2 string, "
    "admin1 string, admin2 string, admin3 string, admin4 string, population bigint, elevation int, dem int, timezone string, modified string"
)


def read_gazetteer(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Places of a tab-separated gazetteer without quoting inside a box (west, south, east, north): id, name, population, lon, lat. Words like NA stay text."""
    raw = spark.read.schema(GAZETTEER).options(sep="\t", quote="", nullValue="\0").csv(path)
    inside = F.col("longitude").between(box[0], box[2]) & F.col("latitude").between(box[1], box[3])
    return raw.where(inside).select(F.col("geonameid").alias("id"), "name", F.coalesce("population", F.lit(0)).alias("population"), F.col("longitude").alias("lon"), F.col("latitude").alias("lat"))


def cleaned_population(value: Column) -> Column:
    """A population as a whole number; what is no number counts as zero."""
    return F.coalesce(F.try_to_number(value.cast("string"), F.lit("999999999999")).cast("bigint"), value.try_cast("double").cast("bigint"), F.lit(0))


def read_curated(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A curated CSV file with a fixed schema: a missing file or a bad row is an error, an empty cell is null, words like None stay text."""
    return spark.read.schema(schema).options(header=True, nullValue="", emptyValue="", mode="FAILFAST", enforceSchema=False).csv(path)


def by_id(registry: DataFrame, key: str, value: str) -> DataFrame:
    """The rows of one id of a registry; an unknown id is an error, there is no default."""
    found = registry.where(F.col(key) == value)
    if found.isEmpty():
        raise KeyError(f"{key} {value!r} is not in the registry")
    return found


def write_banded(rings: DataFrame, path: str, band_m: float) -> None:
    """Rings with their boxes, in a folder for each number of further bands they reach into and each band of northing, so that readers prune bands and row groups."""
    boxed = rings.withColumns({"minx": F.array_min("xs"), "miny": F.array_min("ys"), "maxx": F.array_max("xs"), "maxy": F.array_max("ys")})
    band = F.floor(F.col("miny") / band_m)
    banded = boxed.withColumns({"reach": F.floor(F.col("maxy") / band_m) - band, "band": band})
    banded.repartitionByRange("reach", "band", "minx").sortWithinPartitions("reach", "band", "minx").write.partitionBy("reach", "band").parquet(path)


def read_banded(spark: SparkSession, path: str, box: tuple[float, float, float, float], margin: float, band_m: float) -> DataFrame:
    """Rings whose box meets a box widened by a margin, without exact copies. Rings may reach over one band's end into the next ones."""
    x0, y0, x1, y1 = box[0] - margin, box[1] - margin, box[2] + margin, box[3] + margin
    rings = spark.read.parquet(path).where((F.col("band") <= int(y1 // band_m)) & (F.col("band") + F.col("reach") >= int(y0 // band_m)))
    hit = rings.where((F.col("minx") <= x1) & (F.col("maxx") >= x0) & (F.col("miny") <= y1) & (F.col("maxy") >= y0))
    return hit.drop("band", "reach").dropDuplicates(["xs", "ys"])


def split_expected(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Every expected key with whether it is present."""
    return expected.join(present.select(key, F.lit(True).alias("present")).distinct(), key, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def missing_chunks(expected: DataFrame, written: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Chunks that no earlier run has written."""
    return expected.join(written.select(key).distinct(), key, "left_anti")


def write_chunks(df: DataFrame, path: str, key: str = "chunk_id") -> None:
    """Write or replace whole chunks; others in the folder stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def chunk_manifest(df: DataFrame, key: str, counts: dict[str, Column]) -> DataFrame:
    """For each chunk its rows, conditional counts and a hash of its contents in no order."""
    from hexloom.functions.ids import frame_hash

    numbers = df.groupBy(key).agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return frame_hash(df, [key]).join(numbers, key)


def file_manifest(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """Files below a path with size and SHA-256; with ``known`` (path, size, modified, sha256) unchanged files keep their hash and are not read.

    The listing leaves contents alone; its new paths are named to the scan that reads them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    columns = ["path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")]
    digest = F.sha2("content", 256).alias("sha256")
    if known is None:
        return files.select(*columns, digest)
    listed = files.select(*columns)
    same = listed.join(known, ["path", "size", "modified"]).select("path", "size", "modified", "sha256")
    new = [r["path"] for r in listed.join(known, ["path", "size", "modified"], "left_anti").select("path").collect()]
    return same.unionByName(spark.read.format("binaryFile").load(new).select(*columns, digest)) if new else same


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files that were added, removed or changed between two manifests."""
    b, a = before.select("path", F.col("sha256").alias("before")), after.select("path", F.col("sha256").alias("after"))
    kind = F.when(F.col("before").isNull(), "ADDED").when(F.col("after").isNull(), "REMOVED").otherwise("CHANGED")
    return b.join(a, "path", "full").where(~F.col("before").eqNullSafe(F.col("after"))).select("path", kind.alias("change"))


def metrics_table(run_id: str, one_row: DataFrame) -> DataFrame:
    """A one-row table of aggregates as rows of run_id, metric and value (text)."""
    return one_row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value")) for c in one_row.columns])).alias("m")).select(F.lit(run_id).alias("run_id"), "m.*")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All floating-point columns rounded, for text outputs."""
    return df.select(*[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str, gzip: bool = False) -> None:
    """A table as CSV with a header and six digits after the point, gzipped if wanted."""
    rounded(df).write.options(header=True, compression="gzip" if gzip else "none", emptyValue="").csv(path)


def geojson_lines(df: DataFrame, geometry: Column) -> DataFrame:
    """Each row as one GeoJSON feature in a line; ``geometry`` is a struct of type and coordinates."""
    properties = F.struct(*[F.col(c) for c in df.columns])
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")), {"ignoreNullFields": "false"}).alias("value"))


def line_geometry(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """A straight line between two places as a GeoJSON geometry."""
    at = lambda lon, lat: F.array(F.round(lon, 7), F.round(lat, 7))
    return F.struct(F.lit("LineString").alias("type"), F.array(at(lon1, lat1), at(lon2, lat2)).alias("coordinates"))


def point_geometry(lon: Column, lat: Column) -> Column:
    """A place as a GeoJSON geometry."""
    return F.struct(F.lit("Point").alias("type"), F.array(F.round(lon, 7), F.round(lat, 7)).alias("coordinates"))


def canonical_reference(tables: dict[str, DataFrame]) -> DataFrame:
    """For each table its name, rows and content hash: what points at it instead of a copy."""
    from hexloom.functions.ids import frame_hash

    out = None
    for name, df in tables.items():
        part = frame_hash(df).select(F.lit(name).alias("table"), "rows", "content_sha256")
        out = part if out is None else out.unionByName(part)
    return out


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """The canonical order of an output, kept across its files: a range shuffle and a sort in each part."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def typed(schema: str) -> StructType:
    return StructType.fromDDL(schema)
