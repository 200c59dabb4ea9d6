"""What the corpus operators share: the shared folder, written tables, vector-friendly batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import fresh_dir, written  # noqa: F401

#: Bytes of a record batch that Spark hands to Python; keeps very long texts from filling a worker.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the record batches of this session's Python operators by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def row_keys(key: str, text: str) -> list[Column]:
    """Two hashes of a row's key and text; equal rows, and those alone, have both in common."""
    parts = [F.col(key).isNull(), F.col(key), F.col(text).isNull(), F.col(text)]
    return [F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts[::-1])]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table by its name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
