"""Tables written between rounds of a job, in the folder that the whole cluster shares."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors and the driver see, from ``spark.checkpoint.dir``.

    A folder of our own is set only where the session names none and runs on this machine alone, as
    in a test; on a cluster there must be one.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return posixpath.join(shared_dir(spark).rstrip("/"), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back: lineage ends there and no executor holds it alone."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
