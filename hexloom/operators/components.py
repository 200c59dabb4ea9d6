"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import written


def _large(edges: DataFrame, name: str) -> DataFrame:
    """Each node's larger neighbours are tied to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), name)
    return both.where("v > u").join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame, name: str) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them. In ``edges`` v is below u."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")), name)
    tied = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """For every node of ``edges`` (columns u and v, any ordered type) the smallest node of its component, as u and v.

    Only nodes that have an edge to another node and are not the smallest of their component are
    returned. Edges from a node to itself and repeated edges change nothing. Each
    round is written to the shared folder; rounds grow with the logarithm of a component's size.
    The smallest neighbours are written before they are joined, so that the join stands on two
    shuffles of its own and the edges of one node, however many, can be split over tasks.
    """
    at = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    at, before = written(at, name), None
    while True:
        now = at.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or now[0] == 0:
            return at
        at, before = written(_small(written(_large(at, f"{name}-least"), f"{name}-large"), f"{name}-least"), name), now
