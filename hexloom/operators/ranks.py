"""Ranks and exact percentiles over range partitions: no group, however large, is sorted by one task."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexloom.tables import written


#: Rows that a task of ``percentiles`` counts and sorts.
BLOCK_ROWS = 500_000


def ranked(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """Rows with their place (from 1) in one order of the whole table. Each task counts its range; what lies before a range is a table of one row per range."""
    blocks = written(df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("_block").agg(F.count("*").alias("_n")).select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_block").orderBy(*order))
    return blocks.join(F.broadcast(sizes), "_block").withColumn(name, (place + F.col("_before")).cast("int")).drop("_block", "_before")


def percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """For each group exact percentiles of ``value``, linear between two ranks, one column for each name in ``shares``.

    Values are dealt over as many tasks as there are ``BLOCK_ROWS`` of them, so what one task holds does not grow with the table. Equal values become
    one row with their number, these are dealt by ranges of group and value, and only ranges that hold a wanted rank are looked at row by row.
    Null values count for nothing; a group of nulls alone has no row, a null group is one. Without ``by`` the table is one group.
    """
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("one"))
    given = written(df.where(F.col(value).isNotNull()).select(key.alias("g"), F.col(value).cast("double").alias("v")), "percentiles-values")
    tasks = max(1, math.ceil(given.count() / BLOCK_ROWS))
    counts = given.repartition(tasks, "g", "v").groupBy("g", "v").agg(F.count("*").alias("n"))
    blocks = written(counts.repartitionByRange(tasks, "g", "v").withColumn("block", F.spark_partition_id()), "percentiles")
    whole, before = Window.partitionBy("g"), Window.partitionBy("g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # A group has no more rows here than there are ranges.
    sums = blocks.groupBy("g", "block").agg(F.sum("n").alias("m")).withColumns({"total": F.sum("m").over(whole), "first": F.coalesce(F.sum("m").over(before), F.lit(0))})
    at = lambda p: (F.col("total") - 1) * F.lit(float(p))
    ranks = [(n, at(p), i, F.ceil(at(p)) if i else F.floor(at(p))) for n, p in shares.items() for i in (0, 1)]
    within = lambda low, high: [(rank >= low) & (rank < high) for *_, rank in ranks]
    some = lambda conditions: functools.reduce(operator.or_, conditions, F.lit(False))
    here = sums.where(some(within(F.col("first"), F.col("first") + F.col("m")))).select("g", "block", "first", "total")
    # Rows that are sorted carry two numbers of their range; what is wanted follows from them, for the few rows that hold a rank.
    to = F.col("first") + F.sum("n").over(Window.partitionBy("g", "block").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    rows = blocks.join(here, ["g", "block"]).withColumn("to", to)
    held = within(F.col("to") - F.col("n"), F.col("to"))
    wanted = F.array_compact(F.array(*[F.when(h, F.struct(F.lit(n).alias("name"), at_.alias("at"), F.lit(i).alias("upper"))) for h, (n, at_, i, _) in zip(held, ranks)]))
    met = rows.where(some(held)).select("g", "v", F.explode(wanted).alias("w"))
    part = F.col("w.at") - F.floor("w.at")
    # Of a rank that is whole, the lower and the upper one are the same.
    share = F.when(F.col("w.upper") == 1, F.when(part == 0, 0.0).otherwise(part)).otherwise(1 - part)
    out = met.groupBy("g").agg(*[F.sum(F.when(F.col("w.name") == n, F.when(share == 0, 0.0).otherwise(F.col("v") * share))).alias(n) for n in shares])
    return out.select(*[F.col(f"g.{c}").alias(c) for c in by], *shares)


def with_percentiles(sums: DataFrame, df: DataFrame, by: str | list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """One row for each group (``sums``) with percentiles of its rows in ``df``; a null group meets a null group."""
    by = [by] if isinstance(by, str) else by
    names = {c: f"_group_{k}" for k, c in enumerate(by)}
    found = percentiles(df, by, value, shares).withColumnsRenamed(names)
    same = F.lit(True)
    for c, name in names.items():
        same = same & F.col(c).eqNullSafe(F.col(name))
    return sums.join(found, same, "left").drop(*names.values())
