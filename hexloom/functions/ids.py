"""Ids that depend on stable keys alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed_id(prefix: str, *parts: Column, length: int = 12) -> Column:
    """``prefix`` and the first digits of the SHA-1 of the parts, joined by bars; null parts are empty."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha1(text), 1, length))


def relationship_id(prefix: str, scenario: Column, kind: Column, a: Column, b: Column, symmetric: Column) -> Column:
    """The id of a relation; of a symmetric one the ends' order makes no difference."""
    first = F.when(symmetric, F.least(a, b)).otherwise(a)
    second = F.when(symmetric, F.greatest(a, b)).otherwise(b)
    return hashed_id(prefix, scenario, kind, first, second)


def joined_ids(values: Column) -> Column:
    """Sorted distinct values joined by bars; an aggregate."""
    return F.array_join(F.array_sort(F.collect_set(values)), "|")


def frame_hash(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row (for each value of ``by``) with the number of rows and a hash of their contents in no order.

    Row digests are added up in parts of 32 bits, so that no row list is gathered anywhere.
    """
    by = by or []
    rest = [c for c in df.columns if c not in by]
    digest = F.sha2(F.to_json(F.struct(*[F.col(c) for c in sorted(rest)]), {"ignoreNullFields": "false"}), 256)
    parts = [F.sum(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("decimal(38,0)")).cast("string").alias(f"p{k}") for k in range(8)]
    out = df.groupBy(*by).agg(F.count("*").alias("rows"), *parts)
    return out.select(*by, "rows", F.sha2(F.concat_ws("|", F.col("rows").cast("string"), *[f"p{k}" for k in range(8)]), 256).alias("content_sha256"))


def colour(key: Column) -> Column:
    """A stable colour: the hue from the first four bytes of the key's SHA-1, saturation 0.55, value 0.85."""
    hue = F.conv(F.substring(F.sha1(key.cast("string")), 1, 8), 16, 10).cast("double") / 4294967296.0 * 6
    part = F.floor(hue)
    f, v, s = hue - part, 0.85, 0.55
    p, q, t = F.lit(v * (1 - s)), v * (1 - s * f), v * (1 - s * (1 - f))
    v = F.lit(v)
    pick = lambda *six: F.element_at(F.array(*six), (part + 1).cast("int"))
    byte = lambda c: F.lpad(F.lower(F.hex(F.floor(c * 255).cast("bigint"))), 2, "0")
    return F.concat(F.lit("#"), byte(pick(v, q, p, p, t, v)), byte(pick(t, v, v, q, p, p)), byte(pick(p, p, t, v, v, q)))
