"""Sharding as vector bin packing of groups of equal texts.

A group has three sizes: bytes, tokens (words) and rows. Groups become parcels:
a large group is a parcel of its own, and one above a whole shard's share is cut
into pieces by a hash of the document and the number of the copy, so that one text that
fills a third of the corpus is spread over shards, even if all its rows have one key; all other groups are gathered
by the length of their text and a hash of it, so that there are parcels of many short texts and
parcels of few long ones to make up for what large groups leave uneven. The number of parcels is bounded by the number of
shards alone, so their table of sizes is small however many documents there are. Parcels go, largest first, to
the shard where the dot product of their sizes with the shard's residual
capacity is highest among those with room for them in all three sizes, and
the table of shards goes back to the documents by a broadcast join.

Slots are numbered within a shard by counts per (shard, run) and a running sum
over the runs, so that no task holds a whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parcels of small groups for each shard and class of lengths, and the classes: powers of two, from the first one on.
PARCELS_A_CLASS, CLASSES, FIRST_CLASS = 64, 8, 4
#: A group above such a part of a shard's share is a parcel of its own.
PARCELS_A_SHARD = PARCELS_A_CLASS * CLASSES
#: Pieces for each share that a group above a whole share is cut into.
PIECES_A_SHARD = 8
#: Rows that one run of slots has on average, and the least number of runs.
ROWS_A_RUN, LEAST_RUNS = 100_000, 16
#: Rows equal in key and text that one task numbers at once.
COPIES_A_TASK = 100_000
#: Part of a shard's share that a parcel may be larger than the room for it.
SLACK = 1 / 512


def pack(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each parcel. ``sizes`` has one row for each parcel and a column for each measure, the binding one first.

    Each measure is taken as a part of a shard's even share. Parcels go largest
    first to the shard with the highest dot product of the parcel with the
    residual capacities, among the shards that have room for it in each measure, or
    else in the first one, or else, of all, the one with most room in the first; ties go to the lower shard.
    """
    total = sizes.sum(axis=0)
    parts = sizes * shards / np.where(total > 0, total, 1)
    residual = np.ones((shards, sizes.shape[1]))
    out = np.zeros(len(sizes), np.int32)
    for k in np.argsort(-parts.max(axis=1), kind="stable"):
        fits = (residual >= parts[k] - SLACK).all(axis=1)
        if not fits.any():
            fits = residual[:, 0] >= parts[k, 0] - SLACK / 4
        if not fits.any():
            fits = residual[:, 0] >= residual[:, 0].max()
        out[k] = at = int(np.where(fits, residual @ parts[k], -np.inf).argmax())
        residual[at] -= parts[k]
    return out


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, checksum and place of every row of ``docs``.

    Returns ``key``, size (bytes of the text in UTF-8 plus 8), text_crc32
    (unsigned), law (``bytes``: the shards' sums of sizes are near equal), shard,
    slot (gapless from 0 in each shard, in the order of run, key and checksum) and
    grown_shard (null under this law).

    A null text counts as an empty one: size 8, checksum 0. Equal texts go to one
    shard unless together they exceed a shard's share, an even part of all bytes.
    Tokens and rows are balanced as far as bytes and whole groups allow. Repeated rows are all placed, and rows equal in key and
    text are cut like others where their group is, as are rows with a null key. An empty table gives no rows. Rows equal in key
    and text have interchangeable slots. Shards can't be near equal where single
    texts are large against a shard's share.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        _words(body).alias("tokens"),
        F.xxhash64(body, F.length(body)).alias("h1"),
        F.xxhash64(F.lit(7), F.md5(body.cast("binary"))).alias("h2"),
    )
    groups = rows.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    share = max(1, (total["bytes"] or 0) // shards)
    # By their sizes there are at most shards * PARCELS_A_SHARD large groups, whatever the input.
    pieces = F.when(F.col("bytes") > share, F.ceil(F.col("bytes") * PIECES_A_SHARD / share)).otherwise(1)
    large = groups.where(F.col("bytes") > share / PARCELS_A_SHARD).select("h1", "h2", pieces.alias("pieces"))
    length = F.least(F.lit(CLASSES - 1), F.greatest(F.lit(0), F.floor(F.log2("size")) - FIRST_CLASS))
    small = F.pmod("h1", F.lit(shards * PARCELS_A_CLASS)) * CLASSES + length
    marked = rows.join(F.broadcast(large), ["h1", "h2"], "left")
    # Rows of a large group that are equal in key and text are counted and made again with a number each.
    copies = marked.where("pieces is not null").groupBy("key", "h1", "h2").agg(*[F.first(c).alias(c) for c in ("size", "text_crc32", "tokens", "pieces")], F.count("*").alias("n"))
    many = F.col("n") > COPIES_A_TASK
    spread = copies.where(many).withColumn("begin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES_A_TASK).cast("long")))).repartition("key", "h1", "begin")
    begun = copies.where(~many).withColumn("begin", F.lit(0).cast("long")).unionByName(spread)
    numbered = begun.withColumn("copy", F.explode(F.sequence("begin", F.least(F.col("n"), F.col("begin") + COPIES_A_TASK) - 1)))
    piece = F.pmod(F.pmod(F.xxhash64("key"), "pieces") + F.col("copy"), "pieces")
    columns = ["key", "size", "text_crc32", "tokens", "copy"]
    placed = marked.where("pieces is null").withColumn("copy", F.lit(0).cast("long")).select(*columns, small.alias("parcel")).unionByName(
        numbered.select(*columns, F.xxhash64("h1", "h2", piece).alias("parcel"))
    )
    parcels = placed.groupBy("parcel").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    found = parcels.orderBy("parcel").collect()  # 2 * shards * PARCELS_A_SHARD rows and some pieces at most
    where = pack(np.array([[r["bytes"], r["tokens"], r["rows"]] for r in found], float).reshape(-1, 3), shards)
    spark = docs.sparkSession
    table = spark.createDataFrame([(r["parcel"], int(s)) for r, s in zip(found, where)], "parcel long, shard int")

    runs = max(LEAST_RUNS, -(-(total["rows"] or 0) // (shards * ROWS_A_RUN)))
    dealt = placed.join(F.broadcast(table), "parcel").withColumn("run", F.pmod(F.xxhash64("key", "text_crc32", "copy"), F.lit(runs)))
    earlier = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    first = dealt.groupBy("shard", "run").count().select("shard", "run", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "run").orderBy("key", "text_crc32", "size", "copy")
    return (
        dealt.withColumn("k", F.row_number().over(within))
        .join(F.broadcast(first), ["shard", "run"])
        .select(
            F.col("key").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first") + F.col("k") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _words(body):
    """The number of words between ASCII blanks, without building them."""
    packed = F.trim(F.regexp_replace(body, r"[ \t\r\n]+", " "))
    return F.when(packed == "", F.lit(0)).otherwise(F.length(packed) - F.length(F.replace(packed, F.lit(" "), F.lit(""))) + 1).cast("long")
