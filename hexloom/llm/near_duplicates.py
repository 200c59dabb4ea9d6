"""Jaccard join of texts on word shingles: a MinHash LSH forest, then exact verification.

Texts. A text is the set of its shingles (five words in a row, in lower case). Rows
with equal sets are copies: they become one node, and only nodes are compared.

Forest. A node's signature has ``TREES`` tries of ``DEPTH`` min-hashes each. The nodes of all
tries are sorted by trie and signature, so that nodes with a common prefix stand
side by side. Two sets of similarity s share a prefix of k hashes in one of the tries
with a probability of 1 - (1 - s^k)^TREES. Matching begins with the whole depth and
shortens a node's prefix, hash by hash, until that reaches the target recall for the
least similar set that could still be linked to it: its number of shingles says how similar
that is (a set of 7 has no link below 6/7, one of 4 has links of 4/5). At each length the nodes that have not
reached the target are matched with the next one of them in the order if their prefixes
agree. A set that is so small that no other set can reach the threshold is left out. A match is a
row for each node and trie at most, not a pair for each two.

Verification. Matched nodes are a cluster; every linked pair that the forest finds
lies in one. In a cluster all pairs are verified exactly on their shingles: small
clusters many to a task, large ones cut into blocks of nodes, a task for each two
blocks. No pair becomes a row: a task returns a count of links for each node and one
edge for each node to the least node of its part, from which the classes follow.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from .common import row_keys, small_batches, written
from ..operators.components import components
from .wordhash import chunks, shingle_hashes

WORDS, THRESHOLD = 5, 0.8
#: Tries, hashes in each, and the chance of finding a pair at the threshold that prefixes are shortened for.
TREES, DEPTH, TARGET = 32, 8, 0.9999
#: Nodes of a block of a large cluster, and rows that a task of small clusters is meant for.
BLOCK, TASK_ROWS = 256, 1000
#: Sets of up to so many shingles have their least link worked out; larger ones may have links at the threshold.
SMALL_SET = 64
#: Bytes of the table of clustered nodes up to which it is broadcast, and bytes that a node takes there (keys, digest, counts and the row's own).
BROADCAST_BYTES, NODE_BYTES = 32 << 20, 160

_seeds = np.random.default_rng(20).integers(0, 1 << 32, (2, TREES * DEPTH), np.uint64)
_A, _B = (_seeds[0] | np.uint64(1)).astype(np.uint32), _seeds[1].astype(np.uint32)


def shingles(texts, words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of words; a shorter text is one run; a text without words has none."""
    for chunk in chunks(texts):
        h = chunk.hashes()
        runs = shingle_hashes(h, words) if len(h) >= words else h[:0]
        for a, b in zip(chunk.places[:-1].tolist(), chunk.places[1:].tolist()):
            if b - a >= words:
                yield np.unique(runs[a : b - words + 1])
            else:
                yield shingle_hashes(h[a:b], b - a) if a < b else h[:0]


def signature(sets: np.ndarray) -> bytes:
    """``TREES`` times ``DEPTH`` min-hashes of a set, two bytes each, trie by trie."""
    h = (sets >> np.uint64(16)).astype(np.uint32)
    least = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 1024):
        np.minimum(least, (h[at : at + 1024, None] * _A + _B).min(axis=0), out=least)
    return least.astype(">u2").tobytes()


def prefix_length(similarity: float = THRESHOLD, target: float = TARGET) -> int:
    """The longest prefix that finds a pair of that similarity with the target recall."""
    k = DEPTH
    while k > 1 and 1 - (1 - similarity**k) ** TREES < target:
        k -= 1
    return k


def least_link(shingles: int, threshold: float = THRESHOLD) -> float:
    """The least similarity, not below the threshold, that another set can have to a set of so many shingles."""
    if shingles > SMALL_SET:
        return threshold
    least = 1.0
    for other in range(math.ceil(threshold * shingles - 1e-9), math.floor(shingles / threshold + 1e-9) + 1):
        common = math.ceil(threshold * (shingles + other) / (1 + threshold) - 1e-9)
        if common <= min(shingles, other):
            least = min(least, common / (shingles + other - common))
    return least


@functools.lru_cache(4096)
def shortened(shingles: int, threshold: float = THRESHOLD) -> int:
    """The length that the prefixes of a set of so many shingles are shortened to."""
    return prefix_length(least_link(max(shingles, 1), threshold))


_TIE = "u bigint, v bigint, part int, length int, tree int, high bigint, low bigint"


def matched(signs: DataFrame, shortest: int) -> DataFrame:
    """Matches (u, v) of the nodes of ``signs`` (u, sign, length: what its prefixes are shortened to)."""
    spark = signs.sparkSession

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(b)
            if n:
                words = np.frombuffer(b"".join(b.column("sign").to_pylist()), ">u8").astype(np.uint64).reshape(n, TREES, DEPTH // 4) ^ np.uint64(1 << 63)  # the order of signed numbers
                high, low = (np.ascontiguousarray(words[:, :, k]).view(np.int64).ravel() for k in (0, 1))
                spread = lambda c: np.repeat(b.column(c).to_numpy(), TREES)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.tile(np.arange(TREES, dtype=np.int32), n), high, low, spread("u"), spread("length"))], names=["tree", "high", "low", "u", "length"])

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first: dict[int, tuple] = {}
        last: dict[int, tuple] = {}
        names = [x.split()[0] for x in _TIE.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        for b in batches:
            tree, high, low, u, length = (b.column(c).to_numpy() for c in ("tree", "high", "low", "u", "length"))
            for k in range(shortest, DEPTH + 1):
                at = np.flatnonzero(length <= k)
                if not len(at):
                    continue
                rows = [x[at] for x in (tree, high, low, u)]
                if k in last:
                    rows = [np.r_[x, y] for x, y in zip(last[k], rows)]
                else:
                    first[k] = tuple(x[0] for x in rows)
                t, h, w, x = rows
                fits = (t[1:] == t[:-1]) & agree(h[1:], w[1:], h[:-1], w[:-1], k) & (x[1:] != x[:-1])
                last[k] = tuple(y[-1] for y in rows)
                m = int(fits.sum())
                if m:
                    blank = [pa.nulls(m, kind) for kind in kinds[2:]]
                    yield pa.RecordBatch.from_arrays([pa.array(x[1:][fits]), pa.array(x[:-1][fits]), *blank], names=names)
        ends = [(int(r[3]), side, part, k, int(r[0]), int(r[1]), int(r[2])) for side, found in enumerate((first, last)) for k, r in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([e[c] for e in ends], kind) for c, kind in enumerate(kinds)], names=names)

    sorted_tries = signs.mapInArrow(tries, "tree int, high bigint, low bigint, u bigint, length int").repartitionByRange("tree", "high", "low", "u").sortWithinPartitions("tree", "high", "low", "u")
    found = written(sorted_tries.mapInArrow(neighbours, _TIE), "near-ties")
    # The first and the last node of each part of the order, for each length: a few rows a partition.
    ends = sorted(found.where("part is not null").collect(), key=lambda r: (r["length"], r["part"], r["v"]))
    across = [
        (a["u"], b["u"]) for a, b in zip(ends, ends[1:])
        if a["part"] != b["part"] and a["length"] == b["length"] and a["tree"] == b["tree"] and a["u"] != b["u"] and agree(a["high"], a["low"], b["high"], b["low"], a["length"])
    ]
    return found.where("part is null").select("u", "v").unionByName(spark.createDataFrame(across, "u bigint, v bigint"))


def agree(high, low, other_high, other_low, k: int):
    """Whether the first k hashes, four of 16 bits in each number, are the same."""
    if k <= 4:
        return high >> (64 - 16 * k) == other_high >> (64 - 16 * k)
    return (high == other_high) & (low >> (128 - 16 * k) == other_low >> (128 - 16 * k))


def verify(sets: list[np.ndarray], weights: np.ndarray, split: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set, counted with the weights, and the first set of its part of the graph.

    With ``split`` only pairs of one set before it and one from it on are compared; with 0 all are.
    """
    m = len(sets)
    size = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
    runs = np.diff(np.r_[first, len(flat)])
    shared = np.repeat(runs > 1, runs)  # a shingle of one set alone adds to no intersection
    column = np.repeat(np.cumsum(runs > 1) - 1, runs)[shared]
    owner = owner[shared]
    common = np.zeros((m, m), np.float32)
    width = 8192
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (at, at + width))
        block = np.zeros((m, width), np.float32)
        block[owner[a:b], column[a:b] - at] = 1
        common += block @ block.T
    union = size[:, None] + size[None, :] - common
    linked = common >= threshold * union - 1e-6
    np.fill_diagonal(linked, False)
    if split:
        linked[:split, :split] = linked[split:, split:] = False
    part = np.arange(m)
    while True:
        least = np.minimum(part, np.where(linked, part[None, :], m).min(axis=1))
        least = least[least]
        if (least == part).all():
            return linked @ weights, part
        part = least


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Class and number of links of every row of ``docs``.

    Returns ``key``, class_id and n_links. Two rows are linked if the Jaccard similarity
    of their shingle sets is at least ``threshold``; n_links counts all other rows that a row is
    linked to, copies included; class_id is the smallest key of the rows that links
    connect. Pairs at the threshold are found with a probability of ``TARGET`` at
    least, more similar ones with a higher one, copies always.

    Upper and lower case and white space make no difference. A text of fewer than five
    words is one shingle. A null or blank text has no links and is a class of its
    own key. Repeated rows are copies. Rows with a null key are classed like any other;
    a class of null keys alone has a null class_id. Other columns are not read.
    """
    return _classed(docs, key, text, threshold).select(F.col("id").alias(key), "class_id", "n_links")


def one_of_each_class(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of ``near_duplicates``: the one with the smallest key, null keys last.

    Of rows with that key the one with the smallest hash of key and text stays, of rows equal in
    both the one whose other columns are smallest. Two texts under one key are two rows: each
    stays or goes by its own class. Rows without words are of no class and all stay.
    """
    first = _classed(docs, key, text, threshold).where("first").select("r1", "r2", "alone").distinct()
    first = written(first.select(F.col("r1").alias("\0r1"), F.col("r2").alias("\0r2"), F.col("alone").alias("\0alone")), "near-first")
    r1, r2 = row_keys(key, text)
    rows = docs.withColumns({"\0r1": r1, "\0r2": r2})
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in (key, text)]
    order = Window.partitionBy("\0r1", "\0r2").orderBy(*others, F.lit(0))
    single = rows.join(first.where("not `\0alone`"), ["\0r1", "\0r2"]).withColumn("\0k", F.row_number().over(order)).where("`\0k` = 1")
    alone = rows.join(first.where("`\0alone`"), ["\0r1", "\0r2"], "left_semi")
    names = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*names).unionByName(alone.select(*names))


def _classed(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """For every row its id, row keys, class_id, n_links, whether it is the first of its class, and whether it has no words."""
    spark = docs.sparkSession
    small_batches(spark)
    r1, r2 = row_keys(key, text)
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), r1.alias("r1"), r2.alias("r2"))
    id_type = rows.schema["id"].dataType.simpleString()
    # In a set of n shingles, the closest other set has n - 1 of them, or one more: below 1 / (1 - threshold) none is near.
    least = 1 / (1 - threshold) - 1 if threshold < 1 else float("inf")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, signs, lengths = [], [], []
            for s in shingles(b.column("text").to_pylist()):
                nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signs.append(signature(s) if len(s) >= least - 1e-9 else None)
                lengths.append(shortened(min(len(s), SMALL_SET + 1), threshold))
            made = [pa.array(nodes, pa.binary()), pa.array(signs, pa.binary()), pa.array(lengths, pa.int32())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "r1", "r2")] + made, names=["id", "r1", "r2", "node", "sign", "length"])

    described = written(rows.mapInArrow(describe, f"id {id_type}, r1 bigint, r2 bigint, node binary, sign binary, length int"), "near-rows")
    one = F.struct(F.col("id").isNull().alias("keyless"), "id", "r1", "r2")  # a node's row: the smallest key, null keys last
    nodes = described.where("node is not null").groupBy("node").agg(F.min(one).alias("row"), F.min("id").alias("id"), F.count("*").alias("copies"))
    short = F.xxhash64("node").alias("u")  # nodes that share this number are compared for nothing, not mixed up

    signs = described.where("sign is not null").select(short, "sign", "length").dropDuplicates(["u"])
    clusters = components(matched(signs, prefix_length(threshold)), "near-clusters")
    members = clusters.unionByName(clusters.select(F.col("v").alias("u"), "v").distinct())  # cluster v of node u

    chosen = written(nodes.withColumn("u", F.xxhash64("node")).join(members, "u").select("node", "row.r1", "row.r2", "copies", F.col("v").alias("cluster")), "near-members")
    sizes = written(chosen.groupBy("cluster").agg(F.count("*").alias("n")), "near-sizes")
    chosen = written(chosen.join(sizes, "cluster"), "near-chosen")
    count = chosen.count()
    picked = rows.join(F.broadcast(chosen) if count * NODE_BYTES <= BROADCAST_BYTES else chosen, ["r1", "r2"])

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[bytes] = set()  # rows equal in key and text are one node
        for b in batches:
            b = b[[not (n in met or met.add(n)) for n in b["node"]]]
            yield b.drop(columns="text").assign(shingles=[s.tobytes() for s in shingles(b["text"])])

    columns = "node binary, copies bigint, cluster bigint, n bigint, shingles binary"
    loaded = picked.select("text", "node", "copies", "cluster", "n").mapInPandas(sets, columns)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    tasks = max(1, -(-count // TASK_ROWS))
    dealt = (
        loaded.withColumn("blocks", blocks)
        .withColumn("block", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .withColumn("task", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks))).otherwise(F.xxhash64("cluster", "low", "high")))
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, low, high), g in pdf.groupby(["cluster", "low", "high"], sort=False):
            g = g.drop_duplicates("node").sort_values(["block", "node"])
            node, split = g["node"].to_numpy(), int((g["block"] == low).sum()) if low != high else 0
            if low != high and split == len(g):
                continue
            links, part = verify([np.frombuffer(s, np.uint64) for s in g["shingles"]], g["copies"].to_numpy(), split, threshold)
            out.append(pd.DataFrame({"u": node, "v": node[part], "links": links.astype(np.int64)})[links > 0])
        return pd.concat(out) if out else pd.DataFrame({"u": [], "v": [], "links": []})

    compared = dealt.select("task", "cluster", "low", "high", "block", "node", "copies", "shingles").groupBy("task").applyInPandas(compare, "u binary, v binary, links bigint")
    compared = written(compared, "near-links")
    links = compared.groupBy("u").agg(F.sum("links").alias("links"))
    classes = components(compared.select("u", "v"), "near-classes")
    known = nodes.join(links.withColumnRenamed("u", "node"), "node", "left").join(classes.withColumnRenamed("u", "node"), "node", "left")
    known = written(known.select("node", "id", "row", F.coalesce("v", "node").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "near-nodes")
    named = written(known.groupBy("class").agg(F.min("id").alias("class_id"), F.min("row").alias("first")), "near-named")
    known = known.join(named, "class").select("node", "class_id", "n_links", F.col("first.r1").alias("f1"), F.col("first.r2").alias("f2"))
    alone = F.col("node").isNull()
    return described.select("id", "r1", "r2", "node").join(known, "node", "left").select(
        "id", "r1", "r2", alone.alias("alone"), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("r1") == F.col("f1")) & (F.col("r2") == F.col("f2"))).alias("first"),
    )
