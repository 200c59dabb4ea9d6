"""Approximate nearest neighbours by cosine, with an adaptive scan of dimensions.

Index. Vectors are scaled to length one and turned by a fixed random rotation, so
that every leading block of dimensions is a fair sample of the whole. Centroids
are fitted on a bounded sample; every vector goes to the list of its nearest
centroid, stored as column blocks (dimension by vector). Vectors of another number of
dimensions than the commonest one have a list for each number.

Search. A query probes the lists with the nearest centroids; how many is measured on
the sample, against brute force within it. In a list, distances
are added up one block of dimensions at a time; after each block a hypothesis test
asks whether the full distance can still be below the worst of the best k so far: a
candidate is abandoned once its partial distance, scaled up to all dimensions,
exceeds that bound by a factor that chance would reach with a small probability.
The bound tightens as the scan goes on: candidates come in steps that grow, each tested
against the best of all steps before. Those that are left are scored exactly, in double
precision, on the original vectors.

Skew. Lists and the queries that probe them are cut into blocks of rows, so that a
list that holds a third of all vectors is many tasks. A block returns k rows for
each query, whatever its size. A block of vectors travels once for each block of the
queries that probe its list, so a number travels once for ``BLOCK_NUMBERS`` / dimensions comparisons of it.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Vectors the centroids are fitted on, rounds of fitting, and the most lists.
SAMPLE, ROUNDS, MOST_LISTS = 20_000, 8, 4096
#: Numbers that the sample holds at most.
SAMPLE_NUMBERS = 1 << 23
#: Recall that the number of probed lists is set for, and the sample's queries that it is measured on.
TARGET, TRIED = 0.97, 400
#: Dimensions added before each test, and the test's width in standard errors.
BLOCK_DIMENSIONS, WIDTH = 16, 3.0
#: Candidates of the first step of a scan for each neighbour that is asked for, and how much each further step grows.
FIRST_STEP, GROWTH = 16, 8
#: Numbers in one block of a list, and in one block of the queries that probe it.
BLOCK_NUMBERS = 1 << 20


@functools.lru_cache(16)
def rotation(dimensions: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same on every call."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, lists: int, seed: int = 12) -> np.ndarray:
    """Unit centroids of unit vectors by rounds of assignment and averaging; the first ones are rows of the sample."""
    found = sample[np.random.default_rng(seed).permutation(len(sample))[:lists]]
    for _ in range(ROUNDS):
        at = (sample @ found.T).argmax(axis=1)
        sums = np.zeros_like(found)
        np.add.at(sums, at, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), found)
    return found


def lists_to_probe(sample: np.ndarray, found: np.ndarray, k: int) -> int:
    """The least number of lists that hold ``TARGET`` of the k nearest, by brute force within the sample."""
    asked = sample[:: max(1, len(sample) // TRIED)]
    near = asked @ sample.T
    near[np.arange(len(asked)), np.arange(len(asked)) * max(1, len(sample) // TRIED)] = -2
    best = np.argsort(-near, axis=1)[:, :k]
    order = np.argsort(-(asked @ found.T), axis=1)
    place = np.argsort(order, axis=1)
    at = np.take_along_axis(place, (sample @ found.T).argmax(axis=1)[best], axis=1)
    return int(np.quantile(at, TARGET, method="higher")) + 1


def scan(base: np.ndarray, queries: np.ndarray, k: int, ids: np.ndarray | None = None, own: np.ndarray | None = None) -> list[np.ndarray]:
    """For each query the columns of ``base`` (unit, rotated) that may be among its k nearest; k of them at least, but none whose id is the query's own."""
    dimensions, n = base.shape
    out = []
    for number, q in enumerate(queries):
        held, distances, bound = np.zeros(0, np.int64), np.zeros(0), math.inf
        at, step = 0, FIRST_STEP * k
        while at < n:
            alive = np.arange(at, min(at + step, n))
            if own is not None and (ids[alive] == own[number]).any():
                alive = alive[ids[alive] != own[number]]
            at, step = at + step, step * GROWTH
            if not len(alive):
                continue
            partial = np.zeros(len(alive))
            for d in range(0, dimensions, BLOCK_DIMENSIONS):
                part = base[d : d + BLOCK_DIMENSIONS]
                part = part[:, alive[0] : alive[-1] + 1] if len(alive) == alive[-1] + 1 - alive[0] else part[:, alive]
                partial += ((part - q[d : d + BLOCK_DIMENSIONS, None]) ** 2).sum(axis=0)
                seen = min(d + BLOCK_DIMENSIONS, dimensions)
                # Of a random rotation's first dimensions, the share of the squared distance varies by about sqrt(2 / seen).
                width = WIDTH * math.sqrt(2 / seen * (1 - seen / dimensions))
                keep = partial <= bound * seen / dimensions * (1 + width) + 1e-9
                alive, partial = alive[keep], partial[keep]
                if not len(alive):
                    break
            held, distances = np.r_[held, alive], np.r_[distances, partial]
            if len(held) > k:
                bound = np.partition(distances, k - 1)[k - 1]
                keep = distances <= bound + 1e-9
                held, distances = held[keep], distances[keep]
        out.append(held)
    return out


def unit(vectors) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of one number of dimensions scaled by their largest component, so that no square over- or underflows, and their lengths then."""
    x = np.stack(vectors)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x, np.sqrt((x * x).sum(axis=1))


def _clean(column: str) -> Column:
    """The vector as doubles, null where it is null, empty, zero or holds a null, infinite or undefined component."""
    v = F.col(column).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return F.when(v.isNotNull() & fine, v)


def nearest(vectors: DataFrame, queries: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """The k nearest other rows by cosine for each row of ``vectors`` for which ``queries`` holds.

    Returns query_id, rank (from 1), ``key`` and score (cosine of the original vectors
    in double precision); nearest first, ties by the smaller key. A query with fewer
    than k candidates gets them all.

    Vectors that are null, zero or empty, or hold null or non-finite components,
    take no part; nor do rows with a null key. Vectors are compared with those of their own number of dimensions alone.
    A row never finds its own key, so of rows repeated with one key each is found once for every
    copy, by others only; a query that is repeated has its neighbours once for every copy.
    An empty table gives no rows. Recall is set by ``TARGET`` and ``WIDTH``.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(key).cast("long").alias("id"), _clean(vector).alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query")).where("id is not null and v is not null")
    shapes = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if shapes is None:
        return spark.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    dimensions = shapes["d"]
    lists = max(1, min(MOST_LISTS, round(math.sqrt(shapes["count"]))))
    some = base.where(F.size("v") == dimensions).orderBy(F.xxhash64("id", "v"), "id").limit(max(1, min(SAMPLE, SAMPLE_NUMBERS // dimensions))).select(F.explode("v").alias("x"))
    sample, norms = unit(some.toArrow()["x"].to_numpy().reshape(-1, dimensions))
    sample = sample / norms[:, None]
    found = centroids(sample, lists)
    lists = len(found)
    shared = spark.sparkContext.broadcast(found)  # MOST_LISTS vectors at most
    probed = lists_to_probe(sample, found, k)

    def closeness(v: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each number of dimensions in a batch: it, the rows, and their closeness to the centroids."""
        sizes = np.array([len(x) for x in v])
        for d in np.unique(sizes):
            rows = np.flatnonzero(sizes == d)
            x, norm = unit(v[rows])
            yield int(d), rows, (x / norm[:, None]) @ shared.value.T if d == dimensions else np.zeros((len(rows), 1))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = np.zeros(len(b), np.int32)
            for d, rows, near in closeness(b["v"].to_numpy()):
                at[rows] = near.argmax(axis=1) if d == dimensions else -d
            yield b.assign(list=at)

    indexed = written(base.mapInPandas(assign, "id long, v array<double>, is_query boolean, list int"), "ann-index")
    sizes = {r["list"]: r["count"] for r in indexed.groupBy("list").count().collect()}  # a row for each list at most
    # A query is a key and a vector; how often it is given comes back at the end.
    asked = indexed.where("is_query").groupBy("id", "v").agg(F.count("*").alias("times"))
    asked = written(asked.select(F.monotonically_increasing_id().alias("query"), F.col("id").alias("query_id"), "v", "times"), "ann-queries")
    size_of = np.array([sizes.get(i, 0) for i in range(lists)])

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for d, rows, near in closeness(b["v"].to_numpy()):
                if d != dimensions:
                    yield b.iloc[rows].assign(list=np.int32(-d))
                    continue
                order = np.argsort(-near, axis=1, kind="stable")
                # Enough lists to hold k candidates besides the query itself, if all lists together do.
                held = np.cumsum(size_of[order], axis=1)
                take = np.maximum(probed, np.minimum((held < k + 1).sum(axis=1) + 1, lists))
                at = np.repeat(rows, take)
                picked = np.concatenate([o[:t] for o, t in zip(order, take)])
                fine = size_of[picked] > 0
                yield b.iloc[at[fine]].assign(list=picked[fine].astype(np.int32))

    probes = asked.select("query", "query_id", "v").mapInPandas(probe, "query long, query_id long, v array<double>, list int")
    asked_of = {r["list"]: r["count"] for r in probes.groupBy("list").count().collect()}
    block = lambda at: max(1, BLOCK_NUMBERS // (dimensions if at >= 0 else -at))
    cuts = [(i, -(-n // block(i)), -(-asked_of.get(i, 0) // block(i))) for i, n in sizes.items()]
    cut = F.broadcast(spark.createDataFrame(cuts, "list int, blocks int, parts int"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    stored = indexed.join(cut, "list").where("parts > 0").select(
        "list", F.pmod(F.xxhash64("id", "v"), "blocks").cast("int").alias("block"), every("parts").alias("part"), "id", "v"
    )
    probes = probes.join(cut, "list").select(
        "list", every("blocks").alias("block"), F.pmod(F.xxhash64("query"), "parts").cast("int").alias("part"), "query", "query_id", "v"
    )

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query": np.zeros(0, np.int64), "id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(left) or not len(right):
            return none
        left = left.sort_values("id")
        ids, (x, norms) = left["id"].to_numpy(), unit(left["v"].to_numpy())
        turn = rotation(x.shape[1])
        columns = np.ascontiguousarray(((x / norms[:, None]) @ turn).T)
        q, q_norms = unit(right["v"].to_numpy())
        own, rows = right["query_id"].to_numpy(), []
        for query, v, size, alive in zip(right["query"], q, q_norms, scan(columns, (q / q_norms[:, None]) @ turn, k, ids, own)):
            score = (x[alive] * v).sum(axis=1) / (norms[alive] * size)
            best = np.lexsort((ids[alive], -score))[:k]
            rows.append((np.full(len(best), query), ids[alive][best], score[best]))
        return pd.DataFrame(dict(zip(("query", "id", "score"), map(np.concatenate, zip(*rows))))) if rows else none

    pairs = stored.groupBy("list", "block", "part").cogroup(probes.groupBy("list", "block", "part")).applyInPandas(search, "query long, id long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    given = ranked.join(asked.select("query", "query_id", "times"), "query")
    return given.select("query_id", "rank", "id", "score", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("time")).select("query_id", "rank", F.col("id").alias(key), "score")
