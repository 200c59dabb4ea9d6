"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are never gathered. They are packed into blocks of whole numbers, written
once, and each step of the bidiagonalisation is one pass over the blocks: tasks make
their part of X v and of the transposed product, and Spark adds the parts up. What
the driver holds is bounded by dimensions x steps.

A left vector u has one entry a row; all of them together would be as large as the table. But each is X w
for a short w, a combination of the right vectors, so a task makes the entries of its
rows anew from the w of all steps. With them a pass also gives the products of the new
left vector with all earlier ones, and these are taken off again: both sides are fully
reorthogonalised. The singular value decomposition of the small bidiagonal matrix
turns the right vectors into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import small_batches, written

#: Entries become floor(SCALE * entry) + OFFSET, kept within LARGEST.
SCALE, OFFSET, LARGEST = 64, 1_000_000, 1 << 52
#: Components, and the least number of steps as a multiple of them.
COMPONENTS, STEPS_A_COMPONENT = 32, 4
#: Parts of the largest singular value: of a residual that counts as none, of a new right and left vector that do, and of a component that is left out.
CONVERGED, NO_RIGHT, NO_LEFT, NO_DEVIATION = 1e-14, 1e-13, 1e-10, 1e-6
#: Part of a new left vector along earlier ones from which the pass is repeated.
REPEAT = 1e-8
#: Numbers of a packed block.
BLOCK = 1 << 18


def whole_numbers(vector: Column) -> Column:
    """Each entry as double, times SCALE, rounded down, plus OFFSET; beyond LARGEST it stays there."""
    clipped = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.floor(c * F.lit(float(SCALE)))))
    return F.transform(vector.cast("array<double>"), lambda c: clipped(c) + F.lit(OFFSET))


def usable(vector: Column) -> Column:
    """Not null, and no entry null, not a number or infinite."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector.cast("array<double>"), bad), F.lit(True))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


@dataclass
class Fit:
    """Rows, exact sums of each dimension, components as rows, their eigenvalues, and their parts of the trace."""

    n: int
    width: int
    sums: list[int]
    components: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    explained: np.ndarray = field(default_factory=lambda: np.zeros(0))
    steps: int = 0

    def __post_init__(self):
        self.floor = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean: whole numbers first, so that nothing is lost to the offset."""
        return (x - self.floor).astype(float) - (self.rest / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum of (n * x - S) ** 2 of each row; null beyond a long."""
        d = x - self.floor
        largest = int(np.abs(d).max(initial=0)) * self.n + self.n
        if self.width * largest**2 < 1 << 62:
            return ((d * self.n - self.rest.astype(np.int64)) ** 2).sum(1).tolist()
        exact = ((d.astype(object) * self.n - self.rest) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in exact]

    def scaled(self) -> np.ndarray:
        """Components over the root of their eigenvalues, as columns."""
        return (self.components / np.sqrt(self.values)[:, None]).T


def _packed(vectors: DataFrame, width: int) -> DataFrame:
    """Blocks of rows of whole numbers less OFFSET, in the narrowest type that holds them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, BLOCK // max(width, 1))
        for batch in batches:
            x = _matrix(batch.column(0), width) - OFFSET
            for at in range(0, len(x), rows):
                part = x[at : at + rows]
                low, high = int(part.min(initial=0)), int(part.max(initial=0))
                kind = next(t for t in ("i1", "i2", "i4", "i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
                yield pa.RecordBatch.from_pydict({"rows": pa.array([len(part)], pa.int32()), "kind": [kind], "data": pa.array([part.astype(kind).tobytes()], pa.binary())})

    return written(vectors.select("x").mapInArrow(run, "rows int, kind string, data binary"), "whitening-blocks")


def _added(blocks: DataFrame, make, width: int) -> dict[int, float]:
    """The sum over all blocks of the vector that ``make`` returns for a block's rows, by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for rows, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                part = make(np.frombuffer(data, kind).reshape(rows, width).astype(np.int64) + OFFSET)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["place", "value"])

    kind = "bigint" if make.__name__ == "whole" else "double"
    parts = blocks.mapInArrow(run, f"place int, value {kind}")
    total = F.sum(F.col("value").cast("decimal(38,0)") if kind == "bigint" else F.col("value"))
    return {r["place"]: r["value"] for r in parts.groupBy("place").agg(total.alias("value")).collect()}


def _sums(blocks: DataFrame, width: int) -> list[int]:
    """Exact sums of each dimension: high and low halves apart, so that no part overflows."""

    def whole(x: np.ndarray) -> np.ndarray:
        return np.concatenate([(x >> 26).sum(0), (x & (1 << 26) - 1).sum(0)])

    found = _added(blocks, whole, width)
    return [(int(found[k]) << 26) + int(found[k + width]) for k in range(width)]


def bidiagonalise(product, width: int, count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, int]:
    """The leading right singular vectors (rows), singular values and number of steps.

    ``product(W, a)`` makes one pass: for p = X a it returns the products of p with the columns of X W, p with itself, and the transposed product.
    Steps go on until the leading vectors' residuals are at rounding level, STEPS_A_COMPONENT * ``count`` at least, or until the
    dimensions or the space of the rows are used up. A start lies in the space of the rows. Where what it leads to is exhausted, the next start is
    a random one orthogonal to all before, so repeated singular values are all found.
    """
    random = np.random.default_rng(seed)
    right, short, back = (np.zeros((width, 0)) for _ in range(3))
    alphas: list[float] = []
    betas: list[float] = []

    def orthogonal(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            z = z - right @ (right.T @ z)
        return z

    def fresh() -> np.ndarray | None:
        """A unit vector of the space of the rows that is orthogonal to all before; None if there is none."""
        r = orthogonal(random.standard_normal(width))
        z = orthogonal(product(np.zeros((width, 0)), r / np.linalg.norm(r))[2])
        size = np.linalg.norm(z)
        if size <= NO_RIGHT * max(alphas, default=0.0) ** 2:
            return None
        return orthogonal(z / size)

    v, beta = fresh(), 0.0
    while v is not None:
        v = v / np.linalg.norm(v)
        a = v - beta * short[:, -1] if beta else v
        against, own, z = product(short, a)
        for _ in range(2):
            if against @ against <= REPEAT**2 * own or own <= (NO_LEFT * max(alphas)) ** 2:
                break
            a = a - short @ against  # one pass took off too much to be exact
            against, own, z = product(short, a)
        z = z - back @ against
        alpha = float(np.sqrt(max(own - against @ against, 0.0)))
        if alpha <= NO_LEFT * max([alpha, *alphas]):
            alpha, w, z = 0.0, np.zeros(width), np.zeros(width)
        else:
            w, z = (a - short @ against) / alpha, z / alpha
        right, short, back = np.c_[right, v], np.c_[short, w], np.c_[back, z]
        alphas.append(alpha)
        left, values, turn = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        if len(alphas) == width:
            break
        z = orthogonal(z - alpha * v)
        beta = float(np.linalg.norm(z))
        if len(alphas) >= STEPS_A_COMPONENT * count and (beta * np.abs(left[-1, :count]) <= CONVERGED * values[0]).all():
            break
        if beta <= NO_RIGHT * max(alphas):
            v, beta = fresh(), 0.0
        else:
            v = z / beta
        betas.append(beta)
    if not alphas:
        return np.zeros((0, width)), np.zeros(0), 0
    steps = len(alphas)
    return (right @ turn[:count].T).T, values[:count], steps


def fit(vectors: DataFrame, width: int, count: int = COMPONENTS) -> tuple[Fit, DataFrame] | None:
    """The fit of rows with a column ``x`` of ``width`` whole numbers, and their blocks; None if there are no rows."""
    blocks = _packed(vectors, width)
    n = blocks.agg(F.sum("rows")).first()[0] or 0
    if n == 0 or width == 0:
        return None
    found = Fit(n, width, _sums(blocks, width))
    trace = _added(blocks, lambda x: (found.centred(x) ** 2).sum(keepdims=True).reshape(1), width)[0]

    def product(short: np.ndarray, a: np.ndarray):
        both = np.c_[short, a]

        def make(x: np.ndarray) -> np.ndarray:
            rows = found.centred(x)
            made = rows @ both
            return np.concatenate([made.T @ made[:, -1], rows.T @ made[:, -1]])

        parts = _added(blocks, make, width)
        got = np.array([parts[k] for k in range(len(parts))])
        k = short.shape[1]
        return got[:k], got[k], got[k + 1 :]

    if trace > 0:
        vectors_, values, found.steps = bidiagonalise(product, width, min(count, width))
        kept = values > NO_DEVIATION * values[0]
        found.components, found.values = vectors_[kept], values[kept] ** 2 / n
        found.explained = found.values / (trace / n)
    return found, blocks


def identity_error(found: Fit, blocks: DataFrame) -> float:
    """The largest absolute entry of the covariance of the whitened rows less the identity."""
    k, scaled = len(found.values), found.scaled()

    def make(x: np.ndarray) -> np.ndarray:
        y = found.centred(x) @ scaled
        return np.concatenate([y.sum(0), (y.T @ y).ravel()])

    parts = _added(blocks, make, found.width)
    total = np.array([parts[i] for i in range(k + k * k)]) / found.n
    return float(np.abs(total[k:].reshape(k, k) - np.outer(total[:k], total[:k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector of ``vectors`` and each of the ``count`` leading components.

    Returns ``key``, component (from 1), n, deviation, whitened, explained and identity_error.
    Rows whose vector is null or holds an entry that is null or not finite are left out. The others
    become whole numbers (``whole_numbers``), have the mean taken off, and are projected on the
    unit eigenvectors of their covariance (divisor n), over the root of the eigenvalue. deviation is the exact sum
    of (n * x - S) ** 2, null beyond a long. explained is the eigenvalue's part of the trace.

    A vector shorter than the longest is read as ending in zeros. Repeated rows count and are returned as often
    as they are there; a null key is kept. Components without deviation (singular value of NO_DEVIATION of the largest or less, as with fewer rows
    than components) are left out; where all vectors are equal, or there are none, no row is returned.
    """
    small_batches(vectors.sparkSession)
    kept = vectors.where(usable(F.col(vector))).select(F.col(key).alias("key"), whole_numbers(F.col(vector)).alias("x"))
    width = kept.agg(F.max(F.size("x"))).first()[0] or 0
    even = kept.select("key", F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x"))).alias("x"))
    schema = StructType([StructField(key, vectors.schema[key].dataType), *StructType.fromDDL(
        "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double").fields])
    made = fit(even, width, count)
    if made is None or len(made[0].values) == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    found, blocks = made
    error, scaled, r = identity_error(found, blocks), found.scaled(), len(found.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, BLOCK // max(width, r))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                x = _matrix(part.column(1), width)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), r))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(each), pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), m)), pa.array(np.full(m * r, found.n)),
                        pa.array(found.deviations(x), pa.int64()).take(each), pa.array((found.centred(x) @ scaled).ravel()),
                        pa.array(np.tile(found.explained, m)), pa.array(np.full(m * r, error)),
                    ],
                    names=schema.names,
                )

    return even.mapInArrow(run, schema)
