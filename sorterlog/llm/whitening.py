"""Whitening of embeddings along their leading principal components.

The leading eigenvectors of the covariance come from a Chebyshev-filtered
subspace iteration. A block of vectors Q (the wanted components and some spare
ones) is multiplied by the covariance in passes over the data: every task sums
its rows' (x - mean)ᵀ((x - mean) Q), and the sums of all tasks are added in a
tree. A Chebyshev polynomial of the covariance, made by its three-term recurrence of such passes, damps the part of
the spectrum below the block's smallest Ritz value and lifts the rest; then
QR makes the block orthonormal and a Rayleigh-Ritz step turns it towards the
eigenvectors. It ends once the residuals |V q - e q| certify the wanted
pairs: an eigenvalue lies within the residual of each e, and the eigenvectors
are exact up to residual over gap. The covariance itself is never formed. The
driver and every task hold a few matrices of dimensions x block.

Entries c become whole numbers floor(64 c) + 1,000,000; the model is fitted on
each different vector once, so copies have no weight. Sums are exact integers,
and n x - S is formed before any rounding.

Rows whose vector is null, empty or holds null, NaN or infinite entries are left out; so are rows with an entry of
2^55 or more, whose whole number has no room in 64 bits, and rows of another length than the most frequent one (the
longer of equally frequent ones). Zero vectors
and repeated rows stay, each with its own output rows. Components whose
eigenvalue is zero up to rounding (fewer different vectors than components,
constant tables) have no whitened value and are left out; an empty table gives
an empty one. Equal eigenvalues get some orthonormal basis of their space. Signs
are fixed by a positive largest entry. `deviation` is exact, and null
where it does not fit 64 bits. Further columns are not read.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorterlog.llm.shared import col, prepare
from sorterlog.sources.staging import stage

COMPONENTS = 16
#: Vectors of the block beyond the wanted ones; more of them need fewer passes.
SPARE = 32
SCALE, SHIFT, LARGEST = 64, 1_000_000, 2.0**55
MOST_CYCLES = 60
MOST_DEGREE = 40
#: Residuals relative to the largest eigenvalue: certified below the first, as good as doubles allow below the second.
CERTIFIED, FINEST = 1e-11, 1e-15
#: Blocks that are added on the driver at most.
FAN_IN = 16


@dataclasses.dataclass(frozen=True)
class Whitening:
    """n different vectors with sums S, and the eigenpairs of their covariance by falling eigenvalue."""

    dims: int
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def whole(vector: Column, dims: int | None = None) -> Column:
    """The vector as whole numbers; null if it takes no part."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    kept = finite & ((F.size(v) > 0) if dims is None else (F.size(v) == dims))
    return F.when(kept, F.transform(v, lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n x - S, exact: 64-bit numbers where they suffice, else Python's."""
    largest = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    if 2 * n * largest + max(map(abs, sums)) < 2**62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return (deviations(x, n, sums) / n).astype(np.float64)


def _blocks(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The sum of some blocks as one row; none if there are none."""
    total = None
    for block in blocks:
        total = block if total is None else total + block
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["block"])


def summed(table: DataFrame, dims: int, block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of a block of doubles made from the rows of `x`; tasks add theirs, a tree of tasks adds those."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(block(matrix(b.column(0), dims)).ravel() for b in batches if b.num_rows)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _blocks(np.frombuffer(v.as_py()) for b in batches for v in b.column(0))

    parts, width = table.select("x").mapInArrow(first, "block binary"), table.rdd.getNumPartitions()
    while width > FAN_IN:
        width = -(-width // FAN_IN)
        parts = parts.repartition(width).mapInArrow(again, "block binary")
    return np.sum([np.frombuffer(r["block"]) for r in parts.collect()], axis=0)  # at most FAN_IN rows


def exact_sums(table: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    """The number of rows and the sum of each dimension, as whole numbers."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dims, object)
        for b in batches:
            x = matrix(b.column(0), dims)
            n += len(x)
            high, low = x >> 32, x & 0xFFFFFFFF  # neither can overflow in a batch
            total += high.sum(axis=0).astype(object) * 2**32 + low.sum(axis=0).astype(object)
        values = [Decimal(n), *map(Decimal, total)]
        yield pa.record_batch([pa.array(range(dims + 1), pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["i", "v"])

    found = table.select("x").mapInArrow(each, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v"))
    by = {r["i"]: int(r["v"]) for r in found.collect()}  # dims + 1 rows
    return by.get(0, 0), tuple(by.get(i + 1, 0) for i in range(dims))


def filtered(multiply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the degree, scaled to 1 at `top` and at most 1 / its growth on [0, cut], applied to the block."""
    half = cut / 2
    first = half / (top - half)
    scale, before, now = first, q, (vq - half * q) * (first / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (multiply(now) - half * now) * (2 * after / half) - before * (scale * after)
        scale = after
    return now


def degree_for(cut: float, last: float, top: float, wanted: float) -> int:
    """A degree that shrinks what is unwanted by `wanted` at the last wanted value, without losing that one beside the largest."""
    reach = [math.acosh(max(2 * v / cut - 1, 1 + 1e-9)) for v in (last, top)]
    spread = max(reach[1] - reach[0], 1e-9)
    return max(2, min(MOST_DEGREE, math.ceil(math.log(wanted) / reach[0]), int(14 / spread)))


def eigenpairs(multiply: Callable[[np.ndarray], np.ndarray], dims: int, components: int, spare: int = SPARE) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric, non-negative operator and unit eigenvectors (as columns), certified."""
    wanted, size = min(components, dims), min(components + spare, dims)
    q = np.linalg.qr(np.random.default_rng(11).normal(size=(dims, size)))[0]
    last_worst = math.inf
    for _ in range(MOST_CYCLES):
        vq = multiply(q)
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        if top <= 0:
            return np.zeros(0), np.zeros((dims, 0))
        worst = np.linalg.norm(vq - q * values, axis=0)[:wanted].max() / top
        if worst <= FINEST * math.sqrt(dims) or (worst <= CERTIFIED and worst > last_worst / 2):
            real = values[:wanted] > top * 1e-13 * dims
            return values[:wanted][real], q[:, :wanted][:, real]
        last_worst = worst
        cut = max(values[-1], top * 1e-12)
        q = np.linalg.qr(filtered(multiply, q, vq, cut, top, degree_for(cut, values[wanted - 1], top, worst / FINEST)))[0]
    raise ArithmeticError(f"residual {worst} after {MOST_CYCLES} cycles")


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    spark = prepare(df.sparkSession)
    lengths = df.where(whole(col(vector)).isNotNull()).groupBy(F.size(col(vector)).alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return Whitening(0, 0, (), np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    dims = most["dims"]
    table = stage(df.select(whole(col(vector), dims).alias("x")).where("x is not null").distinct(), "different-vectors")
    n, sums = exact_sums(table, dims)

    def multiply(q: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(q)

        def block(x: np.ndarray) -> np.ndarray:
            c = centred(x, n, sums)
            return c.T @ (c @ shared.value)

        found = summed(table, dims, block).reshape(q.shape) / n
        shared.unpersist()
        return found

    trace = float(summed(table, dims, lambda x: np.array([np.square(centred(x, n, sums)).sum()]))[0]) / n
    values, vectors = eigenpairs(multiply, dims, components)
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1.0, 1.0) if len(values) else vectors
    turn = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ turn
        return np.concatenate((w.sum(axis=0)[None], w.T @ w))

    error = 0.0
    if len(values):
        found = summed(table, dims, moments).reshape(-1, len(values)) / n
        error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(len(values))).max())
    return Whitening(dims, n, sums, values, vectors, trace, error)


def transform(df: DataFrame, model: Whitening, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The key, component (from 1), n, deviation, whitened, explained and identity_error of every remaining row and component."""
    prepare(df.sparkSession)
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
    ])
    k = len(model.values)
    turn, share = model.vectors / np.sqrt(model.values), model.values / (model.trace or 1.0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows or not k:
                continue
            x = matrix(b.column(1), model.dims)
            d = deviations(x, model.n, model.sums)
            if d.dtype != object and np.abs(d.astype(np.float64)).max() ** 2 * model.dims < 2**62:
                deviation = pa.array(np.repeat((d * d).sum(axis=1), k), pa.int64())
            else:
                found = [int(v) for v in np.square(d.astype(object)).sum(axis=1)]
                deviation = pa.array([v if v < 2**63 else None for v in found for _ in range(k)], pa.int64())
            rows, m = np.repeat(np.arange(len(x)), k), len(x)
            yield pa.record_batch([
                b.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)), deviation,
                pa.array(((d / model.n).astype(np.float64) @ turn).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, model.identity_error)),
            ], schema.names)

    rows = df.select(col(key).alias("key"), whole(col(vector), model.dims).alias("x")).where("x is not null")
    return rows.mapInArrow(each, schema)
