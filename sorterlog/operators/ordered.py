"""Ordered computations over keys of any size.

A plain window partitioned by the key puts all rows of a busy key into one
task. The operators here first reduce the rows to distinct (key, position)
points, which combines before the shuffle and so absorbs any number of
copies. The points of a key are then cut into slices of consecutive
positions. Windows run inside one slice only; what crosses a slice border is
computed on one summary row per (key, slice) and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorterlog.functions.clock import MICROS, micros

SLICE_SECONDS = 3600
SLICE = "_slice"
POINTS_PER_SLICE = 1_000_000


def order_slice(df: DataFrame, order: str) -> Column:
    """A part of the rows that holds a bounded number of them and grows with `order`.

    File order keys are cut at the splits of the files, numbers at every POINTS_PER_SLICE.
    """
    kind = df.schema[order].dataType
    if isinstance(kind, T.StructType):
        return F.struct(F.col(order)["file"].alias("file"), F.col(order)["block"].alias("block"))
    return F.floor(F.col(order) / POINTS_PER_SLICE)


def slice_bases(df: DataFrame, key: str, order: str) -> DataFrame:
    """For each (key, `_slice`) the number of rows of the key in earlier slices, `_base`."""
    before = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(key, order_slice(df, order).alias(SLICE)).agg(F.count(F.lit(1)).alias("_n"))
    return totals.select(key, SLICE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))


def add_ordinal(df: DataFrame, key: str, order: str, out: str, bases: DataFrame | None = None) -> DataFrame:
    """Running number from 1 of the rows of a key in `order`; only rows whose slice is in `bases` are kept."""
    bases = slice_bases(df, key, order) if bases is None else bases
    inside = Window.partitionBy(key, SLICE).orderBy(order)
    sliced = df.withColumn(SLICE, order_slice(df, order)).join(bases, [key, SLICE])
    return sliced.withColumn(out, F.col("_base") + F.row_number().over(inside)).select(*df.columns, out)


def time_slice(ts: str, seconds: int = SLICE_SECONDS) -> Column:
    """Slice number of a time stamp. Millisecond stamps give at most seconds * 1000 points per slice."""
    return F.floor(micros(ts) / (seconds * MICROS)).cast("bigint")


def with_value_slices(points: DataFrame, value: str, slices: int | None = None) -> DataFrame:
    """Cut a numeric column into slices of about equal row counts, by default of POINTS_PER_SLICE points each.

    The borders are approximate quantiles of the points, found in one pass and
    fixed as plan literals, so every use of the plan cuts at the same places.
    How many borders there are and where they fall affects the balance only, never the result.
    """
    if slices is None:
        slices = 1 + points.count() // POINTS_PER_SLICE
    probs = [i / slices for i in range(1, slices)]
    found = points.approxQuantile(value, probs, 1.0 / (2 * slices)) if probs else []
    borders = sorted({b for b in found if b == b})
    if not borders:
        return points.withColumn(SLICE, F.lit(0).cast("bigint"))
    cut = Bucketizer(splits=[float("-inf"), *borders, float("inf")], inputCol=value, outputCol=SLICE, handleInvalid="keep")
    return cut.transform(points).withColumn(SLICE, F.col(SLICE).cast("bigint"))


def add_previous(points: DataFrame, by: Sequence[str], position: str, out: str) -> DataFrame:
    """Position of the preceding point of the same key, null for the first one.

    Needs unique (by, position) and a `_slice` column that grows with position.
    """
    inside = Window.partitionBy(*by, SLICE).orderBy(position)
    across = Window.partitionBy(*by).orderBy(SLICE)
    borders = (
        points.groupBy(*by, SLICE).agg(F.max(position).alias("_last"))
        .select(*by, SLICE, F.lag("_last").over(across).alias("_before"))
    )
    return (
        points.withColumn("_lag", F.lag(position).over(inside))
        .join(borders, [*by, SLICE])
        .select(*points.columns, F.coalesce("_lag", "_before").alias(out))
    )


def add_session_number(points: DataFrame, key: str, ts: str, gap_seconds: float, out: str) -> DataFrame:
    """Number sessions per key from 0; a gap strictly above `gap_seconds` opens a new one.

    Needs unique (key, ts) and non-null keys. Points without a time stamp come
    last and belong to the session before them.
    """
    gap = int(gap_seconds * MICROS)
    by_slice = [key, SLICE]
    sliced = points.withColumn("_us", micros(ts)).withColumn(SLICE, F.coalesce(time_slice(ts), F.lit(2**62)))
    inside = Window.partitionBy(*by_slice).orderBy("_us")
    opened = F.coalesce((F.col("_us") - F.lag("_us").over(inside)) > gap, F.lit(False)).cast("bigint")
    marked = sliced.withColumn("_open", opened)

    across = Window.partitionBy(key).orderBy(SLICE)
    edges = marked.groupBy(*by_slice).agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last"), F.sum("_open").alias("_inside")
    )
    entered = F.coalesce((F.col("_first") - F.lag("_last").over(across)) > gap, F.lit(False)).cast("bigint")
    bases = (
        edges.withColumn("_step", entered + F.coalesce(F.lag("_inside").over(across), F.lit(0)))
        .select(*by_slice, F.sum("_step").over(across.rowsBetween(Window.unboundedPreceding, 0)).alias("_base"))
    )
    running = F.sum("_open").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("_run", running)
        .join(bases, by_slice)
        .select(*points.columns, (F.col("_base") + F.col("_run")).alias(out))
    )


def first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order, nulls of the order last; a null key is a key.

    A minimum over (order, row) combines before the shuffle, so no task ever
    holds all rows of a key. Order columns must be sortable.
    """
    sort: list[Column] = []
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        sort += [c.isNull().alias(f"n{i}"), c.alias(f"o{i}")]
    rest = [c for c in df.columns if c not in by]
    best = F.min_by(F.struct(*rest), F.struct(*sort)).alias("_row")
    return df.groupBy(*by).agg(best).select(
        *[F.col(c) if c in by else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )
