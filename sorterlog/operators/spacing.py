"""Distances between neighbouring records and their distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.clock import MICROS, seconds_between
from sorterlog.operators.ordered import SLICE, add_previous, time_slice, with_value_slices
from sorterlog.operators.quantiles import WEIGHT, median, quantiles, upper_median, value_counts_of
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.logs import ORDER
from sorterlog.sources.staging import stage

BINS_PER_TASK = 10_000


def _time_points(df: DataFrame, by: str, ts: str, *extra: Column) -> DataFrame:
    return (
        df.where(F.col(by).isNotNull() & F.col(ts).isNotNull())
        .groupBy(by, ts).agg(F.count(F.lit(1)).alias("_n"), *extra)
        .withColumn(SLICE, time_slice(ts))
    )


def interarrival(df: DataFrame, by: str, ts: str = "timeStamp", order: str = ORDER, out: str = "time_diff") -> DataFrame:
    """Seconds since the preceding record of the same destination, per row.

    The first record of a destination and records without a time stamp get
    null. Of records at one instant the first in file order carries the
    distance to the instant before, the others are 0 apart.
    """
    lead = add_previous(_time_points(df, by, ts, F.min(order).alias("_lead")), [by], ts, "_prev").select(
        F.col(by).alias("_by"), F.col(ts).alias("_ts"), "_lead", "_prev"
    )
    diff = F.when(F.col(order) == F.col("_lead"), seconds_between("_prev", ts)).when(F.col("_lead").isNotNull(), F.lit(0.0))
    joined = df.join(lead, (F.col(by) == F.col("_by")) & (F.col(ts) == F.col("_ts")), "left")
    return joined.select(*df.columns, diff.alias(out))


def interarrival_counts(df: DataFrame, by: str, ts: str = "timeStamp", out: str = "time_diff") -> DataFrame:
    """How often each inter-arrival time occurs per destination, as (by, out, `_w`).

    n records at one instant stand for one distance to the instant before and
    n - 1 distances of 0, so rows themselves are never sorted or joined.
    """
    points = add_previous(_time_points(df, by, ts), [by], ts, "_prev")
    own = F.struct(seconds_between("_prev", ts).alias(out), F.lit(1).cast("bigint").alias(WEIGHT))
    same = F.struct(F.lit(0.0).alias(out), (F.col("_n") - 1).alias(WEIGHT))
    spread = points.select(by, F.inline(F.array(own, same)))
    return (
        spread.where(F.col(out).isNotNull() & (F.col(WEIGHT) > 0))
        .groupBy(by, out).agg(F.sum(WEIGHT).alias(WEIGHT))
    )


def spacing_stats(counts: DataFrame, by: str, value: str = "time_diff", slices: int | None = None) -> DataFrame:
    """Count, mean, smallest, largest and upper median per destination."""
    counts = stage(counts, "spacings")
    basic = counts.groupBy(by).agg(
        F.sum(WEIGHT).alias("count"),
        (F.sum(F.col(value) * F.col(WEIGHT)) / F.sum(WEIGHT)).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return basic.join(upper_median(counts, value, [by], "median", slices), by)


def fixed_width_histogram(counts: DataFrame, by: str, value: str = "time_diff",
                          width: float = fv.SPACING_BIN_SECONDS) -> DataFrame:
    """Counts per right-closed bin; 0 belongs to the first bin; empty bins up to the largest value count 0.

    Values and width are whole microseconds, so edges are exact multiples of
    the width and a group's bins do not depend on other groups. Bin numbers are
    laid out in two steps, so that a long range is spread over many tasks.
    """
    counts = stage(counts, "spacings")
    step = round(width * MICROS)
    exact = counts.withColumn("_us", F.round(F.col(value) * MICROS).cast("bigint"))
    filled = (
        exact.where(F.col("_us") >= 0).withColumn("bin", F.greatest(F.expr(f"(_us + {step - 1}) div {step} - 1"), F.lit(0).cast("bigint")))
        .groupBy(by, "bin").agg(F.sum(WEIGHT).alias("n"))
    )
    last = exact.groupBy(by).agg(F.greatest(F.max(F.expr(f"_us div {step}")), F.lit(0).cast("bigint")).alias("_last"))
    first_of = F.sequence(F.lit(0).cast("bigint"), F.col("_last"), F.lit(BINS_PER_TASK).cast("bigint"))
    parts = last.select(by, "_last", F.explode(first_of).alias("_from")).repartition(by, "_from")
    every = parts.select(by, F.explode(F.sequence(F.col("_from"), F.least("_last", F.col("_from") + (BINS_PER_TASK - 1)))).alias("bin"))
    # The first bin is labelled just below 0 because it includes 0.
    start = F.when(F.col("bin") == 0, F.lit(-0.001)).otherwise(F.round(F.col("bin") * width, 3))
    return every.join(filled, [by, "bin"], "left").select(
        by, "bin", start.alias("bin_start"), F.coalesce("n", F.lit(0)).cast("bigint").alias("count")
    )


def position_gaps(df: DataFrame, by: str, position: str, slices: int | None = None, out: str = "gap") -> DataFrame:
    """How often each gap between neighbouring positions of a group occurs, as (by, out, `_w`).

    Positions are taken in their own order; the first of a group has no gap.
    """
    # Slice borders and both halves of the neighbour search each read the counted positions.
    counted = stage(value_counts_of(df, position, [by]), "positions")
    points = add_previous(with_value_slices(counted, position, slices), [by], position, "_prev")
    own = F.struct((F.col(position) - F.col("_prev")).alias(out), F.lit(1).cast("bigint").alias(WEIGHT))
    same = F.struct(F.lit(0.0).alias(out), (F.col(WEIGHT) - 1).alias(WEIGHT))
    spread = points.select(F.col(by), F.inline(F.array(own, same)))
    return spread.where(F.col(out).isNotNull() & (F.col(WEIGHT) > 0)).groupBy(by, out).agg(F.sum(WEIGHT).alias(WEIGHT))


def auto_scale(counts: DataFrame, value: str = "gap", slices: int | None = None) -> DataFrame:
    """Bring values to millimetres by their median: above 100 they are micrometres, above 10 tenths."""
    counts = stage(counts, "gaps")
    found = median(counts, value, slices).first()
    middle = found[0] if found is not None else None
    divisor = 1000.0 if middle is not None and middle > 100 else 10.0 if middle is not None and middle > 10 else 1.0
    return counts.withColumn(value, F.col(value) / divisor)


def gap_bin(value: Column | str, edges: Sequence[float] = tuple(fv.GAP_EDGES), labels: Sequence[str] = tuple(fv.GAP_LABELS)) -> Column:
    """Label of a right-closed bin; the lowest edge itself and smaller values have none."""
    value = F.col(value) if isinstance(value, str) else value
    label = F.when(value <= edges[0], F.lit(None).cast("string"))
    for upper, name in zip(edges[1:], labels):
        label = label.when(value <= upper, F.lit(name))
    return label.when(value.isNotNull(), F.lit(labels[-1]))


def bin_matrix(counts: DataFrame, by: str, value: str = "gap", labels: Sequence[str] = tuple(fv.GAP_LABELS)) -> DataFrame:
    """Group by bin count matrix with every bin as a column, absent combinations 0."""
    return (
        counts.withColumn("_bin", gap_bin(value)).where(F.col("_bin").isNotNull())
        .groupBy(by).pivot("_bin", list(labels)).agg(F.sum(WEIGHT)).na.fill(0)
    )


def equal_width_histogram(counts: DataFrame, by: str, value: str, bins: int) -> DataFrame:
    """Counts in `bins` equal parts of each group's own range, last part closed, empty parts 0."""
    counts = stage(counts, "value-counts")
    span = counts.groupBy(by).agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    span = span.select(
        by,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    step = (F.col("_hi") - F.col("_lo")) / bins
    rough = F.least(F.floor((F.col(value) - F.col("_lo")) * (bins / (F.col("_hi") - F.col("_lo")))), F.lit(bins - 1))
    # Rounding may put a value beside its edge; the edges themselves decide.
    place = (
        F.when(F.col(value) < F.col("_lo") + F.col("_rough") * step, F.col("_rough") - 1)
        .when((F.col("_rough") < bins - 1) & (F.col(value) >= F.col("_lo") + (F.col("_rough") + 1) * step), F.col("_rough") + 1)
        .otherwise(F.col("_rough"))
    )
    filled = (
        counts.join(broadcast_if_small(span), by)
        .withColumn("_rough", rough)
        .withColumn("bin", place.cast("bigint"))
        .groupBy(by, "bin").agg(F.sum(WEIGHT).alias("n"))
    )
    every = span.select(by, "_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))
    return every.join(filled, [by, "bin"], "left").select(
        by, "bin", (F.col("_lo") + F.col("bin") * step).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("count"),
    )


def describe(counts: DataFrame, value: str, probs: Mapping[str, float], slices: int | None = None) -> DataFrame:
    """Count, mean, standard deviation, smallest, quantiles and largest of all weighted values, one row."""
    counts = stage(counts.groupBy(value).agg(F.sum(WEIGHT).alias(WEIGHT)), "value-counts")
    n = F.sum(WEIGHT)
    basic = counts.agg(n.alias("count"), (F.sum(F.col(value) * F.col(WEIGHT)) / n).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")).first()
    apart = F.col(value) - F.lit(basic["mean"]).cast("double")
    std = counts.agg(F.when(n > 1, F.sqrt(F.sum(apart * apart * F.col(WEIGHT)) / (n - 1))).alias("std")).first()["std"]
    one = {"count": basic["count"] or 0, "mean": basic["mean"], "std": std, "min": basic["min"], "max": basic["max"]}
    kinds = {"count": "bigint"}
    return quantiles(counts, value, probs, (), slices).select(
        *[F.lit(one[c]).cast(kinds.get(c, "double")).alias(c) for c in ("count", "mean", "std", "min")], *probs, F.lit(one["max"]).cast("double").alias("max"),
    )


def collect_spacings(df: DataFrame, by: str, ts: str = "timeStamp", order: str = ORDER, out: str = "time_diff") -> DataFrame:
    """Inter-arrival times in long form, one row each; repeated values are repeated rows."""
    return interarrival(df, by, ts, order, out).where(F.col(out).isNotNull()).select(by, out)
