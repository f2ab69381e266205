"""Exact order statistics without gathering a group in one place.

Values are reduced to (group, value, weight) first. A slice of neighbouring
values holds a bounded share of them, so finding the slice of a rank needs
only slice totals, and only the slices that hold a wanted rank are sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorterlog.operators.ordered import SLICE, with_value_slices
from sorterlog.sources.staging import stage

WEIGHT = "_w"


def value_counts_of(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values per group with their row count; null groups and values are left out."""
    present = F.col(value).isNotNull()
    if isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType)):
        present = present & ~F.isnan(value)
    for c in by:
        present = present & F.col(c).isNotNull()
    return df.where(present).groupBy(*by, value).agg(F.count(F.lit(1)).alias(WEIGHT))


def at_ranks(counts: DataFrame, value: str, ranks: Mapping[str, Column], by: Sequence[str] = (),
             slices: int | None = None) -> DataFrame:
    """Values at 0-based ranks per group, one column per entry of `ranks`.

    `counts` holds unique (by, value) with weight `_w`. A rank is an expression
    of `_total`, the number of rows of the group, which is returned as well.
    """
    names = list(ranks)
    keys = list(by) or ["_all"]
    # Slicing, slice totals and the final sort each read the counts.
    table = stage(counts, "value-counts")
    base = table if by else table.withColumn("_all", F.lit(1))
    sliced = with_value_slices(base.withColumn(value, F.col(value).cast("double")), value, slices)

    across = Window.partitionBy(*keys).orderBy(SLICE)
    totals = (
        sliced.groupBy(*keys, SLICE).agg(F.sum(WEIGHT).alias("_in"))
        .withColumn("_upto", F.sum("_in").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_in").over(Window.partitionBy(*keys)))
        .withColumn("_before", F.col("_upto") - F.col("_in"))
    )
    holds = [(ranks[n] >= F.col("_before")) & (ranks[n] < F.col("_upto")) for n in names]
    any_wanted = holds[0]
    for h in holds[1:]:
        any_wanted = any_wanted | h
    wanted = totals.where(any_wanted).select(
        *keys, SLICE, "_before", "_total", *[F.when(h, ranks[n]).alias(f"_r{i}") for i, (n, h) in enumerate(zip(names, holds))]
    )

    inside = Window.partitionBy(*keys, SLICE).orderBy(value)
    placed = (
        sliced.join(wanted, [*keys, SLICE])
        .withColumn("_to", F.col("_before") + F.sum(WEIGHT).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_from", F.col("_to") - F.col(WEIGHT))
    )
    picked = [
        F.max(F.when((F.col(f"_r{i}") >= F.col("_from")) & (F.col(f"_r{i}") < F.col("_to")), F.col(value))).alias(n)
        for i, n in enumerate(names)
    ]
    return placed.groupBy(*keys).agg(*picked, F.max("_total").alias("_total")).select(*by, *names, "_total")


def quantiles(counts: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (),
              slices: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbouring ranks."""
    ranks: dict[str, Column] = {}
    for i, p in enumerate(probs.values()):
        spot = (F.col("_total") - 1) * F.lit(float(p))
        ranks[f"_lo{i}"] = F.floor(spot)
        ranks[f"_hi{i}"] = F.ceil(spot)
        ranks[f"_at{i}"] = spot
    wanted = {k: v for k, v in ranks.items() if not k.startswith("_at")}
    found = at_ranks(counts, value, wanted, by, slices)

    def interpolated(i: int) -> Column:
        share = ranks[f"_at{i}"] - F.floor(ranks[f"_at{i}"])
        return F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share

    return found.select(*by, *[interpolated(i).alias(n) for i, n in enumerate(probs)])


def upper_median(counts: DataFrame, value: str, by: Sequence[str], out: str = "median", slices: int | None = None) -> DataFrame:
    """Value at place n // 2 of the sorted values, the upper of two middle ones."""
    return at_ranks(counts, value, {out: F.floor(F.col("_total") / 2)}, by, slices).drop("_total")


def median(counts: DataFrame, value: str, slices: int | None = None) -> DataFrame:
    return quantiles(counts, value, {"median": 0.5}, (), slices)
