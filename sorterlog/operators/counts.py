"""Counts, shares, pivots and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import percent
from sorterlog.operators.quantiles import WEIGHT, quantiles
from sorterlog.sources.staging import stage


def _present(keys: Sequence[str]) -> Column:
    test = F.lit(True)
    for k in keys:
        test = test & F.col(k).isNotNull()
    return test


def group_size(df: DataFrame, *keys: str, keep_null: bool = False, out: str = "count") -> DataFrame:
    """Rows per key; keys with a null are left out unless `keep_null`."""
    rows = df if keep_null else df.where(_present(keys))
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def ranked_counts(df: DataFrame, key: str, keep_null: bool = False, out: str = "count") -> DataFrame:
    """Rows per value, most frequent first; equal counts by value."""
    return group_size(df, key, keep_null=keep_null, out=out).orderBy(F.desc(out), F.asc_nulls_last(key))


def shares(df: DataFrame, key: str, places: int = 2) -> DataFrame:
    """Rows per value and their share of all non-null values in percent, from one pass over the rows; the staged counts give the total."""
    counted = stage(group_size(df, key), "counts")
    total = F.broadcast(counted.agg(F.sum("count").alias("_total")))  # one row
    return counted.crossJoin(total).withColumn("percentage", percent(F.col("count"), F.col("_total"), places)).drop("_total").orderBy(F.desc("count"), key)


def repeated_values(df: DataFrame, key: str, out: str = "count") -> DataFrame:
    return group_size(df, key, out=out).where(F.col(out) > 1).orderBy(F.desc(out), key)


def repetition_profile(df: DataFrame, key: str) -> DataFrame:
    """How values repeat: distinct, repeated and their rows, single, largest and smallest count."""
    c = F.col("count")
    return group_size(df, key).agg(
        F.count(F.lit(1)).alias("distinct_values"),
        F.count_if(c > 1).alias("repeated_values"),
        F.coalesce(F.sum(F.when(c > 1, c)), F.lit(0)).alias("repeated_records"),
        F.count_if(c == 1).alias("single_values"),
        F.max(c).alias("max_occurrences"),
        F.min(c).alias("min_occurrences"),
    )


def pivot_counts(counts: DataFrame, row: str, column: str, value: str = "count",
                 columns: Sequence | None = None) -> DataFrame:
    """Counts as a matrix, absent combinations 0. Give `columns` to save the pass that finds them."""
    return counts.groupBy(row).pivot(column, list(columns) if columns is not None else None).agg(F.sum(value)).na.fill(0)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-null values per column, one row."""
    return df.agg(*[F.count_distinct(F.col(c)).alias(c) for c in (columns or df.columns)])


def shape(df: DataFrame) -> DataFrame:
    """Row count and non-null count per column, one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])


def with_remainder(counts: DataFrame, label: str, name: str, places: int) -> DataFrame:
    """Name the rows without a category, put them last and add percentages of all rows.

    `counts` has one row per category, null for the rest, so one pass over the
    data gives categories, rest and total alike. The rest is listed even at 0.
    """
    none = counts.sparkSession.range(1).select(F.lit(name).alias(label), F.lit(0).cast("bigint").alias("count"))
    named = counts.withColumn(label, F.coalesce(label, F.lit(name))).unionByName(none)
    table = named.groupBy(label).agg(F.sum("count").alias("count")).withColumn("_all", F.lit(1))
    total = F.sum("count").over(Window.partitionBy("_all"))
    return (
        table.withColumn("percentage", percent(F.col("count"), total, places)).drop("_all")
        .orderBy(F.col(label) == name, F.desc("count"), label)
    )


def numeric_profile(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75), slices: int | None = None) -> DataFrame:
    """Count, mean, standard deviation, smallest, quantiles and largest per numeric column, one row each."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    basic = long.groupBy("column").agg(
        F.count("value").alias("count"), F.mean("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias(WEIGHT))
    named = {quantile_name(p): p for p in probs}
    found = quantiles(counts, "value", named, ["column"], slices)
    return basic.join(found, "column").select("column", "count", "mean", "std", "min", *named, "max")


def quantile_name(p: float) -> str:
    return f"p{round(p * 100):d}"


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its count per text column.

    Values are counted in parallel first; only counts reach the final step.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.inline(pairs)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
        best.alias("_best"),
    ).select("column", "count", "unique", F.col("_best.value").alias("top"), (-F.col("_best.n")).alias("freq"))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def below_threshold(measures: Sequence[str], threshold: float = fv.SIZE_THRESHOLD) -> Column:
    """All measures below the threshold; null as soon as one is missing."""
    test = F.col(measures[0]) < threshold
    for m in measures[1:]:
        test = test & (F.col(m) < threshold)
    present = _present(measures)
    return F.when(present, test)


def threshold_counts(df: DataFrame, groups: Mapping[str, Sequence[str]], threshold: float = fv.SIZE_THRESHOLD) -> DataFrame:
    """Rows inside and outside the threshold per named set of measures, in one pass."""
    aggs = []
    for name, measures in groups.items():
        mask = below_threshold(measures, threshold)
        aggs += [F.count_if(mask).alias(f"{name}_in"), F.count_if(~mask).alias(f"{name}_out")]
    return df.agg(*aggs)


def seeded_sample(df: DataFrame, keys: Sequence[str], rows: int = fv.SAMPLE_ROWS, seed: int = fv.SAMPLE_SEED) -> DataFrame:
    """Repeatable sample of `rows` rows, all if there are fewer: those with the smallest md5 of the seed and their keys.

    The input is read once; every task keeps its `rows` smallest and only those meet.
    """
    parts = [F.coalesce(F.col(k).cast("string") if not _nested(df, k) else F.to_json(k), F.lit("")) for k in keys]
    ranked = df.withColumn("_rank", F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)))
    return ranked.orderBy("_rank", *keys).limit(rows).drop("_rank")


def _nested(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StructType)
