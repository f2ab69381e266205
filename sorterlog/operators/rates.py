"""Induction rates (pieces per hour) against targets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.clock import seconds_between, time_label
from sorterlog.operators.timewindow import TimeWindow


def choose_target(inductions: DataFrame, name: str = "inductionNo", by: Sequence[str] = ()) -> DataFrame:
    """Target of a set of inductions as one row, null when none has a target; with `by`, a row per group that has one.

    Names without a target are ignored. One induction of a kind has the
    single target, several the kind's share; mixed kinds the mean of both.
    """
    known = inductions.select(*by, name).distinct().where(
        F.col(name).isin(fv.SEMI_INDUCTIONS + fv.AUTO_INDUCTIONS + fv.SPS_INDUCTIONS)
    )
    n, all_semi, all_auto, all_sps = (F.col(c) for c in ("n", "semi", "auto", "sps"))
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.every(F.col(name).isin(fv.SEMI_INDUCTIONS)).alias("semi"),
        F.every(F.col(name).isin(fv.AUTO_INDUCTIONS)).alias("auto"),
        F.every(F.col(name).isin(fv.SPS_INDUCTIONS)).alias("sps"),
    ).select(
        *by,
        F.when(n == 0, F.lit(None).cast("double"))
        .when(all_semi, F.when(n == 1, F.lit(fv.TARGET_SINGLE_SEMI)).otherwise(F.lit(fv.TARGET_ALL_SEMI)))
        .when(all_auto, F.when(n == 1, F.lit(fv.TARGET_SINGLE_AUTO)).otherwise(F.lit(fv.TARGET_ALL_AUTO)))
        .when(all_sps, F.lit(fv.TARGET_SPS))
        .otherwise(F.lit((fv.TARGET_ALL_SEMI + fv.TARGET_ALL_AUTO) / 2))
        .alias("target_pph")
    )


def rate_columns(n: Column, seconds: Column, target: Column) -> dict[str, Column]:
    """Rate, attainment and shortfall of `n` items in `seconds`; a window of no length has rate 0."""
    ran = seconds > 0
    zero = F.lit(0.0)
    pph = F.when(ran, n / seconds * 3600.0).otherwise(zero)
    needed = F.ceil(target / 3600 * seconds)
    return {
        "window_minutes": seconds / 60.0,
        "items_per_sec": F.when(ran, n / seconds).otherwise(zero),
        "items_per_min": F.when(ran, n / seconds * 60).otherwise(zero),
        "pph_window": pph,
        "target_pph": target,
        "attainment_window_%": pph / target * 100,
        "needed_items_for_pass": needed,
        "items_short": F.greatest(F.lit(0), needed - n),
        "sec_per_bag_current": F.when(ran, F.try_divide(seconds, n)).otherwise(zero),
        "sec_per_bag_target": F.lit(3600) / target,
        "passed": pph >= target,
    }


def recommendation(n: Column, seconds: Column, short: Column, current: Column, wanted: Column) -> Column:
    advice = F.format_string(fv.ADVICE_FORMAT, short, seconds / 60.0, wanted, current)
    return F.when((seconds > 0) & (n > 0) & (short > 0), advice).otherwise(F.lit(fv.ADVICE_ON_TARGET))


def summary_line(line: Column, point: Column, label: Column, n: Column) -> Column:
    return F.format_string(fv.SUMMARY_FORMAT, line, point, label, n)


def induction_rates(window: TimeWindow, name: str = "inductionNo", measuring_point: str = fv.MEASURING_POINT) -> DataFrame:
    """Rate per induction of a window. Empty when no induction present has a target.

    All inductions are counted in one aggregation; the few counts carry the
    rest. The window length is that of the resolved window, not of the data.
    """
    counts = window.rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n_items"))
    target = choose_target(counts, name).scalar()
    seconds = F.lit(window.seconds)
    with_target = counts.withColumn("target", target).where(F.col("target").isNotNull())
    start, end = _stamp(window.start), _stamp(window.end)
    n = F.col("n_items")
    rated = with_target.select(
        F.col(name).alias("line_name"), F.lit(measuring_point).alias("measuring_point"),
        start.alias("start_ts"), end.alias("end_ts"), time_label(start, end).alias("time_label"), "n_items",
        *[c.alias(k) for k, c in rate_columns(n, seconds, F.col("target")).items()],
    )
    texts = {
        "recommendation": recommendation(n, seconds, F.col("items_short"), F.col("sec_per_bag_current"), F.col("sec_per_bag_target")),
        "summary_line": summary_line(F.col("line_name"), F.col("measuring_point"), F.col("time_label"), n),
    }
    return rated.withColumns(texts)


def with_total(rates: DataFrame) -> DataFrame:
    """Append the row of all inductions together; columns without a total are null."""
    total = rates.agg(
        F.sum("n_items").alias("n_items"), F.sum("pph_window").alias("pph_window"),
        (F.max("target_pph") * F.count(F.lit(1))).alias("target_pph"), F.count(F.lit(1)).alias("_lines"),
    ).where(F.col("_lines") > 0).select(
        F.lit(fv.TOTAL_LINE).alias("line_name"), "n_items", "pph_window", "target_pph",
        (F.col("pph_window") / F.col("target_pph") * 100).alias("attainment_window_%"),
    )
    both = rates.withColumn("_o", F.lit(0)).unionByName(total.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    return both.orderBy("_o", "line_name").drop("_o")


def line_rate(df: DataFrame, start: datetime, end: datetime, ts: str = "timestamp", target: float = fv.LINE_TARGET,
              line: str = fv.LINE_NAME, measuring_point: str = fv.MEASURING_POINT) -> DataFrame:
    """Rate of one line as one row: window items over the window and over the length of all data."""
    first, last = _stamp(start), _stamp(end)
    seconds = F.lit((end - start).total_seconds())
    inside = F.col(ts).between(first, last)
    one = df.agg(
        F.count(ts).alias("valid_rows"), (F.count(F.lit(1)) - F.count(ts)).alias("invalid_rows"),
        F.min(ts).alias("data_start"), F.max(ts).alias("data_end"), F.count_if(inside).alias("n_items"),
    ).withColumn("overall_seconds", seconds_between("data_start", "data_end"))
    n, overall, goal = F.col("n_items"), F.col("overall_seconds"), F.lit(float(target))
    nothing = F.lit(None).cast("double")
    pph = F.when(seconds > 0, n * 3600 / seconds).otherwise(nothing)
    pph_all = F.when(overall > 0, n * 3600 / overall).otherwise(nothing)
    needed = F.when(seconds > 0, F.ceil(goal * seconds / 3600))
    short = F.when(seconds > 0, F.greatest(F.lit(0), needed - n))
    current, wanted = F.try_divide(seconds, n), F.lit(3600.0) / goal
    label = time_label(first, last)
    return one.select(
        "*",
        first.alias("start_ts"), last.alias("end_ts"), label.alias("time_label"),
        F.when(n > 0, F.try_divide(overall, n)).alias("sec_per_bag"),
        F.when(overall > 0, n / overall).alias("items_per_sec"),
        F.when(overall > 0, n / overall * 60).alias("items_per_min"),
        pph_all.alias("pph_overall"), pph.alias("pph_window"), goal.alias("target_pph"),
        (pph_all / goal * 100).alias("attainment_overall_%"), (pph / goal * 100).alias("attainment_window_%"),
        needed.alias("needed_items_for_pass"), short.alias("items_short"),
        current.alias("sec_per_bag_current"), wanted.alias("sec_per_bag_target"),
        F.coalesce((seconds > 0) & (n > 0) & (pph >= goal), F.lit(False)).alias("passed"),
        recommendation(n, seconds, short, current, wanted).alias("recommendation"),
        summary_line(F.lit(line), F.lit(measuring_point), label, n).alias("summary_line"),
    )


def _stamp(value: datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
