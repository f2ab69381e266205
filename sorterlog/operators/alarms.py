"""Alarm durations, occurrences and carrier alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions import fields as fx
from sorterlog.functions.clock import MICROS, clean_duration, format_duration, parse_duration
from sorterlog.operators.lookup import join_by_own_name
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.tables import POSITION


def device_durations(alarms: DataFrame, pattern: str, group: str | None = None, part: str = "Part name",
                     duration: str = "Duration", strict: bool = False) -> DataFrame:
    """Device id and duration in microseconds per alarm; `group` keeps one alarm group."""
    rows = alarms if group is None else alarms.where(F.col("Group") == group)
    return rows.select(
        fx.device_id(F.col(f"`{part}`"), pattern).alias("device"),
        parse_duration(clean_duration(F.col(f"`{duration}`")), strict).alias("duration_us"),
    )


def duration_summary(durations: DataFrame) -> DataFrame:
    """Alarm count, total, mean and longest duration per device; alarms without a device are left out."""
    us = F.col("duration_us")
    return durations.where(F.col("device").isNotNull()).groupBy("device").agg(
        F.count(F.lit(1)).alias("alarm_count"),
        F.coalesce(F.sum(us), F.lit(0)).alias("total_us"),
        F.avg(us).alias("mean_us"),
        F.max(us).alias("max_us"),
    )


def with_customer_names(summary: DataFrame, mapping: DataFrame) -> DataFrame:
    """Add the customer's destination name to each device.

    A device that the mapping lists m times counts m times, as if its alarms
    had been joined one by one; the join itself meets one row per device. The
    name is the first non-null one in mapping order.
    """
    dim = mapping.where(F.col("Beumer").isNotNull()).groupBy("Beumer").agg(
        F.count(F.lit(1)).alias("_m"),
        F.min_by("Amazon", F.when(F.col("Amazon").isNotNull(), F.col(POSITION))).alias("Amazon"),
    )
    times = F.coalesce(F.col("_m"), F.lit(1))
    return summary.join(broadcast_if_small(dim), F.col("device") == F.col("Beumer"), "left").select(
        "device", "Amazon",
        (F.col("alarm_count") * times).alias("alarm_count"),
        (F.col("total_us") * times).alias("total_us"),
        "mean_us", "max_us",
    )


def duration_report(summary: DataFrame) -> DataFrame:
    """Longest total first, with durations in seconds and as 'HH:MM:SS'."""
    names = [c for c in ("device", "Amazon", "alarm_count") if c in summary.columns]
    return summary.select(
        *names,
        (F.col("total_us") / MICROS).alias("total_seconds"),
        (F.col("mean_us") / MICROS).alias("mean_seconds"),
        (F.col("max_us") / MICROS).alias("max_seconds"),
        format_duration("total_us").alias("total_duration"),
        format_duration("mean_us").alias("average_duration"),
        format_duration("max_us").alias("max_duration"),
    ).orderBy(F.desc("total_seconds"), "device")


def jam_rows(occurrences: DataFrame, mapping: DataFrame) -> DataFrame:
    """Jam occurrences of destinations, labelled with both names; other columns stay, duration last.

    Each row repeats for every mapping row of its unit, so a small file may fan
    out to very many rows: labels are made once for each mapping row, not for each repetition.
    """
    chutes = occurrences.withColumn("Part", fx.part_unit("Part")).where(
        fx.contains("Part", "CHU") & fx.contains("Message", "Jam")
    ).drop("Message")
    named = join_by_own_name(chutes, mapping, "Part", names={"MappingString": fx.destination_label("Beumer", "Amazon")})
    rest = [c for c in occurrences.columns if c not in ("Part", "Message", "Duration")]
    return named.select("MappingString", *rest, "Duration")


def induction_rows(occurrences: DataFrame) -> DataFrame:
    return occurrences.withColumn("Part", fx.part_unit("Part")).where(fx.contains("Part", "IU")).select(
        "Part", "Message", "Duration", "Occurrences"
    )


def occurrence_report(occurrences: DataFrame, mapping: DataFrame, separator: bool = False) -> DataFrame:
    """Destination jams, then inductions by part, as one list ordered by `section`.

    The sections are told apart by a number instead of a row of dashes;
    `separator` adds that row for a printed list. Jams have no part and so no
    order among themselves: the sections are laid one behind the other and
    only inductions are sorted, as a sort of all rows would bring every jam into one task.
    """
    jams = jam_rows(occurrences, mapping).withColumn("section", F.lit(1))
    inductions = induction_rows(occurrences).withColumn("section", F.lit(3)).orderBy(F.asc_nulls_first("Part"))
    sections = [jams, inductions]
    if separator:
        text = [s.select(*[F.col(f"`{c}`").cast("string").alias(c) if c != "section" else F.col(c) for c in s.columns]) for s in sections]
        shown = [c for c in jams.columns if c != "section"]
        dashes = occurrences.sparkSession.range(1).select(
            *[F.lit("---").alias(c) for c in shown], F.lit(2).alias("section")
        )
        sections = [text[0], dashes, text[1]]
    report = sections[0]
    for section in sections[1:]:
        report = report.unionByName(section, allowMissingColumns=True)
    return report


def carrier_summary(alarms: DataFrame, part: str = "Part name", text: str = "Alarm text") -> DataFrame:
    """Alarms per part: those with a text, the two targeted kinds, their sum and the carrier number."""
    t = F.col(f"`{text}`")
    bellows, disabled = (F.count_if(t == kind) for kind in fv.CARRIER_ALARMS)
    number = fx.carrier_number("part")
    return (
        alarms.where(F.col(f"`{part}`").isNotNull()).groupBy(F.col(f"`{part}`").alias("part")).agg(
            F.count(t).alias("total_alarms"), disabled.alias("disabled_count"), bellows.alias("bellows_active_count")
        )
        .withColumn("target_alarms_total", F.col("disabled_count") + F.col("bellows_active_count"))
        .withColumn("carrier_number", number)
        .withColumn("carrier_formatted", fx.zero_pad("carrier_number"))
    )


def targeted_carriers(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("target_alarms_total") > 0).select("carrier_formatted", "target_alarms_total")


def targeted_alarm_counts(alarms: DataFrame, part: str = "Part name", text: str = "Alarm text") -> DataFrame:
    """Targeted alarms per part."""
    hits = alarms.where(F.col(f"`{text}`").isin(fv.CARRIER_ALARMS) & F.col(f"`{part}`").isNotNull())
    return hits.groupBy(F.col(f"`{part}`").alias("part")).agg(F.count(F.lit(1)).alias("target_alarm_count"))
