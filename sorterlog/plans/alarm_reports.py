"""Alarm analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.operators import alarms as al
from sorterlog.operators.columns import arrange_columns
from sorterlog.operators.counts import group_size, ranked_counts, shares


def alarm_summary(alarms: DataFrame, kind: str, mapping: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Alarm durations per device of one kind: 'DBS', 'IAS', 'ES' or 'CHU'.

    Emergency stops look at their own alarm group only. With a mapping, the
    customer's name stands beside each device.
    """
    group = fv.ESTOP_GROUP if kind == "ES" else None
    durations = al.device_durations(alarms, fv.DEVICE_PATTERNS[kind], group, strict=strict)
    summary = al.duration_summary(durations)
    if mapping is not None:
        summary = al.with_customer_names(summary, mapping)
    return al.duration_report(summary)


def printable(report: DataFrame, kind: str) -> DataFrame:
    """Report columns under the headings of the printed table."""
    jam = "Amazon" in report.columns
    names = {"device": "Beumer" if jam else f"{kind} Unit"}
    if jam:
        names["Amazon"] = "Amazon"
    names |= {
        "alarm_count": "Jam Count" if jam else "Alarm Count",
        "total_duration": "Total Duration",
        "average_duration": "Average Duration",
        "max_duration": "Max Duration",
    }
    return arrange_columns(report, names)


def alarm_occurrences(occurrences: DataFrame, mapping: DataFrame, separator: bool = False) -> DataFrame:
    return al.occurrence_report(occurrences, mapping, separator)


def carrier_alarms(alarms: DataFrame, part: str = "Part name", text: str = "Alarm text") -> dict[str, DataFrame]:
    """Alarm counts by part and by text, with the targeted alarms of carriers singled out."""
    summary = al.carrier_summary(alarms, part, text)
    targeted = al.targeted_alarm_counts(alarms, part, text)
    rows = alarms.select(F.col(f"`{part}`").alias("part"), F.col(f"`{text}`").alias("text"))
    return {
        "by_part": group_size(rows, "part", out="total_alarms").orderBy("part"),
        "by_part_and_text": group_size(rows, "part", "text").orderBy("part", "text"),
        "targeted_by_part": targeted.orderBy("part"),
        "targeted_total": targeted.agg(F.coalesce(F.sum("target_alarm_count"), F.lit(0)).alias("total")),
        "targeted_by_text_and_part": group_size(rows.where(F.col("text").isin(fv.CARRIER_ALARMS)), "text", "part")
        .orderBy("text", F.desc("count"), "part"),
        "summary": summary.orderBy("part"),
        "targeted_carriers": al.targeted_carriers(summary),
        "by_text": ranked_counts(rows, "text"),
        "text_shares": shares(rows, "text"),
        "total": rows.agg(F.count(F.lit(1)).alias("total_alarms")),
    }
