"""Induction rates of all inductions, and of a single line from a flattened export."""

from __future__ import annotations

from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.clock import parse_stamp_without_blanks
from sorterlog.functions.fields import induction_name
from sorterlog.operators.columns import drop_constant_columns
from sorterlog.operators.rates import induction_rates, line_rate, with_total
from sorterlog.operators.timewindow import resolve_window, stamp_validity
from sorterlog.plans.messages import records_of, with_payload
from sorterlog.sources.staging import stage


def induction_rate(
    logs: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    minutes: float = fv.WINDOW_MINUTES,
    full: bool = False,
    prune: bool = False,
) -> dict[str, Any]:
    """Rate per induction against the target of the inductions present, with a total row."""
    parsed = with_payload(records_of(logs, fv.ITEM_INDUCTED_CODE), fv.INDUCTION_KEYS)
    messages = stage(parsed.withColumn("inductionNo", induction_name("inductionNo")), "inductions")
    if prune:
        messages = drop_constant_columns(messages, protect=["inductionNo", "timeStamp"])
    window = resolve_window(messages, start, end, minutes, full)
    rates = induction_rates(window)
    return {
        "start_ts": window.start,
        "end_ts": window.end,
        "inductions": window.rows.select("inductionNo").distinct().orderBy("inductionNo"),
        "rate_analysis": with_total(rates),
        "clean_data": messages,
        "window_data": window.rows,
    }


def single_line_rate(
    export: DataFrame,
    start: datetime,
    minutes: float = fv.LINE_WINDOW_MINUTES,
    target: float = fv.LINE_TARGET,
    line: str = fv.LINE_NAME,
) -> dict[str, DataFrame]:
    """Rate of one line in a window that starts at `start`; the window is not clamped to the data."""
    stamped = stage(export.withColumn("timestamp", parse_stamp_without_blanks("stamp_raw")), "line-export")
    end = start + timedelta(minutes=minutes)
    inside = stamped.where(F.col("timestamp").between(*[
        F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in (start, end)
    ]))
    return {
        "validity": stamp_validity(stamped, "timestamp"),
        "rate": line_rate(stamped, start, end, "timestamp", target, line),
        "window_data": inside,
    }
