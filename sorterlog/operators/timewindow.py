"""Analysis windows: closed time intervals inside the range of the data."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.clock import seconds_between


@dataclass(frozen=True)
class TimeWindow:
    """Rows of the window and its resolved bounds."""

    rows: DataFrame
    start: datetime
    end: datetime

    @property
    def seconds(self) -> float:
        return (self.end - self.start).total_seconds()


def time_bounds(df: DataFrame, ts: str = "timeStamp") -> DataFrame:
    """First and last time stamp and the seconds between, as one row."""
    return df.agg(F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts")).withColumn(
        "delta_seconds", seconds_between("start_ts", "end_ts")
    )


def stamp_validity(df: DataFrame, ts: str = "timeStamp") -> DataFrame:
    return df.agg(
        F.count(ts).alias("valid_rows"), (F.count(F.lit(1)) - F.count(ts)).alias("invalid_rows")
    )


def between(df: DataFrame, start: datetime, end: datetime, ts: str = "timeStamp") -> DataFrame:
    """Closed interval; rows without a time stamp drop out."""
    kind = df.schema[ts].dataType.simpleString()
    return df.where(F.col(ts).between(_literal(start, kind), _literal(end, kind)))


def _literal(value: datetime, kind: str):
    return F.lit(value.isoformat(sep=" ")).cast(kind)


def resolve_window(
    df: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    minutes: float = fv.WINDOW_MINUTES,
    full: bool = False,
    strict: bool = False,
    ts: str = "timeStamp",
) -> TimeWindow:
    """Clamp a requested window to the data and cut the rows to it.

    The bounds come from one min/max aggregation and enter the plan as
    literals, so the filter reaches the scan. `full` keeps every row, those
    without a time stamp included. `strict` refuses windows beyond the data.
    """
    bounds = time_bounds(df, ts).first()
    low, high = bounds["start_ts"], bounds["end_ts"]
    if low is None:
        raise ValueError(f"no usable time stamp in column {ts!r}")
    if full:
        return TimeWindow(df, low, high)
    if strict and ((start is not None and start < low) or (end is not None and end > high)):
        raise ValueError(f"window {start} - {end} lies outside the data {low} - {high}")
    first = low if start is None else max(start, low)
    if first > high:
        return TimeWindow(df.limit(0), first, first)
    last = first + timedelta(minutes=minutes) if end is None else end
    last = min(last, high)
    if last < first:
        return TimeWindow(df.limit(0), first, last)
    return TimeWindow(between(df, first, last, ts), first, last)

