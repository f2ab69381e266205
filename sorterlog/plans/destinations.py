"""Destination request analyses: counts per destination and bypass spacing."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.clock import parse_stamp_lenient
from sorterlog.operators import spacing as sp
from sorterlog.operators.columns import drop_constant_columns
from sorterlog.operators.counts import ranked_counts, repeated_values
from sorterlog.operators.lookup import add_destinations, build_mapping
from sorterlog.operators.ordered import first_rows
from sorterlog.operators.timewindow import resolve_window
from sorterlog.plans.messages import first_elements, records_of, with_payload
from sorterlog.sources.logs import ORDER
from sorterlog.sources.staging import stage


def s02_destinations(
    logs: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    minutes: float = fv.WINDOW_MINUTES,
    full: bool = False,
    prune: bool = False,
) -> dict[str, Any]:
    """Requested destinations on the first record per barcode, and repeated barcodes."""
    records = records_of(logs, fv.DESTINATION_REQUEST_CODE)
    rows = stage(first_elements(with_payload(records, fv.SORT_REPORT_KEYS)), "destination-requests")
    if prune:
        rows = drop_constant_columns(rows, protect=["indexNo", "timeStamp"])
    window = resolve_window(rows, start, end, minutes, full)
    unique = first_rows(window.rows, ["barcodeAWCS"], [ORDER])
    narrow = first_rows(window.rows.select("barcodeAWCS", "requestedDestMCID", ORDER), ["barcodeAWCS"], [ORDER])
    return {
        "start_ts": window.start,
        "end_ts": window.end,
        "summary": narrow.agg(
            F.count(F.lit(1)).alias("total_processed"), F.count("barcodeAWCS").alias("unique_packages")
        ),
        "destination_counts": ranked_counts(narrow, "requestedDestMCID"),
        "repeated_barcodes": repeated_values(window.rows, "barcodeAWCS"),
        "clean_data": rows,
        "window_data": unique,
    }


def bypass_spacing(
    logs: DataFrame,
    mapping: DataFrame,
    destinations: list[str] | None = None,
    width: float = fv.SPACING_BIN_SECONDS,
) -> dict[str, Any]:
    """Time between neighbouring items per bypass destination: rows, statistics, histogram."""
    wanted = fv.BYPASS_DESTINATIONS if destinations is None else destinations
    name = fv.MAPPING_NAMES["Amazon"]
    records = records_of(logs, None, scrub=False)
    rows = first_elements(with_payload(records, fv.SORT_REPORT_KEYS, scrubbed=False), literal=True)
    named = add_destinations(rows, build_mapping(mapping), recirculation=True)
    kept = named.where(F.col(name).isin(wanted)).withColumn("timeStamp", parse_stamp_lenient("timeStamp"))
    bypass = stage(kept, "bypass")
    counts = stage(sp.interarrival_counts(bypass, name), "bypass-spacings")
    return {
        "raw_data": sp.interarrival(bypass, name),
        "distributions": sp.collect_spacings(bypass, name),
        "stats": sp.spacing_stats(counts, name),
        "histogram": sp.fixed_width_histogram(counts, name, width=width),
        "chart_histogram": sp.equal_width_histogram(counts, name, "time_diff", 30),
    }
