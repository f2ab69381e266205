"""Sort report analyses: packages, defects, recirculation, jackpots."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.clock import parse_stamp_parts
from sorterlog.functions.fields import defect_category, sort_reason
from sorterlog.operators import package_metrics as pm
from sorterlog.operators.columns import drop_constant_columns
from sorterlog.operators.counts import group_size, pivot_counts, ranked_counts, repetition_profile
from sorterlog.operators.fixes import fix_by_membership, fix_by_occurrence, scan_defects, unapplied_ids
from sorterlog.operators.lookup import add_destinations, add_sort_reason, build_mapping
from sorterlog.operators.packages import assign_packages, package_table, session_table
from sorterlog.operators.timewindow import between, resolve_window
from sorterlog.plans.messages import first_elements, records_of, sort_report_messages, staged_sort_reports, with_payload
from sorterlog.plans.result import Tables
from sorterlog.sources.staging import stage

LABEL_CODE = "_label_code"


def s04_analysis(
    logs: DataFrame,
    mapping: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    minutes: float = fv.WINDOW_MINUTES,
    full: bool = False,
    fixes: DataFrame | None = None,
    relabel: bool = False,
    pivot_destinations: list[str] | None = None,
) -> Tables:
    """Package-level analysis of sort reports.

    Returns the window bounds (`start_ts`, `end_ts`) and named tables. Reasons
    and defect categories come from the codes before corrections, unless
    `relabel` is set; recirculation, jackpots and scan defects see corrected
    codes either way.

    The pivot has the given destination names as columns, or those that occur,
    which costs a pass to find them. The text is parsed once into a staged table, sessions are formed once into
    another, and packages into a third; every result reads these.
    """
    dim = build_mapping(mapping)
    messages, rows = staged_sort_reports(logs)
    window = resolve_window(rows, start, end, minutes, full)
    typed = window.rows.withColumn(LABEL_CODE, F.col("sortCode"))
    fixed = stage(fix_by_occurrence(typed, fixes), "corrected") if fixes is not None else typed
    label = "sortCode" if relabel else LABEL_CODE

    sessions = stage(session_table(fixed), "sessions")
    packages = stage(package_table(fixed, label_code=label, sessions=sessions), "packages")

    def window_data() -> DataFrame:
        labelled = fixed.withColumn("sortReason", sort_reason(label)).withColumn("defectCategory", defect_category("sortReason"))
        return assign_packages(add_destinations(labelled, dim), sessions=sessions).drop(LABEL_CODE)

    tables: Tables = Tables({
        "summary": lambda: pm.run_summary(messages, packages),
        "scanner_metrics": lambda: pm.scanner_metrics(packages),
        "sort_counts": lambda: pm.sort_counts(packages),
        "reason_dest_summary": lambda: pm.reason_destination_counts(packages, dim),
        "reason_dest_pivot": lambda: pm.reason_destination_pivot(tables["reason_dest_summary"], columns=pivot_destinations),
        "recirculation": lambda: pm.recirculation_count(packages),
        "defect_metrics": lambda: pm.defect_metrics(packages),
        "jackpots": lambda: pm.jackpot_packages(fixed, dim, sessions=sessions),
        "jackpot_metrics": lambda: pm.jackpot_metrics(tables["jackpots"]),
        "jackpot_total": lambda: pm.jackpot_total(tables["jackpots"]),
        "scan_defects": lambda: scan_defects(fixed),
        "packages": lambda: packages,
        "window_data": window_data,
        "parsed_data": lambda: rows,
        "raw_data": lambda: sort_report_messages(logs),
        **({"unapplied_ids": lambda: unapplied_ids(typed, fixes)} if fixes is not None else {}),
    }, start_ts=window.start, end_ts=window.end)
    return tables


def s04_barcode_analysis(
    logs: DataFrame,
    mapping: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    minutes: float = fv.WINDOW_MINUTES,
    full: bool = False,
    fixes: DataFrame | None = None,
    prune: bool = False,
) -> dict[str, Any]:
    """Record and barcode level analysis of sort reports; corrections come before labels."""
    _, rows = staged_sort_reports(logs, columns=None)
    if prune:
        rows = drop_constant_columns(rows, protect=["sortCode", "indexNo", "timeStamp", "barcodeAWCS"])
    window = resolve_window(rows, start, end, minutes, full)
    fixed = stage(fix_by_occurrence(window.rows, fixes), "corrected") if fixes is not None else window.rows
    names = {n: fv.MAPPING_NAMES[n] for n in ("Amazon", "Beumer")}
    labelled = add_sort_reason(fixed)
    named = add_destinations(labelled, build_mapping(mapping), names=names)
    destination = fv.MAPPING_NAMES["Amazon"]
    success = labelled.where((F.col("sortCode") == 0) & F.col("requestedDestMCID").isin(fv.SUCCESS_CHECK_IDS))
    reasons = group_size(named, "sortReason", destination).orderBy("sortReason", F.desc("count"), destination)
    return {
        "start_ts": window.start,
        "end_ts": window.end,
        "total_records": labelled.agg(F.count(F.lit(1)).alias("total_records")),
        "scan_metrics": pm.barcode_scan_metrics(fixed),
        "sort_counts": ranked_counts(labelled, "sortReason"),
        "reason_dest_summary": reasons,
        "barcode_repetition": repetition_profile(fixed, "barcodeAWCS"),
        "defect_metrics": pm.row_defect_metrics(labelled),
        "scan_defects": scan_defects(labelled, by_category=True),
        "target_success": ranked_counts(success, "requestedDestMCID"),
        "window_data": named,
        **({"unapplied_ids": unapplied_ids(window.rows, fixes)} if fixes is not None else {}),
    }


def barcode_reason_pivot(tables: dict[str, Any], columns: list[str] | None = None) -> DataFrame:
    return pivot_counts(tables["reason_dest_summary"], "sortReason", fv.MAPPING_NAMES["Amazon"], columns=columns)


def s04_first_element_analysis(
    logs: DataFrame,
    fixes: DataFrame | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    prune: bool = False,
) -> dict[str, Any]:
    """First-element variant: one row per message, corrections by id membership, strict window.

    The time stamp stays text here and is parsed from its three parts; there
    is no message code filter.
    """
    records = records_of(logs, None, scrub=False)
    rows = stage(first_elements(with_payload(records, fv.SORT_REPORT_KEYS, scrubbed=False), literal=True), "first-elements")
    fixed = fix_by_membership(rows, fixes) if fixes is not None else rows
    if prune:
        fixed = drop_constant_columns(fixed)
    labelled = fixed.withColumn("sortReason", sort_reason("sortCode")).withColumn(
        "parsed_time", parse_stamp_parts("timeStamp")
    )
    window = resolve_window(labelled, start, end, strict=True, ts="parsed_time")
    rows_in = between(labelled, window.start, window.end, "parsed_time")
    categorised = rows_in.withColumn("defectCategory", defect_category("sortReason"))
    return {
        "start_ts": window.start,
        "end_ts": window.end,
        "sort_counts": ranked_counts(categorised, "sortReason"),
        "sort_counts_with_null": ranked_counts(categorised, "sortReason", keep_null=True),
        "defect_metrics": pm.row_defect_metrics(categorised, places=2, remainder=False),
        "outcomes": pm.row_defect_metrics(categorised, places=2),
        "scan_defects": scan_defects(categorised, codes=fv.SCAN_DEFECT_CODES_NOTEBOOK).orderBy("timeStamp"),
        "scan_defect_codes": group_size(
            categorised.where(F.col("sortCode").isin(fv.SCAN_DEFECT_CODES_NOTEBOOK)), "sortCode"
        ).orderBy("sortCode"),
        "window_data": categorised,
        **({"unapplied_ids": unapplied_ids(rows, fixes, any_code=True).select("id").distinct().orderBy("id")}
           if fixes is not None else {}),
    }
