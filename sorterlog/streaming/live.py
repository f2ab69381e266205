"""Packages, rates and first requests of log files that keep arriving in a folder.

Every function turns a stream of log records into a stream of finished rows.
A row is finished, and appended once, when the watermark says that no record
can change it any more: `delay` behind the latest time stamp seen. State holds
open sessions and windows only, so its size follows the traffic of the last
`delay` plus gap and not the age of the stream. Records older than the
watermark are late; they are left out and counted by `run_to_end`.

Watermarks need time stamps with a zone: log stamps are read in the session's zone on the way in and lose
it again on the way out. The zone should be one without clock changes, as `session.configure` sets it.

Records without a time stamp cannot be placed in a stream and are left out;
the analyses of finished files keep them. Ties of a time stamp are broken by
record number, since files of a stream have no common line order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import induction_name, is_multi_read, is_no_read
from sorterlog.operators.packages import is_recirculating, package_type
from sorterlog.operators.rates import choose_target, rate_columns
from sorterlog.plans.messages import explode_destinations, first_elements, records_of, sort_report_messages, with_payload
from sorterlog.sources.logs import split_fields

TS = "timeStamp"
DELAY = "10 minutes"
#: Sessions are merged inside each task before they are shuffled, so a busy item arrives as few rows.
MERGE_FIRST = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def stream_log_monitor(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """12-column log records of the files of a folder, those to come included."""
    spark.conf.set(MERGE_FIRST, "true")
    reader = spark.readStream.format("text")
    return split_fields((reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).load(folder))


def _watermarked(rows: DataFrame, delay: str) -> DataFrame:
    return rows.withColumn(TS, F.col(TS).cast("timestamp")).withWatermark(TS, delay)


def _plain(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


def _earliest(row: Column, number: str = "plcRecordNo") -> Column:
    """The row with the least time stamp, ties by record number (numbers before other texts)."""
    n = F.expr(f"try_cast({number} AS bigint)")
    return F.min_by(row, F.struct(F.col(TS), n.isNull(), n, F.col(number)))


def live_packages(logs: DataFrame, delay: str = DELAY, gap_seconds: int = fv.SESSION_GAP_SECONDS) -> DataFrame:
    """Packages of sort reports: a gap of more than `gap_seconds` ends one.

    itemID, first_ts, last_ts, records, pkg_type, recirculates and the code and
    destination of the first record. Numbers of an item's packages, which need all of them, come from `number_packages`.
    """
    rows = _watermarked(explode_destinations(sort_report_messages(logs)).where(F.col("itemID").isNotNull()), delay)
    first = _earliest(F.struct(F.col("sortCode").alias("code"), F.col("requestedDestMCID").alias("mcid")))
    packages = rows.groupBy("itemID", F.session_window(TS, f"{gap_seconds} seconds").alias("session")).agg(
        F.min(TS).alias("first_ts"), F.max(TS).alias("last_ts"), F.count(F.lit(1)).alias("records"),
        F.min(is_no_read("barcodeAWCS")).alias("no"), F.min(is_multi_read("barcodeAWCS")).alias("multi"), F.max(is_recirculating()).alias("recirc"), first.alias("first"),
    )
    return packages.select(
        "itemID", _plain("first_ts").alias("first_ts"), _plain("last_ts").alias("last_ts"), "records", package_type(F.col("no"), F.col("multi")).alias("pkg_type"),
        (F.col("recirc") & (F.col("records") > 1)).alias("recirculates"), F.col("first.code").alias("first_code"), F.col("first.mcid").alias("first_mcid"),
    )


def number_packages(finished: DataFrame) -> DataFrame:
    """Finished packages with their running number `session` from 0 per item.

    An item has at most one package per gap of its history, which bounds what a task sorts.
    """
    from pyspark.sql import Window

    return finished.withColumn("session", F.row_number().over(Window.partitionBy("itemID").orderBy("first_ts")) - 1)


def live_rates(logs: DataFrame, minutes: int = 30, delay: str = DELAY) -> DataFrame:
    """Items per induction in windows of fixed length: start_ts, end_ts, line_name, n_items."""
    messages = with_payload(records_of(logs, fv.ITEM_INDUCTED_CODE), fv.INDUCTION_KEYS)
    named = _watermarked(messages.select(TS, induction_name("inductionNo").alias("line_name")), delay)
    counts = named.groupBy(F.window(TS, f"{minutes} minutes").alias("w"), "line_name").agg(F.count(F.lit(1)).alias("n_items"))
    return counts.select(_plain("w.start").alias("start_ts"), _plain("w.end").alias("end_ts"), "line_name", "n_items")


def rated_windows(finished: DataFrame, minutes: int = 30) -> DataFrame:
    """Finished counts with rate, target, attainment and shortfall; the target is that of the inductions present in the window.

    Windows without any induction that has a target are left out, as in the analysis of one window.
    """
    target = choose_target(finished, "line_name", by=["start_ts"]).where(F.col("target_pph").isNotNull()).withColumnRenamed("target_pph", "_target")
    n, seconds = F.col("n_items"), F.lit(60.0 * minutes)
    rated = rate_columns(n, seconds, F.col("_target"))
    return finished.join(target, "start_ts").select("start_ts", "end_ts", "line_name", "n_items", *[c.alias(k) for k, c in rated.items()])


def _requests(logs: DataFrame) -> DataFrame:
    return first_elements(with_payload(records_of(logs, fv.DESTINATION_REQUEST_CODE), fv.SORT_REPORT_KEYS))


def live_first_requests(logs: DataFrame, delay: str = DELAY, repeat_within: str = "1 hour") -> DataFrame:
    """The first request of each barcode: barcodeAWCS, timeStamp, requestedDestMCID, requests.

    Requests of a barcode no more than `repeat_within` apart are one item; a
    null barcode is a barcode. The row appears when no repeat can come any more.
    """
    rows = _watermarked(_requests(logs), delay)
    first = _earliest(F.struct(F.col(TS).alias("ts"), F.col("requestedDestMCID").alias("mcid")))
    found = rows.groupBy("barcodeAWCS", F.session_window(TS, repeat_within).alias("session")).agg(first.alias("first"), F.count(F.lit(1)).alias("requests"))
    return found.select("barcodeAWCS", _plain("first.ts").alias(TS), F.col("first.mcid").alias("requestedDestMCID"), "requests")


def live_barcodes(logs: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each barcode once, as soon as it appears; it is remembered until the watermark is `delay` past it. Which of its records came first is not told."""
    return _watermarked(_requests(logs), delay).dropDuplicatesWithinWatermark(["barcodeAWCS"]).select("barcodeAWCS")


def run_to_end(stream: DataFrame, sink: str, checkpoint: str) -> dict[str, int]:
    """Work off all files that are there, append finished rows to Parquet files, and stop; a later call goes on with the state left.

    Returns batches, rows read, late rows left out (after merging inside tasks) and rows of state.
    """
    query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    progress = query.recentProgress
    states = [s for p in progress for s in p["stateOperators"]]
    return {
        "batches": len(progress), "rows_read": sum(p["numInputRows"] for p in progress), "late": sum(s["numRowsDroppedByWatermark"] for s in states),
        "state_rows": sum(s["numRowsTotal"] for s in progress[-1]["stateOperators"]) if progress else 0,
    }
