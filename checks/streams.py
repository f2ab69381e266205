"""Streams over log files that arrive in two drops, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import render as r
from checks.catalog import query
from sorterlog import fixed_values as fv
from sorterlog.operators.counts import ranked_counts
from sorterlog.sources.staging import new_folder
from sorterlog.streaming import live

#: Events before this time arrive in the first drop.
HALF = "2024-01-16"
LAST = "301231 000000 000000"


def worked_off(spark: SparkSession, lines: DataFrame, closing: Column, analysis: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Lines (`value`, `ts`) dropped in two parts and then a last record of the far future, each worked off by a run of its own."""
    folder, sink, checkpoint = (new_folder(spark, f"stream-{n}") for n in ("logs", "sink", "state"))
    drops = [lines.where(F.col("ts") < HALF), lines.where(F.col("ts") >= HALF), spark.range(1).select(closing.alias("value"))]
    for drop in drops:
        drop.select("value").write.mode("append").text(folder)
        live.run_to_end(analysis(live.stream_log_monitor(spark, folder)), sink, checkpoint)
    return spark.read.parquet(sink)


def lines_of(rows: DataFrame, ts: str, code: str, number: str, raw: Column) -> DataFrame:
    return rows.select(F.col(ts).alias("ts"), r.log_record(r.stamp_of(ts), F.lit(code), F.col(number), raw).alias("value"))


def closing_record(code: str, pairs: dict[str, Column]) -> Column:
    return r.log_record(F.lit(LAST), F.lit(code), F.lit(0), r.framed(pairs))


@query("stream_sessions", f"""WITH {r.PACKAGE_SQL}
SELECT CAST(item AS VARCHAR) AS item, CAST(packed.session AS BIGINT) AS session, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS records, any_value(pkg_type) AS pkg_type,
  any_value(recirculates) AS recirculates, arg_min(code, rn) AS first_code, arg_min(mcid, rn) AS first_mcid
FROM packed JOIN types USING (pkg) GROUP BY item, packed.session""")
def stream_sessions(spark, sf):
    """Packages of a stream equal those of finished files, also where an item's records lie in both drops."""
    e = r.scan_events(spark, sf)
    raw = r.framed({
        "event": F.lit("SORT"), "plcRecordNo": F.col(r.ORDER), "itemID": F.col("itemID"), "indexNo": F.col("indexNo"), "barcodeAWCS": F.col("barcodeAWCS"),
        "requestedDestMCID": r.bracketed(F.col("requestedDestMCID")), "sortCode": r.bracketed(F.col("sortCode")), "requestedDestStatus": F.lit("[Used]"),
    })
    lines = lines_of(e, "timeStamp", fv.SORT_REPORT_CODE, r.ORDER, raw)
    closing = closing_record(fv.SORT_REPORT_CODE, {"itemID": F.lit("LAST"), "requestedDestMCID": F.lit("[1]"), "sortCode": F.lit("[0]")})
    found = live.number_packages(worked_off(spark, lines, closing, live.live_packages))
    return found.select(
        F.col("itemID").alias("item"), F.col("session").cast("long").alias("session"), "first_ts", "last_ts", "records", "pkg_type", "recirculates", "first_code", "first_mcid",
    )


def sql_list(names: list[str] | tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


@query("stream_rates", f"""
WITH e AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS start_ts, CASE event_type WHEN 'click' THEN 'IU001' WHEN 'view' THEN 'IU002' WHEN 'error' THEN 'IU005'
    WHEN 'purchase' THEN 'SPS001' ELSE 'No Map Yet' END AS line_name FROM events),
c AS (SELECT start_ts, line_name, count(*) AS n_items FROM e GROUP BY ALL),
k AS (SELECT start_ts, count(*) AS n, bool_and(line_name IN {sql_list(fv.SEMI_INDUCTIONS)}) AS all_semi, bool_and(line_name IN {sql_list(fv.AUTO_INDUCTIONS)}) AS all_auto,
    bool_and(line_name IN {sql_list(fv.SPS_INDUCTIONS)}) AS all_sps FROM c WHERE line_name <> 'No Map Yet' GROUP BY 1),
t AS (SELECT start_ts, CAST(CASE WHEN all_semi AND n = 1 THEN {fv.TARGET_SINGLE_SEMI} WHEN all_semi THEN {fv.TARGET_ALL_SEMI} WHEN all_auto AND n = 1 THEN {fv.TARGET_SINGLE_AUTO}
    WHEN all_auto THEN {fv.TARGET_ALL_AUTO} WHEN all_sps THEN {fv.TARGET_SPS} ELSE {(fv.TARGET_ALL_SEMI + fv.TARGET_ALL_AUTO) / 2} END AS DOUBLE) AS target FROM k)
SELECT start_ts, start_ts + INTERVAL 30 MINUTE AS end_ts, line_name, n_items, round(n_items * 2.0::DOUBLE, 4) AS pph_window, round(target, 4) AS target_pph,
  round(n_items * 2.0::DOUBLE / target * 100, 4) AS attainment, n_items * 2.0::DOUBLE >= target AS passed FROM c JOIN t USING (start_ts)""")
def stream_rates(spark, sf):
    """Items and rates per induction in windows of half an hour."""
    e = r.table(spark, sf, "events")
    number = (
        F.when(F.col("event_type") == "click", "0").when(F.col("event_type") == "view", "1")
        .when(F.col("event_type") == "error", "4").when(F.col("event_type") == "purchase", "100").otherwise(F.lit("99"))
    )
    raw = r.framed({"event": F.lit("IND"), "itemID": F.col("user_id"), "inductionNo": number, "carrierNo": F.col("event_id")})
    lines = lines_of(e, "ts", fv.ITEM_INDUCTED_CODE, "event_id", raw)
    closing = closing_record(fv.ITEM_INDUCTED_CODE, {"inductionNo": F.lit("99")})
    found = live.rated_windows(worked_off(spark, lines, closing, live.live_rates))
    return found.select(
        "start_ts", "end_ts", "line_name", "n_items", F.round("pph_window", 4).alias("pph_window"), F.round("target_pph", 4).alias("target_pph"),
        F.round("`attainment_window_%`", 4).alias("attainment"), "passed",
    )


def request_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    """Orders as destination requests: the customer is the barcode, the priority its destination, one minute of January an order."""
    o = r.table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.lit(900) + F.col("o_orderkey") % 40).alias("dest"))
    ts = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, (o_orderkey * 7919 % 40000) * 60)")
    barcode = F.when(F.col("o_custkey") % 50 != 0, F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    rows = o.select("*", ts.alias("ts"), barcode.alias("barcode"))
    raw = F.concat(F.lit("->{plcRecordNo:"), F.col("o_orderkey").cast("string"), F.when(F.col("barcode").isNotNull(), F.concat(F.lit(",barcodeAWCS:"), "barcode")).otherwise(F.lit("")),
                   F.lit(",requestedDestMCID:["), F.col("dest").cast("string"), F.lit("],sortCode:[0]}<"))
    return lines_of(rows, "ts", fv.DESTINATION_REQUEST_CODE, "o_orderkey", raw), closing_record(fv.DESTINATION_REQUEST_CODE, {"barcodeAWCS": F.lit("LAST")})


REQUEST_SQL = """
o AS (SELECT o_orderkey AS n, CASE WHEN o_custkey % 50 <> 0 THEN 'C' || o_custkey END AS barcode, 900 + o_orderkey % 40 AS dest, o_orderkey * 7919 % 40000 AS minute FROM orders),
gaps AS (SELECT *, CASE WHEN minute - lag(minute) OVER (PARTITION BY barcode ORDER BY minute, n) > 1440 THEN 1 ELSE 0 END AS opened FROM o),
items AS (SELECT *, sum(opened) OVER (PARTITION BY barcode ORDER BY minute, n ROWS UNBOUNDED PRECEDING) AS item FROM gaps),
firsts AS (SELECT *, row_number() OVER (PARTITION BY barcode, item ORDER BY minute, n) AS place FROM items)"""


@query("stream_first_requests", f"""WITH {REQUEST_SQL}
SELECT CAST(dest AS VARCHAR) AS destination, count(*) AS "count" FROM firsts WHERE place = 1 GROUP BY 1""")
def stream_first_requests(spark, sf):
    """Destination counts over the first request of each barcode; requests up to a day apart are one item."""
    lines, closing = request_lines(spark, sf)
    found = worked_off(spark, lines, closing, lambda logs: live.live_first_requests(logs, repeat_within="1 day"))
    return ranked_counts(found, "requestedDestMCID").select(F.col("requestedDestMCID").alias("destination"), "count")


@query("stream_barcodes", """
SELECT CASE WHEN o_custkey % 50 <> 0 THEN 'C' || o_custkey END AS barcode FROM orders GROUP BY 1 UNION ALL SELECT 'LAST'""")
def stream_barcodes(spark, sf):
    """Each barcode once over both drops."""
    lines, closing = request_lines(spark, sf)
    return worked_off(spark, lines, closing, lambda logs: live.live_barcodes(logs, "60 days")).select(F.col("barcodeAWCS").alias("barcode"))
