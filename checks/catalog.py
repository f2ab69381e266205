"""Queries over the supplied tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import render as r
from sorterlog import fixed_values as fv
from sorterlog.functions import clock, fields, payload
from sorterlog.operators import alarms as al
from sorterlog.operators import columns as co
from sorterlog.operators import counts as ct
from sorterlog.operators import fixes as fx
from sorterlog.operators import package_metrics as pm
from sorterlog.operators import quantiles as qu
from sorterlog.operators import rates as ra
from sorterlog.operators import spacing as sp
from sorterlog.operators.lookup import add_destinations, add_sort_reason, build_mapping
from sorterlog.operators.ordered import first_rows
from sorterlog.operators.packages import PACKAGE, assign_packages, assign_sessions, package_id, package_table
from sorterlog.operators.timewindow import resolve_window, stamp_validity, time_bounds
from sorterlog.plans import alarm_reports, messages
from sorterlog.plans.induction import induction_rate, single_line_rate
from sorterlog.plans.measurements import MEASURES, measurement_rows
from sorterlog.plans.sort_report import s04_analysis
from sorterlog.sources.staging import stage
from sorterlog.sources.logs import ORDER, read_flat_export, read_lines, read_log_monitor, split_fields

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# ---- sessions and packages ------------------------------------------------

@query("sessionize_events", f"""WITH {r.PACKAGE_SQL}
SELECT ord AS event_id, item AS user_id, session, pkg AS package_id FROM packed""")
def sessionize_events(spark, sf):
    events = r.table(spark, sf, "events").select("event_id", "user_id", "ts")
    rows = assign_sessions(events, "user_id", "ts")
    return rows.select("event_id", "user_id", "session", package_id("user_id", "session").alias("package_id"))


@query("package_rows", f"""WITH {r.PACKAGE_SQL}
SELECT ord AS event_id, pkg AS package_id, pkg_type FROM packed JOIN types USING (pkg)""")
def package_rows(spark, sf):
    rows = assign_packages(r.scan_events(spark, sf))
    return rows.select(F.col(ORDER).alias("event_id"), F.col(PACKAGE).alias("package_id"), "pkg_type")


@query("package_types", f"""WITH {r.PACKAGE_SQL}
SELECT pkg AS package_id, pkg_type, records, recirculates FROM types""")
def package_types(spark, sf):
    return package_table(r.scan_events(spark, sf)).select(
        F.col(PACKAGE).alias("package_id"), "pkg_type", "records", "recirculates"
    )


@query("scanner_metrics", f"""WITH {r.PACKAGE_SQL}
SELECT 'total_packages' AS metric, count(*) AS "count" FROM types
UNION ALL SELECT 'normal_packages', count(*) FROM types WHERE pkg_type = 'normal'
UNION ALL SELECT 'no_read_packages', count(*) FROM types WHERE pkg_type = 'no_read'
UNION ALL SELECT 'multi_read_packages', count(*) FROM types WHERE pkg_type = 'multi_read'""")
def scanner_metrics(spark, sf):
    return pm.scanner_metrics(package_table(r.scan_events(spark, sf)))


@query("recirculation", f"""WITH {r.PACKAGE_SQL}
SELECT count(*) AS recirculation_packages FROM types WHERE recirculates""")
def recirculation(spark, sf):
    return pm.recirculation_count(package_table(r.scan_events(spark, sf)))


KEPT_SQL = r.PACKAGE_SQL + """,
kept AS (SELECT *, row_number() OVER (PARTITION BY pkg ORDER BY ts, ord) AS krn FROM packed WHERE NOT recirc)"""


@query("package_sort_counts", f"""WITH {KEPT_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", count(*) AS "count" FROM kept WHERE krn = 1 GROUP BY 1 HAVING "sortReason" IS NOT NULL""")
def package_sort_counts(spark, sf):
    return pm.sort_counts(package_table(r.scan_events(spark, sf)))


@query("package_reason_destinations", f"""WITH {KEPT_SQL}, {r.MAPPING_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", amazon AS "Amazon_Destination", count(*) AS "count"
FROM kept JOIN mapping ON mcid = id WHERE krn = 1 AND amazon IS NOT NULL GROUP BY 1, 2 HAVING "sortReason" IS NOT NULL""")
def package_reason_destinations(spark, sf):
    mapping = build_mapping(r.destination_mapping(spark, sf))
    return pm.reason_destination_counts(package_table(r.scan_events(spark, sf)), mapping)


DEFECT_SQL = """
, cats AS ({cats}), total AS (SELECT count(*) AS t FROM ({units}))
SELECT "defectCategory", "count", round("count" * 100.0 / t, 4) AS percentage FROM (
  SELECT cat AS "defectCategory", count(*) AS "count" FROM cats WHERE cat IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'No Defect', (SELECT t FROM total) - (SELECT count(*) FROM cats WHERE cat IS NOT NULL)), total"""


@query("defect_metrics", f"WITH {r.PACKAGE_SQL}" + DEFECT_SQL.format(
    cats=f"SELECT {r.category_sql('code')} AS cat FROM packed WHERE rn = 1", units="SELECT * FROM types"))
def defect_metrics(spark, sf):
    return pm.defect_metrics(package_table(r.scan_events(spark, sf)))


@query("jackpot_metrics", f"""WITH {r.PACKAGE_SQL}, {r.MAPPING_SQL}
SELECT beumer AS "Beumer_Destination", amazon AS "Amazon_Destination", count(DISTINCT pkg) AS unique_packages
FROM packed JOIN mapping ON mcid = id WHERE code = 0 AND jackpot = 'jackpot' AND amazon IS NOT NULL GROUP BY 1, 2""")
def jackpot_metrics(spark, sf):
    mapping = build_mapping(r.destination_mapping(spark, sf))
    return pm.jackpot_metrics(pm.jackpot_packages(r.scan_events(spark, sf), mapping))


@query("jackpot_total", f"""WITH {r.PACKAGE_SQL}, {r.MAPPING_SQL}
SELECT count(DISTINCT pkg) AS jackpot_packages FROM packed JOIN mapping ON mcid = id WHERE code = 0 AND jackpot = 'jackpot'""")
def jackpot_total(spark, sf):
    mapping = build_mapping(r.destination_mapping(spark, sf))
    return pm.jackpot_total(pm.jackpot_packages(r.scan_events(spark, sf), mapping))


@query("run_summary", f"""WITH {r.PACKAGE_SQL}
SELECT (SELECT count(*) FROM events) AS "S04_processed", count(*) AS package_processed, count(*) AS unique_packages,
       CAST(sum(CASE WHEN recirculates THEN 1 ELSE 0 END) AS BIGINT) AS recirculation_packages,
       CAST(sum(CASE WHEN records > 1 THEN records ELSE 0 END) AS BIGINT) AS recirculation_records FROM types""")
def run_summary(spark, sf):
    return pm.run_summary(r.table(spark, sf, "events"), package_table(r.scan_events(spark, sf)))


@query("sort_report_from_lines", f"WITH {r.PACKAGE_SQL}" + DEFECT_SQL.format(
    cats=f"SELECT {r.category_sql('code')} AS cat FROM packed WHERE rn = 1", units="SELECT * FROM types"))
def sort_report_from_lines(spark, sf):
    """The whole path: raw lines, fields, payload, lists, window, packages, defects."""
    return s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True)["defect_metrics"]


# ---- parsing --------------------------------------------------------------

@query("message_roundtrip", """
WITH base AS (SELECT l_orderkey, l_suppkey, l_partkey, CAST(l_quantity AS BIGINT) % 23 AS code, l_linenumber FROM lineitem)
SELECT CAST(l_orderkey AS VARCHAR) AS "itemID", l_suppkey AS "requestedDestMCID", code AS "sortCode", 'Unused' AS status, 0 AS place FROM base
UNION ALL
SELECT CAST(l_orderkey AS VARCHAR), l_partkey, CAST(l_linenumber AS BIGINT), 'Unused', 1 FROM base WHERE l_linenumber % 3 <> 0""")
def message_roundtrip(spark, sf):
    li = r.table(spark, sf, "lineitem")
    code = F.col("l_quantity").cast("bigint") % 23
    codes = F.when(F.col("l_linenumber") % 3 == 0, r.bracketed(code)).otherwise(r.bracketed(code, F.col("l_linenumber")))
    raw = r.framed({
        "event": F.lit("SORT"), "itemID": F.lit("old"), "barcodeAWCS": F.col("l_partkey"),
        "requestedDestMCID": r.bracketed(F.col("l_suppkey"), F.col("l_partkey")), "sortCode": codes,
        "requestedDestStatus": F.lit("[Used,FromAwcs]"), "junk": F.lit("x,nothing"), "itemID ": F.col("l_orderkey"),
    })
    path = r.log_files(li.select(raw.alias("value")), "messages")
    lines = split_fields(read_lines(spark, path), ["rawMessage"])
    rows = messages.explode_destinations(messages.with_payload(lines, fv.SORT_REPORT_KEYS, scrubbed=False))
    return rows.select(
        "itemID", "requestedDestMCID", "sortCode", F.col("requestedDestStatus").alias("status"),
        F.col(f"{ORDER}.place").alias("place"),
    )


@query("raw_line_scan", """
SELECT CAST(event_id AS VARCHAR) AS seq, ts AS stamp, event_type AS payload FROM events
WHERE event_id % 4 <> 0 AND event_id % 10 <> 9 AND event_id % 10 <> 8
UNION ALL
SELECT CAST(event_id AS VARCHAR), NULL, event_type FROM events WHERE event_id % 4 <> 0 AND event_id % 10 = 8""")
def raw_line_scan(spark, sf):
    e = r.table(spark, sf, "events")
    code = F.when(F.col("event_id") % 4 == 0, "54163").otherwise(F.lit(" 54 177"))
    stamp = F.when(F.col("event_id") % 10 == 8, F.lit("bad")).otherwise(r.stamp_of("ts"))
    line = r.log_record(stamp, code, F.col("event_id"), F.concat(F.lit("->{"), F.col("event_type"), F.lit("}<")))
    line = F.when(F.col("event_id") % 10 == 9, F.concat(line, F.lit(";x"))).otherwise(F.concat(line, F.lit("\0")))
    logs = split_fields(e.select(line.alias("value")))
    rows = messages.records_of(logs, fv.SORT_REPORT_CODE)
    return rows.select(
        F.col("sequenceNo").alias("seq"), F.col("timeStamp").alias("stamp"), payload.strip_frame("rawMessage").alias("payload")
    )


@query("message_code_counts", """
SELECT count(*) FILTER (event_id % 4 <> 0) AS kept, count(*) FILTER (event_id % 4 = 0) AS dropped FROM events""")
def message_code_counts(spark, sf):
    code = F.when(F.col("event_id") % 4 == 0, "54163").otherwise(F.lit("54177"))
    e = r.table(spark, sf, "events")
    line = r.log_record(r.stamp_of("ts"), code, F.col("event_id"), F.lit("->{a:1}<"))
    return messages.filter_counts(split_fields(e.select(line.alias("value"))), fv.SORT_REPORT_CODE)


@query("payload_keys", "SELECT DISTINCT event_type AS key FROM events UNION SELECT 'value' FROM events")
def payload_keys(spark, sf):
    e = r.table(spark, sf, "events")
    raw = F.concat(F.lit("->{"), F.col("event_type"), F.lit(":[1,2],value:"), F.col("value").cast("string"), F.lit("}<"))
    return messages.payload_keys(e.select(raw.alias("rawMessage")))


@query("first_elements", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey + 1 END AS literal_id,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_suppkey + 1 AS VARCHAR) ELSE lpad(CAST(l_suppkey + 1 AS VARCHAR), 6, '0') END AS first_text,
       CAST(l_quantity AS BIGINT) AS code FROM lineitem""")
def first_elements(spark, sf):
    li = r.table(spark, sf, "lineitem")
    ids = F.when(F.col("l_linenumber") % 2 == 0, r.bracketed((F.col("l_suppkey") + 1), F.lit(1))).otherwise(
        r.bracketed(F.format_string("%06d", (F.col("l_suppkey") + 1)), F.lit(1)))
    return li.select(
        "l_orderkey", "l_linenumber", payload.first_int(ids).alias("literal_id"), payload.first_literal(ids).alias("first_text"),
        fields.to_int(payload.first_text(r.bracketed(F.col("l_quantity").cast("bigint"), F.lit(7)))).alias("code"),
    )


@query("nested_pairs", """
SELECT event_id, '[' || user_id || ',[' || event_type || ',x]]' AS nested, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS last_value FROM events""")
def nested_pairs(spark, sf):
    e = r.table(spark, sf, "events")
    text = F.concat(F.lit("k:["), F.col("user_id"), F.lit(",["), F.col("event_type"), F.lit(",x]],v:old,,v:"),
                    F.col("value").cast("decimal(18,2)").cast("string"), F.lit(","))
    pairs = e.select("event_id", payload.key_value_pieces(payload.split_pairs(text)).alias("p")).select(
        "event_id", payload.keys_of("p").alias("k"), payload.values_of("p").alias("v"))
    return pairs.select(
        "event_id", payload.value_of("k", "v", "k").alias("nested"),
        payload.value_of("k", "v", "v").try_cast("double").alias("last_value"),
    )


@query("lenient_stamps", """
SELECT event_id, date_trunc('millisecond', ts) AS full_stamp, date_trunc('second', ts) AS short_stamp FROM events""")
def lenient_stamps(spark, sf):
    e = r.table(spark, sf, "events")
    text = F.date_format("ts", "yyMMdd HHmmss SSS")
    return e.select(
        "event_id", clock.parse_stamp_lenient(text).alias("full_stamp"),
        clock.parse_stamp_lenient(F.substring(text, 1, 13)).alias("short_stamp"),
    )


# ---- lookups and counts ---------------------------------------------------

def coded_lineitems(spark, sf):
    li = r.table(spark, sf, "lineitem")
    return li.select(
        (F.col("l_quantity").cast("bigint") % 25).alias("sortCode"),
        (F.lit(2990) + F.col("l_suppkey") % 30).cast("bigint").alias("requestedDestMCID"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_returnflag",
    )


CODED_SQL = """
coded AS (SELECT CAST(l_quantity AS BIGINT) % 25 AS code, 2990 + l_suppkey % 30 AS mcid, l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem)"""


@query("sort_reason_counts", f"""WITH {CODED_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", count(*) AS "count" FROM coded GROUP BY 1 HAVING "sortReason" IS NOT NULL""")
def sort_reason_counts(spark, sf):
    return ct.ranked_counts(add_sort_reason(coded_lineitems(spark, sf)), "sortReason")


@query("sort_reason_counts_with_null", f"""WITH {CODED_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", count(*) AS "count" FROM coded GROUP BY 1""")
def sort_reason_counts_with_null(spark, sf):
    return ct.ranked_counts(add_sort_reason(coded_lineitems(spark, sf)), "sortReason", keep_null=True)


NAMED = [f"NATION_{k}_B" if k < 3 else f"NATION_{k}" for k in range(25) if k != 7]


@query("reason_dest_pivot", f"""WITH {CODED_SQL}, {r.MAPPING_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", {", ".join(f"count(*) FILTER (amazon = '{n}') AS \"{n}\"" for n in NAMED)}
FROM coded JOIN mapping ON mcid = id WHERE amazon IS NOT NULL GROUP BY 1 HAVING "sortReason" IS NOT NULL""")
def reason_dest_pivot(spark, sf):
    """Every named destination of the mapping is a column."""
    mapping = build_mapping(r.destination_mapping(spark, sf))
    named = add_destinations(add_sort_reason(coded_lineitems(spark, sf)), mapping)
    counts = ct.group_size(named, "sortReason", "Amazon_Destination")
    return ct.pivot_counts(counts, "sortReason", "Amazon_Destination", columns=NAMED)


@query("destination_enrichment", f"""WITH {CODED_SQL}, {r.MAPPING_SQL}
SELECT l_orderkey, l_linenumber, mcid AS "requestedDestMCID",
  CASE WHEN mcid BETWEEN 3000 AND 3999 THEN 'Recirculation' ELSE amazon END AS "Amazon_Destination",
  CASE WHEN mcid BETWEEN 3000 AND 3999 THEN 'Recirculation' ELSE beumer END AS "Beumer_Destination",
  CASE WHEN jackpot IS NOT NULL THEN ' JackPot ' END AS "Jackpot_Destination"
FROM coded LEFT JOIN mapping ON mcid = id""")
def destination_enrichment(spark, sf):
    rows = coded_lineitems(spark, sf).select("l_orderkey", "l_linenumber", "requestedDestMCID")
    return add_destinations(rows, build_mapping(r.destination_mapping(spark, sf)), recirculation=True)


@query("row_defect_metrics", f"WITH {CODED_SQL}" + DEFECT_SQL.format(
    cats=f"SELECT {r.category_sql('code')} AS cat FROM coded", units="SELECT * FROM coded"))
def row_defect_metrics(spark, sf):
    return pm.row_defect_metrics(add_sort_reason(coded_lineitems(spark, sf)))


@query("success_destinations", f"""WITH {CODED_SQL}
SELECT mcid AS "requestedDestMCID", count(*) AS "count" FROM coded WHERE code = 0 AND mcid IN (2995, 3001) GROUP BY 1""")
def success_destinations(spark, sf):
    rows = coded_lineitems(spark, sf)
    return ct.ranked_counts(rows.where((F.col("sortCode") == 0) & F.col("requestedDestMCID").isin(2995, 3001)), "requestedDestMCID")


@query("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def first_per_key(spark, sf):
    orders = r.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return first_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("destination_counts", """
SELECT o_orderpriority, count(*) AS "count" FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1 GROUP BY 1""")
def destination_counts(spark, sf):
    orders = r.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    return ct.ranked_counts(first_rows(orders, ["o_custkey"], ["o_orderkey"]), "o_orderpriority")


@query("repeated_keys", """SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY 1 HAVING count(*) > 1""")
def repeated_keys(spark, sf):
    return ct.repeated_values(r.table(spark, sf, "orders"), "o_custkey")


@query("barcode_repetition", """
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT count(*) AS distinct_values, count(*) FILTER (n > 1) AS repeated_values,
  CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS repeated_records, count(*) FILTER (n = 1) AS single_values,
  max(n) AS max_occurrences, min(n) AS min_occurrences FROM c""")
def barcode_repetition(spark, sf):
    return ct.repetition_profile(r.table(spark, sf, "orders"), "o_custkey")


@query("barcode_scan_metrics", f"""WITH {r.SCAN_SQL}, m AS (
SELECT count(DISTINCT barcode) FILTER (barcode NOT IN ('????', '9999')) AS n, count(DISTINCT item) FILTER (barcode = '????') AS q,
  count(DISTINCT item) FILTER (barcode = '9999') AS k FROM scan)
SELECT n AS normal_packages, q AS no_read_packages, k AS multi_read_packages, n + q + k AS total_packages FROM m""")
def barcode_scan_metrics(spark, sf):
    return pm.barcode_scan_metrics(r.scan_events(spark, sf))


# ---- corrections ----------------------------------------------------------

FIXED_SQL = f"""WITH {r.SCAN_SQL}, {r.FIX_SQL},
cand AS (SELECT ord, indexno, row_number() OVER (PARTITION BY indexno ORDER BY ord) AS k FROM scan WHERE code IN (8, 9, 10)),
hits AS (SELECT cand.ord, comment FROM cand JOIN fixes ON indexno = id AND cand.k = fixes.k)"""


@query("false_positive_fix", FIXED_SQL + """
SELECT scan.ord AS event_id, CASE WHEN hits.ord IS NOT NULL THEN 0 ELSE code END AS "sortCode", coalesce(comment, '') AS explanation
FROM scan LEFT JOIN hits ON scan.ord = hits.ord""")
def false_positive_fix(spark, sf):
    fixed = fx.fix_by_occurrence(r.scan_events(spark, sf), r.fix_list(spark, sf))
    return fixed.select(F.col(ORDER).alias("event_id"), "sortCode", F.col(fx.EXPLANATION).alias("explanation"))


@query("membership_fix", f"""WITH {r.SCAN_SQL}, {r.FIX_SQL},
last AS (SELECT id, arg_max(comment, pos) AS comment FROM fixes GROUP BY 1)
SELECT ord AS event_id, CASE WHEN id IS NOT NULL THEN 0 ELSE code END AS "sortCode", coalesce(comment, '') AS explanation
FROM scan LEFT JOIN last ON indexno = id""")
def membership_fix(spark, sf):
    fixed = fx.fix_by_membership(r.scan_events(spark, sf), r.fix_list(spark, sf))
    return fixed.select(F.col(ORDER).alias("event_id"), "sortCode", F.col(fx.EXPLANATION).alias("explanation"))


@query("unapplied_ids", FIXED_SQL + """
SELECT id, count(*) AS listings FROM fixes WHERE id NOT IN (SELECT indexno FROM cand) GROUP BY 1""")
def unapplied_ids(spark, sf):
    left = fx.unapplied_ids(r.scan_events(spark, sf), r.fix_list(spark, sf))
    return left.groupBy("id").agg(F.count(F.lit(1)).alias("listings"))


@query("scan_defects", f"""WITH {r.SCAN_SQL}
SELECT indexno AS "indexNo", ts AS "timeStamp", code AS "sortCode" FROM scan WHERE code IN (8, 9, 10)""")
def scan_defects(spark, sf):
    return fx.scan_defects(r.scan_events(spark, sf))


# ---- alarms ---------------------------------------------------------------

def alarm_sql(kind: str, where: str = "TRUE", extra: str = "", times: str = "1") -> str:
    return f"""WITH {r.ALARM_SQL}, g AS (
  SELECT kind || num AS device, count(*) AS n, coalesce(sum(secs), 0) AS total, avg(secs) AS mean, max(secs) AS top
  FROM alarms WHERE kind = '{kind}' AND {where} GROUP BY 1)
SELECT device, CAST(n AS BIGINT) AS alarm_count, CAST(total AS DOUBLE) AS total_seconds, round(mean, 4) AS mean_seconds,
  CAST(top AS DOUBLE) AS max_seconds, {r.hms_sql('total')} AS total_duration, {r.hms_sql('mean')} AS average_duration,
  {r.hms_sql('top')} AS max_duration FROM g"""


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


@query("device_alarm_summary", alarm_sql("DBS"))
def device_alarm_summary(spark, sf):
    return rounded(alarm_reports.alarm_summary(r.alarm_history(spark, sf), "DBS"), 4, "mean_seconds")


@query("alignment_alarm_summary", alarm_sql("IAS"))
def alignment_alarm_summary(spark, sf):
    return rounded(alarm_reports.alarm_summary(r.alarm_history(spark, sf), "IAS"), 4, "mean_seconds")


@query("estop_alarm_summary", alarm_sql("ES", "grp = 'ES'"))
def estop_alarm_summary(spark, sf):
    return rounded(alarm_reports.alarm_summary(r.alarm_history(spark, sf), "ES"), 4, "mean_seconds")


def device_names(spark, sf):
    """Suppliers as a device mapping: unit names repeat, so rows fan out."""
    s = r.table(spark, sf, "supplier")
    return s.select(
        F.concat(F.lit("CHU"), F.format_string("%03d", F.col("s_suppkey") % 31)).alias("Beumer"),
        F.when(F.col("s_suppkey") % 4 != 0, F.col("s_name")).alias("Amazon"), F.col("s_suppkey").alias("_pos"),
    )


NAMES_SQL = """
names AS (SELECT 'CHU' || lpad(CAST(s_suppkey % 31 AS VARCHAR), 3, '0') AS beumer,
                 CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS amazon, s_suppkey AS pos FROM supplier)"""


@query("chute_jam_summary", f"""WITH {r.ALARM_SQL}, {NAMES_SQL}, j AS (
  SELECT kind || num AS device, secs, amazon, pos FROM alarms LEFT JOIN names ON kind || num = beumer WHERE kind = 'CHU'),
g AS (SELECT device, count(*) AS n, coalesce(sum(secs), 0) AS total, avg(secs) AS mean, max(secs) AS top,
  arg_min(amazon, pos) FILTER (amazon IS NOT NULL) AS amazon FROM j GROUP BY 1)
SELECT device AS "Beumer", amazon AS "Amazon", CAST(n AS BIGINT) AS "Jam Count", {r.hms_sql('total')} AS "Total Duration",
  {r.hms_sql('mean')} AS "Average Duration", {r.hms_sql('top')} AS "Max Duration" FROM g""")
def chute_jam_summary(spark, sf):
    report = alarm_reports.alarm_summary(r.alarm_history(spark, sf), "CHU", device_names(spark, sf))
    return alarm_reports.printable(report, "CHU")


@query("alarm_occurrences", f"""WITH {NAMES_SQL}, occ AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN 'IU' ELSE 'CHU' END || lpad(CAST(p_partkey % 37 AS VARCHAR), 3, '0') AS part,
    CASE WHEN p_size % 2 = 0 THEN 'Jam ' ELSE 'Stop ' END || p_brand AS message, CAST(p_size AS VARCHAR) AS duration,
    CAST(p_partkey AS VARCHAR) AS occurrences FROM part)
SELECT 1 AS section, CASE WHEN amazon IS NULL THEN beumer ELSE beumer || ' - ' || amazon END AS "MappingString",
  occurrences AS "Occurrences", duration AS "Duration", NULL AS "Part", NULL AS "Message"
FROM occ LEFT JOIN names ON part = beumer WHERE part LIKE 'CHU%' AND message LIKE '%Jam%'
UNION ALL SELECT 3, NULL, occurrences, duration, part, message FROM occ WHERE part LIKE 'IU%'""")
def alarm_occurrences(spark, sf):
    p = r.table(spark, sf, "part")
    unit = F.concat(F.when(F.col("p_partkey") % 3 == 0, "IU").otherwise(F.lit("CHU")), F.format_string("%03d", F.col("p_partkey") % 37))
    occurrences = p.select(
        F.concat(F.lit("=CBS01."), unit, F.lit("+S001")).alias("Part"),
        F.concat(F.when(F.col("p_size") % 2 == 0, "Jam ").otherwise(F.lit("Stop ")), F.col("p_brand")).alias("Message"),
        F.col("p_size").cast("string").alias("Duration"), F.col("p_partkey").cast("string").alias("Occurrences"),
    )
    return alarm_reports.alarm_occurrences(occurrences, device_names(spark, sf))


CARRIER_SQL = """
carriers AS (SELECT 'CA' || (o_custkey % 211) AS part, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Disabled'
  WHEN o_orderpriority = '2-HIGH' THEN 'Item on bellows is active' WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'Other' END AS txt FROM orders)"""


def carrier_table(spark, sf):
    o = r.table(spark, sf, "orders")
    p = F.col("o_orderpriority")
    return o.select(
        F.concat(F.lit("CA"), (F.col("o_custkey") % 211).cast("string")).alias("Part name"),
        F.when(p == "1-URGENT", "Disabled").when(p == "2-HIGH", "Item on bellows is active")
        .when(p == "5-LOW", F.lit(None).cast("string")).otherwise(F.lit("Other")).alias("Alarm text"),
    )


@query("carrier_alarms", f"""WITH {CARRIER_SQL}
SELECT part, count(txt) AS total_alarms, count(*) FILTER (txt = 'Disabled') AS disabled_count,
  count(*) FILTER (txt LIKE 'Item%') AS bellows_active_count,
  count(*) FILTER (txt = 'Disabled') + count(*) FILTER (txt LIKE 'Item%') AS target_alarms_total,
  substr(part, 3) AS carrier_number, lpad(substr(part, 3), 4, '0') AS carrier_formatted FROM carriers GROUP BY part""")
def carrier_alarms(spark, sf):
    return alarm_reports.carrier_alarms(carrier_table(spark, sf))["summary"]


@query("carrier_targets_by_text", f"""WITH {CARRIER_SQL}
SELECT txt AS "text", part, count(*) AS "count" FROM carriers WHERE txt IN ('Disabled', 'Item on bellows is active') GROUP BY 1, 2""")
def carrier_targets_by_text(spark, sf):
    return alarm_reports.carrier_alarms(carrier_table(spark, sf))["targeted_by_text_and_part"]


@query("carrier_target_total", f"""WITH {CARRIER_SQL}
SELECT count(*) AS total FROM carriers WHERE txt IN ('Disabled', 'Item on bellows is active')""")
def carrier_target_total(spark, sf):
    return alarm_reports.carrier_alarms(carrier_table(spark, sf))["targeted_total"]


@query("alarm_share", f"""WITH {CARRIER_SQL}
SELECT txt AS "text", count(*) AS "count", round(count(*) * 100.0 / (SELECT count(txt) FROM carriers), 2) AS percentage
FROM carriers WHERE txt IS NOT NULL GROUP BY 1""")
def alarm_share(spark, sf):
    return alarm_reports.carrier_alarms(carrier_table(spark, sf))["text_shares"]


# ---- windows and rates ----------------------------------------------------

@query("time_bounds", """SELECT min(ts) AS start_ts, max(ts) AS end_ts, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS delta_seconds FROM events""")
def time_bounds_query(spark, sf):
    return time_bounds(r.table(spark, sf, "events"), "ts")


@query("stamp_validity", "SELECT count(ts) AS valid_rows, count(*) - count(ts) AS invalid_rows FROM events")
def stamp_validity_query(spark, sf):
    return stamp_validity(r.table(spark, sf, "events"), "ts")


@query("window_default", """
SELECT event_id FROM events WHERE ts <= (SELECT min(ts) FROM events) + INTERVAL 1 DAY""")
def window_default(spark, sf):
    return resolve_window(r.table(spark, sf, "events").select("event_id", "ts"), minutes=1440, ts="ts").rows.select("event_id")


@query("window_clamped", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-29 12:00:00'")
def window_clamped(spark, sf):
    rows = r.table(spark, sf, "events").select("event_id", "ts")
    return resolve_window(rows, datetime(2024, 1, 29, 12), datetime(2025, 1, 1), ts="ts").rows.select("event_id")


INDUCTION_SQL = """
w AS (SELECT CASE event_type WHEN 'click' THEN 'IU001' WHEN 'view' THEN 'IU002' WHEN 'error' THEN 'IU005'
             WHEN 'purchase' THEN 'SPS001' ELSE 'No Map Yet' END AS ind
      FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'),
c AS (SELECT ind, count(*) AS n, (9119.0::DOUBLE / 4 + 7351.0::DOUBLE / 3) / 2 AS target, 604800.0::DOUBLE AS s FROM w GROUP BY 1),
rate AS (SELECT ind AS line_name, n AS n_items, round(s / 60, 4) AS window_minutes, round(n / s, 6) AS items_per_sec,
  round(n / s * 3600, 4) AS pph_window, round(target, 4) AS target_pph, round(n / s * 3600 / target * 100, 4) AS attainment,
  CAST(ceil(target / 3600 * s) AS BIGINT) AS needed, greatest(0, CAST(ceil(target / 3600 * s) AS BIGINT) - n) AS short,
  round(s / n, 4) AS sec_per_bag, n / s * 3600 >= target AS passed, '0000-0000AM' AS time_label,
  ind || ';Measuring Point: MP1000605: Time 0000-0000AM; Total Inducted = ' || n AS summary_line FROM c)"""


def induction_lines(spark, sf):
    e = r.table(spark, sf, "events")
    number = (
        F.when(F.col("event_type") == "click", "0").when(F.col("event_type") == "view", "1")
        .when(F.col("event_type") == "error", "4").when(F.col("event_type") == "purchase", "100").otherwise(F.lit("99"))
    )
    raw = r.framed({"event": F.lit("IND"), "itemID": F.col("user_id"), "inductionNo": number, "carrierNo": F.col("event_id")})
    line = r.log_record(r.stamp_of("ts"), F.lit(fv.ITEM_INDUCTED_CODE), F.col("event_id"), raw)
    return read_log_monitor(spark, r.log_files(e.select(line.alias("value")), "induction-lines"))


def induction_table(spark, sf):
    window = {"start": datetime(2024, 1, 5), "end": datetime(2024, 1, 12)}
    table = induction_rate(induction_lines(spark, sf), **window)["rate_analysis"]
    return rounded(table, 4, "window_minutes", "pph_window", "target_pph", "attainment_window_%", "sec_per_bag_current")


@query("induction_rate", f"WITH {INDUCTION_SQL} SELECT * FROM rate")
def induction_rate_query(spark, sf):
    return induction_table(spark, sf).where(F.col("line_name") != "All Inductions").select(
        "line_name", "n_items", "window_minutes", F.round("items_per_sec", 6).alias("items_per_sec"), "pph_window", "target_pph",
        F.col("`attainment_window_%`").alias("attainment"), F.col("needed_items_for_pass").alias("needed"),
        F.col("items_short").alias("short"), F.col("sec_per_bag_current").alias("sec_per_bag"), "passed", "time_label", "summary_line",
    )


@query("rate_total", f"""WITH {INDUCTION_SQL}
SELECT 'All Inductions' AS line_name, CAST(sum(n) AS BIGINT) AS n_items, round(sum(n / s * 3600), 4) AS pph_window,
  round(max(target) * count(*), 4) AS target_pph, round(sum(n / s * 3600) / (max(target) * count(*)) * 100, 4) AS attainment FROM c""")
def rate_total(spark, sf):
    return induction_table(spark, sf).where(F.col("line_name") == "All Inductions").select(
        "line_name", "n_items", "pph_window", "target_pph", F.col("`attainment_window_%`").alias("attainment"))


@query("line_rate", """
WITH d AS (SELECT count(*) AS valid_rows, epoch_us(max(ts)) - epoch_us(min(ts)) AS us,
  count(*) FILTER (ts BETWEEN TIMESTAMP '2024-01-10 08:00:00' AND TIMESTAMP '2024-01-10 18:00:00') AS n FROM events)
SELECT valid_rows, n AS n_items, round(n * 3600 / (us / 1e6), 4) AS pph_overall, round(n * 3600 / 36000.0::DOUBLE, 4) AS pph_window,
  CAST(24500 AS BIGINT) AS needed, 24500 - n AS short, round(36000.0::DOUBLE / n, 4) AS sec_per_bag, FALSE AS passed, '0800-1800PM' AS time_label
FROM d""")
def line_rate(spark, sf):
    e = r.table(spark, sf, "events")
    line = F.concat_ws(";", *[F.concat(F.lit('"'), c, F.lit(' "')) for c in (
        r.stamp_of("ts"), F.lit("I"), F.lit("S"), F.lit("h"), F.lit("m"), F.lit(""), F.lit(""), F.lit("1"), F.lit("2"), F.lit("3"),
        F.lit("4"), F.lit("5"), F.col("event_type"))])
    export = read_flat_export(spark, r.log_files(e.select(line.alias("value")), "flat-export"), width=13)
    rate = single_line_rate(export, datetime(2024, 1, 10, 8), minutes=600)["rate"]
    return rate.select(
        "valid_rows", "n_items", F.round("pph_overall", 4).alias("pph_overall"), F.round("pph_window", 4).alias("pph_window"),
        F.col("needed_items_for_pass").alias("needed"), F.col("items_short").alias("short"),
        F.round("sec_per_bag_current", 4).alias("sec_per_bag"), "passed", "time_label",
    )


# ---- spacing and gaps -----------------------------------------------------

DIFF_SQL = """
d AS (SELECT event_id, event_type, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) / 1000000.0::DOUBLE AS diff FROM events)"""


def typed_events(spark, sf):
    return r.table(spark, sf, "events").select("event_id", "event_type", "ts")


def event_spacings(spark, sf):
    return stage(sp.interarrival_counts(typed_events(spark, sf), "event_type", "ts"), "spacings")


@query("interarrival", f"WITH {DIFF_SQL} SELECT event_id, event_type, diff AS time_diff FROM d")
def interarrival(spark, sf):
    return sp.interarrival(typed_events(spark, sf), "event_type", "ts", "event_id").drop("ts")


@query("interarrival_distribution", f"WITH {DIFF_SQL} SELECT event_type, diff AS time_diff FROM d WHERE diff IS NOT NULL")
def interarrival_distribution(spark, sf):
    return sp.collect_spacings(typed_events(spark, sf), "event_type", "ts", "event_id")


@query("interarrival_stats", f"""WITH {DIFF_SQL},
o AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY diff) - 1 AS rk, count(*) OVER (PARTITION BY event_type) AS n FROM d WHERE diff IS NOT NULL)
SELECT event_type, count(*) AS "count", round(avg(diff), 4) AS mean, min(diff) AS min, max(diff) AS max,
  max(CASE WHEN rk = n // 2 THEN diff END) AS median FROM o GROUP BY 1""")
def interarrival_stats(spark, sf):
    return rounded(sp.spacing_stats(event_spacings(spark, sf), "event_type"), 4, "mean")


def histogram_sql(width_us: int) -> str:
    """Right-closed bins of whole microseconds, 0 in the first one."""
    return f"""WITH u AS (SELECT event_type, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id)) AS us FROM events),
b AS (SELECT event_type, greatest((us + {width_us - 1}) // {width_us} - 1, 0) AS bin FROM u WHERE us IS NOT NULL),
m AS (SELECT event_type, max(us) // {width_us} AS last FROM u WHERE us IS NOT NULL GROUP BY 1),
e AS (SELECT event_type, unnest(generate_series(0, last)) AS bin FROM m),
n AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY 1, 2)
SELECT e.event_type, e.bin, CASE WHEN e.bin = 0 THEN -0.001 ELSE round(e.bin * {width_us / 1e6}::DOUBLE, 3) END AS bin_start, coalesce(n, 0) AS "count"
FROM e LEFT JOIN n ON e.event_type = n.event_type AND e.bin = n.bin"""


@query("interarrival_histogram", histogram_sql(280_000))
def interarrival_histogram(spark, sf):
    """The default width."""
    return sp.fixed_width_histogram(event_spacings(spark, sf), "event_type")


@query("interarrival_histogram_wide", histogram_sql(60_000_000))
def interarrival_histogram_wide(spark, sf):
    return sp.fixed_width_histogram(event_spacings(spark, sf), "event_type", width=60.0)


@query("interarrival_chart_bins", f"""WITH {DIFF_SQL},
m AS (SELECT event_type, min(diff) AS lo, max(diff) AS hi FROM d WHERE diff IS NOT NULL GROUP BY 1),
b AS (SELECT d.event_type, least(CAST(floor((diff - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin FROM d JOIN m USING (event_type) WHERE diff IS NOT NULL),
e AS (SELECT event_type, unnest(generate_series(0, 29)) AS bin FROM m)
SELECT e.event_type, e.bin, round(lo + e.bin * ((hi - lo) / 30), 4) AS bin_start, count(b.bin) AS "count"
FROM e JOIN m ON e.event_type = m.event_type LEFT JOIN b ON e.event_type = b.event_type AND e.bin = b.bin GROUP BY 1, 2, 3""")
def interarrival_chart_bins(spark, sf):
    return rounded(sp.equal_width_histogram(event_spacings(spark, sf), "event_type", "time_diff", 30), 4, "bin_start")


GAP_SQL = """
g AS (SELECT l_returnflag AS line, l_extendedprice - lag(l_extendedprice) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS gap FROM lineitem)"""


def price_gaps(spark, sf):
    return sp.position_gaps(r.table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "line"), "line", "l_extendedprice")


def bins_sql(value: str) -> str:
    edges = [str(e) for e in fv.GAP_EDGES] + ["1e300"]
    return ", ".join(
        f"count(*) FILTER ({value} > {lo} AND {value} <= {hi}) AS \"{label}\"" for lo, hi, label in zip(edges, edges[1:], fv.GAP_LABELS))


@query("gap_bins", f"""WITH {GAP_SQL}, m AS (SELECT quantile_cont(gap, 0.5) AS md FROM g WHERE gap IS NOT NULL),
s AS (SELECT line, gap / (SELECT CASE WHEN md > 100 THEN 1000.0::DOUBLE WHEN md > 10 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END FROM m) AS v FROM g WHERE gap IS NOT NULL)
SELECT line, {bins_sql('v')} FROM s GROUP BY 1""")
def gap_bins(spark, sf):
    return sp.bin_matrix(sp.auto_scale(price_gaps(spark, sf)), "line")


@query("gap_quantiles", f"""WITH {GAP_SQL}
SELECT line, {", ".join(f"round(quantile_cont(gap, {p}), 6) AS p{round(p * 100)}" for p in fv.GAP_QUANTILES)} FROM g WHERE gap IS NOT NULL GROUP BY 1""")
def gap_quantiles(spark, sf):
    names = {f"p{round(p * 100)}": p for p in fv.GAP_QUANTILES}
    return rounded(qu.quantiles(price_gaps(spark, sf), "gap", names, ["line"]), 6, *names)


@query("position_auto_scale", """
WITH g AS (SELECT l_linestatus AS line, (l_orderkey * 40 + l_linenumber) - lag(l_orderkey * 40 + l_linenumber) OVER (PARTITION BY l_linestatus ORDER BY l_orderkey * 40 + l_linenumber) AS gap FROM lineitem),
m AS (SELECT quantile_cont(gap, 0.5) AS md FROM g WHERE gap IS NOT NULL),
s AS (SELECT line, gap / (SELECT CASE WHEN md > 100 THEN 1000.0::DOUBLE WHEN md > 10 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END FROM m) AS v FROM g WHERE gap IS NOT NULL)
SELECT line, round(v, 6) AS gap, count(*) AS n FROM s GROUP BY 1, 2""")
def position_auto_scale(spark, sf):
    li = r.table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("line"), (F.col("l_orderkey") * 40 + F.col("l_linenumber")).cast("double").alias("position"))
    scaled = sp.auto_scale(sp.position_gaps(li, "line", "position"))
    return scaled.groupBy("line", F.round("gap", 6).alias("gap")).agg(F.sum("_w").alias("n"))


# ---- profiles -------------------------------------------------------------

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]


def profile_sql(c: str) -> str:
    q = ", ".join(f"round(quantile_cont({c}, {p}), 4) AS p{round(p * 100)}" for p in (0.25, 0.5, 0.75))
    return (f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
            f"min({c}) AS min, {q}, max({c}) AS max FROM lineitem")


@query("profile_numeric", " UNION ALL ".join(profile_sql(c) for c in NUMERIC))
def profile_numeric(spark, sf):
    return rounded(ct.numeric_profile(r.table(spark, sf, "lineitem"), NUMERIC), 4, "mean", "std", "p25", "p50", "p75")


def categorical_sql(c: str) -> str:
    return (f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST(sum(n) OVER () AS BIGINT) AS \"count\", count(*) OVER () AS \"unique\", v AS top, n AS freq "
            f"FROM (SELECT {c} AS v, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, v LIMIT 1)")


@query("profile_categorical", " UNION ALL ".join(categorical_sql(c) for c in ("o_orderstatus", "o_orderpriority")))
def profile_categorical(spark, sf):
    return ct.categorical_profile(r.table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("distinct_counts", """
SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_suppkey) AS l_suppkey, count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem""")
def distinct_counts(spark, sf):
    return ct.distinct_counts(r.table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey", "l_returnflag"])


@query("table_shape", "SELECT count(*) AS rows, count(part) AS part, count(txt) AS txt FROM (WITH " + CARRIER_SQL + " SELECT * FROM carriers)")
def table_shape(spark, sf):
    return ct.shape(carrier_table(spark, sf).toDF("part", "txt"))


@query("measure_masks", """
SELECT count(*) FILTER (a < 450 AND b < 450) AS ab_in, count(*) FILTER (NOT (a < 450 AND b < 450)) AS ab_out,
  count(*) FILTER (a < 450 AND b < 450 AND c < 450) AS all_in, count(*) FILTER (NOT (a < 450 AND b < 450 AND c < 450)) AS all_out
FROM (SELECT l_quantity * 15 AS a, l_partkey % 900 AS b, l_suppkey * 9 AS c FROM lineitem)""")
def measure_masks(spark, sf):
    li = r.table(spark, sf, "lineitem").select(
        (F.col("l_quantity") * 15).alias("a"), (F.col("l_partkey") % 900).alias("b"), (F.col("l_suppkey") * 9).alias("c"))
    return ct.threshold_counts(li, {"ab": ["a", "b"], "all": ["a", "b", "c"]})


@query("item_thresholds", """
SELECT count(*) FILTER (a < 450 AND b < 450) AS length_width_in, count(*) FILTER (NOT (a < 450 AND b < 450)) AS length_width_out,
  count(*) FILTER (a < 450 AND c < 450) AS length_position_in, count(*) FILTER (NOT (a < 450 AND c < 450)) AS length_position_out,
  count(*) FILTER (b < 450 AND c < 450) AS width_position_in, count(*) FILTER (NOT (b < 450 AND c < 450)) AS width_position_out,
  count(*) FILTER (a < 450 AND b < 450 AND c < 450) AS all_in, count(*) FILTER (NOT (a < 450 AND b < 450 AND c < 450)) AS all_out
FROM (SELECT CAST(l_quantity AS BIGINT) * 15 AS a, l_partkey % 900 AS b, l_suppkey * 9 AS c FROM lineitem)""")
def item_thresholds(spark, sf):
    """Measurement messages from raw lines, with pairs that need repair."""
    return ct.threshold_counts(measurement_rows(measurement_lines(spark, sf)), {
        "length_width": ["length", "width"], "length_position": ["length", "positionFront"],
        "width_position": ["width", "positionFront"], "all": MEASURES,
    })


def measurement_lines(spark, sf):
    li = r.table(spark, sf, "lineitem")
    raw = F.concat(
        F.lit("->{length , "), (F.col("l_quantity").cast("bigint") * 15).cast("string"), F.lit(", width:"),
        (F.col("l_partkey") % 900).cast("string"), F.lit(",positionFront, "), (F.col("l_suppkey") * 9).cast("string"),
        F.lit(",inductionNo:"), (F.lit(4) + F.col("l_linenumber") % 3).cast("string"), F.lit(",noOfCarriers:1}<"))
    line = r.log_record(r.stamp_of("l_shipdate"), F.lit("50102"), F.col("l_orderkey"), raw)
    return read_log_monitor(spark, r.log_files(li.select(line.alias("value")), "measurement-lines"))


@query("constant_columns", "SELECT l_orderkey, l_linenumber, l_returnflag, NULL::VARCHAR AS nothing FROM lineitem")
def constant_columns(spark, sf):
    li = r.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").withColumns(
        {"same": F.lit("x"), "nothing": F.lit(None).cast("string")})
    return co.drop_constant_columns(li)


@query("numeric_columns", "SELECT CAST(event_id AS DOUBLE) AS event_id, event_type, value FROM events")
def numeric_columns(spark, sf):
    e = r.table(spark, sf, "events")
    return co.numeric_where_possible(e.select(F.col("event_id").cast("string").alias("event_id"), "event_type", F.col("value").cast("string").alias("value")))


@query("seeded_sample", """
SELECT * FROM lineitem ORDER BY md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey), l_orderkey, l_linenumber, l_partkey LIMIT 5000""")
def seeded_sample(spark, sf):
    """A sampling operator: the rows with the smallest seeded md5."""
    return ct.seeded_sample(r.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 5000)
