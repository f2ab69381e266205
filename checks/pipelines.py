"""Whole analyses, readers and writers over the supplied tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import render as r
from checks.catalog import (
    DEFECT_SQL, FIXED_SQL, KEPT_SQL, NAMES_SQL, bins_sql, device_names, measurement_lines, query, rounded, typed_events,
)
from sorterlog import fixed_values as fv
from sorterlog.functions import clock
from sorterlog.operators import columns as co
from sorterlog.operators import fixes as fx
from sorterlog.operators import rates as ra
from sorterlog.operators.lookup import build_mapping
from sorterlog.operators.timewindow import resolve_window
from sorterlog.plans import alarm_reports, messages
from sorterlog.plans.destinations import bypass_spacing, s02_destinations
from sorterlog.plans.induction import induction_rate
from sorterlog.plans.measurements import MEASURES, item_measurements
from sorterlog.plans.sort_report import s04_analysis, s04_barcode_analysis, s04_first_element_analysis
from sorterlog.sources import combine, sinks, tables
from sorterlog.sources.logs import ORDER, read_lines, read_log_monitor
from sorterlog.sources.staging import new_folder

WEEK = (datetime(2024, 1, 5), datetime(2024, 1, 12))
IN_WEEK = "ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'"
TWO_PLACES = DEFECT_SQL.replace("4) AS percentage", "2) AS percentage")


# ---- sort reports ---------------------------------------------------------

@query("report_week_fixed", f"""{FIXED_SQL}, wk AS (SELECT * FROM scan WHERE {IN_WEEK}),
wcand AS (SELECT ord, indexno, row_number() OVER (PARTITION BY indexno ORDER BY ord) AS k FROM wk WHERE code IN (8, 9, 10)),
whits AS (SELECT wcand.ord FROM wcand JOIN fixes ON indexno = id AND wcand.k = fixes.k),
fixed AS (SELECT item, ts, wk.ord, mcid, CASE WHEN whits.ord IS NOT NULL THEN 0 ELSE code END AS code FROM wk LEFT JOIN whits ON wk.ord = whits.ord),
opened AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY item ORDER BY ts, ord)) > 1800000000 THEN 1 ELSE 0 END AS o FROM fixed),
packs AS (SELECT *, item || '_' || CAST(sum(o) OVER (PARTITION BY item ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS pkg FROM opened),
firsts AS (SELECT *, row_number() OVER (PARTITION BY pkg ORDER BY ts, ord) AS rn FROM packs)""" + DEFECT_SQL.format(
    cats=f"SELECT {r.category_sql('code')} AS cat FROM firsts WHERE rn = 1", units="SELECT * FROM firsts WHERE rn = 1"))
def report_week_fixed(spark, sf):
    """Window, corrections and labels from corrected codes."""
    tables_ = s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), *WEEK, fixes=r.fix_list(spark, sf), relabel=True)
    return tables_["defect_metrics"]


@query("report_window_data", f"""WITH {r.PACKAGE_SQL}, {r.MAPPING_SQL}
SELECT packed.ord AS record, packed.pkg AS package_id, pkg_type, amazon AS destination, {r.reason_sql('code')} AS reason
FROM packed JOIN types ON packed.pkg = types.pkg LEFT JOIN mapping ON mcid = id""")
def report_window_data(spark, sf):
    rows = s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True)["window_data"]
    return rows.select(
        F.col("plcRecordNo").cast("long").alias("record"), F.col("RealPackageID").alias("package_id"), "pkg_type",
        F.col("Amazon_Destination").alias("destination"), F.col("sortReason").alias("reason"),
    )


@query("report_jackpots", f"""WITH {r.PACKAGE_SQL}, {r.MAPPING_SQL}
SELECT beumer AS "Beumer_Destination", amazon AS "Amazon_Destination", count(DISTINCT pkg) AS unique_packages
FROM packed JOIN mapping ON mcid = id WHERE code = 0 AND jackpot = 'jackpot' AND amazon IS NOT NULL GROUP BY 1, 2""")
def report_jackpots(spark, sf):
    return s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True)["jackpot_metrics"]


@query("report_reason_destinations", f"""WITH {KEPT_SQL}, {r.MAPPING_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", amazon AS "Amazon_Destination", count(*) AS "count"
FROM kept JOIN mapping ON mcid = id WHERE krn = 1 AND amazon IS NOT NULL GROUP BY 1, 2 HAVING "sortReason" IS NOT NULL""")
def report_reason_destinations(spark, sf):
    return s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True)["reason_dest_summary"]


@query("barcode_report_defects", FIXED_SQL + """, fixed AS (
SELECT CASE WHEN hits.ord IS NOT NULL THEN 0 ELSE code END AS code FROM scan LEFT JOIN hits ON scan.ord = hits.ord)""" + DEFECT_SQL.format(
    cats=f"SELECT {r.category_sql('code')} AS cat FROM fixed", units="SELECT * FROM fixed"))
def barcode_report_defects(spark, sf):
    return s04_barcode_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True, fixes=r.fix_list(spark, sf))["defect_metrics"]


@query("barcode_report_reasons", f"""WITH {r.SCAN_SQL}, {r.MAPPING_SQL}
SELECT {r.reason_sql('code')} AS "sortReason", amazon AS "Amazon_Destination", count(*) AS "count"
FROM scan JOIN mapping ON mcid = id WHERE amazon IS NOT NULL GROUP BY 1, 2 HAVING "sortReason" IS NOT NULL""")
def barcode_report_reasons(spark, sf):
    return s04_barcode_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True)["reason_dest_summary"]


FIRST_SQL = f"""WITH {r.SCAN_SQL}, {r.FIX_SQL},
fixed AS (SELECT CASE WHEN indexno IN (SELECT id FROM fixes) THEN 0 ELSE code END AS code FROM scan WHERE {IN_WEEK})"""


def first_element(spark, sf):
    return s04_first_element_analysis(r.scan_logs(spark, sf), r.fix_list(spark, sf), *WEEK)


@query("first_element_counts", FIRST_SQL + f"""
SELECT {r.reason_sql('code')} AS "sortReason", count(*) AS "count" FROM fixed GROUP BY 1 HAVING "sortReason" IS NOT NULL""")
def first_element_counts(spark, sf):
    """Three-part time stamps, a strict window, corrections by membership."""
    return first_element(spark, sf)["sort_counts"]


@query("first_element_outcomes", FIRST_SQL + TWO_PLACES.format(cats=f"SELECT {r.category_sql('code')} AS cat FROM fixed", units="SELECT * FROM fixed"))
def first_element_outcomes(spark, sf):
    return first_element(spark, sf)["outcomes"]


# ---- destinations ---------------------------------------------------------

REQUEST_SQL = f"""WITH {r.SCAN_SQL}, req AS (SELECT * FROM scan WHERE ord % 4 <> 0 AND {IN_WEEK})"""


def requests(spark, sf):
    s = r.scan_events(spark, sf)
    raw = r.framed({
        "itemID": F.col("itemID"), "indexNo": F.col("indexNo"), "barcodeAWCS": F.col("barcodeAWCS"),
        "requestedDestMCID": r.bracketed(F.col("requestedDestMCID"), F.lit(1)), "sortCode": r.bracketed(F.col("sortCode")),
    })
    code = F.when(F.col(ORDER) % 4 == 0, fv.SORT_REPORT_CODE).otherwise(F.lit(fv.DESTINATION_REQUEST_CODE))
    line = r.log_record(r.stamp_of("timeStamp"), code, F.col(ORDER), raw)
    logs = read_log_monitor(spark, r.log_files(s.select(line.alias("value")), "request-lines"))
    return s02_destinations(logs, *WEEK)


@query("request_destinations", REQUEST_SQL + """
SELECT CAST(mcid AS VARCHAR) AS "requestedDestMCID", count(*) AS "count" FROM (
  SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY ord) AS rn FROM req) WHERE rn = 1 GROUP BY 1""")
def request_destinations(spark, sf):
    return requests(spark, sf)["destination_counts"]


@query("request_repetitions", REQUEST_SQL + """
SELECT barcode AS "barcodeAWCS", count(*) AS "count" FROM req GROUP BY 1 HAVING count(*) > 1""")
def request_repetitions(spark, sf):
    return requests(spark, sf)["repeated_barcodes"]


BYPASS = ["NATION_0_B", "NATION_3", "NATION_9"]
BYPASS_SQL = f"""WITH {r.SCAN_SQL}, {r.MAPPING_SQL},
ms AS (SELECT amazon, epoch_us(date_trunc('millisecond', ts)) AS us FROM scan JOIN mapping ON mcid = id
  WHERE mcid < 3000 AND amazon IN ({", ".join(f"'{n}'" for n in BYPASS)})),
d AS (SELECT amazon, us - lag(us) OVER (PARTITION BY amazon ORDER BY us) AS us FROM ms)"""


def bypass(spark, sf, **options):
    return bypass_spacing(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), BYPASS, **options)


@query("bypass_stats", BYPASS_SQL + """,
o AS (SELECT amazon, us / 1000000.0::DOUBLE AS diff, row_number() OVER (PARTITION BY amazon ORDER BY us) - 1 AS rk, count(*) OVER (PARTITION BY amazon) AS n FROM d WHERE us IS NOT NULL)
SELECT amazon AS "Amazon_Destination", count(*) AS "count", round(avg(diff), 4) AS mean, min(diff) AS min, max(diff) AS max, max(CASE WHEN rk = n // 2 THEN diff END) AS median FROM o GROUP BY 1""")
def bypass_stats(spark, sf):
    return rounded(bypass(spark, sf)["stats"], 4, "mean")


@query("bypass_rows", BYPASS_SQL + """ SELECT amazon AS "Amazon_Destination", us / 1000000.0::DOUBLE AS time_diff FROM d WHERE us IS NOT NULL""")
def bypass_rows(spark, sf):
    return bypass(spark, sf)["distributions"]


@query("bypass_histogram", BYPASS_SQL + """,
b AS (SELECT amazon, greatest((us + 299999999) // 300000000 - 1, 0) AS bin, count(*) AS n FROM d WHERE us IS NOT NULL GROUP BY 1, 2),
e AS (SELECT amazon, unnest(generate_series(0, max(us) // 300000000)) AS bin FROM d WHERE us IS NOT NULL GROUP BY 1)
SELECT e.amazon AS "Amazon_Destination", e.bin, CASE WHEN e.bin = 0 THEN -0.001 ELSE e.bin * 300.0::DOUBLE END AS bin_start, coalesce(n, 0) AS "count"
FROM e LEFT JOIN b ON e.amazon = b.amazon AND e.bin = b.bin""")
def bypass_histogram(spark, sf):
    return bypass(spark, sf, width=300.0)["histogram"]


# ---- measurements ---------------------------------------------------------

MEASURE_SQL = """
WITH m AS (SELECT 'IU00' || (5 + l_linenumber % 3) AS ind, CAST(CAST(l_quantity AS BIGINT) * 15 AS DOUBLE) AS length, CAST(l_partkey % 900 AS DOUBLE) AS width,
  CAST(l_suppkey * 9 AS DOUBLE) AS "positionFront", 1.0::DOUBLE AS "noOfCarriers" FROM lineitem),
g AS (SELECT ind, "positionFront" - lag("positionFront") OVER (PARTITION BY ind ORDER BY "positionFront") AS gap FROM m)"""


@query("measurement_gap_counts", MEASURE_SQL + f""",
md AS (SELECT quantile_cont(gap, 0.5) AS md FROM g WHERE gap IS NOT NULL),
s AS (SELECT ind, gap / (SELECT CASE WHEN md > 100 THEN 1000.0::DOUBLE WHEN md > 10 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END FROM md) AS v FROM g WHERE gap IS NOT NULL)
SELECT ind AS "inductionNo", {bins_sql('v')} FROM s GROUP BY 1 HAVING count(*) FILTER (v > 0) > 0""")
def measurement_gap_counts(spark, sf):
    return item_measurements(measurement_lines(spark, sf))["gap_counts"]


@query("measurement_gap_description", MEASURE_SQL + f"""
SELECT count(gap) AS "count", round(avg(gap), 6) AS mean, round(stddev_samp(gap), 6) AS std, min(gap) AS min,
  {", ".join(f"quantile_cont(gap, {p}) AS p{round(p * 100)}" for p in fv.GAP_QUANTILES)}, max(gap) AS max FROM g WHERE gap IS NOT NULL""")
def measurement_gap_description(spark, sf):
    return rounded(item_measurements(measurement_lines(spark, sf))["gap_description"], 6, "mean", "std")


@query("measurement_profile", MEASURE_SQL + " UNION ALL ".join(
    f"""
SELECT '{c}' AS "column", count("{c}") AS "count", round(avg("{c}"), 4) AS mean, round(stddev_samp("{c}"), 4) AS std, min("{c}") AS min,
  round(quantile_cont("{c}", 0.25), 4) AS p25, round(quantile_cont("{c}", 0.5), 4) AS p50, round(quantile_cont("{c}", 0.75), 4) AS p75, max("{c}") AS max FROM m"""
    for c in (*MEASURES, "noOfCarriers")))
def measurement_profile(spark, sf):
    return rounded(item_measurements(measurement_lines(spark, sf))["numeric_profile"], 4, "mean", "std", "p25", "p50", "p75")


@query("measurement_gap_histogram", MEASURE_SQL + """,
s AS (SELECT ind, min(gap) AS lo, max(gap) AS hi FROM g WHERE gap IS NOT NULL GROUP BY 1),
b AS (SELECT g.ind, least(CAST(floor((gap - lo) / (hi - lo) * 50) AS BIGINT), 49) AS bin FROM g JOIN s ON g.ind = s.ind WHERE gap IS NOT NULL),
e AS (SELECT ind, lo, hi, unnest(generate_series(0, 49)) AS bin FROM s)
SELECT e.ind AS "inductionNo", e.bin, round(lo + e.bin * ((hi - lo) / 50), 4) AS bin_start, count(b.bin) AS "count"
FROM e LEFT JOIN b ON e.ind = b.ind AND e.bin = b.bin GROUP BY 1, 2, 3""")
def measurement_gap_histogram(spark, sf):
    return rounded(item_measurements(measurement_lines(spark, sf))["gap_histogram"], 4, "bin_start")


# ---- readers and writers --------------------------------------------------

def headed_files(df: DataFrame, path: str, line: F.Column, key: str, *head: str, rows_per_file: int = 2000) -> None:
    """Files of `rows_per_file` neighbouring rows each, with leading lines of their own."""
    lines = df.groupBy(F.floor(F.col(key) / rows_per_file)).agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), line.alias("line")))).alias("l"))
    whole = F.concat_ws("\n", *[F.lit(h) for h in head], F.array_join(F.transform("l", lambda x: x["line"]), "\n"))
    lines.select(whole.alias("value")).write.option("maxRecordsPerFile", 1).text(path)


@query("combined_logs", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 2 = 0 THEN event_type END AS kind,
  CASE WHEN event_id % 2 = 1 THEN CAST(user_id AS VARCHAR) || ';x' END AS person, TRUE AS has_file FROM events WHERE event_id % 10 <> 9""")
def combined_logs(spark, sf):
    """Two kinds of headers in one directory; lines longer than their header are skipped."""
    e = r.table(spark, sf, "events").select("event_id", "event_type", F.col("user_id").cast("string").alias("user"))
    base = new_folder(spark, "headed-logs")
    id_ = F.col("event_id").cast("string")
    more = F.when(F.col("event_id") % 10 == 9, F.lit(";too;many")).otherwise(F.lit(""))
    headed_files(e.where("event_id % 2 = 0"), f"{base}/a", F.concat_ws(";", id_, "event_type"), "event_id", "id;kind")
    headed_files(e.where("event_id % 2 = 1"), f"{base}/b", F.concat(F.lit('"'), F.col("user"), F.lit(';x";'), id_, more), "event_id", '"person";id')
    rows = combine.combine_logs(spark, base, "*/*.txt")
    return rows.select("id", "kind", "person", F.col("source_file").rlike("part-.*txt$").alias("has_file"))


@query("combine_report", """
SELECT kind, bytes > 0 AS has_bytes, rows, skipped, status FROM (
  SELECT 'a' AS kind, 1 AS bytes, count(*) FILTER (event_id % 2 = 0) AS rows, 0::BIGINT AS skipped, 'read' AS status FROM events
  UNION ALL SELECT 'b', 1, count(*) FILTER (event_id % 2 = 1 AND event_id % 10 <> 9), count(*) FILTER (event_id % 10 = 9), 'read' FROM events
  UNION ALL SELECT 'broken', 1, 0, 0, 'unreadable')""")
def combine_report(spark, sf):
    """Two headed files, one of them with lines that are too long, and one that is no text although its name says so."""
    e = r.table(spark, sf, "events").select("event_id", "event_type", F.col("user_id").cast("string").alias("user"))
    base = new_folder(spark, "reported-logs")
    id_ = F.col("event_id").cast("string")
    more = F.when(F.col("event_id") % 10 == 9, F.lit(";too;many")).otherwise(F.lit(""))
    headed_files(e.where("event_id % 2 = 0"), f"{base}/kind=a", F.concat_ws(";", id_, "event_type"), "event_id", "id;kind")
    headed_files(e.where("event_id % 2 = 1"), f"{base}/kind=b", F.concat(F.lit('"'), F.col("user"), F.lit(';x";'), id_, more), "event_id", '"person";id')
    # a compressed table under a name that promises compressed lines: its bytes are no such stream
    e.coalesce(1).write.parquet(f"{base}/raw")
    rename_first(spark, f"{base}/raw", f"{base}/kind=broken/part-0.txt.gz")
    report = combine.combine_report(spark, f"{base}/kind=*", "*.txt*")
    kind = F.when(F.col("file").endswith(".gz"), "broken").when(F.col("skipped") > 0, "b").otherwise("a")
    return report.groupBy(kind.alias("kind"), (F.col("bytes") > 0).alias("has_bytes"), "status").agg(
        F.sum("rows").alias("rows"), F.sum("skipped").alias("skipped"))


def rename_first(spark, folder: str, target: str) -> None:
    """Move the one data file of a folder to another name."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, to = hadoop.Path(folder), hadoop.Path(target)
    files = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(to.getParent())
    data = next(s.getPath() for s in files.listStatus(source) if s.getPath().getName().startswith("part-"))
    files.rename(data, to)


@query("alarm_history_files", f"""WITH {r.ALARM_SQL}
SELECT ' =CBS01.' || kind || num || '+S001-U01' AS part, grp, CASE WHEN secs IS NOT NULL THEN '="' || {r.hms_sql('secs')} || '"' END AS duration, txt FROM alarms""")
def alarm_history_files(spark, sf):
    """Banner and header per file, columns in another order in every other file."""
    a = r.alarm_history(spark, sf).withColumn("n", F.monotonically_increasing_id())
    quoted = {c: F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in ("Part name", "Group", "Duration", "Alarm text")}
    base = new_folder(spark, "alarm-files")
    one, other = ["Part name", "Group", "Alarm text", "Duration"], ["Duration", "Part name", "Alarm text", "Group"]
    for name, order, rest in (("a", one, 0), ("b", other, 1)):
        line = F.concat_ws(";", *[quoted[c] for c in order])
        headed_files(a.where(F.col("n") % 2 == rest), f"{base}/{name}", line, "n", "Filter: all", ";".join(order))
    rows = tables.read_alarm_history(spark, f"{base}/*/*.txt")
    return rows.select(F.col("Part name").alias("part"), F.col("Group").alias("grp"), F.col("Duration").alias("duration"), F.col("Alarm text").alias("txt"))


@query("occurrence_files", f"""WITH {NAMES_SQL}, occ AS (
  SELECT CASE WHEN p_partkey % 3 = 0 THEN 'IU' ELSE 'CHU' END || lpad(CAST(p_partkey % 37 AS VARCHAR), 3, '0') AS part,
    'Jam ' || p_brand || ', "' || p_name || '"' AS message, CAST(p_partkey AS VARCHAR) AS occurrences FROM part)
SELECT CASE WHEN amazon IS NULL THEN beumer ELSE beumer || ' - ' || amazon END AS "MappingString", occurrences AS "Occurrences", NULL AS "Message"
FROM occ LEFT JOIN names ON part = beumer WHERE part LIKE 'CHU%' UNION ALL SELECT NULL, occurrences, message FROM occ WHERE part LIKE 'IU%'""")
def occurrence_files(spark, sf):
    """Comma CSV written and read back, with quotes and commas in values."""
    p = r.table(spark, sf, "part")
    unit = F.concat(F.when(F.col("p_partkey") % 3 == 0, "IU").otherwise(F.lit("CHU")), F.format_string("%03d", F.col("p_partkey") % 37))
    path = new_folder(spark, "occurrences")
    sinks.write_csv(p.select(
        F.concat(F.lit("=CBS01."), unit, F.lit("+S001")).alias("Part"),
        F.concat(F.lit("Jam "), "p_brand", F.lit(', "'), "p_name", F.lit('"')).alias("Message"),
        F.col("p_size").cast("string").alias("Duration"), F.col("p_partkey").cast("string").alias("Occurrences"),
    ), path)
    found = alarm_reports.alarm_occurrences(tables.read_csv_table(spark, path), device_names(spark, sf))
    return found.select("MappingString", "Occurrences", "Message")


@query("mapping_files", f"WITH {r.MAPPING_SQL} SELECT id AS \"IndexNo\", amazon AS \"Amazon\", beumer AS \"Beumer\", CASE WHEN jackpot IS NOT NULL THEN 'JackPot' END AS \"Jackpot\" FROM mapping")
def mapping_files(spark, sf):
    """Mapping written in file order and read back: the last row of an id wins, values are trimmed."""
    path = new_folder(spark, "mapping")
    rows = r.destination_mapping(spark, sf).orderBy("_pos").drop("_pos")
    sinks.write_csv(rows.select(*[F.when(F.col(c).isNotNull(), F.concat(F.col(c), F.lit("  "))).alias(c) for c in rows.columns]), path)
    return build_mapping(tables.read_mapping(spark, path))


@query("fix_list_files", FIXED_SQL + """
SELECT scan.ord AS event_id, CASE WHEN hits.ord IS NOT NULL THEN 0 ELSE code END AS "sortCode", coalesce(comment, '') AS explanation
FROM scan LEFT JOIN hits ON scan.ord = hits.ord""")
def fix_list_files(spark, sf):
    path = new_folder(spark, "fix-list")
    sinks.write_csv(r.fix_list(spark, sf).orderBy("_pos").select("id", "comment"), path)
    fixed = fx.fix_by_occurrence(r.scan_events(spark, sf), tables.read_fix_list(spark, path))
    return fixed.select(F.col(ORDER).alias("event_id"), "sortCode", F.col(fx.EXPLANATION).alias("explanation"))


@query("report_files", "SELECT 'orders' AS name, o_orderkey AS key FROM orders UNION ALL SELECT 'parts', p_partkey FROM part")
def report_files(spark, sf):
    named = {"orders": r.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key")), "parts": r.table(spark, sf, "part").select(F.col("p_partkey").alias("key"))}
    paths = sinks.write_report(named, new_folder(spark, "report"))
    parts = [spark.read.parquet(p).select(F.lit(n).alias("name"), "key") for n, p in zip(named, paths)]
    return parts[0].unionByName(parts[1])


@query("destination_folders", "SELECT 'to/' || event_type AS destination, event_id FROM events WHERE event_id % 7 <> 0")
def destination_folders(spark, sf):
    path = new_folder(spark, "destinations")
    rows = typed_events(spark, sf).select("event_id", F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("to/"), "event_type")).alias("Amazon_Destination"))
    sinks.write_per_destination(rows, path)
    return spark.read.parquet(path).select(F.col("sheet").alias("destination"), "event_id")


# ---- columns, windows, durations, targets ---------------------------------

@query("quote_scrub", "SELECT event_id, event_type || ' x' AS text FROM events")
def quote_scrub(spark, sf):
    e = typed_events(spark, sf)
    return co.drop_quotes_all(e.select("event_id", F.concat(F.lit('"'), "event_type", F.lit('" x"')).alias("text")))


@query("empty_columns", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS half FROM orders")
def empty_columns(spark, sf):
    o = r.table(spark, sf, "orders")
    return co.drop_empty_columns(o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("half"), F.lit(None).cast("string").alias("none")))


@query("trimmed_columns", "SELECT p_partkey, p_name FROM part")
def trimmed_columns(spark, sf):
    p = r.table(spark, sf, "part")
    return co.trim_all(p.select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" \t")).alias("p_name")))


@query("window_strict", f"SELECT event_id FROM events WHERE {IN_WEEK}")
def window_strict(spark, sf):
    return resolve_window(typed_events(spark, sf), *WEEK, strict=True, ts="ts").rows.select("event_id")


@query("complete_rows", """
SELECT CAST(l_orderkey % 50 AS DOUBLE) AS length, CAST(l_linenumber AS DOUBLE) AS width, CAST(l_orderkey AS DOUBLE) AS "positionFront"
FROM lineitem WHERE l_orderkey % 3 <> 0 AND l_linenumber % 2 <> 0""")
def complete_rows(spark, sf):
    """Measured points: messages without a number in one of the three measures are left out."""
    li = r.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    length = F.when(F.col("l_orderkey") % 3 != 0, (F.col("l_orderkey") % 50).cast("string")).otherwise(F.lit("none"))
    width = F.when(F.col("l_linenumber") % 2 != 0, F.col("l_linenumber").cast("string")).otherwise(F.lit(""))
    raw = r.framed({"inductionNo": F.lit("4"), "length": length, "width": width, "positionFront": F.col("l_orderkey")})
    line = r.log_record(F.lit("240101 000000 000"), F.lit(fv.MEASUREMENT_CODES[0]), F.col("l_orderkey"), raw)
    logs = read_log_monitor(spark, r.log_files(li.select(line.alias("value")), "measured-lines"))
    return item_measurements(logs)["points"].select(*MEASURES)


@query("payload_profile", """
WITH m AS (SELECT CASE WHEN event_id % 4 = 0 THEN '54163' ELSE '54177' END AS code, * FROM events),
t AS (SELECT code, count(*) AS total FROM m GROUP BY 1),
p AS (SELECT code, event_type AS key, 'list' AS type FROM m UNION ALL SELECT code, 'id', 'integer' FROM m UNION ALL SELECT code, 'value', 'decimal' FROM m
  UNION ALL SELECT code, 'odd', CASE WHEN event_id % 3 = 1 THEN 'empty' ELSE 'text' END FROM m WHERE event_id % 3 > 0)
SELECT code, key, type, count(*) AS messages, round(count(*) / any_value(total)::DOUBLE, 9) AS share FROM p JOIN t USING (code) GROUP BY 1, 2, 3""")
def payload_profile(spark, sf):
    """Keys, types and shares of messages of two codes, one key of which is not in all of them and repeats."""
    odd = F.when(F.col("event_id") % 3 == 0, F.lit("")).when(F.col("event_id") % 3 == 1, F.lit(",odd:7,odd:")).otherwise(F.lit(",odd:7,odd:x y,"))
    raw = F.concat(F.lit("->{"), F.col("event_type"), F.lit(":[1,2],id:"), F.col("event_id").cast("string"), F.lit(",value:"), F.format_string("%.2f", "value"), odd, F.lit("}<"))
    code = F.when(F.col("event_id") % 4 == 0, "54163").otherwise(F.lit("54177"))
    rows = r.table(spark, sf, "events").select(code.alias("messageCode"), raw.alias("rawMessage"))
    return messages.payload_profile(rows).select(F.col("messageCode").alias("code"), "key", "type", "messages", F.round("share", 9).alias("share"))


@query("whole_report", """
SELECT 'parts' AS name, p_partkey AS key, 'Brand "' || p_brand || '", x' AS text FROM part UNION ALL SELECT 'suppliers', s_suppkey, s_name FROM supplier""")
def whole_report(spark, sf):
    """A report of two tables as comma files, found again by its list of tables."""
    named = {
        "parts": r.table(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.concat(F.lit('Brand "'), "p_brand", F.lit('", x')).alias("text")),
        "suppliers": r.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("text")),
    }
    base = new_folder(spark, "report")
    sinks.write_report(named, base, fmt="csv")
    one, other = (t.select(F.lit(n).alias("name"), F.col("key").cast("long").alias("key"), "text") for n, t in sinks.read_report(spark, base).items())
    return one.unionByName(other)


@query("run_counts", """
SELECT count(*) + 2 AS lines, 2::BIGINT AS blank, count(*) FILTER (event_id % 11 = 0) AS too_long, count(*) FILTER (event_id % 11 <> 0 AND event_id % 4 <> 0) AS kept,
  count(*) FILTER (event_id % 11 <> 0 AND event_id % 4 = 0) AS dropped, count(*) FILTER (event_id % 11 <> 0 AND event_id % 4 <> 0 AND event_id % 7 = 0) AS bad_stamps,
  count(*) FILTER (event_id % 11 <> 0 AND event_id % 4 <> 0) AS stored FROM events""")
def run_counts(spark, sf):
    """What one pass over log files read, kept and left out."""
    code = F.when(F.col("event_id") % 4 == 0, "54163").otherwise(F.lit(fv.SORT_REPORT_CODE))
    stamp = F.when(F.col("event_id") % 7 == 0, F.lit("no stamp")).otherwise(r.stamp_of("ts"))
    line = F.concat(r.log_record(stamp, code, F.col("event_id"), F.lit("->{a:1}<")), F.when(F.col("event_id") % 11 == 0, F.lit(";more")).otherwise(F.lit("")))
    lines = r.table(spark, sf, "events").select(line.alias("value")).union(spark.range(2).select(F.lit("  ")))
    table, counts = messages.counted_records(read_lines(spark, r.log_files(lines, "counted-lines")), fv.SORT_REPORT_CODE)
    return table.agg(*[F.lit(n).cast("long").alias(name) for name, n in counts.items()], F.count(F.lit(1)).alias("stored"))


@query("inductions_present", f"""SELECT DISTINCT CASE event_type WHEN 'click' THEN 'IU001' WHEN 'view' THEN 'IU002' WHEN 'error' THEN 'IU005'
  WHEN 'purchase' THEN 'SPS001' ELSE 'No Map Yet' END AS "inductionNo" FROM events WHERE {IN_WEEK}""")
def inductions_present(spark, sf):
    from checks.catalog import induction_lines

    return induction_rate(induction_lines(spark, sf), *WEEK)["inductions"]


@query("day_durations", """
SELECT event_id, CAST(event_id % 12 AS BIGINT) * 86400000000 + (event_id % 86400) * 1000000 AS us FROM events""")
def day_durations(spark, sf):
    n = F.col("event_id")
    s = n % 86400
    text = F.format_string("%d days %02d:%02d:%02d", (n % 12).cast("long"), F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)
    return typed_events(spark, sf).select("event_id", clock.parse_duration(text).alias("us"))


@query("target_choices", """
SELECT s_suppkey AS case_no, CASE s_suppkey % 8 WHEN 0 THEN 2640.0 WHEN 1 THEN 9119.0::DOUBLE / 4 WHEN 2 THEN 2820.0 WHEN 3 THEN 7351.0::DOUBLE / 3 WHEN 4 THEN 100.0
  WHEN 5 THEN (9119.0::DOUBLE / 4 + 7351.0::DOUBLE / 3) / 2 WHEN 6 THEN (9119.0::DOUBLE / 4 + 7351.0::DOUBLE / 3) / 2 END AS target_pph FROM supplier""")
def target_choices(spark, sf):
    """Every branch of the target choice, looked up for the kind of each supplier."""
    cases = [["IU001"], ["IU001", "IU002"], ["IU005"], ["IU005", "IU006"], ["SPS001"], ["IU001", "IU005"], ["IU001", "SPS001"], ["No Map Yet"]]
    s = r.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("case_no"))
    kinds = s.select(F.col("case_no"), (F.col("case_no") % 8).alias("kind"))
    parts = []
    for k, names in enumerate(cases):
        here = kinds.where(F.col("kind") == k)
        present = here.select(F.explode(F.array(*[F.lit(n) for n in names])).alias("inductionNo"))
        parts.append(here.select("case_no", ra.choose_target(present).scalar().alias("target_pph")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
