"""Sorter-shaped inputs derived from the supplied tables, row by row and without shuffles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.sources.logs import ORDER, read_log_monitor
from sorterlog.sources.staging import new_folder
from sorterlog.sources.tables import POSITION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.floor(F.col(c) * 100).cast("bigint")


def scan_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sort records: user = item, type = barcode class, id and value = destination and code."""
    e = table(spark, sf_dir, "events")
    barcode = (
        F.when(F.col("event_type") == "error", "????").when(F.col("event_type") == "click", "9999")
        .otherwise(F.concat(F.lit("B"), (F.col("event_id") % 700).cast("string")))
    )
    return e.select(
        F.col("user_id").alias("itemID"), F.col("ts").alias("timeStamp"), F.col("event_id").alias(ORDER),
        barcode.alias("barcodeAWCS"),
        F.format_string("%04d", F.col("event_id") % 400).alias("indexNo"),
        F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(cents("value") % 23).cast("bigint").alias("sortCode"),
        (F.lit(2990) + F.col("event_id") % 27).cast("bigint").alias("requestedDestMCID"),
        "event_type", "value",
    )


SCAN_SQL = """
scan AS (
  SELECT user_id AS item, ts, event_id AS ord,
         CASE event_type WHEN 'error' THEN '????' WHEN 'click' THEN '9999' ELSE 'B' || (event_id % 700) END AS barcode,
         lpad(CAST(event_id % 400 AS VARCHAR), 4, '0') AS indexno,
         CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) % 23 END AS code,
         2990 + event_id % 27 AS mcid
  FROM events)"""


def destination_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as destinations 2990..3014; the first three are listed twice with a new name."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    base = n.select(
        (F.lit(2990) + key).cast("string").alias("IndexNo"),
        F.when(key != 7, F.col("n_name")).alias("Amazon"),
        F.concat(F.lit("CHU"), (key % 20).cast("string")).alias("Beumer"),
        F.when(key % 5 == 0, F.lit(" JackPot ")).alias("Jackpot"),
        key.cast("bigint").alias(POSITION),
    )
    again = base.where(F.col(POSITION) < 3).select(
        "IndexNo", F.concat("Amazon", F.lit("_B")).alias("Amazon"), "Beumer", "Jackpot", (F.col(POSITION) + 100).alias(POSITION)
    )
    return base.unionByName(again)


MAPPING_SQL = """
mapping AS (
  SELECT 2990 + n_nationkey AS id,
         CASE WHEN n_nationkey < 3 THEN n_name || '_B' WHEN n_nationkey <> 7 THEN n_name END AS amazon,
         'CHU' || (n_nationkey % 20) AS beumer,
         CASE WHEN n_nationkey % 5 = 0 THEN 'jackpot' END AS jackpot
  FROM nation)"""


def case_sql(pairs: dict, expr: str) -> str:
    quote = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {expr} " + " ".join(f"WHEN {quote(k)} THEN {quote(v)}" for k, v in pairs.items()) + " END"


def reason_sql(expr: str) -> str:
    return case_sql(fv.SORT_REASONS, expr)


def category_sql(expr: str) -> str:
    return case_sql(fv.DEFECT_CATEGORIES, reason_sql(expr))


PACKAGE_SQL = SCAN_SQL + """,
gaps AS (
  SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY item ORDER BY ts, ord)) > 1800000000
                 THEN 1 ELSE 0 END AS opened FROM scan),
rows_ AS (
  SELECT *, CAST(sum(opened) OVER (PARTITION BY item ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM gaps),
packed AS (
  SELECT *, item || '_' || session AS pkg, (code = 0 AND mcid BETWEEN 3000 AND 3999) AS recirc,
         row_number() OVER (PARTITION BY item, session ORDER BY ts, ord) AS rn,
         count(*) OVER (PARTITION BY item, session) AS n FROM rows_),
types AS (
  SELECT pkg, CASE WHEN bool_and(barcode = '????') THEN 'no_read' WHEN bool_and(barcode = '9999') THEN 'multi_read'
                   ELSE 'normal' END AS pkg_type, count(*) AS records,
         bool_or(recirc) AND count(*) > 1 AS recirculates FROM packed GROUP BY pkg)"""


def fix_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' ids as a fix list with repeated ids and some that match nothing."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        (F.col("c_custkey") % 53 * 9).cast("string").alias("id"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("comment"),
        F.col("c_custkey").alias(POSITION),
    )


FIX_SQL = """
fixes AS (
  SELECT lpad(CAST(c_custkey % 53 * 9 AS VARCHAR), 4, '0') AS id,
         CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE '' END AS comment, c_custkey AS pos,
         row_number() OVER (PARTITION BY c_custkey % 53 ORDER BY c_custkey) AS k
  FROM customer)"""


def log_record(stamp: Column, code: Column, sequence: Column, raw: Column) -> Column:
    """One 12-field log line with quoted fields."""
    fields = [stamp, F.lit("I"), F.lit("SYS1"), F.lit("10.0.0.1"), F.lit("AWCS"), F.lit(""), F.lit(""),
              F.lit("0"), F.lit("MCC01"), code, sequence.cast("string"), raw]
    quoted = [F.concat(F.lit('"'), f, F.lit('"')) for f in fields]
    return F.concat_ws(";", *quoted)


def stamp_of(ts: str) -> Column:
    return F.date_format(ts, "yyMMdd HHmmss SSSSSS")


def framed(pairs: dict[str, Column]) -> Column:
    body = F.concat_ws(",", *[F.concat(F.lit(f"{k}:"), v.cast("string")) for k, v in pairs.items()])
    return F.concat(F.lit("->{"), body, F.lit("}<"))


def bracketed(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *[i.cast("string") for i in items]), F.lit("]"))


def scan_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sort report log files, one line per event, read back as log records."""
    s = scan_events(spark, sf_dir)
    raw = framed({
        "event": F.lit("SORT"), "plcRecordNo": F.col(ORDER), "itemID": F.col("itemID"), "indexNo": F.col("indexNo"),
        "locationAWCS": F.lit("L1"), "barcodeAWCS": F.col("barcodeAWCS"),
        "actualDestMCID": F.col("requestedDestMCID"), "requestedDestMCID": bracketed(F.col("requestedDestMCID")),
        "sortCode": bracketed(F.col("sortCode")), "requestedDestStatus": F.lit("[Used]"), "comHost": F.lit("h"),
    })
    line = log_record(stamp_of("timeStamp"), F.lit(fv.SORT_REPORT_CODE), F.col(ORDER), raw)
    return read_log_monitor(spark, log_files(s.select(line.alias("value")), "sort-lines"))


def log_files(lines: DataFrame, name: str) -> str:
    """Write rendered lines (`value`) as text files, as a controller would, and return the folder."""
    path = new_folder(lines.sparkSession, name)
    lines.select("value").write.text(path)
    return path


def order_of(n: Column) -> Column:
    return F.struct(F.lit("events").alias("file"), F.lit(0).cast("bigint").alias("block"), n.cast("bigint").alias("line")).alias(ORDER)


def alarm_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as alarm history rows: part from the user, duration text from the value."""
    e = table(spark, sf_dir, "events")
    kind = (
        F.when(F.col("event_type") == "click", "DBS").when(F.col("event_type") == "view", "IAS")
        .when(F.col("event_type") == "error", "CHU").when(F.col("event_type") == "signup", "ES").otherwise("X")
    )
    secs = cents("value") % 200000
    clock = F.format_string("%02d:%02d:%02d", (secs / 3600).cast("bigint"), ((secs % 3600) / 60).cast("bigint"), secs % 60)
    return e.select(
        F.concat(F.lit(" =CBS01."), kind, F.format_string("%03d", F.col("user_id") % 40), F.lit("+S001-U01")).alias("Part name"),
        F.when(F.col("event_id") % 4 == 0, "MCC").otherwise(F.lit("ES")).alias("Group"),
        F.when(F.col("event_id") % 6 != 0, F.concat(F.lit('="'), clock, F.lit('"'))).alias("Duration"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string")).when(F.col("event_id") % 5 == 0, "Disabled")
        .when(F.col("event_id") % 5 == 1, "Item on bellows is active").otherwise(F.lit("Jam")).alias("Alarm text"),
    )


ALARM_SQL = """
alarms AS (
  SELECT CASE event_type WHEN 'click' THEN 'DBS' WHEN 'view' THEN 'IAS' WHEN 'error' THEN 'CHU' WHEN 'signup' THEN 'ES' ELSE 'X' END AS kind,
         lpad(CAST(user_id % 40 AS VARCHAR), 3, '0') AS num,
         CASE WHEN event_id % 4 = 0 THEN 'MCC' ELSE 'ES' END AS grp,
         CASE WHEN event_id % 6 <> 0 THEN CAST(floor(value * 100) AS BIGINT) % 200000 END AS secs,
         CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 'Disabled'
              WHEN event_id % 5 = 1 THEN 'Item on bellows is active' ELSE 'Jam' END AS txt
  FROM events)"""


def hms_sql(secs: str) -> str:
    s = f"CAST(trunc({secs}) AS BIGINT)"
    return (f"CASE WHEN ({secs}) IS NULL THEN '' ELSE printf('%02d:%02d:%02d', {s} // 3600, ({s} % 3600) // 60, {s} % 60) END")
