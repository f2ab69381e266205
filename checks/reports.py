"""The remaining tables of whole analyses, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import render as r
from checks.catalog import CARRIER_SQL, FIXED_SQL, carrier_table, measurement_lines, query, rounded
from checks.pipelines import MEASURE_SQL
from sorterlog.plans import alarm_reports
from sorterlog.plans.measurements import item_measurements
from sorterlog.plans.sort_report import s04_analysis

TARGETS = "txt IN ('Disabled', 'Item on bellows is active')"


def carrier(spark, sf, name):
    return alarm_reports.carrier_alarms(carrier_table(spark, sf))[name]


@query("carrier_parts", f"WITH {CARRIER_SQL} SELECT part, count(*) AS total_alarms FROM carriers GROUP BY 1")
def carrier_parts(spark, sf):
    return carrier(spark, sf, "by_part")


@query("carrier_parts_and_texts", f"""WITH {CARRIER_SQL} SELECT part, txt AS "text", count(*) AS "count" FROM carriers WHERE txt IS NOT NULL GROUP BY 1, 2""")
def carrier_parts_and_texts(spark, sf):
    return carrier(spark, sf, "by_part_and_text")


@query("carrier_targets_by_part", f"WITH {CARRIER_SQL} SELECT part, count(*) AS target_alarm_count FROM carriers WHERE {TARGETS} GROUP BY 1")
def carrier_targets_by_part(spark, sf):
    return carrier(spark, sf, "targeted_by_part")


@query("carrier_numbers", f"""WITH {CARRIER_SQL}
SELECT lpad(substr(part, 3), 4, '0') AS carrier_formatted, count(*) AS target_alarms_total FROM carriers WHERE {TARGETS} GROUP BY 1""")
def carrier_numbers(spark, sf):
    return carrier(spark, sf, "targeted_carriers")


@query("carrier_texts", f"""WITH {CARRIER_SQL} SELECT txt AS "text", count(*) AS "count" FROM carriers WHERE txt IS NOT NULL GROUP BY 1""")
def carrier_texts(spark, sf):
    return carrier(spark, sf, "by_text")


@query("carrier_total", f"WITH {CARRIER_SQL} SELECT count(*) AS total_alarms FROM carriers")
def carrier_total(spark, sf):
    return carrier(spark, sf, "total")


def fixed_report(spark, sf):
    """Sort reports with corrections, from rendered lines."""
    return s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True, fixes=r.fix_list(spark, sf))


@query("report_summary", f"""WITH {r.PACKAGE_SQL}
SELECT (SELECT count(*) FROM events) AS "S04_processed", count(*) AS package_processed, count(*) AS unique_packages,
       CAST(sum(CASE WHEN recirculates THEN 1 ELSE 0 END) AS BIGINT) AS recirculation_packages,
       CAST(sum(CASE WHEN records > 1 THEN records ELSE 0 END) AS BIGINT) AS recirculation_records FROM types""")
def report_summary(spark, sf):
    return s04_analysis(r.scan_logs(spark, sf), r.destination_mapping(spark, sf), full=True)["summary"]


@query("report_scan_defects", FIXED_SQL + """
SELECT indexno AS "indexNo", ts AS "timeStamp", code AS "sortCode" FROM scan LEFT JOIN hits ON scan.ord = hits.ord WHERE code IN (8, 9, 10) AND hits.ord IS NULL""")
def report_scan_defects(spark, sf):
    return fixed_report(spark, sf)["scan_defects"]


@query("report_unapplied_ids", FIXED_SQL + """
SELECT id, count(*) AS listings FROM fixes WHERE id NOT IN (SELECT indexno FROM cand) GROUP BY 1""")
def report_unapplied_ids(spark, sf):
    return fixed_report(spark, sf)["unapplied_ids"].groupBy("id").agg(F.count(F.lit(1)).alias("listings"))


@query("measurement_gap_quartiles", MEASURE_SQL + """
SELECT ind AS "inductionNo", round(quantile_cont(gap, 0.25), 6) AS p25, round(quantile_cont(gap, 0.5), 6) AS p50, round(quantile_cont(gap, 0.75), 6) AS p75
FROM g WHERE gap IS NOT NULL GROUP BY 1""")
def measurement_gap_quartiles(spark, sf):
    return rounded(item_measurements(measurement_lines(spark, sf))["gap_quartiles"], 6, "p25", "p50", "p75")
