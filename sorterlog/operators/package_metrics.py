"""Metrics over the package table; each reads one narrow row per package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import defect_category, is_multi_read, is_no_read, normalised, sort_reason
from sorterlog.operators.counts import group_size, pivot_counts, with_remainder
from sorterlog.operators.lookup import add_destinations
from sorterlog.operators.packages import PACKAGE, at_sessions, package_id, session_points


def scanner_metrics(packages: DataFrame) -> DataFrame:
    """Packages in total and by type as four rows; absent types count 0."""
    one = packages.agg(
        F.count(F.lit(1)).alias("t"),
        *[F.count_if(F.col("pkg_type") == kind).alias(kind) for kind in ("normal", "no_read", "multi_read")],
    )
    rows = F.array(
        F.struct(F.lit("total_packages").alias("metric"), F.col("t").alias("count")),
        *[F.struct(F.lit(f"{kind}_packages").alias("metric"), F.col(kind).alias("count"))
          for kind in ("normal", "no_read", "multi_read")],
    )
    return one.select(F.inline(rows))


def sort_counts(packages: DataFrame) -> DataFrame:
    """Packages per sort reason of their first record that is no recirculation."""
    by_code = group_size(packages.where("has_kept"), "kept_code", out="n")
    return (
        by_code.withColumn("sortReason", sort_reason("kept_code")).where(F.col("sortReason").isNotNull())
        .groupBy("sortReason").agg(F.sum("n").alias("count")).orderBy(F.desc("count"), "sortReason")
    )


def reason_destination_counts(packages: DataFrame, mapping: DataFrame, by: str = "Amazon") -> DataFrame:
    """Packages per sort reason and destination name.

    Packages are counted by code and id first; names join the few counts.
    """
    name = fv.MAPPING_NAMES[by]
    by_code = group_size(packages.where("has_kept"), "kept_code", "kept_mcid", out="n")
    named = add_destinations(by_code.withColumn("sortReason", sort_reason("kept_code")), mapping, "kept_mcid", {by: name})
    return (
        named.where(F.col("sortReason").isNotNull() & F.col(name).isNotNull())
        .groupBy("sortReason", name).agg(F.sum("n").alias("count"))
        .orderBy("sortReason", F.desc("count"), name)
    )


def reason_destination_pivot(counts: DataFrame, by: str = "Amazon", columns: list[str] | None = None) -> DataFrame:
    return pivot_counts(counts, "sortReason", fv.MAPPING_NAMES[by], columns=columns)


def recirculation_count(packages: DataFrame) -> DataFrame:
    return packages.agg(F.count_if("recirculates").alias("recirculation_packages"))


def defect_metrics(packages: DataFrame) -> DataFrame:
    """Packages per defect category of their first record, plus the rest as 'No Defect'."""
    by_code = group_size(packages, "first_code", keep_null=True, out="n")
    counts = (
        by_code.withColumn("defectCategory", defect_category(sort_reason("first_code")))
        .groupBy("defectCategory").agg(F.sum("n").alias("count"))
    )
    return with_remainder(counts, "defectCategory", "No Defect", 4)


def row_defect_metrics(df: DataFrame, places: int = 4, remainder: bool = True) -> DataFrame:
    """The same per record: `df` carries `defectCategory`."""
    table = with_remainder(group_size(df, "defectCategory", keep_null=True), "defectCategory", "No Defect", places)
    return table if remainder else table.where(F.col("defectCategory") != "No Defect")


def is_jackpot(code: str = "sortCode", jackpot: str = "Jackpot_Destination") -> Column:
    return F.coalesce((F.col(code) == 0) & (normalised(jackpot) == "jackpot"), F.lit(False))


def jackpot_packages(df: DataFrame, mapping: DataFrame, key: str = "itemID", ts: str = "timeStamp",
                     code: str = "sortCode", mcid: str = "requestedDestMCID",
                     gap_seconds: float = fv.SESSION_GAP_SECONDS, sessions: DataFrame | None = None) -> DataFrame:
    """Distinct (package, destination id) of success records to a jackpot destination.

    Only jackpot records meet the session numbers, which come from all records.
    """
    named = add_destinations(df.where(F.col(code) == 0), mapping, mcid)
    hits = named.where(is_jackpot(code) & F.col(key).isNotNull()).select(
        key, ts, *fv.MAPPING_NAMES.values()
    ).distinct()
    points = session_points(df, key, ts, gap_seconds) if sessions is None else sessions
    return at_sessions(hits, points, "session", key=key, ts=ts, how="inner").select(
        package_id(key, "session").alias(PACKAGE), *fv.MAPPING_NAMES.values()
    ).distinct()


def jackpot_metrics(jackpots: DataFrame) -> DataFrame:
    """Distinct packages per destination, most packages first."""
    names = [fv.MAPPING_NAMES["Beumer"], fv.MAPPING_NAMES["Amazon"]]
    unique = jackpots.where(F.col(names[0]).isNotNull() & F.col(names[1]).isNotNull()).select(*names, PACKAGE).distinct()
    return group_size(unique, *names, out="unique_packages").orderBy(F.desc("unique_packages"), *names)


def jackpot_total(jackpots: DataFrame) -> DataFrame:
    return jackpots.agg(F.count_distinct(PACKAGE).alias("jackpot_packages"))


def run_summary(messages: DataFrame, packages: DataFrame) -> DataFrame:
    """Counts of one run as one row. Records are all messages, before window and list expansion."""
    total = messages.agg(F.count(F.lit(1))).scalar()
    records = F.col("records")
    return packages.agg(
        F.count(F.lit(1)).alias("package_processed"),
        F.count(F.lit(1)).alias("unique_packages"),
        F.count_if("recirculates").alias("recirculation_packages"),
        F.coalesce(F.sum(F.when(records > 1, records)), F.lit(0)).alias("recirculation_records"),
    ).select(total.alias("S04_processed"), "*")


def barcode_scan_metrics(df: DataFrame, item: str = "itemID", barcode: str = "barcodeAWCS") -> DataFrame:
    """Barcode view of scanning: unread items, multi-read items and distinct real barcodes.

    (barcode, item) pairs are made distinct first, so the distinct counts run on a reduced table.
    """
    no, multi = is_no_read(barcode), is_multi_read(barcode)
    kind = F.when(no, F.lit("no_read")).when(multi, F.lit("multi_read")).otherwise(F.lit("normal"))
    value = F.when(no | multi, F.col(item).cast("string")).otherwise(F.col(barcode))
    unique = df.select(kind.alias("kind"), value.alias("value")).where(F.col("value").isNotNull()).distinct()
    one = unique.agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_packages") for k in ("normal", "no_read", "multi_read")])
    return one.withColumn(
        "total_packages", F.col("normal_packages") + F.col("no_read_packages") + F.col("multi_read_packages")
    )
