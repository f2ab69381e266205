"""Packages: records of one item without a long gap between them.

`assign_packages` labels rows. `package_table` goes straight to one row per
package; all package metrics read that table, so raw rows are reduced before
the first shuffle and never sorted per item.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import is_multi_read, is_no_read
from sorterlog.operators.lookup import in_recirculation
from sorterlog.operators.ordered import add_session_number
from sorterlog.sources.logs import ORDER

PACKAGE = "RealPackageID"


def package_id(item: Column | str, session: Column | str) -> Column:
    item = F.col(item) if isinstance(item, str) else item
    session = F.col(session) if isinstance(session, str) else session
    return F.when(item.isNotNull(), F.concat_ws("_", item.cast("string"), session.cast("string")))


def package_type(all_no_read: Column, all_multi_read: Column) -> Column:
    return F.when(all_no_read, F.lit("no_read")).when(all_multi_read, F.lit("multi_read")).otherwise(F.lit("normal"))


def is_recirculating(code: str = "sortCode", mcid: str = "requestedDestMCID") -> Column:
    """Success record to a recirculation destination; missing values count as no."""
    return F.coalesce((F.col(code) == 0) & in_recirculation(mcid), F.lit(False))


def session_points(df: DataFrame, key: str = "itemID", ts: str = "timeStamp",
                   gap_seconds: float = fv.SESSION_GAP_SECONDS, out: str = "session") -> DataFrame:
    """Session number of every distinct (key, ts)."""
    points = df.where(F.col(key).isNotNull()).groupBy(key, ts).agg(F.count(F.lit(1)).alias("_n"))
    return add_session_number(points.select(key, ts), key, ts, gap_seconds, out)


def assign_sessions(df: DataFrame, key: str = "itemID", ts: str = "timeStamp",
                    gap_seconds: float = fv.SESSION_GAP_SECONDS, out: str = "session") -> DataFrame:
    """Attach the session number to every row; rows without a key get null.

    The join runs on (key, ts), so a busy key spreads over many tasks.
    """
    points = session_points(df, key, ts, gap_seconds, out).select(
        F.col(key).alias("_k"), F.col(ts).alias("_t"), out
    )
    same = (F.col(key) == F.col("_k")) & F.col(ts).eqNullSafe(F.col("_t"))
    return df.join(points, same, "left").select(*df.columns, out)


def session_table(df: DataFrame, key: str = "itemID", ts: str = "timeStamp", barcode: str = "barcodeAWCS",
                  gap_seconds: float = fv.SESSION_GAP_SECONDS) -> DataFrame:
    """Session number and package type of every distinct (key, ts); written once, it serves all package operators."""
    points = df.where(F.col(key).isNotNull()).groupBy(key, ts).agg(
        F.min(is_no_read(barcode)).alias("_no"), F.min(is_multi_read(barcode)).alias("_multi")
    )
    numbered = add_session_number(points, key, ts, gap_seconds, "session")
    types = numbered.groupBy(key, "session").agg(
        package_type(F.min("_no"), F.min("_multi")).alias("pkg_type")
    )
    return numbered.join(types, [key, "session"]).select(key, ts, "session", "pkg_type")


def at_sessions(df: DataFrame, sessions: DataFrame, *columns: Column | str, key: str = "itemID", ts: str = "timeStamp", how: str = "left") -> DataFrame:
    """Columns of `session_table` joined to the rows of the same (key, ts)."""
    found = sessions.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), *columns)
    same = (F.col(key) == F.col("_k")) & F.col(ts).eqNullSafe(F.col("_t"))
    return df.join(found, same, how).drop("_k", "_t")


def assign_packages(df: DataFrame, key: str = "itemID", ts: str = "timeStamp", barcode: str = "barcodeAWCS",
                    gap_seconds: float = fv.SESSION_GAP_SECONDS, sessions: DataFrame | None = None) -> DataFrame:
    """Attach package id and package type to every row.

    Both depend on (key, ts) alone: the type is worked out per package from
    points and comes back with the session number in one join.
    """
    sessions = session_table(df, key, ts, barcode, gap_seconds) if sessions is None else sessions
    labelled = at_sessions(df, sessions, package_id(key, "session").alias(PACKAGE), "pkg_type", key=key, ts=ts)
    return labelled.select(*df.columns, PACKAGE, "pkg_type")


def package_table(
    df: DataFrame,
    key: str = "itemID",
    ts: str = "timeStamp",
    barcode: str = "barcodeAWCS",
    code: str = "sortCode",
    mcid: str = "requestedDestMCID",
    label_code: str | None = None,
    order: str = ORDER,
    gap_seconds: float = fv.SESSION_GAP_SECONDS,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """One row per package with all that package metrics need.

    `records` rows, `pkg_type`, `recirculates` (more than one row and at least
    one recirculation row), `first` = (label code, mcid) of the earliest row and
    `first_kept` = the same over rows that are no recirculation (null if none).
    `label_code` is the code that defect labels come from, `code` by default.
    Rows are aggregated to (key, ts) first, then to packages; both steps
    combine partial results before their shuffle.
    """
    label = label_code or code
    recirc = is_recirculating(code, mcid)
    row = F.struct(F.col(order).alias("ord"), F.col(label).alias("code"), F.col(mcid).alias("mcid"))
    points = df.where(F.col(key).isNotNull()).groupBy(key, ts).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(is_no_read(barcode)).alias("_no"),
        F.min(is_multi_read(barcode)).alias("_multi"),
        F.max(recirc).alias("_recirc"),
        F.min(row).alias("_first"),
        F.min(F.when(~recirc, row)).alias("_kept"),
    )
    if sessions is None:
        numbered = add_session_number(points, key, ts, gap_seconds, "session")
    else:
        numbered = at_sessions(points, sessions, "session", key=key, ts=ts, how="inner")
    when = F.struct(F.col(ts).isNull(), F.col(ts))
    packages = numbered.groupBy(key, "session").agg(
        F.sum("_n").alias("records"),
        package_type(F.min("_no"), F.min("_multi")).alias("pkg_type"),
        F.max("_recirc").alias("_recirc"),
        F.min_by("_first", when).alias("_first"),
        F.min_by("_kept", F.when(F.col("_kept").isNotNull(), when)).alias("_kept"),
    )
    return packages.select(
        package_id(key, "session").alias(PACKAGE),
        F.col(key).alias(key),
        "session", "records", "pkg_type",
        (F.col("_recirc") & (F.col("records") > 1)).alias("recirculates"),
        F.col("_first.code").alias("first_code"), F.col("_first.mcid").alias("first_mcid"),
        F.col("_kept").isNotNull().alias("has_kept"),
        F.col("_kept.code").alias("kept_code"), F.col("_kept.mcid").alias("kept_mcid"),
    )
