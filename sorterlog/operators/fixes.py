"""Corrections of wrong scan defects from a list of ids with comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import zero_pad
from sorterlog.operators.ordered import add_ordinal, slice_bases
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.logs import ORDER
from sorterlog.sources.staging import stage
from sorterlog.sources.tables import POSITION

EXPLANATION = "No Scan Defect Explanation"


def listed_ids(fixes: DataFrame) -> DataFrame:
    """Fix list with padded ids and the running number `_k` of each repetition of an id."""
    listed = fixes.withColumn("_listed", zero_pad("id")).where(F.col("_listed").isNotNull())
    return add_ordinal(
        listed.select("_listed", F.coalesce("comment", F.lit("")).alias("_comment"), POSITION), "_listed", POSITION, "_k"
    )


def matched_rows(df: DataFrame, fixes: DataFrame, index: str = "indexNo", code: str = "sortCode",
                 order: str = ORDER, codes: Sequence[int] = tuple(fv.SCAN_DEFECT_CODES)) -> DataFrame:
    """Row order keys that the list corrects: the k-th listing of an id takes its k-th scan defect.

    Candidates are counted per id and part of the input first. Of each id only
    the parts that hold its first candidates, as many as it has listings, are
    ranked, part by part, so no task ever holds all rows of an id.
    """
    listed = stage(listed_ids(fixes), "listed-ids")
    wanted = listed.groupBy(F.col("_listed").alias("_index")).agg(F.count(F.lit(1)).alias("_listings"))
    candidates = (
        df.where(F.col(code).isin(list(codes))).select(F.col(index).alias("_index"), F.col(order))
        .join(broadcast_if_small(wanted.select("_index")), "_index", "left_semi")
    )
    near = slice_bases(candidates, "_index", order).join(broadcast_if_small(wanted), "_index").where(F.col("_base") < F.col("_listings"))
    ranked = add_ordinal(candidates, "_index", order, "_k", near)
    hits = ranked.join(
        listed.withColumnRenamed("_k", "_lk"), (F.col("_index") == F.col("_listed")) & (F.col("_k") == F.col("_lk")),
    )
    return stage(hits.select(F.col(order).alias("_hit"), "_listed", F.col("_comment")), "fix-hits")


def fix_by_occurrence(df: DataFrame, fixes: DataFrame, index: str = "indexNo", code: str = "sortCode",
                      order: str = ORDER) -> DataFrame:
    """Set the code of matched rows to 0 and note the comment; surplus listings do nothing."""
    hits = broadcast_if_small(matched_rows(df, fixes, index, code, order).drop("_listed"))
    hit = F.col("_hit").isNotNull()
    return (
        df.join(hits, F.col(order) == F.col("_hit"), "left")
        .withColumn(code, F.when(hit, F.lit(0).cast(df.schema[code].dataType)).otherwise(F.col(code)))
        .withColumn(EXPLANATION, F.when(hit, F.col("_comment")).otherwise(F.lit("")))
        .drop("_hit", "_comment")
    )


def fix_by_membership(df: DataFrame, fixes: DataFrame, index: str = "indexNo", code: str = "sortCode") -> DataFrame:
    """Set the code of every row with a listed id to 0 and note the id's last comment."""
    listed = listed_ids(fixes)
    last = listed.groupBy("_listed").agg(F.max_by("_comment", POSITION).alias("_comment"))
    hit = F.col("_listed").isNotNull()
    return (
        df.join(broadcast_if_small(last), F.col(index) == F.col("_listed"), "left")
        .withColumn(code, F.when(hit, F.lit(0).cast(df.schema[code].dataType)).otherwise(F.col(code)))
        .withColumn(EXPLANATION, F.when(hit, F.col("_comment")).otherwise(F.lit("")))
        .drop("_listed", "_comment")
    )


def unapplied_ids(df: DataFrame, fixes: DataFrame, index: str = "indexNo", code: str = "sortCode",
                  any_code: bool = False) -> DataFrame:
    """Listed ids that corrected nothing, one row per listing.

    An id is applied when it has at least one candidate row, so no ranking is
    needed. `any_code` counts rows of every code as candidates.
    """
    listed = listed_ids(fixes).select(F.col("_listed").alias("id"), POSITION)
    rows = df if any_code else df.where(F.col(code).isin(fv.SCAN_DEFECT_CODES))
    wanted = broadcast_if_small(listed.select("id").distinct())
    present = rows.join(wanted, F.col(index) == F.col("id"), "left_semi").select(F.col(index).alias("id")).distinct()
    return listed.join(present, "id", "left_anti")


def scan_defects(df: DataFrame, by_category: bool = False, codes: Sequence[int] = tuple(fv.SCAN_DEFECT_CODES)) -> DataFrame:
    """Narrow list of scan defects: index, time and code."""
    wanted = F.col("defectCategory") == "Scan Defect" if by_category else F.col("sortCode").isin(list(codes))
    return df.where(wanted).select("indexNo", "timeStamp", "sortCode")


