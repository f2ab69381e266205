"""Delimited tables with a header: alarm histories, occurrence reports, mappings, fix lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.sources.headed import read_headed
from sorterlog.sources.logs import ORDER

POSITION = "_pos"


def read_csv_table(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header row; all columns are strings named by the header.

    Only the header line is looked at to plan the scan, values are not inferred.
    """
    return spark.read.csv(path, sep=sep, header=True, escape='"', inferSchema=False)


def read_alarm_history(spark: SparkSession, path: str) -> DataFrame:
    """Alarm history: a banner line, then a ';' header, then rows; each file is read by its own header."""
    return read_headed(spark, path, place=1).drop("source_file", ORDER)


def read_mapping(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Dimension table, all columns as trimmed strings, with row position `_pos`."""
    from sorterlog.operators.columns import trim_all

    raw = read_csv_table(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    text = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns], position_of_row())
    return trim_all(text, raw.columns)


def read_fix_list(spark: SparkSession, path: str) -> DataFrame:
    """List of ids to correct: the first column is the id, the second its comment."""
    raw = read_csv_table(spark, path)
    first, second = raw.columns[:2]
    return raw.select(F.col(f"`{first}`").alias("id"), F.col(f"`{second}`").alias("comment"), position_of_row())


def position_of_row() -> Column:
    """Sort key of a row over all files of a source: file name, start of the split, running id inside it."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"),
    ).alias(POSITION)
