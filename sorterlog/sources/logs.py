"""Log Monitor files: one record per line, ';' between fields, no header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import blank_to_null, strip

ORDER = "_ord"


def read_lines(spark: SparkSession, paths: str | Sequence[str], skip_unreadable: bool = False) -> DataFrame:
    """Lines with what places them: `value`, `source_file`, `_file` (path) and `_block` (split start)."""
    reader = spark.read.option("ignoreCorruptFiles", str(skip_unreadable).lower())
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(
        "value",
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def line_order() -> Column:
    """Sort key that restores file order without a shuffle.

    Text splits are read in parallel and carry no line number. The running id
    grows inside a split, the block start orders the splits of a file.
    """
    return F.struct(
        F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("line")
    ).alias(ORDER)


def split_fields(lines: DataFrame, columns: Sequence[str] = tuple(fv.LOG_COLUMNS), line: str = "value",
                 missing: bool = True) -> DataFrame:
    """Cut lines into named string columns; every other column is kept.

    NUL characters vanish, blank lines and lines with too many fields are
    skipped, short lines end in nulls, blanks after a separator are dropped,
    quotes are ordinary characters. With `missing`, texts such as 'NA' are null.

    Lines from `read_lines` get their `_ord` key here, in the same step as the
    cut. Filters on fields then stay above it, so a line is cut just once.
    """
    placed = "_file" in lines.columns and "_block" in lines.columns
    others = [c for c in lines.columns if c not in (line, "_file", "_block")]
    kept = [*others, ORDER] if placed else others
    clean = F.replace(F.col(line), F.lit("\0"), F.lit(""))

    def field(i: int) -> Column:
        text = F.ltrim(F.get(F.col("_fields"), F.lit(i)))
        return blank_to_null(text) if missing else text

    cut = lines.select(*others, *([line_order()] if placed else []), F.split(clean, ";").alias("_fields"))
    return (
        cut.where((F.size("_fields") <= len(columns)) & ((F.size("_fields") > 1) | (strip(F.get("_fields", F.lit(0))) != "")))
        .select(*kept, *[field(i).alias(name) for i, name in enumerate(columns)])
    )


def read_log_monitor(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """12-column log records of one or many files, in `_ord` order."""
    return split_fields(read_lines(spark, paths))


def read_flat_export(spark: SparkSession, paths: str | Sequence[str], width: int = len(fv.FLAT_EXPORT_COLUMNS)) -> DataFrame:
    """Flattened export: the first `width` of 27 names, fields trimmed and unquoted."""
    from sorterlog.operators.columns import unquote_all

    names = fv.FLAT_EXPORT_COLUMNS[:width]
    return unquote_all(split_fields(read_lines(spark, paths), names), names)
