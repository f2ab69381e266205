"""Combine a directory of headed ';' logs into one table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.headed import body_lines, field_count, header_lines, numbered_lines, read_headed
from sorterlog.sources.staging import stage


def combine_logs(spark: SparkSession, directory: str, suffix: str = "*.log") -> DataFrame:
    """Union of all logs of a directory over the union of their columns.

    Files may differ in their header. Lines with more fields than their header
    are skipped. `source_file` holds the base name.
    """
    return read_headed(spark, f"{directory.rstrip('/')}/{suffix}", skip_unreadable=True, drop_long=True)


def _one_slash(path: Column) -> Column:
    """A path with one slash after its scheme; listings and metadata differ in that."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def combine_report(spark: SparkSession, directory: str, suffix: str = "*.log") -> DataFrame:
    """What became of each file of `combine_logs`: file, bytes, rows, skipped (lines longer than the header) and status.

    The status is `read`, `empty` (no bytes) or `unreadable` (bytes, but no
    line could be had from them). Files are listed by their metadata, their content is not
    loaded for that; a file that breaks off later counts with the lines before the break.
    The names come from the listing that every scan makes on the driver; sizes are those of files that a scan would open, which empty ones are not.
    """
    path = f"{directory.rstrip('/')}/{suffix}"
    found = spark.read.format("binaryFile").load(path)
    names = spark.createDataFrame([(f,) for f in found.inputFiles()], "_name string")
    sized = found.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("bytes"))
    same = _one_slash(F.col("_name")) == _one_slash(F.col("_file"))
    listed = names.join(sized, same, "left").select(
        "_file", F.url_decode(F.replace(F.substring_index("_name", "/", -1), F.lit("+"), F.lit("%2B"))).alias("file"), F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes"),
    )
    lines = numbered_lines(spark, path, skip_unreadable=True)
    headers = stage(header_lines(lines), "headers")
    long = field_count(F.col("value")) > F.size(F.split("_header", ";"))
    counts = body_lines(lines, headers).groupBy("_file").agg(F.count_if(~long).alias("rows"), F.count_if(long).alias("skipped"))
    known = headers.select("_file", F.lit(True).alias("_known"))
    found = listed.join(broadcast_if_small(known), "_file", "left").join(counts, "_file", "left")
    status = F.when(F.col("_known"), "read").when(F.col("bytes") == 0, "empty").otherwise("unreadable")
    nothing = F.lit(0).cast("long")
    return found.select("file", "bytes", F.coalesce("rows", nothing).alias("rows"), F.coalesce("skipped", nothing).alias("skipped"), status.alias("status"))
