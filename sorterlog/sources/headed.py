"""Delimited text files that name their columns in a header line, which may differ from file to file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.logs import ORDER, line_order, read_lines
from sorterlog.sources.staging import stage


def numbered_lines(spark: SparkSession, path: str, skip_unreadable: bool = False) -> DataFrame:
    """Lines that are not blank with `_line`, which counts up by one inside a split."""
    return read_lines(spark, path, skip_unreadable).where(F.trim("value") != "").withColumn("_line", F.monotonically_increasing_id())


def header_lines(lines: DataFrame, place: int = 0) -> DataFrame:
    """Per file its header, the line with `place` lines before it, and the header's running id; files without one are left out.

    The first `place` + 1 lines of a file follow each other in number, so
    each is the least of its remainder class, and one aggregation that combines
    before its shuffle finds them all in one pass over the text.
    """
    count = place + 1
    line = F.struct("_line", "value")
    least = F.array(*[F.min(F.when(F.col("_line") % count == i, line)) for i in range(count)])
    found = lines.where(F.col("_block") == 0).groupBy("_file").agg(least.alias("_first"))
    last = found.where(F.forall("_first", lambda x: x.isNotNull())).select("_file", F.array_max("_first").alias("_h"))
    return last.select("_file", F.col("_h.value").alias("_header"), F.col("_h._line").alias("_at"))


def header_names(header: str, sep: str = ";") -> list[str]:
    return [n.strip().strip('"') for n in header.split(sep)]


def field_count(line: Column, sep: str = ";") -> Column:
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), sep))


def body_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines after the header of their file that do not repeat it."""
    joined = lines.join(broadcast_if_small(headers), "_file").where(F.col("value") != F.col("_header"))
    return joined.where((F.col("_block") > 0) | (F.col("_line") > F.col("_at")))


def read_headed(spark: SparkSession, path: str, place: int = 0, sep: str = ";", skip_unreadable: bool = False, drop_long: bool = False) -> DataFrame:
    """All rows over the union of the files' columns, with `source_file` and `_ord`.

    The header of each file is joined to its lines by file name; only the
    distinct headers reach the driver. Blank lines, lines up to the header and
    lines that repeat it are left out, with `drop_long` also those with more
    fields than the header has.
    """
    lines = numbered_lines(spark, path, skip_unreadable)
    headers = stage(header_lines(lines, place), "headers")
    texts = sorted(r["_header"] for r in headers.select("_header").distinct().toLocalIterator())
    if not texts:
        raise ValueError(f"no readable file with a header matches {path}")
    lists = [header_names(t, sep) for t in texts]
    names = list(dict.fromkeys(n for one in lists for n in one))
    places = [(t, len(one), [one.index(n) if n in one else None for n in names]) for t, one in zip(texts, lists)]
    known = F.broadcast(spark.createDataFrame(places, "_header string, _width int, _places array<int>"))
    body = (
        body_lines(lines, headers).join(known, "_header")
    )
    if drop_long:
        body = body.where(field_count(F.col("value"), sep) <= F.col("_width"))
    widest = max(len(one) for one in lists)
    cut = body.select(
        F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(widest)), {"sep": sep, "escape": '"'}).alias("_r"),
        "_places", "source_file", line_order(),
    ).select(F.array(*[F.col(f"_r.c{i}") for i in range(widest)]).alias("_fields"), "_places", "source_file", ORDER)
    return cut.select(*[F.get("_fields", F.get("_places", F.lit(i))).alias(n) for i, n in enumerate(names)], "source_file", ORDER)
