"""Size checks in front of broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast `df` when it provably has at most `max_rows` rows and `max_bytes` bytes, else leave the join to Spark.

    A larger side is joined by shuffle, where adaptive execution splits skewed partitions.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether `df` has at most so many rows and bytes. The check looks no further than one row past the bound."""
    wide = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide = wide + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            wide = wide + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            wide = wide + 8
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(wide), F.lit(0)).alias("b")).first()
    return found["n"] <= max_rows and found["b"] <= max_bytes
