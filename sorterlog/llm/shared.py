"""Small helpers of this subpackage."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows in one Arrow batch. Texts can be long, so batches hold few of them.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it, keep Arrow batches small, drop shuffle files when a query ends."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    environment.setdefault("TOKENIZERS_PARALLELISM", "false")
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; -1 for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % folds, F.lit(-1))


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    """A column by its whole name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of at most `most` units in sum; an item that is larger stands alone."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


@functools.lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
