"""Intermediate tables.

Some steps are read many times or are expensive to repeat. `stage` writes them
once as Parquet below the cluster's checkpoint folder and reads them back.
Later steps then scan only the columns they need, filters reach the scan, and
lost executors cost no new parse.
"""

from __future__ import annotations

import atexit
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []
_tables: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def staging_folder(spark: SparkSession) -> str:
    """The shared folder the session names; where none is named, one below the warehouse, which executors share too.

    The rule is the same for every master.
    """
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder, removed by `remove_staged`."""
    if not _written:
        atexit.register(remove_staged)
    path = f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and return the written table; a table that `stage` returned is returned as it is."""
    if df in _tables:
        return df
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _tables[table] = path
    return table


def remove_staged(keep: int = 0) -> None:
    """Delete all but the first `keep` tables this process staged; results read from them must be consumed before."""
    while len(_written) > keep:
        try:
            _delete(*_written.pop())
        except Exception:  # noqa: BLE001  the session may be gone at exit; the folder's own clean-up then removes it
            return


def unstage(*tables: DataFrame | None) -> None:
    """Delete staged tables that no later step reads; what `stage` did not write is left alone."""
    for table in tables:
        path = None if table is None else _tables.pop(table, None)
        if path is not None:
            _written.remove((table.sparkSession, path))
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
