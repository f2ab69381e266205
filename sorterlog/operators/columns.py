"""Column-wise cleaning, pruning and typing."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sorterlog.functions import fields as fx


def _string_columns(df: DataFrame, only: Sequence[str] | None) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and (only is None or f.name in only)]


def _map_strings(df: DataFrame, fn: Callable[[Column], Column], only: Sequence[str] | None) -> DataFrame:
    touched = set(_string_columns(df, only))
    return df.select([fn(F.col(f"`{c}`")).alias(c) if c in touched else F.col(f"`{c}`") for c in df.columns])


def scrub_all(df: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Remove quotes and all whitespace in every string column."""
    return _map_strings(df, fx.scrub, only)


def drop_quotes_all(df: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    return _map_strings(df, fx.drop_quotes, only)


def trim_all(df: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    return _map_strings(df, fx.strip, only)


def unquote_all(df: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    return _map_strings(df, fx.strip_and_unquote, only)


def name_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional renaming; a different number of columns is an error."""
    if len(df.columns) != len(names):
        raise ValueError(f"expected {len(names)} columns, found {len(df.columns)}")
    return df.toDF(*names)


def name_columns_to_width(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional renaming with the leading names of a longer list."""
    return name_columns(df, names[: len(df.columns)])


def keep_columns(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep)


def arrange_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename and reorder at once: `names` maps old to new in output order."""
    return df.select([F.col(f"`{old}`").alias(new) for old, new in names.items()])


def first_and_last(df: DataFrame, first: str, last: str) -> DataFrame:
    middle = [c for c in df.columns if c not in (first, last)]
    return df.select(first, *[f"`{c}`" for c in middle], last)


def column_stats(df: DataFrame, columns: Iterable[str] | None = None) -> dict[str, tuple[int, bool]]:
    """Per column (non-null count, has one distinct value), from a single pass.

    One distinct value means smallest equals largest, so the pass keeps two
    values per column and never a set of distinct ones.
    """
    names = [f.name for f in df.schema.fields
             if (columns is None or f.name in columns) and not isinstance(f.dataType, (T.MapType, T.ArrayType))]
    if not names:
        return {}
    aggs = []
    for i, c in enumerate(names):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), F.min(col).eqNullSafe(F.max(col)).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], bool(row[f"s{i}"]) and row[f"n{i}"] > 0) for i, c in enumerate(names)}


def drop_constant_columns(df: DataFrame, protect: Sequence[str] = (), all_null: bool = False) -> DataFrame:
    """Drop columns with exactly one distinct non-null value, except protected ones.

    Columns without any value stay unless `all_null` is set. Runs one
    aggregation, since the schema has to be known before the plan goes on.
    """
    stats = column_stats(df)
    gone = {c for c, (n, single) in stats.items()
            if (single and c not in protect) or (all_null and n == 0)}
    return df.select([F.col(f"`{c}`") for c in df.columns if c not in gone])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are null in every row."""
    stats = column_stats(df)
    return df.select([F.col(f"`{c}`") for c in df.columns if stats.get(c, (1, False))[0] > 0])


def to_int_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fx.to_int(c) for c in columns})


def to_double_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fx.to_double(c) for c in columns})


def numeric_where_possible(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """String columns whose every value reads as a number become double.

    One aggregation decides for all columns together.
    """
    names = _string_columns(df, columns)
    if not names:
        return df
    row = df.agg(*[
        (F.count(F.col(f"`{c}`")) == F.count(fx.to_double(F.col(f"`{c}`")))).alias(f"c{i}")
        for i, c in enumerate(names)
    ]).first()
    numeric = {c for i, c in enumerate(names) if row[f"c{i}"]}
    return df.select([fx.to_double(F.col(f"`{c}`")).alias(c) if c in numeric else F.col(f"`{c}`") for c in df.columns])
