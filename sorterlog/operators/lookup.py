"""Destination names and other small dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorterlog import fixed_values as fv
from sorterlog.functions.fields import defect_category, sort_reason, to_int
from sorterlog.operators.sizing import broadcast_if_small, is_small
from sorterlog.sources.tables import POSITION

NAMES = tuple(fv.MAPPING_NAMES)
#: Neighbouring rows whose rows of one unit form a block, as a power of two; rows and names of a block that are laid out at once.
BLOCK_BITS, ROWS_AT_ONCE, NAMES_AT_ONCE = 13, 256, 64
#: Tasks for each core that blocks are dealt to before they fan out.
TASKS_A_CORE = 8


def build_mapping(dim: DataFrame, key: str = fv.MAPPING_ID, names: tuple[str, ...] = NAMES, position: str = POSITION) -> DataFrame:
    """One row per integer id; of repeated ids the last row wins.

    The last row is found by a maximum over (position, names), which combines
    before the shuffle, so many copies of one id cost nothing. The size check
    for broadcasting is made here, once for all joins with the result.
    """
    last = F.max(F.struct(F.col(position), *[F.col(n) for n in names])).alias("_last")
    return broadcast_if_small(
        dim.withColumn("_id", to_int(key)).where(F.col("_id").isNotNull())
        .groupBy("_id").agg(last)
        .select(F.col("_id").alias(key), *[F.col(f"_last.{n}").alias(n) for n in names])
    )


def in_recirculation(mcid: Column | str) -> Column:
    mcid = F.col(mcid) if isinstance(mcid, str) else mcid
    return F.coalesce(mcid.between(*fv.RECIRCULATION_IDS), F.lit(False))


def add_destinations(
    df: DataFrame,
    mapping: DataFrame,
    mcid: str = "requestedDestMCID",
    names: dict[str, str] | None = None,
    recirculation: bool = False,
    key: str = fv.MAPPING_ID,
) -> DataFrame:
    """Attach destination names by id from `build_mapping`; unknown ids give nulls.

    With `recirculation`, ids of the recirculation range are named so, whether
    the mapping knows them or not; their jackpot name stays as mapped.
    """
    names = fv.MAPPING_NAMES if names is None else names
    dim = mapping.select(F.col(key).alias("_dim_id"), *[F.col(n).alias(f"_{n}") for n in names])
    joined = df.join(dim, F.col(mcid) == F.col("_dim_id"), "left")

    def named(n: str) -> Column:
        if recirculation and n != "Jackpot":
            return F.when(in_recirculation(mcid), F.lit("Recirculation")).otherwise(F.col(f"_{n}"))
        return F.col(f"_{n}")

    return joined.select(*df.columns, *[named(n).alias(out) for n, out in names.items()])


def add_sort_reason(df: DataFrame, code: str = "sortCode") -> DataFrame:
    """Sort reason and defect category of a typed sort code."""
    return df.withColumn("sortReason", sort_reason(code)).withColumn("defectCategory", defect_category("sortReason"))


def join_by_own_name(df: DataFrame, mapping: DataFrame, device: str, dedupe: bool = False, names: dict[str, Column] | None = None) -> DataFrame:
    """Left join on the mapping's own device name: the columns of `df`, then `names` made of the mapping's (both its names if not given).

    A name mapped twice repeats the row, as a plain left join does; `dedupe`
    keeps the last mapping row instead. Where many rows meet many names, the
    result is far larger than both sides. So both are joined as blocks, each of
    rows or names of one unit, that are dealt to all tasks, and two blocks are laid out name by
    name: columns of the result are runs or short cycles then, which files store in little space.
    """
    names = {n: F.col(n) for n in ("Beumer", "Amazon")} if names is None else names
    dim = mapping
    if dedupe:
        dim = dim.groupBy("Beumer").agg(F.max_by("Amazon", POSITION).alias("Amazon"))
    dim = dim.where(F.col("Beumer").isNotNull()).select(F.col("Beumer").alias("_unit"), F.struct(*[c.alias(n) for n, c in names.items()]).alias("_v"))
    others = [c for c in df.columns if c != device]
    rows = df.select(F.col(device).alias("_unit"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("_v"))
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows, listed = _blocks(rows, TASKS_A_CORE * cores), _blocks(dim)
    few = is_small(listed)
    # without a broadcast the rows of a unit are cut into slices, and its names travel once for each of them
    slices = 1 if few else cores
    listed = listed.select("_unit", F.col("_block").alias("_names"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"))
    pairs = rows.withColumn("_slice", F.pmod(F.hash("_at"), F.lit(slices))).join(F.broadcast(listed) if few else listed, ["_unit", "_slice"], "left")
    none = F.array(F.lit(None).cast(listed.schema["_names"].dataType.elementType))
    cells = pairs.select("_unit", F.coalesce("_names", none).alias("_names"), F.explode(_cut("_block", ROWS_AT_ONCE)).alias("_rows"))
    cells = cells.select("_unit", "_rows", F.explode(_cut("_names", NAMES_AT_ONCE)).alias("_names"))
    laid = cells.select("_unit", "_rows", F.explode("_names").alias("_name")).select("_unit", "_name", F.inline("_rows"))
    return laid.select(*[F.col("_unit").alias(c) if c == device else F.col(f"`{c}`") for c in df.columns], *[F.col("_name")[n].alias(n) for n in names])


def _blocks(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """(_unit, _at, _block): the values `_v` of a unit, in lists that hold those of neighbouring rows."""
    placed = df.select("*", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("_at"))
    dealt = placed.repartition(tasks, "_unit", "_at") if tasks else placed
    return dealt.groupBy("_unit", "_at").agg(F.collect_list("_v").alias("_block"))


def _cut(values: str, most: int) -> Column:
    """A list as a list of lists of about the same size, at most `most`."""
    size = F.size(values)
    step = F.ceil(size / F.ceil(size / most)).cast("int")
    return F.transform(F.sequence(F.lit(1), size, step), lambda i: F.slice(values, i, step))
