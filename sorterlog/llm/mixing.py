"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source is cut into blocks of documents by a hash of the key. A source
whose target is r times its size gives every block floor(r) times and a part
of its blocks once more; each (block, round) is a unit. The exact numbers of
units per source are then split among the output shards by a binary tree: at
every node the left half's share of each source is a multivariate
hypergeometric draw from the units that remain. Each source's units are
permuted, and every shard takes its own consecutive, disjoint range of the
permutation. Inside a shard rows are sorted by a hash.

The number of blocks is bounded (`MAX_BLOCKS` in all, plus one per source), so
the plan does not grow with the documents. The block at which a source's
target falls and the next ones of the permutation (`CUT_BLOCKS`) are cut by documents: in hash order each document that still fits
is taken, and one more if that comes nearer to the target. All draws come from `seed` and hashes, so reruns agree.

Rows that are the same in key and size are copies of one another there: if only
some of them fit, so many are taken, which ones is decided by
counts per task and never by sorting all of them in one place.

A document's size is its number of words (0 for a null text). Null sources
form one source and come last; null keys hash like any other. An empty table gives an empty mix.
Very long texts are rows like others; one that is larger than what is left is passed over. Further columns may have any names.
The driver holds one entry per source, and per output shard and source a number of units. Shards are at most
`MAX_BLOCKS` / 8; beyond, each is written by several tasks, one after the other in the order of the shard.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, fresh, prepare
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.staging import stage

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
MAX_BLOCKS = 65536
BLOCK_DOCUMENTS = 64
SHARD_WORDS = 5_000_000
#: Blocks of a source, from the one at which its target falls, that are cut by documents.
CUT_BLOCKS = 8
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Source:
    name: str | None
    documents: int
    size: int
    weight: float
    target: float
    blocks: int


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: list[float], cap: float = CAP) -> list[float]:
    """Share the sum of sizes by weight, no source above `cap` times its size; what is over goes to the others by weight."""
    total, out = float(sum(sizes)), [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    left = total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if unit * weights[i] > cap * sizes[i]}
        for i in full or open_:
            out[i] = float(cap * sizes[i]) if full else unit * weights[i]
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


def split_units(units: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Units per shard and source (shards x sources), drawn down a binary tree; shard totals differ by one at most."""
    out = np.zeros((shards, len(units)), np.int64)
    stack = [(0, shards, units.astype(np.int64))]
    while stack:
        a, b, mine = stack.pop()
        if b - a == 1:
            out[a] = mine
            continue
        middle = (a + b) // 2
        want, left = int(mine.sum()) * (middle - a) // (b - a), np.zeros_like(mine)
        rest = int(mine.sum())
        for s in np.flatnonzero(mine):
            left[s] = rng.hypergeometric(int(mine[s]), rest - int(mine[s]), want) if want else 0
            want -= int(left[s])
            rest -= int(mine[s])
        stack += [(middle, b, mine - left), (a, middle, left)]
    return out


def shard_count(narrow: DataFrame) -> tuple[int, int]:
    """Output shards of about SHARD_WORDS words, and the tasks for each when there would be too many."""
    words = narrow.agg(F.sum("size")).first()[0] or 0
    shards = int(min(MAX_BLOCKS // 8, max(8, words // SHARD_WORDS)))
    return shards, int(max(1, -(-words // (shards * SHARD_WORDS)) if words > shards * SHARD_WORDS * 2 else 1))


def source_table(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> list[Source]:
    """One entry per source: its size, weight, target and number of blocks. `rows` has source and size."""
    found = [(r["source"], r["n"], r["w"] or 0) for r in rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("w")).collect()]
    found.sort(key=lambda r: (r[0] is None, r[0] or ""))
    documents = sum(n for _, n, _ in found)
    weight = [weights[i % len(weights)] for i in range(len(found))]
    goal = targets([w for _, _, w in found], weight, cap)
    return [
        Source(name, n, w, weight[i], goal[i], max(1, min(n // BLOCK_DOCUMENTS, MAX_BLOCKS * n // max(documents, 1))))
        for i, (name, n, w) in enumerate(found)
    ]


def draw(sources: list[Source], block_sizes: dict[int, np.ndarray], shards: int, seed: int) -> tuple[list[tuple], list[tuple]]:
    """Units (source, block, round, shard) that the mix takes whole, and the cut blocks of each source (source, block, words, round, shard, place)."""
    orders, whole, cut = [], [], []
    for i, s in enumerate(sources):
        sizes = block_sizes.get(i, np.zeros(s.blocks, np.int64))
        rounds = int(s.target // s.size) if s.size else 1
        left = s.target - rounds * s.size
        order = np.random.default_rng([seed, i, zlib.crc32((s.name or "").encode())]).permutation(s.blocks)
        full = np.cumsum(sizes[order])
        extra = int(np.searchsorted(full, left, side="right")) if s.size else 0
        whole.append([(int(b), r) for r in range(rounds) for b in order] + [(int(b), rounds) for b in order[:extra]])
        if s.size:
            words = float(left - (full[extra - 1] if extra else 0))
            cut += [(i, int(b), words, rounds, place) for place, b in enumerate(order[extra : extra + CUT_BLOCKS])]
        orders.append(np.random.default_rng([seed, i, 1]).permutation(len(whole[-1])))
    rng = np.random.default_rng([seed, len(sources)])
    quota = split_units(np.array([len(w) for w in whole], np.int64), shards, rng)
    units = []
    for i, (mine, order) in enumerate(zip(whole, orders, strict=True)):
        shard = np.repeat(np.arange(shards), quota[:, i])
        units += [(i, *mine[k], int(t)) for k, t in zip(order, shard, strict=True)]
    return units, [(i, b, words, r, int(rng.integers(shards)), place) for i, b, words, r, place in cut]


def assign(
    rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, shards: int | None = None, seed: int = 7,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """Where each document goes. `rows` has key, source and size; `copies` lists (round, shard) of every time it is taken.

    Adds source_size, target and copies. `narrow` has key, source and size of the same rows, written already;
    it is made here if it is not given, so that sizes are counted once for all steps of the plan.
    """
    spark = prepare(rows.sparkSession)
    narrow = stage(rows.select("key", "source", "size"), "mix-sizes") if narrow is None else narrow
    sources = source_table(narrow, weights, cap)
    if not sources:
        return rows.select("*", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"), F.array().cast("array<struct<round:int,shard:int>>").alias("copies"))
    table = spark.createDataFrame(
        [(i, s.name, s.size, s.target, s.blocks) for i, s in enumerate(sources)], "s int, name string, source_size long, target double, blocks int",
    )

    small = broadcast_if_small(table)

    def in_blocks(df: DataFrame) -> DataFrame:
        return df.join(small, F.col("source").eqNullSafe(F.col("name"))).drop("name").withColumn(
            "h", F.xxhash64(F.col("key").cast("string"), F.col("size"), F.lit(seed)),
        ).withColumn("b", F.pmod("h", F.col("blocks").cast("long")).cast("int"))

    sums = in_blocks(narrow).groupBy("s", "b").agg(F.sum("size").alias("w")).toPandas()  # at most MAX_BLOCKS rows and one per source
    block_sizes = {}
    for i, group in sums.groupby("s"):
        block_sizes[i] = np.zeros(sources[i].blocks, np.int64)
        block_sizes[i][group["b"].to_numpy()] = group["w"].to_numpy()
    units, cuts = draw(sources, block_sizes, shards or shard_count(narrow)[0], seed)
    by_block: dict[tuple[int, int], list[tuple[int, int]]] = {(i, b): [] for i, b, *_ in cuts}
    for i, b, r, shard in units:
        by_block.setdefault((i, b), []).append((r, shard))
    at_cut = {(i, b) for i, b, *_ in cuts}
    plan = spark.createDataFrame(
        [(i, b, v, (i, b) in at_cut) for (i, b), v in by_block.items()], "s int, b int, whole array<struct<round:int,shard:int>>, is_cut boolean",
    )
    cut = spark.createDataFrame(cuts, "s int, b int, words double, round int, shard int, place int")
    group_key, units_type = ["s", "b", "h", "size"], "array<struct<round:int,shard:int>>"

    def fitting(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["place", "h", "size"], kind="stable").reset_index(drop=True)
        left, over = float(group["words"].iloc[0]), None
        taken = np.zeros(len(group), np.int64)
        for i, (size, n) in enumerate(zip(group["size"], group["n"], strict=True)):
            taken[i] = n if not size else min(n, int(left // size))
            left -= size * taken[i]
            if taken[i] < n and (over is None or size < group["size"][over]):
                over = i
        if over is not None and group["size"][over] - left < left:  # one more document comes nearer to the target than none
            taken[over] += 1
        return group.assign(taken=taken)[taken > 0][[*group_key, "n", "taken", "round", "shard"]]

    edge = (
        in_blocks(narrow).join(broadcast_if_small(cut), ["s", "b"]).groupBy(*group_key, "words", "round", "shard", "place").agg(F.count("*").alias("n"))
        .groupBy("s").applyInPandas(fitting, "s int, b int, h long, size long, n long, taken long, round int, shard int")  # CUT_BLOCKS blocks of one source
    )
    edge = stage(edge, "mix-cut-blocks").select(*group_key, (F.col("taken") < F.col("n")).alias("some"), "taken", F.array(F.struct("round", "shard")).alias("part"))
    empty = F.array().cast(units_type)
    planned = in_blocks(rows).join(broadcast_if_small(plan), ["s", "b"], "left").withColumn("whole", F.coalesce("whole", empty))
    kept = [*rows.columns, "source_size", "target"]
    # only the rows of cut blocks, a few blocks per source, meet the list of fitting documents
    inside = planned.where("is_cut is not true").select(*kept, F.col("whole").alias("copies"))
    border = planned.where("is_cut").join(edge, group_key, "left")
    either = border.where("some is not true").select(*kept, F.concat("whole", F.coalesce("part", empty)).alias("copies"))
    found = inside.unionByName(either)
    if edge.where("some").isEmpty():
        return found
    divided = numbered(border.where("some"), group_key)
    chosen = F.when(F.col("number") <= F.col("taken"), F.concat("whole", "part")).otherwise(F.col("whole"))
    return found.unionByName(divided.select(*kept, chosen.alias("copies")))


def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """`number` from 1 of each row in its group. Rows are written with running ids first; a task numbers the rows of one task that wrote them."""
    table = stage(rows.withColumn("uid", F.monotonically_increasing_id()), "mix-copies")
    task = F.shiftright("uid", 33).alias("task")
    before = Window.partitionBy(*by).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = table.groupBy(*by, task).agg(F.count("*").alias("m")).select(*by, "task", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*by, "task").orderBy("uid")
    return table.select("*", task).join(bases, [*by, "task"]).withColumn("number", F.col("base") + F.row_number().over(inside))


def mix(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
    weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, shards: int | None = None, seed: int = 7,
) -> DataFrame:
    """The mixed rows: each row of `df` as often as the mix takes it, by shard and shuffled inside each shard."""
    held = fresh(df, "row")
    rows = df.select(F.struct(*[col(c) for c in df.columns]).alias(held), col(key).alias("key"), col(source).alias("source"), word_count(col(text)).alias("size"))
    narrow = stage(rows.select("key", "source", "size"), "mix-sizes")
    shards, tasks = (shards, 1) if shards else shard_count(narrow)
    placed = assign(rows, weights, cap, shards, seed, narrow)
    order = F.xxhash64(F.col("key").cast("string"), F.col("copy")["round"], F.lit(seed))
    shares = placed.select(held, "key", F.explode("copies").alias("copy")).withColumn("order", order)
    task = F.col("copy")["shard"] * tasks + (F.shiftrightunsigned("order", 33) * tasks / (1 << 31)).cast("int")  # a shard is `tasks` partitions, by ranges of the order
    return shares.repartitionById(shards * tasks, task).sortWithinPartitions(task, F.shiftrightunsigned("order", 33), "order").select(f"{held}.*")
