"""SimHash near duplicates by vantage-point trees.

A text's fingerprint takes the majority of each bit over the XXH64 values of
its word shingles. Equal fingerprints form one class, so copies cost one row.
Distinct fingerprints are dealt to shards by a vantage-point tree: a node has
a vantage fingerprint and a radius; what lies within the radius goes inside,
what lies beyond `radius - most_bits` goes outside. By the triangle bound two
fingerprints that differ in at most `most_bits` bits always meet in at least
one child, so the fingerprints near the border, which go to both, make the
search exact. Each shard goes on with its own tree down to small leaves, and
reports a star of edges for each group it finds linked, not all pairs.
Components of these edges give the answer.

The top tree comes from a sample of `LEAF_SAMPLE` fingerprints per leaf; it
affects only balance. Its depth follows the number of distinct fingerprints up
to `MAX_DEPTH`, which bounds the sample and the tree; beyond that the trees
inside the shards grow deeper instead.

Null and empty texts have fingerprint zero and are linked like any other.
Rows that repeat a doc_id stay separate rows. Null ids never become a
component_id unless their class has no other id. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog.llm.components import components
from sorterlog.llm.shared import col, fresh, prepare
from sorterlog.sources.staging import stage

SEED = 42
LEAF_SAMPLE = 16
MAX_DEPTH = 15
SHARD_ROWS = 4096
LEAF_ROWS = 96
PIECE = 400_000


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes set each of the 64 bits (lowest first)."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = 3, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a whole text as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > width:
        starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    total, n = np.zeros(64, np.int64), len(starts)
    hash_ = xxhash.xxh64_intdigest
    for at in range(0, n, PIECE):
        piece = [hash_(joined[a:b], seed) for a, b in zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist(), strict=True)]
        total += bit_counts(np.array(piece, np.uint64))
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0])


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def split(points: np.ndarray, vantage: np.uint64, most_bits: int) -> tuple[int, np.ndarray] | None:
    """The radius that balances both sides best and the distances; None if no radius parts the points."""
    d = distance(points, vantage).astype(np.int64)
    up_to = np.cumsum(np.bincount(d, minlength=65))
    radius = np.arange(65)
    outside = len(points) - np.concatenate((np.zeros(most_bits, np.int64), up_to))[radius]
    larger = np.maximum(up_to, outside)
    best = int(larger.argmin())
    return (best, d) if larger[best] < len(points) else None


def top_tree(sample: np.ndarray, depth: int, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a complete binary tree in level order; a radius of 64 keeps everything inside."""
    vantage, radius = np.zeros((1 << depth) - 1, np.uint64), np.full((1 << depth) - 1, 64, np.int64)
    rng = np.random.default_rng(SEED)
    parts = {0: sample}
    for node in range(len(vantage)):
        mine = parts.pop(node, sample[:0])
        if len(mine) > 1:
            vantage[node] = mine[rng.integers(len(mine))]
            found = split(mine, vantage[node], most_bits)
            if found:
                radius[node], d = found
                parts[2 * node + 1], parts[2 * node + 2] = mine[d <= radius[node]], mine[d > radius[node] - most_bits]
                continue
        parts[2 * node + 1] = mine
    return vantage, radius


def route(points: np.ndarray, vantage: np.ndarray, radius: np.ndarray, depth: int, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each point with the number of every leaf it belongs to."""
    node = np.zeros(len(points), np.int64)
    for _ in range(depth):
        d = distance(points, vantage[node]).astype(np.int64)
        inside, outside = d <= radius[node], d > radius[node] - most_bits
        outside &= radius[node] < 64
        node = np.concatenate((2 * node[inside] + 1, 2 * node[outside] + 2))
        points = np.concatenate((points[inside], points[outside]))
    return points, node


def linked_groups(points: np.ndarray, most_bits: int) -> Iterator[np.ndarray]:
    """Groups of two and more points that links connect, by breadth-first search without a list of pairs."""
    if len(points) <= 4 * LEAF_ROWS:
        near = distance(points[:, None], points[None, :]) <= most_bits
        lone = near.sum(axis=1) == 1
        points = points[~lone]
    left = points
    while len(left):
        group, frontier, left = [left[:1]], left[:1], left[1:]
        while len(frontier) and len(left):
            hit = np.zeros(len(left), bool)
            for at in range(0, len(frontier), 256):
                rest = np.flatnonzero(~hit)
                hit[rest] = (distance(left[rest][:, None], frontier[None, at : at + 256]) <= most_bits).any(axis=1)
            frontier, left = left[hit], left[~hit]
            group.append(frontier)
        found = np.concatenate(group)
        if len(found) > 1:
            yield found


def shard_edges(points: np.ndarray, most_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the linked points of one shard, found by a tree of its own."""
    rng = np.random.default_rng(SEED)
    stack, a, b = [points], [], []
    while stack:
        mine = stack.pop()
        found = split(mine, mine[rng.integers(len(mine))], most_bits) if len(mine) > LEAF_ROWS else None
        if found and max((found[1] <= found[0]).sum(), (found[1] > found[0] - most_bits).sum()) < 0.9 * len(mine):
            radius, d = found
            stack += [mine[d <= radius], mine[d > radius - most_bits]]
            continue
        for group in linked_groups(mine, most_bits):
            a.append(group)
            b.append(np.full(len(group), group.min()))
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (empty, empty)


def links(distinct: DataFrame, most_bits: int = 2, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (`fp`, a signed long) whose components are those of all links."""
    spark = prepare(distinct.sparkSession)
    total = distinct.count()
    depth = min(MAX_DEPTH, max(0, int(np.ceil(np.log2(max(total, 1) / shard_rows)))))
    share = LEAF_SAMPLE * (1 << depth) / max(total, 1) if depth else 0.0
    sample = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < share * (1 << 30)).toPandas()["fp"]
    tree = spark.sparkContext.broadcast(top_tree(np.sort(sample.to_numpy(np.int64)).view(np.uint64), depth, most_bits))  # at most 2^MAX_DEPTH nodes

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            points, leaf = route(batch["fp"].to_numpy(np.int64).view(np.uint64), *tree.value, depth, most_bits)
            yield pd.DataFrame({"leaf": leaf, "fp": points.view(np.int64)})

    def search(group: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_edges(group["fp"].to_numpy(np.int64).copy().view(np.uint64), most_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return distinct.select("fp").mapInPandas(deal, "leaf long, fp long").groupBy("leaf").applyInPandas(search, "a long, b long")


def fingerprints(df: DataFrame, out: str, text: str = "text", width: int = 3) -> DataFrame:
    """`df` with its fingerprint as a signed long in `out`."""
    prepare(df.sparkSession)

    def values(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return df.withColumn(out, F.pandas_udf(values, "long")(col(text)))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", most_bits: int = 2, width: int = 3) -> DataFrame:
    """One row per row of `df`: doc_id, text_hash, fp (signed long), component_id (the smallest key its links reach) and
    first_hash, the text hash that is least among the component's rows with that key."""
    rows = fingerprints(df.select(col(key).alias("doc_id"), col(text).alias("text")), "fp", "text", width)
    rows = stage(rows.select("doc_id", F.xxhash64("text").alias("text_hash"), "fp"), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = stage(rows.groupBy("fp").agg(F.min(order).alias("least")), "fingerprint-classes")
    roots = components(links(classes.select("fp"), most_bits)).withColumnRenamed("node", "fp")
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = stage(rooted.join(least, "root").select("fp", F.col("first.doc_id").alias("component_id"), F.col("first.text_hash").alias("first_hash")), "fingerprint-components")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "first_hash")


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", most_bits: int = 2) -> DataFrame:
    """One row of each component stays, one with the component's smallest key; the columns stay as they are."""
    found = stage(near_duplicates(df, key, text, most_bits), "near-duplicates")
    winners = found.where("doc_id <=> component_id and text_hash = first_hash").groupBy(
        F.col("doc_id").alias("winner"), F.col("text_hash").alias("winner_hash"),
    ).agg(F.count("*").alias("n"))
    winners = stage(winners, "winners")
    held = fresh(df, "row")
    rows = df.select(F.struct(*[col(c) for c in df.columns]).alias(held), col(key).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("winner")) & (F.col("text_hash") == F.col("winner_hash"))
    kept = rows.join(winners, same, "left_semi")
    if not winners.where("n > 1").isEmpty():  # rows that repeat key and text
        kept = kept.dropDuplicates(["doc_id", "text_hash"])
    return kept.select(f"{held}.*")
