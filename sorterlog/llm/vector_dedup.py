"""Near duplicates among embeddings by int8 tile products with rigorous error bounds.

Vectors are compared inside a label. Equal vectors form one class, so copies
cost one row. The classes of a label are dealt to blocks of about
`block_rows`, and every pair of blocks is one tile. In a tile unit vectors
u = q / s + e are quantised to int8 codes q with a scale s and a rest e of known
length, so

    |u.v - (q.p) / (s t)|  <=  |q / s| |rest of v|  +  |rest of u|

holds for every pair. Only pairs that may reach the threshold by this bound
are computed in double precision. The product of codes is exact in single
precision up to 1040 dimensions, beyond that it is taken in double precision.

A tile reports, for each class that has links in it, the number of linked
vectors and one edge to the least class its links connect it to, never a list
of pairs. Sums and components of these give the answer.

Vectors that are null, empty, zero or hold null or non-finite components, and
rows without a label, link with nothing. Vectors of different dimension do not link. Repeated
rows count as separate vectors. A null id is never a component_id unless its component has no other id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog.llm.components import components
from sorterlog.llm.shared import col, prepare
from sorterlog.llm.vectors import as_matrix, plain, usable
from sorterlog.sources.staging import stage

THRESHOLD = 0.98
BLOCK_ROWS = 2048
STRIP = 256
EXACT_DIMENSIONS = 1040


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (int8), scales, length of code / scale and length of the rest, both rounded up."""
    scale = 127 / np.abs(unit).max(axis=1)
    codes = np.rint(unit * scale[:, None]).astype(np.int8)
    back = codes / scale[:, None]
    up = 1 + 1e-9
    return codes, scale, np.linalg.norm(back, axis=1) * up, np.linalg.norm(unit - back, axis=1) * up + 1e-12


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lower the labels, in place, until both ends of every pair have the same."""
    while True:
        least = np.minimum(label[a], label[b])
        if (label[a] == least).all() and (label[b] == least).all():
            return
        for end in (label[a], label[b], a, b):
            np.minimum.at(label, end, least)
        while (label[label] != label).any():
            label[:] = label[label]


def tile_links(left: np.ndarray, right: np.ndarray, left_weight: np.ndarray, right_weight: np.ndarray, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the rows of both sides one after the other: the weight of linked rows, and a label shared by linked rows."""
    n, m = len(left), len(right)
    total, label = np.zeros(n + m, np.int64), np.arange(n + m)
    u, v = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (left, right))
    (q, s, ql, qr), (p, t, _, pr) = quantise(u), quantise(v)
    kind = np.float32 if left.shape[1] <= EXACT_DIMENSIONS else np.float64
    turned = p.astype(kind).T
    for a in range(0, n, STRIP):
        b = min(a + STRIP, n)
        near = (q[a:b].astype(kind) @ turned) / (s[a:b, None] * t) + ql[a:b, None] * pr + qr[a:b, None]
        i, j = np.nonzero(near >= threshold - 1e-12)
        i += a
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 200_000):
            ii, jj = i[k : k + 200_000], j[k : k + 200_000]
            dot = np.einsum("ij,ij->i", left[ii], right[jj])
            hit = dot / (np.linalg.norm(left[ii], axis=1) * np.linalg.norm(right[jj], axis=1)) >= threshold
            ii, jj = ii[hit], jj[hit]
            np.add.at(total, ii, right_weight[jj])
            np.add.at(total, jj if same else jj + n, left_weight[ii])
            merge(label, ii, jj if same else jj + n)
    return total, label


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of `df`: vec_id, n_links, component_id and kept."""
    prepare(df.sparkSession)
    rows = df.select(col(key).alias("vec_id"), col(label).alias("label"), col(vector).alias("v"))
    ok = usable(F.col("v")) & F.col("label").isNotNull()
    taking = rows.where(ok).withColumn("v", plain(F.col("v"))).withColumn("h", F.xxhash64("v"))
    classes = taking.groupBy("label", "h", "v").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "vector-classes")
    parts = classes.groupBy("label", F.size("v").alias("d")).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    dealt = (
        classes.select("class", "label", F.size("v").alias("d"), "v", "n").join(parts, ["label", "d"])
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("label", "d", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class", "v", "n")
    )

    def compare(table: pa.Table) -> pa.Table:
        block, low, high = (table.column(c).to_numpy() for c in ("block", "low", "high"))
        ids, weight, values = table.column("class").to_numpy(), table.column("n").to_numpy(), as_matrix(table.column("v"))
        first, second = block == low, block == high
        same = bool(low[0] == high[0])
        if not first.any() or not second.any():
            return pa.table({"class": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        total, group = tile_links(values[first], values[second], weight[first], weight[second], same, threshold)
        both = np.concatenate((ids[first], ids[second]))
        linked = np.flatnonzero(total)
        return pa.table({"class": both[linked], "links": total[linked], "root": both[group[linked]]})

    found = stage(dealt.groupBy("label", "d", "low", "high").applyInArrow(compare, "class long, links long, root long"), "vector-links")
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = (
        classes.join(links, "class", "left").join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(named.join(least, "root").select("label", "h", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"), "vector-components")
    inside = taking.join(named, ["label", "h", "v"]).select("vec_id", "n_links", "component_id")
    outside = rows.where(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.union(outside).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
