"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard.

Rows are dealt to shards of about `shard_rows` distinct vectors. A shard's
vectors get one more component that brings them all to the same length; then
the largest inner product is the smallest angle. Its graph has layers, each a
flat array of neighbour numbers: every node is in the lowest layer, one in
`degree` of a layer is in the next. Nodes are added in batches; a node's
neighbours are chosen among those a search of the graph so far finds, nearest
first, leaving out those that are closer to a chosen one.

A search walks down the layers and then keeps a pool of the `pool` best nodes
found, expanding the best ones first, for many queries at once. Every query
block meets every shard, and the shard results are merged by score.

Equal vectors are one node that knows its smallest ids, as many as an answer
can hold, so copies neither clog the graph nor get lost. Vectors that are
null, empty, zero or hold null or non-finite components and rows with a null id take no
part; rows that repeat id and vector count once. Vectors meet those of their own
dimension only. Scores are inner products of the original vectors in double
precision; ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, prepare
from sorterlog.llm.vectors import as_matrix, plain, usable
from sorterlog.sources.staging import stage

SHARD_ROWS = 8192
QUERY_ROWS = 4096
DEGREE = 16
BUILD_POOL = 64
SEARCH_POOL = 96
WIDTH = 4
GROUP = 256
SEED = 5


@dataclass
class Graph:
    """Layers from the lowest: node numbers and a flat neighbour array (nodes x degree, -1 where there is none) each."""

    vectors: np.ndarray
    nodes: list[np.ndarray]
    neighbours: list[np.ndarray]


def same_length(vectors: np.ndarray) -> np.ndarray:
    square = (vectors * vectors).sum(axis=1)
    more = np.sqrt(np.maximum(square.max() - square, 0))
    return np.hstack((vectors, more[:, None])).astype(np.float32)


def best_first(ids: np.ndarray, score: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """The `keep` best of each row, best first."""
    if ids.shape[1] > keep:
        top = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
        ids, score = np.take_along_axis(ids, top, 1), np.take_along_axis(score, top, 1)
    order = np.argsort(-score, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)


def walk(vectors: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, entry: np.ndarray, pool: int) -> tuple[np.ndarray, np.ndarray]:
    """The pool of best nodes of one layer for each query, best first; -1 with score -inf where a pool is not full.

    Node numbers count within the layer: `vectors` and `neighbours` are the layer's.
    """
    q, n, degree = len(queries), len(vectors), neighbours.shape[1]
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True
    row = np.arange(q)[:, None]
    ids = np.full((q, pool), n)
    score = np.full((q, pool), -np.inf, np.float32)
    ids[:, 0], score[:, 0] = entry, np.einsum("qd,qd->q", vectors[entry], queries)
    seen[row[:, 0], entry] = True
    opened = np.zeros((q, pool), bool)
    active = np.arange(q)
    while len(active):
        waiting = np.where(opened[active] | (ids[active] == n), -np.inf, score[active])
        pick = np.argpartition(-waiting, WIDTH - 1, axis=1)[:, :WIDTH] if pool > WIDTH else np.tile(np.arange(pool), (len(active), 1))
        chosen = np.take_along_axis(waiting, pick, 1) > -np.inf
        go = chosen.any(axis=1)
        active, pick, chosen = active[go], pick[go], chosen[go]
        if not len(active):
            break
        at = active[:, None]
        opened[at, pick] |= chosen
        near = neighbours[np.where(chosen, ids[at, pick], 0)]
        near = np.where((near >= 0) & chosen[:, :, None], near, n).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[seen[at, near]] = n
        seen[at, near] = True
        fresh = np.where(near < n, np.matmul(vectors[np.minimum(near, n - 1)], queries[active][:, :, None])[:, :, 0], np.float32(-np.inf))
        both = np.concatenate((score[active], fresh), axis=1)
        top = np.argpartition(-both, pool - 1, axis=1)[:, :pool]
        ids[active] = np.take_along_axis(np.concatenate((ids[active], near), axis=1), top, 1)
        opened[active] = np.take_along_axis(np.concatenate((opened[active], np.zeros(near.shape, bool)), axis=1), top, 1)
        score[active] = np.take_along_axis(both, top, 1)
    ids[score == -np.inf] = -1
    return best_first(ids, score, pool)


def spread(vectors: np.ndarray, ids: np.ndarray, score: np.ndarray, degree: int) -> np.ndarray:
    """Up to `degree` neighbours of each row from candidates, best first: near ones that are not closer to a chosen one.

    Candidates left out fill the places that remain free, nearest first.
    """
    n, c = ids.shape
    there = ids >= 0
    near = vectors[np.maximum(ids, 0)]
    between = np.matmul(near, near.transpose(0, 2, 1))
    chosen = np.zeros((n, c), bool)
    count = np.zeros(n, np.int64)
    for k in range(c):
        closer = ((between[:, k, :] > score[:, k, None]) & chosen).any(axis=1)
        take = there[:, k] & ~closer & (count < degree)
        chosen[:, k] = take
        count += take
    order = np.argsort(np.where(chosen, 0, np.where(there, 1, 2)) * c + np.arange(c), axis=1)[:, :degree]
    out = np.take_along_axis(np.where(there, ids, -1), order, 1)
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)


def build_layer(vectors: np.ndarray, degree: int, pool: int, entry: int = 0) -> np.ndarray:
    """Neighbours of each node of a layer."""
    n = len(vectors)
    neighbours = np.full((n, degree), -1, np.int32)
    done = 0
    while done < n:
        batch = np.arange(done, min(n, done + max(64, min(GROUP, done))))
        mine = vectors[batch]
        inner = mine @ mine.T
        np.fill_diagonal(inner, -np.inf)
        ids, score = best_first(np.tile(batch, (len(batch), 1)), inner, min(len(batch), degree))
        ids = np.where(score > -np.inf, ids, -1)
        if done:
            old, old_score = walk(vectors[:done], neighbours[:done], mine, np.full(len(batch), entry), pool)
            ids, score = best_first(np.hstack((old, ids)), np.hstack((old_score, score)), pool)
        neighbours[batch] = spread(vectors, ids, score, degree)
        source = np.repeat(batch, degree)
        target = neighbours[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        goal, first, count = np.unique(target, return_index=True, return_counts=True)
        incoming = np.full((len(goal), count.max()), -1)
        incoming[np.repeat(np.arange(len(goal)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        for a in range(0, len(goal), GROUP):
            to = goal[a : a + GROUP]
            ids = np.hstack((neighbours[to], incoming[a : a + GROUP]))
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            score = np.where(ids >= 0, np.matmul(vectors[np.maximum(ids, 0)], vectors[to][:, :, None])[:, :, 0], np.float32(-np.inf))
            ids, score = best_first(ids, score, min(ids.shape[1], 2 * degree))
            neighbours[to] = spread(vectors, ids, score, degree)
        done = int(batch[-1]) + 1
    return neighbours


def build(vectors: np.ndarray, degree: int = DEGREE, pool: int = BUILD_POOL) -> Graph:
    """The layers of a shard. Node 0 is in every layer and is where searches start."""
    graph = Graph(same_length(vectors), [], [])
    rng = np.random.default_rng(SEED)
    level = np.floor(-np.log(1 - rng.random(len(vectors))) / np.log(degree)).astype(int)
    level[0] = level.max(initial=0)
    for k in range(level[0] + 1):
        nodes = np.flatnonzero(level >= k)
        if k and len(nodes) < 2:
            break
        graph.nodes.append(nodes)
        graph.neighbours.append(build_layer(graph.vectors[nodes], degree * (2 if k == 0 else 1), pool))
    return graph


def search(graph: Graph, queries: np.ndarray, keep: int, pool: int = SEARCH_POOL) -> np.ndarray:
    """The `keep` best nodes found for each query, -1 where there are fewer."""
    asked = np.hstack((queries, np.zeros((len(queries), 1)))).astype(np.float32)
    pool = min(max(pool, keep), len(graph.vectors))
    out = []
    for a in range(0, len(asked), GROUP):
        some = asked[a : a + GROUP]
        at = np.zeros(len(some), np.int64)
        for k in range(len(graph.nodes) - 1, 0, -1):
            nodes = graph.nodes[k]
            found, _ = walk(graph.vectors[nodes], graph.neighbours[k], some, np.searchsorted(nodes, at), 1)
            at = nodes[found[:, 0]]
        found, _ = walk(graph.vectors, graph.neighbours[0], some, at, pool)
        out.append(found[:, :keep])
    found = np.concatenate(out) if out else np.zeros((0, keep), np.int64)
    return np.pad(found, ((0, 0), (0, keep - found.shape[1])), constant_values=-1)


def top(
    df: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, degree: int = DEGREE, build_pool: int = BUILD_POOL, search_pool: int = SEARCH_POOL,
) -> DataFrame:
    """The k nearest rows of each query: query_id, rank, vec_id, score. `is_query` is a condition on the rows of `df`."""
    prepare(df.sparkSession)
    rows = df.select(col(key).cast("long").alias("vec_id"), col(vector).alias("v"), is_query.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))).withColumn("v", plain(F.col("v")))
    first = Window.partitionBy("v").orderBy("vec_id")
    nodes = (
        rows.select("vec_id", "v").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    nodes = stage(nodes.select("v", "members", F.size("v").alias("d")), "vector-nodes")
    asked = rows.where("asks").select("vec_id", "v").distinct().select("vec_id", "v", F.size("v").alias("d"), F.xxhash64("v").alias("h"))
    asked = stage(asked, "vector-queries")
    shards = nodes.groupBy("d").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    blocks = asked.groupBy("d").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("blocks"))

    def graph_of(table: pa.Table) -> pa.Table:
        vectors = as_matrix(table.column("v"))
        graph = build(vectors, degree, build_pool)
        return pa.table({
            "d": table.column("d")[:1], "shard": table.column("shard")[:1], "vectors": [vectors.tobytes()],
            "nodes": [[x.astype("<i4").tobytes() for x in graph.nodes]], "neighbours": [[x.astype("<i4").tobytes() for x in graph.neighbours]],
            "members": [[m.as_py() for m in table.column("members")]],
        })

    dealt = nodes.join(shards, "d").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards").cast("long")).cast("int"))
    number = shards.agg(F.sum("shards")).first()[0] or 1  # a graph is long work for few bytes: one task each
    graphs = stage(
        dealt.repartition(3 * number, "d", "shard").groupBy("d", "shard").applyInArrow(
            graph_of, "d int, shard int, vectors binary, nodes array<binary>, neighbours array<binary>, members array<array<long>>",
        ),
        "vector-graphs",
    )

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        query, other, scores = [], [], []
        if len(left) and len(right):
            d = left.column("d")[0].as_py()
            vectors = np.frombuffer(left.column("vectors")[0].as_py()).reshape(-1, d)
            layers = [np.frombuffer(x, "<i4") for x in left.column("nodes")[0].as_py()]
            graph = Graph(same_length(vectors), [x.astype(np.int64) for x in layers], [
                np.frombuffer(x, "<i4").reshape(len(n), -1) for n, x in zip(layers, left.column("neighbours")[0].as_py(), strict=True)
            ])
            members = left.column("members")[0].as_py()
            ids, asked = right.column("vec_id").to_pylist(), as_matrix(right.column("v"))
            for i, found in enumerate(search(graph, asked, k + 1, search_pool)):
                found = found[found >= 0]
                mine = [
                    (-s, m) for node, s in zip(found.tolist(), (vectors[found] @ asked[i]).tolist(), strict=True) for m in members[node] if m != ids[i]
                ]
                for s, m in sorted(mine)[:k]:
                    query.append(i)
                    other.append(m)
                    scores.append(-s)
        at = pa.array(query, pa.int32())
        return pa.table({
            "query_id": right.column("vec_id").take(at), "h": right.column("h").take(at),
            "vec_id": pa.array(other, pa.int64()), "score": pa.array(scores, pa.float64()),
        })

    every_block = graphs.join(blocks, "d").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    every_shard = (
        asked.join(blocks, "d").join(shards, "d").withColumn("block", F.pmod(F.xxhash64("vec_id", "h"), F.col("blocks").cast("long")).cast("int"))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    )
    found = (
        every_block.groupBy("d", "shard", "block")
        .cogroup(every_shard.select("d", "shard", "block", "vec_id", "v", "h").groupBy("d", "shard", "block"))
        .applyInArrow(look, "query_id long, h long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "h").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
