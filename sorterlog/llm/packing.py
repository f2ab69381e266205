"""Best-fit packing of token pieces into sequences of a fixed capacity.

Texts become ids with an end id; only documents longer than the capacity are
cut, into pieces of the capacity, the first of which may be shorter. How many
sequences of which make-up are needed depends on the histogram of piece
lengths alone, at most `capacity` numbers, so the plan is made on the driver at
any size of the data:

* The configuration linear program (a configuration is a multiset of lengths
  that fits) is solved by multiplicative weights. Prices start at the lengths
  themselves and fall for what is covered well; each round adds the best
  configuration at its prices, found by dynamic programming over the capacity.
  Every round's prices give a lower bound on the number of sequences.
* Rounding takes configurations in the order of their weight as often as the
  remaining pieces allow; what is left over by cutting weights to whole numbers
  is packed largest first, each sequence filled by the largest piece that fits.

Spark numbers the pieces of each length (counts per task and length, running
sums) and each number looks up its sequence and offset in the plan.

Null and empty texts are one piece holding only the end id. Repeated rows are
packed as often as they occur. An empty table gives no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, prepare
from sorterlog.llm.token_ids import END, VOCABULARY, encoder
from sorterlog.sources.staging import stage

CAPACITY = 1024
ROUNDS = 300
STEP = 0.25
RATE = 4.0
LARGE_FIRST = 0.01


@dataclass(frozen=True)
class Plan:
    """Runs of pieces: numbers first..last-1 of a length go to sequences sequence.. at an offset. `bound`: no packing has fewer sequences."""

    length: np.ndarray
    first: np.ndarray
    last: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    bound: int


def best_configuration(price: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length (index) is used in the configuration of the largest total price."""
    lengths = np.flatnonzero(price > 0)
    value, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    worth = price[lengths]
    for room in range(1, capacity + 1):
        k = np.searchsorted(lengths, room, side="right")
        value[room], choice[room] = value[room - 1], 0
        if k:
            total = worth[:k] + value[room - lengths[:k]]
            best = int(total.argmax())
            if total[best] > value[room]:
                value[room], choice[room] = total[best], lengths[best]
    used, room = np.zeros(capacity + 1, np.int64), capacity
    while room > 0:
        if choice[room]:
            used[choice[room]] += 1
            room -= choice[room]
        else:
            room -= 1
    return used


def configurations(demand: np.ndarray, capacity: int, rounds: int = ROUNDS) -> tuple[list[np.ndarray], list[float], int]:
    """Configurations with fractional multiplicities that cover `demand` evenly, and a lower bound on the sequences."""
    need = demand > 0
    if not need.any():
        return [], [], 0
    target, share = np.where(need, demand, 1).astype(float), np.arange(capacity + 1) / capacity
    start = share + LARGE_FIRST * share**2  # of equal fills the one of larger pieces
    covered, bound = np.zeros(capacity + 1), float(np.ceil((demand * share).sum()))
    found: dict[bytes, float] = {}
    for _ in range(rounds):
        price = np.where(need, start * np.exp(-RATE * (covered - covered[need].min())), 0)
        used = best_configuration(price, capacity)
        bound = max(bound, float((price * demand).sum() / (price * used).sum()))
        step = STEP * float((target[used > 0] / used[used > 0]).min())
        covered += step * used / target
        found[used.tobytes()] = found.get(used.tobytes(), 0.0) + step
    scale = 1 / float(np.average(covered[need], weights=(demand * share)[need]))
    return [np.frombuffer(k, np.int64) for k in found], [v * scale for v in found.values()], int(np.ceil(bound - 1e-6))


def largest_first(left: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Pack what `left` counts: the largest piece, then again and again the largest that fits, in bulk."""
    left, out = left.copy(), []
    while left.any():
        used, room = np.zeros_like(left), capacity
        while room > 0:
            fits = np.flatnonzero(left[: room + 1] > used[: room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            times = min(room // length, int(left[length] - used[length]))
            used[length] += times
            room -= times * length
        times = int((left[used > 0] // used[used > 0]).min())
        out.append((used, times))
        left -= used * times
    return out


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    demand = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        demand[length] = n
    configs, weights, bound = configurations(demand, capacity, rounds)
    left, rounded = demand.copy(), []
    for used, weight in sorted(zip(configs, weights, strict=True), key=lambda c: -c[1]):
        times = min(int(weight), int((left[used > 0] // used[used > 0]).min()))
        if times:
            rounded.append((used, times))
            left -= used * times
    rounded += largest_first(left, capacity)
    runs, at, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for used, times in rounded:
        offset = 0
        for length in np.flatnonzero(used)[::-1]:
            for _ in range(used[length]):
                runs.append((length, at[length], at[length] + times, sequence, offset))
                at[length] += times
                offset += int(length)
        sequence += times
    table = np.array(sorted(runs), np.int64).reshape(-1, 5).T
    return Plan(*table, sequence, bound)


def place(plan: Plan, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the piece with this length and number."""
    bits = np.int64(40)
    run = np.searchsorted((plan.length << bits) + plan.first, (length.astype(np.int64) << bits) + number, side="right") - 1
    return plan.sequence[run] + number - plan.first[run], plan.offset[run]


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of `size` ids."""
    head = size % capacity
    return ([(0, head)] if head else []) + [(a, capacity) for a in range(head, size, capacity)]


def pieces(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """One row per piece, with its task and its number among that task's pieces of the same length; written once."""
    prepare(df.sparkSession)
    rows = df.select(col(key).alias("doc_id"), col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, number long" + ", ids array<int>" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, task = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            owner, values = [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, ids in enumerate(encoder(vocabulary).encode(texts)):
                ids = np.append(ids, np.uint32(END)).astype("<u4")
                for k, (a, n) in enumerate(cut(len(ids), capacity)):
                    part = ids[a : a + n]
                    owner.append(i)
                    values.append((k, a, n, zlib.crc32(part.tobytes()), task, int(seen[n]), *([part.astype(np.int32)] if with_ids else [])))
                    seen[n] += 1
            if owner:
                columns = list(zip(*values, strict=True))
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number", "ids"][: len(arrays) + 1]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), *arrays], names)
        encoder(vocabulary).forget()

    return stage(rows.mapInArrow(encode, schema), "pieces")


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset; `with_ids` adds the ids themselves."""
    spark = prepare(df.sparkSession)
    table = pieces(df, key, text, capacity, vocabulary, with_ids)
    counts = stage(table.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(make_plan(histogram, capacity))  # its size depends on the capacity only
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")

    def assign(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = place(plan.value, length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = table.join(bases, ["task", "length"]).withColumn(
        "at", F.pandas_udf(assign, "sequence_id long, offset long")("length", F.col("number") + F.col("base")),
    )
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, at most `capacity` of them, from pieces packed `with_ids`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
