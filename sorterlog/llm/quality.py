"""Quality scores: random Fourier features, ridge regression and isotonic calibration.

Each text becomes a vector of statistics (shares of character classes, word
and line lengths, repetition, order). The statistics are written once; the fit
and the scores read them. Cosines of random projections of the standardised
statistics approximate a Gaussian kernel. Every task sums its normal
equations, Spark adds them up block by block, and one solve on the driver
gives the ridge weights; its size depends on the number of features only.
Raw scores are calibrated by isotonic regression over a fixed number of bins.

Null texts count as empty. Texts with several labels have their mean as target. If
no label is given, every score is 0.5; labels of one kind give that kind.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.llm.shared import code_points, col, fresh, letters, prepare
from sorterlog.sources.staging import stage

FEATURES = 256
SEED = 11
RIDGE = 1e-3
BINS = 1024
BLOCKS = 16
REACH = 6.0
NAMES = (
    "characters", "words", "lines", "letters", "capitals", "digits", "white", "bars", "marks", "symbols", "beyond_ascii",
    "word_length", "word_spread", "long_words", "short_words", "distinct_words", "top_word", "distinct_lines", "repeated_characters",
    "line_length", "line_end_stops", "stops_per_word", "commas_per_word", "word_end_symbols", "capital_words", "distinct_pairs",
)


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of NAMES."""
    n = len(text)
    if not n:
        return [0.0] * len(NAMES)
    points = code_points(text)
    low = np.bincount(np.minimum(points, 128), minlength=129)
    letter = letters()[points]
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    w, rows = max(len(words), 1), max(len(lines), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    pairs = len(set(zip(words, words[1:], strict=False))) / max(len(words) - 1, 1)
    capitals = int(low[65:91].sum())
    stops, marks = int(low[[33, 46, 63]].sum()), int(low[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]].sum())
    white = int(low[[9, 10, 11, 12, 13, 32]].sum())
    symbols = int(low[33:48].sum() + low[58:65].sum() + low[91:97].sum() + low[123:127].sum()) - marks
    ends = sum(1 for word in words if word[-1] in "#$%&*@^~=+<>|\\/_!")
    return [
        np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), letter.mean(), capitals / n, int(low[48:58].sum()) / n, white / n,
        int(low[124]) / w, marks / n, symbols / n, int(low[128]) / n,
        sizes.mean(), sizes.std(), (sizes > 14).mean(), (sizes <= 3).mean(), len(counts) / w, max(counts.values(), default=0) / w,
        len(set(lines)) / rows, (points[1:] == points[:-1]).mean() if n > 1 else 0.0,
        np.log1p(len(words) / rows), sum(1 for x in lines if x.rstrip()[-1] in ".!?") / rows, stops / w, int(low[44]) / w, ends / w,
        sum(1 for word in words if word.isupper()) / w, pairs,
    ]


def with_statistics(df: DataFrame, out: str, text: str = "text") -> DataFrame:
    prepare(df.sparkSession)

    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t or "") for t in texts])

    return df.withColumn(out, F.pandas_udf(each, "array<double>")(col(text)))


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        return np.hstack((np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases), np.ones((len(z), 1))))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def isotonic(position: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the best rising fit, as one knot per pool."""
    pools: list[list[float]] = []
    for p, m, w in zip(position, mean, weight, strict=True):
        pools.append([p * w, m * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    return np.array([p / w for p, _, w in pools]), np.array([m / w for _, m, w in pools])


def matrix(values: pd.Series) -> np.ndarray:
    return np.array(values.tolist(), float).reshape(-1, len(NAMES))


def fit(rows: DataFrame, stats: str = "stats", label: str = "label", features: int = FEATURES) -> QualityModel:
    """Learn from rows with statistics and a label between 0 and 1 that is not null."""
    spark = rows.sparkSession
    rows = rows.select(col(stats).alias("x"), col(label).cast("double").alias("y")).where("y is not null")
    size = len(NAMES)
    sums = rows.agg(
        F.count("*").alias("n"), F.avg("y").alias("y"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(size)], *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(size)],
    ).first()
    rng = np.random.default_rng(SEED)
    directions, phases = rng.normal(size=(size, features)) / np.sqrt(size), rng.uniform(0, 2 * np.pi, features)
    if not sums["n"]:
        return QualityModel(np.zeros(size), np.ones(size), directions, phases, np.zeros(features + 1), np.array([0.0]), np.array([0.5]))
    mean, spread = np.array([sums[f"m{i}"] for i in range(size)]), np.array([sums[f"s{i}"] for i in range(size)])
    plain = QualityModel(mean, np.where(spread > 1e-9, spread, 1), directions, phases, np.zeros(features + 1), np.array([0.0]), np.array([sums["y"]]))
    if sums["y"] in (0.0, 1.0):
        return plain
    shared, width = spark.sparkContext.broadcast(plain), features + 2

    def normal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for batch in batches:
            z = np.hstack((shared.value.features(matrix(batch["x"])), batch[["y"]].to_numpy()))
            total += z.T @ z
        parts = np.array_split(total, BLOCKS)
        yield pd.DataFrame({"block": range(BLOCKS), "sums": [p.tobytes() for p in parts]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b) for b in group["sums"])
        return pd.DataFrame({"block": group["block"].iloc[:1], "sums": [total.tobytes()]})

    blocks = rows.mapInPandas(normal, "block int, sums binary").groupBy("block").applyInPandas(add, "block int, sums binary")
    gram = np.concatenate([np.frombuffer(r["sums"]) for r in blocks.orderBy("block").collect()]).reshape(width, width)
    left = gram[:-1, :-1] + RIDGE * sums["n"] / features * np.diag([1.0] * features + [0.0])
    weights = np.linalg.solve(left + 1e-9 * np.eye(width - 1), gram[:-1, -1])
    model = QualityModel(mean, plain.scale, directions, phases, weights, plain.knots, plain.values)
    found = spark.sparkContext.broadcast(model)

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = np.clip(found.value.raw(matrix(batch["x"])), -1, 2)
            yield pd.DataFrame({"bin": np.floor((raw + 1) / 3 * BINS).astype(np.int32), "raw": raw, "y": batch["y"]})

    summed = rows.mapInPandas(bins, "bin int, raw double, y double").groupBy("bin").agg(
        F.avg("raw").alias("raw"), F.avg("y").alias("y"), F.count("*").alias("n"),
    ).toPandas().sort_values("raw")  # at most BINS rows
    knots, values = isotonic(summed["raw"].to_numpy(), summed["y"].to_numpy(), summed["n"].to_numpy())
    # a slight slope beyond the pools keeps the order of raw scores
    knots = np.concatenate(([knots[0] - 1], knots, [knots[-1] + 1]))
    values = np.concatenate(([values[0] * 0.5], values, [(values[-1] + 1) / 2]))
    return QualityModel(mean, plain.scale, directions, phases, weights, knots, values)


def with_score(df: DataFrame, model: QualityModel, out: str, stats: str = "stats") -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(model)

    def score(values: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(matrix(values)))

    return df.withColumn(out, F.pandas_udf(score, "double")(col(stats)))


def label_table(labels: DataFrame, learn: Column, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row per labelled key among those to learn from: doc_id and its mean label."""
    return labels.where(learn & col(key).isNotNull() & col(label).isNotNull()).groupBy(col(key).alias("doc_id")).agg(F.avg(col(label)).alias("label"))


def score_table(spark: SparkSession, docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_hash and score of every row of `docs`, learnt from `labels` (doc_id, label)."""
    rows = docs.select(col(key).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    table = stage(with_statistics(rows, "stats").select("doc_id", "text_hash", F.col("stats").cast("array<float>").alias("stats")), "statistics")
    model = fit(table.join(labels, "doc_id"))
    return with_score(table, model, "score").drop("stats")


def keep_good(df: DataFrame, labels: DataFrame, least: float = 0.5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `df` that score at least `least`; the columns stay as they are."""
    stats, score = fresh(df, "statistics"), fresh(df, "score")
    rows = with_statistics(df.select(col(key).alias("doc_id"), col(text).alias("text")).join(labels, "doc_id"), "stats").select("stats", "label")
    model = fit(stage(rows, "labelled-statistics"))
    found = with_score(with_statistics(df, stats, text), model, score, stats)
    return found.where(F.col(score) >= least).drop(stats, score)
