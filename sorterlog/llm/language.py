"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts per language in each task and then in Spark. The
model is a matrix of log probabilities (languages x buckets), broadcast to the
scoring tasks. A batch of texts becomes one array of bucket numbers with text
borders, a sparse row per text; its product with the matrix is a gather and a
segmented sum.

Texts are lower-cased; each run of characters that are no letters counts as
one border. Null texts and texts without a letter are `und` with score 0. The
score is the posterior probability of the predicted language. Ties go to the
language that sorts first. Without any labelled text every text is `und`.

More than `MAX_LANGUAGES` labels (dirty ones, say) are scored in slices of so
many rows of the matrix, one after the other; each keeps the best label so far
and the sum over all, so the result is that of one matrix. The labels and their numbers of texts are
held by the driver, the counts stay in a table.

Long texts are scored whole, repeated rows one by one, an empty table gives an
empty one, and further columns may have any names and stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog.llm.shared import code_points, col, fresh, letters, prepare, slices
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.staging import stage, unstage

ORDERS = (1, 2, 3)
BITS = 15
UNDETERMINED = "und"
#: Bounds of the model: labelled texts per language for the fit, and languages (each is a row of 128 kB).
MAX_FIT_TEXTS = 8192
MAX_LANGUAGES = 1024
#: Languages whose counts a task holds before it passes them on.
HELD_LANGUAGES = 256
CHUNK = 2_000_000


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray


@dataclass(frozen=True)
class SlicedModel:
    """Labels in order with their numbers of texts, and the table (l, bucket, n) of their counts."""

    languages: tuple[str, ...]
    texts: tuple[int, ...]
    counts: DataFrame

    def parts(self) -> Iterator[LanguageModel]:
        for a in range(0, len(self.languages), MAX_LANGUAGES):
            names = self.languages[a : a + MAX_LANGUAGES]
            yield model_of(names, self.texts[a : a + MAX_LANGUAGES], sum(self.texts), self.counts.where(F.col("l").between(names[0], names[-1])))


def model_of(names: tuple[str, ...], texts: tuple[int, ...], all_texts: int, counts: DataFrame) -> LanguageModel:
    found = counts.toPandas()  # at most languages x buckets rows
    total = np.ones((len(names), 1 << BITS))
    place = {name: i for i, name in enumerate(names)}
    total[found["l"].map(place).to_numpy(int), found["bucket"].to_numpy(int)] += found["n"].to_numpy()
    return LanguageModel(names, np.log(np.array(texts, float) / all_texts), np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32))


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts in one array, the text number of each symbol, and the letters of each text."""
    parts = ["\n" + t.lower() + "\n" for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    points = code_points("".join(parts))
    starts = np.cumsum(sizes) - sizes
    letter = letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[starts] = True
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)[keep]
    return np.where(letter, points, np.uint32(32))[keep], owner, np.add.reduceat(letter.astype(np.int64), starts)


def grams(symbol: np.ndarray, owner: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each position, and which of them lie inside one text."""
    n = max(len(symbol) - order + 1, 0)
    mixed = np.full(n, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(order):
        mixed = (mixed ^ symbol[k : k + n]) * np.uint32(0x85EBCA6B)
        mixed ^= mixed >> np.uint32(15)
    return (mixed * np.uint32(0xC2B2AE35)) >> np.uint32(32 - BITS), owner[:n] == owner[order - 1 : order - 1 + n]


def count_grams(texts: list[str]) -> np.ndarray:
    total = np.zeros(1 << BITS, np.int64)
    for a, b in slices([len(t) for t in texts], CHUNK):
        symbol, owner, _ = symbols(texts[a:b])
        for order in ORDERS:
            bucket, inside = grams(symbol, owner, order)
            total += np.bincount(bucket[inside], minlength=1 << BITS)
    return total


def log_likelihood(texts: list[str], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Per text and language the log posterior up to a constant, and the letters of each text."""
    out, counts = np.zeros((len(texts), len(model.languages))), np.zeros(len(texts), np.int64)
    for a, b in slices([len(t) for t in texts], CHUNK):
        symbol, owner, counts[a:b] = symbols(texts[a:b])
        starts = np.searchsorted(owner, np.arange(b - a))
        for order in ORDERS:
            bucket, inside = grams(symbol, owner, order)
            at = np.minimum(starts, max(len(bucket) - 1, 0))
            for k in range(len(model.languages)):
                if len(bucket):
                    value = model.log_prob[k][bucket]
                    value[~inside] = 0
                    summed = np.add.reduceat(value, at, dtype=np.float64)
                    summed[starts > at] = 0
                    out[a:b, k] += summed
    return out + model.log_prior, counts


def predict_texts(texts: pd.Series, model: LanguageModel) -> pd.DataFrame:
    values = ["" if t is None else t for t in texts]
    if not model.languages or not values:
        return pd.DataFrame({"language": [UNDETERMINED] * len(values), "score": [0.0] * len(values)})
    joint, counts = log_likelihood(values, model)
    best = joint.argmax(axis=1)
    with np.errstate(under="ignore"):
        score = 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)
    known = counts > 0
    names = np.array(model.languages, dtype=object)[best]
    return pd.DataFrame({"language": np.where(known, names, UNDETERMINED), "score": np.where(known, score, 0.0)})


def slice_scores(texts: pd.Series, model: LanguageModel) -> pd.DataFrame:
    """Per text the best label of a slice, its log posterior and the logarithm of the sum over the slice, up to a constant of the text."""
    values = ["" if t is None else t for t in texts]
    if not values:
        return pd.DataFrame({"language": [], "best": [], "total": [], "known": []})
    joint, counts = log_likelihood(values, model)
    best = joint.max(axis=1)
    with np.errstate(under="ignore"):
        total = best + np.log(np.exp(joint - best[:, None]).sum(axis=1))
    return pd.DataFrame({"language": np.array(model.languages, dtype=object)[joint.argmax(axis=1)], "best": best, "total": total, "known": counts > 0})


def fit(df: DataFrame, text: str = "text", language: str = "lang", key: str = "doc_id", max_fit_texts: int = MAX_FIT_TEXTS) -> LanguageModel | SlicedModel:
    """Learn from the rows whose text and language are not null.

    At most about `max_fit_texts` texts per language are used, chosen by a hash
    of the key (of the text where the key is null); smaller languages are used whole.
    """
    spark = prepare(df.sparkSession)
    rows = df.select(col(key).alias("k"), col(text).alias("t"), col(language).alias("l")).where("t is not null and l is not null")
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).toLocalIterator()}
    if not sizes:
        return LanguageModel((), np.zeros(0), np.zeros((0, 1 << BITS), np.float32))
    shares = spark.createDataFrame([(k, min(1.0, max_fit_texts / n)) for k, n in sizes.items()], "l string, share double")
    chosen = (
        rows.join(broadcast_if_small(shares), "l")
        .where(F.pmod(F.when(F.col("k").isNull(), F.xxhash64("t")).otherwise(F.xxhash64("k", F.lit("fit"))), F.lit(1 << 20)) < F.col("share") * (1 << 20))
        .select("l", "t")
    )

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}

        def finished() -> Iterator[pd.DataFrame]:
            for name, total in totals.items():
                bucket = np.flatnonzero(total)
                yield pd.DataFrame({"l": name, "bucket": bucket.astype(np.int32), "n": total[bucket]})
            totals.clear()

        for batch in batches:
            for name, group in batch.groupby("l"):
                totals[name] = totals.get(name, 0) + count_grams(list(group["t"]))
                if len(totals) >= HELD_LANGUAGES:
                    yield from finished()
        yield from finished()

    summed = stage(
        chosen.mapInPandas(counts, "l string, bucket int, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")),
        "language-counts",
    )
    names = tuple(sorted(sizes))
    texts = tuple(sizes[n] for n in names)
    return model_of(names, texts, sum(texts), summed) if len(names) <= MAX_LANGUAGES else SlicedModel(names, texts, summed)


def with_language(df: DataFrame, model: LanguageModel | SlicedModel, out: str, text: str = "text") -> DataFrame:
    """`df` with a struct column `out` of language and score."""
    spark = prepare(df.sparkSession)
    if isinstance(model, SlicedModel):
        return _with_slices(df, model, out, text)
    shared = spark.sparkContext.broadcast(model)  # at most MAX_LANGUAGES rows of 128 kB

    def predict(texts: pd.Series) -> pd.DataFrame:
        return predict_texts(texts, shared.value)

    udf = F.pandas_udf(predict, "language string, score double")
    return df.withColumn(out, udf(col(text)))


def _with_slices(df: DataFrame, model: SlicedModel, out: str, text: str) -> DataFrame:
    """The same by one slice of labels after the other; rows are written between, so one slice at a time is held."""
    now, kept, found = df, fresh(df, "so_far"), fresh(df, "slice")
    for part in model.parts():
        shared = df.sparkSession.sparkContext.broadcast(part)
        scores = F.pandas_udf(lambda texts: slice_scores(texts, shared.value), "language string, best double, total double, known boolean")
        scored, one = now.withColumn(found, scores(col(text))), col(found)
        if now is df:
            after = scored.withColumnRenamed(found, kept)
        else:
            last = col(kept)
            high, low = F.greatest(last["total"], one["total"]), F.least(last["total"], one["total"])
            better = one["best"] > last["best"]  # a tie stays with the earlier label
            merged = F.struct(
                F.when(better, one["language"]).otherwise(last["language"]).alias("language"), F.greatest(last["best"], one["best"]).alias("best"),
                (high + F.log1p(F.exp(low - high))).alias("total"), one["known"].alias("known"),
            )
            after = scored.withColumn(kept, merged).drop(found)
        before, now = now, stage(after, "language-slices")
        unstage(before)
        shared.unpersist()
    end = col(kept)
    name = F.when(end["known"], end["language"]).otherwise(F.lit(UNDETERMINED)).alias("language")
    score = F.when(end["known"], F.exp(end["best"] - end["total"])).otherwise(F.lit(0.0)).alias("score")
    return now.withColumn(kept, F.struct(name, score)).withColumnRenamed(kept, out)


def keep_identified(df: DataFrame, model: LanguageModel | SlicedModel, min_score: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of `df` whose language is determined with at least `min_score`; the columns stay as they are."""
    name = fresh(df, "identified")
    found = with_language(df, model, name, text)
    return found.where((F.col(name)["language"] != UNDETERMINED) & (F.col(name)["score"] >= min_score)).drop(name)
