"""Cases beyond the usual bounds: many labels, hot and equal rows, many sources, long texts."""

import collections

import numpy as np
from pyspark.sql import functions as F

from sorterlog.llm import language, mixing, near_text
from tests.llm.test_operators import DOCS, collected, corpus, documents


def test_labels_in_slices_give_the_result_of_one_matrix(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefghij"[i % 7 :]), 6)) for _ in range(20)), f"l{i % 9}", "s") for i in range(180)]
    rows += [(1000, None, "l1", "s"), (1001, "12 3", "l2", "s"), (None, rows[4][1], "l4", "s")]
    df = documents(spark, rows, extra=True)
    want = {(r["doc_id"], r["text"]): r["found"] for r in language.with_language(df, language.fit(df), "found").collect()}
    monkeypatch.setattr(language, "MAX_LANGUAGES", 4)
    monkeypatch.setattr(language, "HELD_LANGUAGES", 2)
    model = language.fit(df)
    assert isinstance(model, language.SlicedModel) and len(list(model.parts())) == 3
    found = language.with_language(df, model, "found")
    assert found.columns == [*df.columns, "found"]
    for r in found.collect():
        one = want[r["doc_id"], r["text"]]
        assert r["found"]["language"] == one["language"] and abs(r["found"]["score"] - one["score"]) < 1e-9


def test_more_labels_than_one_matrix_holds(spark):
    rows = [(i, f"wort{i % 40} und etwas mehr", f"label{i}", "s") for i in range(1100)]
    df = documents(spark, rows)
    got = language.with_language(df.limit(20), language.fit(df), "found").collect()
    assert len(got) == 20 and all(r["found"]["language"].startswith("label") and 0 < r["found"]["score"] <= 1 for r in got)


def taken(df):
    got = collected(mixing.assign(df.select(F.col("doc_id").alias("key"), "source", mixing.word_count(F.col("text")).alias("size"))))
    size, took, goal = collections.Counter(), collections.Counter(), {}
    for r in got:
        size[r["source"]] += r["size"]
        took[r["source"]] += r["size"] * len(r["copies"])
        goal[r["source"]] = r["target"]
        assert len(r["copies"]) <= 3
    return size, took, goal


def test_equal_rows_are_taken_one_by_one(spark):
    same = [(None, "one two three four five six seven eight nine ten", "l", "b")] * 900
    rows = same + [(i, "w " * 10, "l", "b") for i in range(100)] + [(5000 + i, "x " * 40, "l", "a") for i in range(10)]
    for parts in (1, 7):
        size, took, goal = taken(documents(spark, rows).repartition(parts))
        assert size["b"] == 10_000
        for s in ("a", "b"):
            assert abs(took[s] - goal[s]) <= 40


def test_what_a_long_document_leaves_is_filled_by_the_next_blocks(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(1, 30)), "l", "abc"[i % 3]) for i in range(3000)]
    rows += [(9000 + i, "w " * 5000, "l", "b") for i in range(3)]
    size, took, goal = taken(documents(spark, rows))
    for s in "abc":
        assert abs(took[s] - goal[s]) <= 3


def test_many_sources(spark):
    rows = [(i, "w " * (1 + i % 5), "l", f"host{i % 1000:05d}") for i in range(2000)]
    size, took, goal = taken(documents(spark, rows))
    assert len(size) == 1000 and abs(sum(took.values()) - sum(goal.values())) <= 0.2 * sum(goal.values())
    assert all(abs(took[s] - goal[s]) <= 5 for s in size)


def test_shards_of_several_tasks_keep_their_order(spark, monkeypatch):
    rows = [(i, "w " * 10, "l", "ab"[i % 2]) for i in range(400)]
    df = documents(spark, rows)
    one = [r["doc_id"] for r in mixing.mix(df).collect()]
    monkeypatch.setattr(mixing, "shard_count", lambda narrow: (8, 3))
    several = mixing.mix(df)
    assert several.rdd.getNumPartitions() == 24
    assert [r["doc_id"] for r in several.collect()] == one


def test_masks_of_different_lengths_fold(spark):
    rng = np.random.default_rng(9)
    whole = np.unique(rng.integers(0, 2**63, 1100).astype(np.uint64))
    for n, m in ((1100, 1020), (1100, 900), (70, 60), (20, 16), (1, 0), (0, 0)):
        a, b = near_text.mask(whole[:n]).tolist(), near_text.mask(whole[:m]).tolist()
        got = spark.createDataFrame([(a, b)], "a array<long>, b array<long>").select(near_text.differing_bits("a", "b")).first()[0]
        assert got <= n - m and (n - m) % 2 == got % 2
    assert len(near_text.mask(whole[:1100])) == 2 * len(near_text.mask(whole[:1000]))


def test_near_copies_with_hot_shingles_long_texts_and_odd_columns(spark):
    rng = np.random.default_rng(10)
    line = "this very line stands in each and every text of all"
    base = " ".join(rng.choice([f"w{i}" for i in range(5000)], 1_000_000))
    rows = [(1, base, "l", "s"), (2, base + " more words at the end", "l", "s")]
    rows += [(10 + i, line + " " + " ".join(rng.choice([f"v{k}" for k in range(300)], 12)), "l", "s") for i in range(300)]
    rows += [(400, None, "l", "s"), (401, "", "l", "s"), (402, line, "l", "s"), (403, line.upper(), "l", "s"), (404, line, "l", "s"), (404, line, "l", "s")]
    df = documents(spark, rows, extra=True)
    kept = near_text.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, *range(10, 310), 400, 402]
    assert near_text.keep_first(documents(spark, [])).count() == 0


def test_frequency_levels_count_every_text(spark):
    df = spark.createDataFrame(corpus(), DOCS).repartition(5)
    levels = near_text.frequency_levels(df, "text")
    want = np.zeros(1 << near_text.FREQUENCY_BITS)
    for s in near_text.shingle_sets([r[1] for r in corpus()]):
        np.add.at(want, near_text.bucket(s, near_text.FREQUENCY_BITS), 1)
    assert (levels == np.log2(want + 1).astype(np.uint8)).all()
