"""The queries with their contract columns, and the pipeline with each of its stages, on a folder of small tables."""

import collections
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sorterlog.llm import mixing, queries, token_ids
from tests.llm.test_near_text import plain_kept

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LIBRARY = Tokenizer.from_file(token_ids.VOCABULARY)


def fold(key, n):
    return zlib.crc32(str(key).encode()) % n


def sentences(rng, vocab, n):
    out = []
    while n > 0:
        k = int(rng.integers(4, 12))
        words = list(rng.choice(vocab, k))
        out.append(" ".join(words).capitalize() + ".")
        n -= k
    return " ".join(out)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(12)
    vocab = {"xx": [f"{a}{b}" for a in ("alba", "brom", "cind", "dora") for b in ("en", "or", "is", "um", "ath", "el", "on")],
             "yy": [f"{a}{b}" for a in ("zûq", "wøk", "vyñ", "ümle", "tsç") for b in ("ö", "å", "ïk", "ëm", "þu")]}
    rows, labels = [], []
    for i in range(320):
        lang = ("xx", "yy")[i % 2]
        good = i % 4 < 3
        text = sentences(rng, vocab[lang], int(rng.integers(30, 90))) if good else " | ".join(f"{w} $$$ {rng.integers(9999)}" for w in rng.choice(vocab[lang], 30))
        rows.append((i, text, lang if i % 7 else None, f"s{i % 3}"))
        if i % 5:
            labels.append((i, int(good), 0))
    near = rows[4][1].split()
    near[-1] = "changed"
    rows += [(400, rows[4][1], "xx", "s0"), (401, " ".join(near), "xx", "s1"), (402, None, "xx", "s0"), (403, "", None, None), (404, "12 !! 34", "yy", "s2"), (405, rows[8][1] + " <|endoftext|> x", "xx", None)]
    path = tmp_path_factory.mktemp("tables").as_uri()
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, dict((i, q) for i, q, _ in labels)


def by_key(df):
    got = {r["doc_id"]: r.asDict() for r in df.collect()}
    assert len(got) == df.count()
    return got


def test_quality_query(spark, folder):
    path, rows, labels = folder
    df = queries.op1_quality(spark, path)
    assert dict(df.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    got = by_key(df)
    assert got.keys() == {r[0] for r in rows}
    assert all(g["held_out"] == (fold(i, 3) == 1) and 0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.5) for i, g in got.items())
    held = [i for i in labels if fold(i, 3) == 1]
    assert np.mean([got[i]["predicted"] == labels[i] for i in held]) > 0.95


def test_language_query(spark, folder):
    path, rows, _ = folder
    df = queries.op8_language(spark, path)
    assert dict(df.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    got = by_key(df)
    for i, text, _, _ in rows:
        plain = "und" if not re.search(r"[^\W\d_]", text or "") else "yy" if re.search("[ûøñüçåïëþ]", text) else "xx"
        assert (got[i]["held_out"], got[i]["lang_pred"]) == (fold(i, 5) == 0, plain)


def fingerprint(text):
    words = re.split(rb"[\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_query(spark, folder):
    path, rows, _ = folder
    got = by_key(queries.op7_simhash(spark, path))
    value = {i: fingerprint(text) for i, text, _, _ in rows}
    assert {i: g["fingerprint"] for i, g in got.items()} == {i: f"{v:016x}" for i, v in value.items()}
    root = {i: i for i in value}
    for _ in range(len(value)):  # the smallest key spreads over the links
        new = {i: min(root[j] for j in value if (value[i] ^ value[j]).bit_count() <= 2) for i in value}
        if new == root:
            break
        root = new
    assert {i: g["component_id"] for i, g in got.items()} == root


def test_mixing_query(spark, folder):
    path, rows, _ = folder
    got = by_key(queries.op10_mixing(spark, path))
    size = {i: len([w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t, _, _ in rows}
    source = {i: s for i, _, _, s in rows}
    names = ["s0", "s1", "s2", None]
    sums = [sum(n for i, n in size.items() if source[i] == s) for s in names]
    goals = dict(zip(names, mixing.targets(sums, [5, 2, 1, 5]), strict=True))
    took = collections.Counter()
    for i, g in got.items():
        assert (g["size"], g["source_size"]) == (size[i], sums[names.index(source[i])]) and g["target"] == pytest.approx(goals[source[i]])
        assert g["taken"] in {k * size[i] for k in range(4)}
        took[source[i]] += g["taken"]
    assert all(abs(took[s] - goals[s]) <= 60 for s in names)


def test_token_queries(spark, folder):
    path, rows, _ = folder
    ids = {i: [*LIBRARY.encode(t or "", add_special_tokens=False).ids, 2] for i, t, _, _ in rows}
    assert 50256 in ids[405]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    got, start = by_key(queries.op5_token_files(spark, path)), 0
    for i in sorted(ids):
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids[i]), crc(ids[i]))
        start += len(ids[i])
    packed = queries.op2_packing(spark, path).collect()
    assert {r["doc_id"] for r in packed} == set(ids) and sum(r["length"] for r in packed) == start
    assert all(r["ids_crc32"] == crc(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]) for r in packed)
    counts = by_key(queries.op13_token_counts(spark, path))
    assert all(counts[i]["n_tokens"] == len(ids[i]) - 1 for i in ids)


def test_every_stage_and_the_whole_run(spark, folder):
    path, rows, labels = folder
    text = {r[0]: r[1] for r in rows}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "quality", "near_duplicates", "mixing", "packing"]

    def step(name, df):
        out = stages[name](spark, df, path)
        if name != "packing":
            assert out.columns == docs.columns
            out.write.parquet(f"{path}/after-{name}")
            return spark.read.parquet(f"{path}/after-{name}")
        return out

    one = step("language", docs)
    assert {r["doc_id"] for r in one.collect()} == {i for i, t in text.items() if re.search(r"[^\W\d_]", t or "")}
    two = step("quality", one)
    kept = {r["doc_id"] for r in two.collect()}
    clean = {r["doc_id"] for r in one.collect()}
    assert np.mean([(i in kept) == (i % 4 < 3) for i in clean if i < 320]) > 0.97
    three = step("near_duplicates", two)
    left = [r["doc_id"] for r in three.collect()]
    assert sorted(left) == plain_kept([(i, text[i], "", "") for i in sorted(kept)])
    assert 4 in left and not {400, 401} & set(left)
    four = step("mixing", three)
    size, source, took = {}, {r["doc_id"]: r["source"] for r in three.collect()}, collections.Counter()
    for i in left:
        size[i] = len(text[i].split())
    copies = collections.Counter(r["doc_id"] for r in four.collect())
    names = sorted(s for s in set(source.values()) if s is not None) + ([None] if None in source.values() else [])
    goals = mixing.targets([sum(size[i] for i in left if source[i] == s) for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))])
    for i, n in copies.items():
        assert n <= 3
        took[source[i]] += n * size[i]
    assert all(abs(took[s] - g) <= 60 for s, g in zip(names, goals, strict=True))
    five = step("packing", four).collect()
    tokens = {i: len(LIBRARY.encode(text[i], add_special_tokens=False).ids) + 1 for i in copies}
    total = collections.Counter()
    for r in five:
        total[r["doc_id"]] += r["length"]
    assert total == {i: n * tokens[i] for i, n in copies.items()}
    fill = collections.Counter()
    for r in five:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 1024
    whole = corpus_pipeline.run(spark, path).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in whole} == total
