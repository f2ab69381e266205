import collections
import datetime
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sorterlog.llm import components, language, licenses, mixing, nearest, packing, pages, quality, simhash, token_files, token_ids, vector_dedup

DOCS = "doc_id long, text string, lang string, source string"
#: Columns whose names clash with those the operators use inside, one more with a strange name.
EXTRA = ["key", "size", "h", "b", "s", "fp", "stats", "score", "language", "row", "row_", "label", "copies", "target", "strange.name"]


def corpus(seed=1, n=120):
    rng = np.random.default_rng(seed)
    vocab = {"xx": ["alba", "brom", "cindel", "dorath", "elmo", "fistor"], "yy": ["zûq", "wøk", "vyñ", "ümle", "tsçh", "qürk"]}
    rows = []
    for i in range(n):
        lang = ("xx", "yy")[i % 2]
        rows.append((i, " ".join(rng.choice(vocab[lang], rng.integers(3, 60))), lang, f"s{i % 3}"))
    rows[7] = (7, None, "xx", None)
    rows[8] = (8, "", "xx", "s1")
    rows[9] = (9, "123 !!", None, None)
    rows[12] = (12, "alba brom <|endoftext|> cindel dorath", "xx", "s0")
    rows[10] = (10, "alba " * 20_000, "xx", "s0")
    rows += [rows[3], rows[3], (None, rows[5][1], "yy", None), (200, rows[4][1], "xx", "s2"), (201, None, None, None)]
    return rows


def documents(spark, rows=None, extra=False):
    df = spark.createDataFrame(corpus() if rows is None else rows, DOCS)
    for name in EXTRA if extra else []:
        df = df.withColumn(name, F.lit(datetime.date(2020, 1, 1)))
    return df


def collected(df):
    return [r.asDict() for r in df.collect()]


# language


def test_language_predicts_and_defines_edges(spark):
    df = documents(spark)
    model = language.fit(df.where("doc_id is not null"))
    assert model.languages == ("xx", "yy")
    found = collected(language.with_language(df, model, "found"))
    for r in found:
        if r["text"] is None or not re.search(r"[^\W\d_]", r["text"]):
            assert r["found"] == ("und", 0.0)
        else:
            assert r["found"]["language"] == r["lang"] and 0 <= r["found"]["score"] <= 1


def test_language_log_likelihood_matches_a_plain_sum():
    model = language.LanguageModel(("a", "b"), np.log([0.5, 0.5]), np.log(np.random.default_rng(0).random((2, 1 << language.BITS))).astype(np.float32))
    texts = ["", "ab", "Ab c", "!", "x" * 50, "é ab\nab"]
    together, _ = language.log_likelihood(texts, model)
    for t, row in zip(texts, together, strict=True):
        symbol, owner, _ = language.symbols([t])
        plain = sum(
            model.log_prob[:, language.grams(symbol[i : i + k], owner[i : i + k], k)[0][0]].astype(float)
            for k in language.ORDERS for i in range(len(symbol) - k + 1)
        ) + model.log_prior
        assert np.allclose(row, plain)


def test_language_keeps_columns_and_handles_empty_tables(spark):
    df = documents(spark, extra=True)
    kept = language.keep_identified(df, language.fit(df))
    assert kept.schema == df.schema
    assert {r["doc_id"] for r in collected(kept)} == {r[0] for r in corpus()} - {7, 8, 9, 201}
    empty = documents(spark, [])
    assert language.keep_identified(empty, language.fit(empty)).count() == 0


# quality


def quality_rows():
    rng = np.random.default_rng(2)
    words = ["stone", "river", "under", "light", "and", "the", "green", "of"]
    rows, labels = [], []
    for i in range(300):
        good = i % 4 != 0
        text = " ".join(rng.choice(words, rng.integers(5, 60))) + "." if good else " | ".join(rng.choice(words, rng.integers(5, 60))) + "###"
        rows.append((i, text, "xx", "s"))
        labels.append((i, int(good)))
    return rows + [(1000, None, None, None), (1001, "", None, None), (None, "the river", None, None)], labels


def test_quality_on_held_out_rows(spark):
    rows, labels = quality_rows()
    learn = spark.createDataFrame(labels, "doc_id long, quality int")
    table = quality.label_table(learn, F.col("doc_id") % 3 != 1)
    found = {r["doc_id"]: r["score"] for r in collected(quality.score_table(spark, documents(spark, rows), table))}
    assert len(found) == len(rows) and all(0 <= s <= 1 for s in found.values())
    held = [(found[i] >= 0.5) == bool(q) for i, q in labels if i % 3 == 1]
    assert np.mean(held) > 0.95
    kept = quality.keep_good(documents(spark, rows, extra=True), table)
    assert kept.columns == documents(spark, [], extra=True).columns
    assert {r["doc_id"] for r in collected(kept)} == {i for i, s in found.items() if s >= 0.5}


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (None, 1), (3, None)], 0.0)])
def test_quality_without_two_kinds_of_labels(spark, labels, score):
    table = quality.label_table(spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
    found = collected(quality.score_table(spark, documents(spark), table))
    assert {r["score"] for r in found} == {score}
    assert quality.score_table(spark, documents(spark, []), table).count() == 0


def test_normal_equations_match_one_solve(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, len(quality.NAMES)))
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y, strict=True)], "stats array<double>, label double").repartition(5)
    model = quality.fit(df, features=32)
    z = model.features(x)
    left = z.T @ z + quality.RIDGE * 200 / 32 * np.diag([1.0] * 32 + [0.0])
    assert np.allclose(model.weights, np.linalg.solve(left + 1e-9 * np.eye(33), z.T @ y), atol=1e-6)
    assert (np.diff(model.values) >= 0).all()


def test_isotonic_is_the_least_squares_rising_fit():
    _, values = quality.isotonic(np.arange(5.0), np.array([0.1, 0.5, 0.2, 0.2, 0.9]), np.ones(5))
    assert values.tolist() == pytest.approx([0.1, 0.3, 0.9])


# SimHash


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, linked):
    root = list(range(len(points)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(points):
            for j, b in enumerate(points[:i]):
                if root[i] != root[j] and linked(a, b):
                    low, high = sorted((root[i], root[j]))
                    root = [low if r == high else r for r in root]
                    changed = True
    return root


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "a b c d a b c", "É à É\x1fx\x85y b", "w " * 3000])
def test_fingerprint_matches_brute_force(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def near_points(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    flips = [base]
    for _ in range(4):
        moved = flips[-1][: n // 2].copy()
        for _ in range(int(rng.integers(1, 4))):
            moved ^= np.uint64(1) << rng.integers(0, 64, len(moved), dtype=np.uint64)
        flips.append(moved)
    return np.unique(np.concatenate(flips))


@pytest.mark.parametrize("bits", [0, 1, 2, 5])
def test_links_find_all_components(spark, bits):
    points = near_points(150, 4)
    df = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    edges = {(r["a"], r["b"]) for r in collected(simhash.links(df, bits, shard_rows=32)) if r["a"] != r["b"]}
    root = plain_components([int(p) for p in points], lambda a, b: (a ^ b).bit_count() <= bits)
    found = dict(zip(points.view(np.int64).tolist(), range(len(points)), strict=True))
    mine = plain_components(range(len(points)), lambda a, b: (ids[a], ids[b]) in pairs or (ids[b], ids[a]) in pairs) if (ids := {v: k for k, v in found.items()}) and (pairs := edges) else list(range(len(points)))
    assert mine == root


def test_shard_tree_matches_brute_force_on_tight_balls():
    rng = np.random.default_rng(5)
    ball = np.unique(np.uint64(0x1234567890ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)))
    a, b = simhash.shard_edges(ball, 2)
    assert set(a.tolist()) == set(ball.tolist()) and len(a) < 40 * len(ball)
    lone = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    assert len(simhash.shard_edges(np.unique(lone), 2)[0]) == 0


def test_near_duplicates_and_keep_first(spark):
    rows = corpus()
    found = collected(simhash.near_duplicates(documents(spark, rows)))
    by = collections.defaultdict(list)
    for i, r in enumerate(rows):
        by[plain_fingerprint(r[1])].append(i)
    prints = sorted(by)
    root = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    ids = collections.defaultdict(list)
    for p, k in zip(prints, root, strict=True):
        ids[k] += [rows[i][0] for i in by[p] if rows[i][0] is not None]
    want = collections.Counter((rows[i][0], p, min(ids[k])) for p, k in zip(prints, root, strict=True) for i in by[p])
    got = collections.Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found)
    assert got == want
    df = documents(spark, rows, extra=True)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in collected(kept)) == sorted({min(v) for v in ids.values()})
    assert simhash.keep_first(documents(spark, [])).count() == 0
    nulls = documents(spark, [(None, "a b c d", None, None), (None, "a b c d", None, None), (None, "zz yy xx ww", None, None)])
    assert sorted(r["text"] for r in collected(simhash.keep_first(nulls))) == ["a b c d", "zz yy xx ww"]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (201, 200), (200, 201)]
    found = {r["node"]: r["root"] for r in collected(components.components(spark.createDataFrame(edges, "a long, b long")))}
    assert found == {i: 10 for i in range(10, 41)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# vectors


def vectors(seed=6, n=162, d=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d))
    base[n // 2 :] = base[: n - n // 2] + rng.normal(size=(n - n // 2, d)) * 0.12
    base[5] = base[6] = base[7]
    rows = [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in enumerate(base)]
    rows[6] = (6, rows[6][1], rows[5][2])
    rows[20] = (20, None, 1)
    rows[21] = (21, [0.0] * d, 1)
    rows[22] = (22, [float("nan")] + [1.0] * (d - 1), 1)
    rows[23] = (23, [None] + [1.0] * (d - 1), 1)
    rows[24] = (24, [float("inf")] + [1.0] * (d - 1), 1)
    rows[25] = (25, rows[26][1], None)
    rows[27] = (27, [], 1)
    rows[28] = (28, [1.0, -0.0], 1)
    rows[40] = (40, [2.0, 0.0], 1)
    return rows


def table_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("h", F.lit("x")).withColumn("class", F.lit(1)).withColumn("v", F.lit(2))


def takes_part(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_vector_dedup_matches_brute_force(spark, block_rows):
    rows = vectors()
    rows += [rows[30], (None, rows[31][1], rows[31][2])]

    def linked(i, j):
        (_, a, la), (_, b, lb) = rows[i], rows[j]
        if i == j or la is None or la != lb or not (takes_part(a) and takes_part(b)) or len(a) != len(b):
            return False
        a, b = np.array(a), np.array(b)
        return a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98

    n = len(rows)
    links = [sum(linked(i, j) for j in range(n)) for i in range(n)]
    root = plain_components(range(n), linked)
    least = {k: min((rows[i][0] for i in range(n) if root[i] == k and rows[i][0] is not None), default=None) for k in set(root)}
    want = collections.Counter((rows[i][0], links[i], least[root[i]], rows[i][0] == least[root[i]]) for i in range(n))
    got = vector_dedup.near_duplicates(table_of(spark, rows), block_rows=block_rows)
    assert collections.Counter(tuple(r) for r in got.collect()) == want
    assert sum(links) > 30
    assert vector_dedup.near_duplicates(table_of(spark, [])).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(7)
    for scale in (1, 100):
        u = rng.normal(size=(200, 30)) ** scale
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        q, s, long, rest = vector_dedup.quantise(u)
        near = (q.astype(float) @ q.T.astype(float)) / (s[:, None] * s)
        assert (np.abs(u @ u.T - near) <= long[:, None] * rest + rest[:, None]).all()


@pytest.mark.parametrize(("shard_rows", "query_rows"), [(8192, 4096), (40, 3)])
def test_nearest_recall_order_and_edges(spark, shard_rows, query_rows):
    rows = vectors(n=400)
    rows += [(1000 + i, rows[10][1], 0) for i in range(60)] + [rows[10], (None, rows[10][1], 0)]
    found = nearest.top(table_of(spark, rows), F.col("vec_id") % 10 == 0, 20, shard_rows=shard_rows, query_rows=query_rows).orderBy("query_id", "rank").collect()
    pool = {(i, tuple(v)) for i, v, _ in rows if i is not None and takes_part(v)}
    by = collections.defaultdict(list)
    for r in found:
        by[r["query_id"]].append(r)
    hit = total = 0
    for q, v in pool:
        if q % 10:
            continue
        exact = sorted((-float(np.dot(v, w)), i) for i, w in pool if i != q and len(w) == len(v))[:20]
        mine = by.pop(q)
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1)) and len(mine) == len(exact)
        keys = [(-r["score"], r["vec_id"]) for r in mine]
        assert keys == sorted(keys)
        for r in mine:
            assert any(i == r["vec_id"] and abs(np.dot(v, w) - r["score"]) < 1e-9 for i, w in pool if len(w) == len(v))
        hit += len({i for _, i in exact} & {r["vec_id"] for r in mine})
        total += len(exact)
    assert not by and hit / total >= 0.95
    assert nearest.top(table_of(spark, []), F.col("vec_id") % 10 == 0).count() == 0


# mixing


def test_targets_fill_up_by_weight():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == pytest.approx([187.5, 75, 37.5])
    assert mixing.targets([10, 100, 100], [5, 2, 1]) == pytest.approx([30, 120, 60])
    assert mixing.targets([0, 0], [5, 2]) == [0, 0]
    assert mixing.targets([], []) == []


def test_split_tree_keeps_quotas():
    rng = np.random.default_rng(8)
    units = np.array([5, 0, 91, 1000])
    out = mixing.split_units(units, 7, rng)
    assert out.sum(axis=0).tolist() == units.tolist() and np.ptp(out.sum(axis=1)) <= 2 and (out >= 0).all()


def test_mix_comes_near_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "w " * int(rng.integers(0, 50)), None, ("a", "b", "c", None, "a")[i % 5]) for i in range(3000)]
    rows += [rows[0], (None, "x y", None, "z"), (9999, None, None, "only")]
    df = documents(spark, rows, extra=True)
    taken = [tuple(sorted((r["doc_id"], r["text"], r["source"]) if r["doc_id"] is not None else (-1, "", "") for r in mixing.mix(d).select("doc_id", "text", "source").collect() if r["doc_id"] is not None and r["source"])) for d in (df, df.repartition(3))]
    assert taken[0] == taken[1]
    narrow = df.select(F.col("doc_id").alias("key"), "source", mixing.word_count(F.col("text")).alias("size"))
    got = collected(mixing.assign(narrow))
    size, took, goal = collections.Counter(), collections.Counter(), {}
    for r in got:
        assert len(r["copies"]) <= 3
        size[r["source"]] += r["size"]
        took[r["source"]] += r["size"] * len(r["copies"])
        goal[r["source"]] = (r["source_size"], r["target"])
    names = sorted((s for s in size if s is not None)) + [None]
    want = mixing.targets([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))])
    for s, t in zip(names, want, strict=True):
        assert goal[s][0] == size[s] and goal[s][1] == pytest.approx(t)
        assert abs(took[s] - t) <= max(2, 0.002 * t)
    assert mixing.mix(df).columns == df.columns
    assert mixing.mix(documents(spark, [])).count() == 0


# token ids


def plain_tokenizer():
    return Tokenizer.from_file(token_ids.VOCABULARY)  # as the library gives it, nothing switched


def test_encoder_equals_the_tokenizer():
    rng, t = np.random.default_rng(10), plain_tokenizer()
    bits = ["'", "s", "t", "re", "ve", "m", "ll", "d", " ", "  ", "\n", "\t", "a", "é", "1", "²", "!", "…", "日本", "\xa0", "　", "😀", "\x00", "\x1c", "\x85", "<|endoftext|>", "S", "'LL", "ß", "word"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 14))) for _ in range(3000)] + ["", "x" * 100_000, "a'll", "hello <|endoftext|> world", "<|endoftext|>" * 3]
    for text, ids in zip(texts, token_ids.encoder().encode(texts), strict=True):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, text


def encoded(rows):
    t = plain_tokenizer()
    return [[*t.encode(r[1] or "", add_special_tokens=False).ids, 2] for r in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, tmp_path):
    rows = corpus()
    manifest = token_files.write(documents(spark, rows, extra=True), f"file://{tmp_path}/out", shard_characters=3000)
    assert manifest.count() > 3
    back = sorted(collected(token_files.read_back(manifest)), key=lambda r: r["start"])
    order = sorted(zip(rows, encoded(rows), strict=True), key=lambda p: (p[0][0] is not None, p[0][0] or 0))
    assert [r["key"] for r in back] == [r[0] for r, _ in order]
    assert [r["n_tokens"] for r in back] == [len(i) for _, i in order]
    assert [r["start"] for r in back] == np.cumsum([0] + [len(i) for _, i in order])[:-1].tolist()
    assert [r["ids_crc32"] for r in back] == [crc(i) for _, i in order]
    wanted = spark.createDataFrame([(3,), (7,), (None,), (10,), (777,), (-5,)], "key long")
    found = collections.Counter((r["key"], r["copy"], crc(r["ids"])) for r in collected(token_files.lookup(manifest, wanted)))
    by = collections.defaultdict(list)
    for r, i in order:
        by[r[0]].append(crc(i))
    assert found == collections.Counter((k, c, x) for k in (3, 7, None, 10) for c, x in enumerate(by[k]))
    empty = token_files.write(documents(spark, []), f"file://{tmp_path}/empty")
    assert empty.count() == 0 and token_files.read_back(empty).count() == 0


def test_index_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 50_000):
        hashes = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        sizes, bits, slot = token_files.build_index(hashes)
        assert sorted(slot.tolist()) == list(range(len(hashes)))
        assert (token_files.find_slots(hashes, sizes, bits) == slot).all()
    with pytest.raises(ValueError):
        token_files.build_index(np.array([5, 5], np.uint64))


# packing


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing_is_whole_gapless_and_tight(spark, capacity):
    rows = corpus()
    packed = packing.pack(documents(spark, rows, extra=True), capacity=capacity, with_ids=True)
    got, ids = collected(packed), encoded(rows)
    want = collections.Counter()
    for r, i in zip(rows, ids, strict=True):
        for k, (a, n) in enumerate(packing.cut(len(i), capacity)):
            want[(r[0], k, a, n, crc(i[a : a + n]))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(len(i) for i in ids)
    assert len(bins) <= int(np.ceil(total / capacity)) * 1.06 + 2
    assert sum(len(r["ids"]) for r in packing.sequences(packed).collect()) == total
    assert packing.pack(documents(spark, []), capacity=capacity).count() == 0


def test_plan_reaches_the_bound_where_pairs_fit_exactly():
    plan = packing.make_plan({n: 10 for n in range(1, 64)}, 64)
    assert plan.sequences == plan.bound == 315
    rng = np.random.default_rng(12)
    sizes = collections.Counter(rng.integers(1, 101, 5000).tolist())
    plan = packing.make_plan(dict(sizes), 100)
    assert plan.bound <= plan.sequences <= plan.bound * 1.02
    assert packing.make_plan({}, 10).sequences == 0


@pytest.mark.parametrize("sizes", [(300, 400), (200, 700), (1, 1025)])
def test_plan_is_no_worse_than_packing_largest_first(sizes):
    rng = np.random.default_rng(16)
    histogram = collections.Counter(rng.integers(*sizes, 20_000).tolist())
    demand = np.zeros(1025, np.int64)
    for n, k in histogram.items():
        demand[n] = k
    plan = packing.make_plan(dict(histogram))
    assert plan.bound <= plan.sequences <= sum(k for _, k in packing.largest_first(demand, 1024))


def test_best_configuration_matches_enumeration():
    rng = np.random.default_rng(13)
    for _ in range(20):
        price = np.where(rng.random(13) < 0.5, rng.random(13), 0)
        price[0] = 0
        best = [0.0] * 13
        for room in range(1, 13):
            best[room] = max([best[room - 1], *[price[n] + best[room - n] for n in range(1, room + 1)]])
        used = packing.best_configuration(price, 12)
        assert (used * price).sum() == pytest.approx(best[12]) and (used * np.arange(13)).sum() <= 12


# licenses


def test_licenses_match_brute_force(spark):
    rng = np.random.default_rng(14)
    bits = ["under the mit license", "Under The MIT-License", "apache license, version 2.0", "cc by nc", "CC BY-NC CC by nc", "é", "the", "license", "x2", "under the", "mit license", "cc by", licenses.TEMPLATES[5].text]
    rows = [(i, " ".join(rng.choice(bits, rng.integers(0, 12))), None, None) for i in range(200)]
    rows += [(500, None, None, None), (501, "", None, None), (502, "cc by nc " * 3000, None, None), rows[3], (None, "cc by nc", None, None)]
    phrases = {t.label: t.text.split() for t in licenses.TEMPLATES if t.exact}
    want = collections.Counter()
    for key, text, _, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        at = [(i, n) for n, p in phrases.items() for i in range(len(words)) if words[i : i + len(p)] == p]
        ends = (min(at)[0], max(at)[0]) if at else (None, None)
        want[(key, len(words), len(at), *ends, ",".join(sorted({n for _, n in at})))] += 1
    found = collected(licenses.scan(documents(spark, rows, extra=True)))
    assert collections.Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found) == want
    for r in found:
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
    assert any("bsd" in r["labels"] for r in found)
    assert licenses.scan(documents(spark, [])).count() == 0


def test_neighbouring_diagonals_merge(spark):
    words = licenses.TEMPLATES[5].text.split()
    changed = words[:12] + ["oh"] + words[12:]
    text = " ".join(["lead"] * 5 + changed + ["tail"] * 5)
    rows = [(1, text, None, None), (2, " ".join(words[:8]), None, None)]
    found = {r["doc_id"]: r for r in collected(licenses.scan(documents(spark, rows)))}
    assert found[1]["labels"] == "bsd" and 0.8 < found[1]["score"] < 1 and found[1]["n_base"] == 0
    assert found[2]["labels"] == "" and 0 < found[2]["score"] < 0.8


# pages

ARTICLE = "<h1>Head &amp; shoulders</h1><p>One <b>two</b>\n three<br>four<p>five&nbsp;six<div class='share'>share me</div><p>seven"
WANT = "Head & shoulders One two three four five six seven"


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul><li>menu</ul></nav><article>{ARTICLE}</article><footer>foot</footer></body></html>",
    f"<body class='has-sidebar'><header>site</header><div id=cookie-notice>we use cookies <a href='x'>ok</a></div><main>{ARTICLE}<form>name <input></form></main><aside>more</aside>",
    f"<script>var a='<p>no</p>';</script><!-- <p>no --><div class='ad'>buy</div><article data-x=\"a>b\">{ARTICLE}<section class=comments><p>I say</p></section></article>",
    f"<div><div role=navigation>a b c</div><div class='post'>{ARTICLE}</div><div class='sidebar widget'>x y z</div></div>",
    f"<article>{ARTICLE}</article><article class='comment'><p>reader says so</p></article>",
    f"<article><noscript>no</noscript><template>no</template>{ARTICLE}<script>let x = 1 < 2;",
])
def test_main_text(page):
    assert pages.main_text(page, pages.DEFAULT) == WANT


def test_main_text_edges():
    for page in (None, "", "<", "<p>", "<!--", "<script>x", "<p", "</div></p>", "<nav>only menu</nav>"):
        assert pages.main_text(page, pages.DEFAULT) in ("", "<")
    assert pages.main_text("a < b &lt; c", pages.DEFAULT) == "a < b < c"
    assert pages.main_text("<b>" * 50_000 + "x y", pages.DEFAULT) == "x y"
    assert pages.main_text("<article>" + "<p>word</p>" * 30_000 + "</article>", pages.DEFAULT) == " ".join(["word"] * 30_000)


def test_best_stretch_matches_enumeration():
    rng = np.random.default_rng(15)
    for _ in range(50):
        x = rng.integers(-5, 6, rng.integers(1, 12)).astype(float)
        a, b = pages.best_stretch(x)
        assert x[a : b + 1].sum() == max(x[i : j + 1].sum() for i in range(len(x)) for j in range(i, len(x)))


def test_extract_learns_weights(spark):
    page = f"<body><div>short lead</div><article>{ARTICLE}</article><div>left over words</div></body>"
    rows = [(i, f"u{i}", page) for i in range(20)] + [(99, None, None), (None, "u", ""), (3, "u3", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("k", F.lit(1))
    model = pages.fit(df)
    assert model.tag["/article"] < model.tag["p"] < 0 and model.tag["/article"] <= -20
    found = collected(pages.extract(df, model))
    assert collections.Counter((r["page_id"], r["url"], r["text"], r["n_chars"]) for r in found) == collections.Counter(
        (i, u, WANT if p else "", len(WANT) if p else 0) for i, u, p in rows
    )
    empty = df.where("false")
    assert pages.fit(empty) == pages.DEFAULT and pages.extract(empty, pages.DEFAULT).count() == 0
