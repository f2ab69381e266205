import itertools

import numpy as np

import corpus_pipeline
from sorterlog.llm import near_text

DOCS = "doc_id long, text string, lang string, source string"


def plain_set(text):
    words = (text or "").lower().split()
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_kept(rows):
    """Keys that stay when all pairs are compared."""
    sets = [plain_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) > 0:
            root[top(j)] = top(i)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    return sorted(min(g) for g in groups.values())


def planted(seed=5):
    """Texts with near copies that differ in one word or more, chains of them, a common line, copies and short texts."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, key = [], itertools.count()
    for n in (8, 30, 60, 150, 400):
        for _ in range(6):
            base = list(rng.choice(vocab, n))
            if rng.random() < 0.3:
                base = "every text here starts with this very common line".split() + base
            rows.append((next(key), " ".join(base), "xx", "s"))
            for edits in (1, 1, 2, 3, 6, 12):
                words = list(base if rng.random() < 0.5 else rows[-1][1].split())
                for at in rng.integers(0, len(words), edits):
                    words[at] = str(rng.choice(vocab))
                rows.append((next(key), " ".join(words), "xx", "s"))
    base = list(rng.choice(vocab, 60))
    for _ in range(60):  # one large group whose members are partly too far from one another
        words = list(base)
        words[int(rng.integers(0, 60))] = str(rng.choice(vocab))
        rows.append((next(key), " ".join(words), "xx", "s"))
    rows += [(next(key), t, "xx", "s") for t in ("", None, "a", "A", "a b", "a b c d e", "A b  c d E", "a b c d e f")]
    return rows


def test_stage_links_near_copies_with_edited_words(spark, monkeypatch):
    rows = planted()
    want = plain_kept(rows)
    assert len(want) < len({plain_set(r[1]) for r in rows}) - 40  # most go only as near copies
    df = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    monkeypatch.setattr(near_text, "PAIRS_A_ROW", 0)  # all rounds of stars, then the rest
    assert sorted(r["doc_id"] for r in near_text.keep_first(df).collect()) == want


def test_edges_of_the_near_copy_stage(spark):
    assert near_text.keep_first(spark.createDataFrame([], DOCS)).count() == 0
    same = [(None, "a b c d e f", None, None)] * 2 + [(3, "q r s", None, None)] * 3
    assert sorted(r["text"] for r in near_text.keep_first(spark.createDataFrame(same, DOCS)).collect()) == ["a b c d e f", "q r s"]


def test_prefix_holds_a_shared_shingle_whatever_the_order():
    rng = np.random.default_rng(3)
    for n in range(1, 60):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: (8 * n + 8) // 9], rng.integers(0, 1 << 63, n // 9, dtype=np.uint64))))
        if 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b)):
            levels = rng.integers(0, 9, 1 << near_text.FREQUENCY_BITS).astype(np.uint8)
            assert len(np.intersect1d(near_text.prefix(a, levels), near_text.prefix(b, levels)))


def test_fingerprints_of_the_trees_give_candidates_that_are_verified(spark, monkeypatch):
    """Texts whose fingerprints link are tried first; those whose sets overlap too little stay apart."""
    twice = " ".join(f"u{i}" for i in range(40))
    rows = [(1, twice, "xx", "s"), (2, f"{twice} {twice}", "xx", "s"), (3, "p q r", "xx", "s"), (4, "p q r s", "xx", "s")]
    assert plain_kept(rows) == [1, 3, 4]
    df = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(near_text, "fingerprint", lambda text: 3 + len(text or "") % 2)  # all within two bits
    found, tried = [], near_text.verified

    def seen(pairs, classes, texts):
        found.append(pairs.count())
        return tried(pairs, classes, texts)

    monkeypatch.setattr(near_text, "verified", seen)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == [1, 3, 4]
    assert found[0] == 3  # a star of all four


def test_classes_meet_their_roots_before_their_shingles_are_laid_out(spark, monkeypatch):
    """The join with the roots has one row per class, however many shingles the texts share."""
    rows = planted()
    df = spark.createDataFrame(rows, DOCS)
    monkeypatch.setattr(near_text, "PAIRS_A_ROW", 0)
    sizes, staged = {}, near_text.stage

    def seen(table, name):
        out = staged(table, name)
        sizes.setdefault(name, []).append((out.count(), out.columns))
        return out

    monkeypatch.setattr(near_text, "stage", seen)
    assert sorted(r["doc_id"] for r in near_text.keep_first(df).collect()) == plain_kept(rows)
    (n, columns), = sizes["shared-shingles"]
    assert n <= sizes["text-classes"][0][0] and columns == ["cls", "n", "posts"]


def recorded(monkeypatch):
    """Names of the tables that are staged from now on, with their rows."""
    sizes, staged = [], near_text.stage

    def seen(table, name):
        out = staged(table, name)
        sizes.append((name, out.count()))
        return out

    monkeypatch.setattr(near_text, "stage", seen)
    return sizes


def test_frequencies_are_counts_not_their_logarithm(spark, monkeypatch):
    """Where every bucket is full of rare shingles, a logarithm would not show which one holds a frequent shingle too."""
    monkeypatch.setattr(near_text, "FREQUENCY_BITS", 6)
    texts = [r[1] for r in planted()]
    want = np.zeros(64, np.int64)
    for s in near_text.shingle_sets(texts):
        np.add.at(want, near_text.bucket(s, 6), 1)
    assert near_text.frequency_levels(spark.createDataFrame([(t,) for t in texts], "text string"), "text").tolist() == want.tolist()


def test_shingles_of_the_same_prefixes_make_a_pair_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for key in range(0, 40, 2):
        words = [f"v{i}" for i in rng.integers(0, 100_000, 120)]
        rows += [(key, " ".join(words), "xx", "s"), (key + 1, " ".join([*words[:60], "edited", *words[61:]]), "xx", "s")]
    monkeypatch.setattr(near_text, "fingerprint", lambda text: near_text.xxhash.xxh64_intdigest(text))  # no links from the trees
    sizes = recorded(monkeypatch)
    assert sorted(r["doc_id"] for r in near_text.keep_first(spark.createDataFrame(rows, DOCS)).collect()) == plain_kept(rows) == list(range(0, 40, 2))
    assert [n for name, n in sizes if name == "shared-open"] == [40]  # 20 pairs; each has more than ten common shingles in its prefixes


def test_few_likely_pairs_are_compared_at_once(spark, monkeypatch):
    rows = planted()
    df, want = spark.createDataFrame(rows, DOCS), plain_kept(rows)
    calls, found = [], near_text.components
    monkeypatch.setattr(near_text, "components", lambda edges: calls.append(1) or found(edges))
    sizes = recorded(monkeypatch)
    assert sorted(r["doc_id"] for r in near_text.keep_first(df).collect()) == want
    assert len(calls) == sum(name == "shared-roots" for name, _ in sizes)
    monkeypatch.setattr(near_text, "PAIRS_AT_ONCE", 0)
    monkeypatch.setattr(near_text, "PAIRS_A_SET", 0)
    assert sorted(r["doc_id"] for r in near_text.keep_first(df).collect()) == want


def test_rounds_end_when_texts_that_share_a_line_are_unlike(spark, monkeypatch):
    rng = np.random.default_rng(9)
    line = "every text here starts with this very common line"
    rows = [(i, " ".join([line, *(f"v{j}" for j in rng.integers(0, 100_000, 8))]), "xx", "s") for i in range(60)]
    monkeypatch.setattr(near_text, "PAIRS_A_ROW", 0)
    monkeypatch.setattr(near_text, "prefix", lambda shingles, levels: shingles)  # so that the line's shingles are in it
    sizes = recorded(monkeypatch)
    assert near_text.keep_first(spark.createDataFrame(rows, DOCS)).count() == 60
    assert [name for name, _ in sizes].count("shared-tops") == 2


def test_a_dense_group_is_joined_without_trying_all_its_pairs(spark, monkeypatch):
    """Five places with three words each: two texts are linked if they differ in two places or fewer, all are one group."""
    rows = []
    for i in range(3**5):
        words = [f"v{j}" for j in range(100)]
        for k in range(5):
            words[10 + 20 * k] = "abc"[i // 3**k % 3] + str(k)
        rows.append((i, " ".join(words), "xx", "s"))
    monkeypatch.setattr(near_text, "fingerprint", lambda text: near_text.xxhash.xxh64_intdigest(text))  # no links from the trees
    monkeypatch.setattr(near_text, "HOT_PAIRS", 100, raising=False)
    sizes = recorded(monkeypatch)
    assert [r["doc_id"] for r in near_text.keep_first(spark.createDataFrame(rows, DOCS)).collect()] == [0]
    assert max(n for name, n in sizes if name == "shared-pairs") < 3000  # of 29,403
