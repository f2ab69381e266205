import collections

import duckdb
import numpy as np
import pytest

from sorterlog.llm import oracles, phrases
from tests.llm.test_operators import corpus, documents


def brute(rows, least=100, top=2000):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        data = (text or "").encode().lower()
        for c in b".,;:!?\n\x0b\x0c\r":
            data = data.replace(bytes([c]), b"\n")
        for piece in data.split(b"\n"):
            words = tuple(w for w in piece.replace(b"\t", b" ").split(b" ") if w)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts[lang, words[i : i + k]] += 1
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= least}
    hidden = set()
    for (lang, w), a in found.items():
        hidden |= {(lang, w[i:j]) for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w) and a >= counts[lang, w[i:j]]}
    out = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if (lang, w) not in hidden:
            score, _, left, right = min((1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k, counts[lang, w[:k]], counts[lang, w[k:]]) for k in range(1, len(w)))
            out[lang].append((-score, -a, b" ".join(w), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for lang, one in out.items() for i, (s, a, p, left, right) in enumerate(sorted(one)[:top]))


def prose(seed=6):
    """Zipf-like words, stock phrases, a very frequent pair, odd blanks and breaks."""
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(60)] + ["Éa", "naïve", "漢字", "A-B", "x\xa0y", "\x01z"]
    weights = 1 / np.arange(1, len(names) + 1)
    rows = []
    for i in range(400):
        parts = []
        for w in rng.choice(names, rng.integers(0, 60), p=weights / weights.sum()):
            parts += [w, str(rng.choice([" ", "  ", "\t", ". ", ", ", "\n", " ; ", "\r\n"], p=[0.7, 0.1, 0.05, 0.05, 0.04, 0.03, 0.02, 0.01]))]
            if rng.random() < 0.1:
                parts += ["once upon a time there ", "of the of the "][int(rng.random() < 0.4)]
        rows.append((i, "".join(parts), ("aa", "bb", None)[int(rng.random() * 3)], "s"))
    return rows + [(500, None, "aa", None), (501, "", None, None), (None, rows[3][1], "bb", None), (502, "go on " * 20_000, "aa", "s")] + [rows[7]] * 40


@pytest.mark.parametrize(("share", "stretch", "block", "least", "codes"), [(2048, 6_000_000, 64_000, 100, 50_000), (3, 300, 70, 20, 5), (40, 5000, 100, 5, 0)])
def test_collocations_equal_brute_force(spark, monkeypatch, share, stretch, block, least, codes):
    for name, value in (("SHARE", share), ("STRETCH", stretch), ("BLOCK", block), ("CODES", codes), ("WAITING", 2 * stretch)):
        monkeypatch.setattr(phrases, name, value)
    rows = prose()
    df = documents(spark, rows, extra=True).repartition(5)
    assert sorted(map(tuple, phrases.collocations(df, least=least).collect())) == brute(rows, least)


def test_every_frequent_phrase_is_counted(spark):
    rows = corpus() * 3
    found, totals = phrases.frequent_phrases(documents(spark, rows), least=4)
    got = {(r["lang"], r["phrase"]): r["n"] for r in found.collect()}
    want = collections.Counter()
    for _, text, lang, _ in rows:
        words = (text or "").lower().replace("!", " ").split()
        want.update((lang or "und", " ".join(words[i : i + k])) for i in range(len(words)) for k in range(1, 6) if i + k <= len(words))
    assert got == {key: n for key, n in want.items() if n >= 4}
    assert {r["lang"]: r["total"] for r in totals.collect()}["xx"] == sum(n for (lang, p), n in want.items() if lang == "xx" and " " not in p)


def test_empty_tables_and_ranks(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None, None), (2, "one", "aa", None)])).count() == 0
    rows = [(i, " ".join(f"k{i % 9} l{i % 9}." for _ in range(20)), "aa", "s") for i in range(90)]
    got = sorted(map(tuple, phrases.collocations(documents(spark, rows), top=4).collect()))
    assert got == brute(rows, top=4) and [r[1] for r in got] == [1, 2, 3, 4]


def test_sql_equals_brute_force():
    rows = prose()
    with duckdb.connect() as c:
        c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
        c.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
        assert sorted(c.sql(oracles.PHRASES).fetchall()) == brute(rows)


def test_suffixes_of_a_stretch_travel_in_one_row_for_each_place(spark, monkeypatch):
    """What is shuffled are blocks of suffixes in order, and they lay out to every suffix with its count."""
    sizes, grouped = [], phrases.grouped

    def seen(*args):
        blocks = grouped(*args)
        rows = blocks.collect()
        leaves = phrases.laid_out(blocks).collect()
        assert len(leaves) == sum(len(r["counts"]) for r in rows) and all(r["suffix"].endswith(" ") and r["n"] > 0 for r in leaves)
        sizes.append((len(rows), len(leaves), len({(r["place"], r["depth"], r["lang"]) for r in rows})))
        return blocks

    monkeypatch.setattr(phrases, "grouped", seen)
    rows = prose()
    assert sorted(map(tuple, phrases.collocations(documents(spark, rows).coalesce(1), least=20).collect())) == brute(rows, 20)
    (blocks, leaves, kinds), = sizes
    assert blocks == kinds < leaves / 5
