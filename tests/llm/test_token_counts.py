import random

import pytest
from tokenizers import Tokenizer

from sorterlog.llm import token_counts, token_ids
from tests.llm.test_operators import collected, corpus, documents

LIBRARY = Tokenizer.from_file(token_ids.VOCABULARY)


def expected(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts():
    rng = random.Random(3)
    letters = "aelrvstmd''  \n\t\xa0　\x85éß漢字12²٣.,!?-<|>\x00😀"
    words = ["hello", "don't", "we've", "they'll", "I'd", "'re", "<|endoftext|>", "ÃÂÃÂ", "-----", "\n\n\n", "aaaaaaa", "  ", "'", "'l", "'v"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(1000)]
    return texts + ["", None, "'r", "x'l", "\n's", " 's", "<|endoftext|>" * 3, "a<|endoftext|>", "<|endoftext|", "a" * 5000, "etaoin" * 3000, "漢字" * 2000, "-" * 3000]


@pytest.mark.parametrize("stride", [1, 7, 128])
def test_counts_equal_the_library(monkeypatch, stride):
    monkeypatch.setattr(token_counts, "STRIDE", stride)
    texts = odd_texts()
    assert token_counts.count_texts(texts).tolist() == expected(texts)


def test_counts_do_not_depend_on_when_states_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_STATES", 20)
    monkeypatch.setattr(token_counts, "CHUNK", 500)
    texts = odd_texts()[::7]
    assert token_counts.count_texts(texts).tolist() == expected(texts)


def test_maps_compose_to_the_state_after_each_chunk():
    after, _ = token_counts.boundary_tables()
    rng = random.Random(4)
    read = [rng.randrange(token_counts.FIRST) for _ in range(300)]
    maps, plain, state = [], [], token_counts.BEGIN
    for at in range(0, 300, 10):
        one = []
        for s in range(token_counts.STATES):
            for symbol in read[at : at + 10]:
                s = after[s * token_counts.SYMBOLS + symbol]
            one.append(s)
        maps.append(one)
        state = one[state]
        plain.append(state)
    found = token_counts.compose_all(token_counts.np.array(maps, token_counts.np.int16))
    assert found[:, token_counts.BEGIN].tolist() == plain


def test_every_transition_weighs_what_the_library_counts():
    transducer = token_counts.CountTransducer(token_ids.VOCABULARY)
    for word in ("internationalisation", " Straßenbahn", "ÃÂÃÂÃÂ", "zzzzzzzz", "漢字かな"):
        data, state, total = word.encode(), 0, 0
        for i, byte in enumerate(data):
            state, gain = transducer.edge(state, byte)
            total += gain
            try:
                assert total == len(LIBRARY.encode(data[: i + 1].decode(), add_special_tokens=False).ids)
            except UnicodeDecodeError:
                continue


def test_table_edges(spark):
    rows = corpus()
    got = collected(token_counts.count_tokens(documents(spark, rows, extra=True)))
    assert sorted(map(str, got)) == sorted(
        str({"doc_id": r[0], "n_bytes": len((r[1] or "").encode()), "n_tokens": n, "over_limit": n > 512})
        for r, n in zip(rows, expected([r[1] for r in rows]), strict=True)
    )
    empty = token_counts.count_tokens(documents(spark, []))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
