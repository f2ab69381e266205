"""Token ids of many texts at once.

The byte-level vocabulary encodes each pre-token by itself. A batch of texts
is cut into pre-tokens with array operations, equal pre-tokens are found by
Arrow's dictionary encoding, and the tokenizer sees each different pre-token
once. Its ids are then put back in place. Texts are cut at the vocabulary's
added tokens first, each of which has one id wherever its string stands. The
result equals `Tokenizer.encode` of an untouched tokenizer without special
tokens added.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from tokenizers import Tokenizer, pre_tokenizers, processors

from sorterlog.llm.shared import code_points, slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
END = 2
CHUNK = 500_000
#: Pre-tokens whose ids a worker remembers; it starts anew beyond.
MEMORY = 600_000
SPACE, APOSTROPHE = ord(" "), ord("'")
LETTER, NUMBER, WHITE, OTHER = 1, 2, 3, 0
#: Endings that the vocabulary's pre-tokenizer splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@functools.lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


@functools.lru_cache(maxsize=1)
def byte_letters() -> np.ndarray:
    """The character that byte-level vocabularies write for each byte: itself if it is printable, else the next free one from 256 on."""
    plain = np.zeros(256, bool)
    for a, b in (("!", "~"), ("¡", "¬"), ("®", "ÿ")):
        plain[ord(a) : ord(b) + 1] = True
    out = np.arange(256, dtype=np.uint32)
    out[~plain] = 256 + np.arange((~plain).sum())
    return out


def pretoken_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in the code points of several texts; `text_starts` are the starts of texts that are not empty."""
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    start = first[:n].copy()
    white = kind == WHITE
    changed = kind[1:] != kind[:-1]
    after_space = (points[:-1] == SPACE) & ~first[1:n]
    start[1:] |= changed & ~(after_space & ~white[1:])
    last_white = white.copy()  # the last white character before something else starts a pre-token
    last_white[:-1] &= ~white[1:]
    start |= last_white & ~first[1:]
    mark = np.flatnonzero((points == APOSTROPHE) & start)
    mark = mark[(mark == text_starts_floor(text_starts, mark)) | (points[mark - 1] != SPACE)] if len(mark) else mark
    for ending in ENDINGS:
        end = mark + 1 + len(ending)
        at, end = mark[end <= n], end[end <= n]
        ok = np.ones(len(at), bool)
        for k, letter in enumerate(ending):
            ok &= (points[at + 1 + k] == ord(letter)) & ~first[at + 1 + k]
        start[at[ok] + 1] = False
        end = end[ok]
        end = end[end < n]
        inside = kind[end] == LETTER
        start[end[inside]] = True
    return np.flatnonzero(start)


def text_starts_floor(text_starts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return text_starts[np.searchsorted(text_starts, at, side="right") - 1]


def byte_strings(array: pa.BinaryArray) -> list[bytes]:
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].tolist()
    raw = data.to_pybytes()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


@functools.lru_cache(maxsize=2)
def added_tokens(path: str) -> regex.Pattern:
    """A pattern in one group that finds the strings of the vocabulary's added tokens; of several that start together the longest counts."""
    with open(path, encoding="utf-8") as file:
        strings = [t["content"] for t in json.load(file)["added_tokens"]]
    return regex.compile("(" + "|".join(map(regex.escape, sorted(strings, key=len, reverse=True))) + ")" if strings else "((?!))")


class Encoder:
    """A tokenizer with a memory of pre-tokens."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.added = added_tokens(path)
        self.tokenizer.encode_special_tokens = True  # pieces between added tokens hold none
        # words come cut and as the vocabulary writes bytes, so these two steps have nothing to do
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([])
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        self.vocabulary_size = self.tokenizer.get_vocab_size()
        self.forget()

    def forget(self) -> None:
        """Give the remembered pre-tokens' memory back, as at the end of a task."""
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.begins = np.zeros(1, np.int64)

    def learn(self, words: list[bytes]) -> None:
        ids, sizes = [self.ids], []
        for at in range(0, len(words), 500):
            some = words[at : at + 500]
            ends = np.cumsum([len(w) for w in some]).tolist()
            written = byte_letters()[np.frombuffer(b"".join(some), np.uint8)].tobytes().decode("utf-32-le")
            found = self.tokenizer.encode(
                [written[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)], is_pretokenized=True, add_special_tokens=False,
            )
            ids.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))
        for w in words:
            self.place[w] = len(self.place)
        self.ids = np.concatenate(ids)
        self.begins = np.concatenate((self.begins, self.begins[-1] + np.cumsum(np.concatenate(sizes))))

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order, without an end id."""
        for a, b in slices([len(t) for t in texts], CHUNK):
            cut = [self.added.split(t.encode("utf-8", "replace").decode()) for t in texts[a:b]]
            found = self._encode([piece for pieces in cut for piece in pieces[::2]])
            for pieces in cut:
                ids = next(found)
                for string in pieces[1::2]:
                    ids = np.concatenate((ids, np.array([self.tokenizer.token_to_id(string)], np.uint32), next(found)))
                yield ids

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        if not ends[-1]:
            yield from (np.zeros(0, np.uint32) for _ in texts)
            return
        joined = "".join(texts)
        points = code_points(joined)
        starts = pretoken_starts(points, (ends - sizes)[sizes > 0])
        width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
        byte_end = np.cumsum(width, dtype=np.int64)
        offsets = np.concatenate((byte_end[starts] - width[starts], byte_end[-1:])).astype(np.int32)
        data = pa.py_buffer(joined.encode())
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), data]).dictionary_encode()
        known = byte_strings(words.dictionary)
        if len(self.place) + len(known) > MEMORY:
            self.forget()
        new = [w for w in known if w not in self.place]
        if new:
            self.learn(new)
        slot = np.fromiter((self.place[w] for w in known), np.int64, len(known))[words.indices.to_numpy()]
        begin = self.begins[slot]
        count = self.begins[slot + 1] - begin
        until = np.cumsum(count)
        at = np.repeat(begin - until + count, count) + np.arange(until[-1])
        ids = self.ids[at]
        last = np.searchsorted(starts, ends)  # pre-tokens that start before each text's end
        cut = np.concatenate(([0], until))[last]
        for i, j in zip(np.concatenate(([0], cut[:-1])).tolist(), cut.tolist(), strict=True):
            yield ids[i:j]


@functools.lru_cache(maxsize=2)
def encoder(path: str = VOCABULARY) -> Encoder:
    return Encoder(path)
