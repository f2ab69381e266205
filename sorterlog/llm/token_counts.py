"""Token counts of texts by a tokenizer compiled to finite-state transducers.

Two deterministic transducers do the work of the byte-level vocabulary.

* The boundary transducer reads characters by class and marks where pre-tokens
  start (`boundaries`). It has twelve states, so a chunk of characters is a map
  from the state before it to the state after it. All chunks of a batch get
  their maps side by side, a parallel prefix scan composes the maps, and with
  the state before each chunk known every chunk emits its marks.
* The count transducer (`CountTransducer`) reads the bytes of a pre-token.
  Every transition carries how many tokens the encoding of the longer prefix
  has more than that of the shorter one (it may be negative when a merge
  closes), so the carried counts of a path sum to the number of tokens. A
  pre-token always begins in the first state, hence its map is one number, and
  the scan goes on as a running sum over the pre-tokens of all texts.

A state of the count transducer holds what later tokens depend on: the longest
end of the bytes read that begins some token and, for each place in it where a
token may still begin, the last token before it and the count up to it relative
to the present one. Two tokens may
follow each other if encoding both as one text gives the same two tokens; a
sequence of tokens is the encoding of its text exactly if this holds for all
neighbours. So each prefix has one last token that may follow the last token of
what is before it. States are made when a text first needs them; beyond
`MOST_STATES` a worker starts anew, which bounds its memory and changes no count.

Texts are cut at the added tokens of the vocabulary first, each of which is one
token, as the library does by default. Null and empty texts have 0 tokens.
Length is no limit: a long text spans many chunks. Repeated rows are counted
one by one, an empty table gives an empty one, and no column of the input but
the chosen two is read, so others may have any name. No order is involved, so
there are no ties.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, code_points, prepare, slices
from sorterlog.llm.token_ids import CHUNK, LETTER, NUMBER, VOCABULARY, WHITE, added_tokens, byte_letters, byte_strings, classes

LIMIT = 512
MOST_STATES = 150_000
#: Tokens with one beginning that are compared to find last tokens of equal effect.
MOST_COMPARED = 32
#: Characters whose joint effect is one state map.
STRIDE = 128

# symbols: what the boundary transducer tells apart; FIRST is added for the first character of a text
OTHER_LETTER, LONE, R_OR_V, E, L, DIGIT, SPACE, OTHER_WHITE, QUOTE_MARK, MARK = range(10)
FIRST, PADDING, SYMBOLS = 10, 20, 21
# states, by what was read last
BEGIN, LETTERS, DIGITS, MARKS, ONE_SPACE, ONE_WHITE, LAST_SPACE, LAST_WHITE, QUOTE, WAITS_E, WAITS_L, ENDED = range(12)
STATES = 12
HERE, BEFORE = 1, 2
#: Letters that end a word after an apostrophe alone, or after which a second letter does.
LONE_LETTERS, SECOND_E, SECOND_L = "stmd", "rv", "l"


def boundary_step(state: int, symbol: int) -> tuple[int, int]:
    """The next state, and whether a pre-token starts HERE (at the character read) or BEFORE (at the one before it)."""
    if state in (WAITS_E, WAITS_L):
        if symbol == (E if state == WAITS_E else L):
            return ENDED, 0
        after, mark = boundary_step(LETTERS, symbol)
        return after, mark | BEFORE
    if symbol in (SPACE, OTHER_WHITE):
        if state in (ONE_SPACE, ONE_WHITE, LAST_SPACE, LAST_WHITE):
            return (LAST_SPACE if symbol == SPACE else LAST_WHITE), 0
        return (ONE_SPACE if symbol == SPACE else ONE_WHITE), HERE
    kind = LETTERS if symbol <= L else DIGITS if symbol == DIGIT else MARKS
    before = BEFORE if state in (LAST_SPACE, LAST_WHITE) else 0  # the last of several white characters stands apart
    if state in (ONE_SPACE, LAST_SPACE):  # a space belongs to what follows it
        return kind, before
    if state == QUOTE and symbol in (LONE, R_OR_V, L):
        return {LONE: ENDED, R_OR_V: WAITS_E, L: WAITS_L}[symbol], 0
    if kind == state or (kind == MARKS and state == QUOTE):
        return kind, 0
    return (QUOTE if symbol == QUOTE_MARK else kind), HERE | before


@functools.lru_cache(maxsize=1)
def boundary_tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks of state * SYMBOLS + symbol."""
    after, marks = np.zeros((STATES, SYMBOLS), np.int16), np.zeros((STATES, SYMBOLS), np.uint8)
    for state in range(STATES):
        for symbol in range(FIRST):
            after[state, symbol], marks[state, symbol] = boundary_step(state, symbol)
            after[state, FIRST + symbol], marks[state, FIRST + symbol] = boundary_step(BEGIN, symbol)
            marks[state, FIRST + symbol] |= BEFORE if state in (WAITS_E, WAITS_L) else 0  # the text before ended while waiting
        after[state, PADDING] = state
    return after.ravel(), marks.ravel()


@functools.lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """The symbol of each code point."""
    kind = classes()
    out = np.full(len(kind), MARK, np.int16)
    out[kind == LETTER] = OTHER_LETTER
    out[kind == NUMBER] = DIGIT
    out[kind == WHITE] = OTHER_WHITE
    for text, symbol in ((LONE_LETTERS, LONE), (SECOND_E, R_OR_V), ("e", E), (SECOND_L, L), (" ", SPACE), ("'", QUOTE_MARK)):
        for letter in text:
            out[ord(letter)] = symbol
    return out


def compose_all(maps: np.ndarray) -> np.ndarray:
    """Row i becomes the map of rows 0 to i one after the other, in about log2(rows) rounds."""
    step = 1
    while step < len(maps):
        maps = np.concatenate((maps[:step], np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)))
        step *= 2
    return maps


def boundaries(read: np.ndarray) -> np.ndarray:
    """Where pre-tokens start, for the symbols of one or more texts."""
    after, marks = boundary_tables()
    chunks = -(-len(read) // STRIDE)
    table = np.full(chunks * STRIDE, PADDING, np.int16)
    table[: len(read)] = read
    columns = np.ascontiguousarray(table.reshape(chunks, STRIDE).T)
    maps = np.tile(np.arange(STATES, dtype=np.int16), (chunks, 1))
    for column in columns:
        maps = after[maps * np.int16(SYMBOLS) + column[:, None]]
    state = np.concatenate((np.full(1, BEGIN, np.int16), compose_all(maps)[:-1, BEGIN]))
    emitted = np.zeros((STRIDE, chunks), np.uint8)
    for i, column in enumerate(columns):
        at = state * np.int16(SYMBOLS) + column
        emitted[i], state = marks[at], after[at]
    emitted = emitted.T.ravel()[: len(read)]
    start = (emitted & HERE).astype(bool)
    start[:-1] |= (emitted[1:] & BEFORE).astype(bool)
    start[-1:] |= state[-1] in (WAITS_E, WAITS_L)
    return np.flatnonzero(start)


class CountTransducer:
    """Numbers of tokens of pre-tokens under a byte-level vocabulary."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {chr(c): i for i, c in enumerate(byte_letters().tolist())}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(self._bytes(a, byte_of), self._bytes(b, byte_of)): i for i, (a, b) in enumerate(pairs)}
        self.tokens = {bytes([i]) for i in range(256)} | {a + b for a, b in self.rank}
        self.beginnings: dict[bytes, list[bytes]] = {}  # the tokens that go on after each beginning
        for token in self.tokens:
            for i in range(len(token)):
                self.beginnings.setdefault(token[:i], []).append(token)
        self.parts = {a + b: (a, b) for a, b in self.rank}
        self.pieces: tuple[dict[bytes, list[tuple[int, bytes]]], ...] = ({}, {})
        self.start_anew()

    @staticmethod
    def _bytes(written: str, byte_of: dict[str, int]) -> bytes:
        return bytes(byte_of[c] for c in written)

    def start_anew(self) -> None:
        first = (b"", (b"",), (0,))
        self.states, self.number = [first], {first: 0}
        self.edges: dict[int, tuple[int, int]] = {}
        self.alike: dict[tuple[bytes, frozenset[bytes]], bytes] = {}
        self.stand_ins: dict[tuple[bytes, bytes], bytes] = {}

    def edge_pieces(self, token: bytes, side: int) -> list[tuple[int, bytes]]:
        """The pieces that stand at the right (1) or left (0) edge of a token while it is merged, each with the rank that ends it."""
        found = self.pieces[side].get(token)
        if found is None:
            found, until, piece = [], len(self.rank), token
            while piece in self.parts:
                found.append((until, piece))
                until = self.rank[self.parts[piece]]
                piece = self.parts[piece][side]
            found.append((until, piece))
            found.reverse()
            self.pieces[side][token] = found
        return found

    def may_follow(self, token: bytes, before: bytes) -> bool:
        """Whether no merge crosses the border of the two tokens: at no time has the pair at the border the next rank in turn."""
        if not before:
            return True
        left, right, never = self.edge_pieces(before, 1), self.edge_pieces(token, 0), len(self.rank)
        i = j = 0
        while True:
            until_left, until_right = left[i][0], right[j][0]
            rank = self.rank.get((left[i][1], right[j][1]), never)
            if rank < until_left and rank <= until_right and rank < never:
                return False
            if until_left <= until_right:
                i += 1
            else:
                j += 1
            if i == len(left) or j == len(right):
                return True

    def stand_in(self, before: bytes, beginning: bytes) -> bytes:
        """One token for all that let the same tokens with this beginning follow, so that fewer states differ; itself where too many go on."""
        if not beginning or not before or len(self.beginnings[beginning]) > MOST_COMPARED:
            return before
        found = self.stand_ins.get((before, beginning))
        if found is None:
            barred = frozenset(t for t in self.beginnings[beginning] if not self.may_follow(t, before))
            found = self.stand_ins[before, beginning] = self.alike.setdefault((beginning, barred), before)
        return found

    def edge(self, state: int, byte: int) -> tuple[int, int]:
        """The next state and the tokens that the encoding gains, made when first asked for."""
        tail, last, ahead = self.states[state]
        tail += bytes([byte])
        for size in range(len(tail), 0, -1):
            token = tail[-size:]
            if token in self.tokens and self.may_follow(token, last[size - 1]):
                break
        else:
            raise ValueError(f"no token ends {tail!r}")
        gain = ahead[size - 1] + 1
        while tail not in self.beginnings:
            tail = tail[1:]
        kept_last, kept_ahead = [token], [0]
        for back in range(1, len(tail) + 1):
            beginning = tail[-back:]
            open_ = beginning in self.beginnings  # else no token can begin there any more
            kept_last.append(self.stand_in(last[back - 1], beginning) if open_ else b"")
            kept_ahead.append(ahead[back - 1] - gain if open_ else 0)
        key = (tail, tuple(kept_last), tuple(kept_ahead))
        after = self.number.setdefault(key, len(self.states))
        if after == len(self.states):
            self.states.append(key)
        self.edges[state << 8 | byte] = after, gain
        return after, gain

    def count(self, pretoken: bytes) -> int:
        state, total, edges = 0, 0, self.edges
        for byte in pretoken:
            found = edges.get(state << 8 | byte) or self.edge(state, byte)
            state = found[0]
            total += found[1]
        if len(self.states) > MOST_STATES:
            self.start_anew()
        return total


def count_pieces(pieces: list[str], transducer: CountTransducer) -> np.ndarray:
    """The number of tokens of each text, none of which holds an added token."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    joined = "".join(pieces)
    if not joined:
        return np.zeros(len(pieces), np.int64)
    points = code_points(joined)
    read = symbols()[points]
    ends = np.cumsum(sizes)
    read[(ends - sizes)[sizes > 0]] += FIRST
    starts = boundaries(read)
    width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800) + (points >= 0x10000)
    byte_end = np.cumsum(width, dtype=np.int64)
    offsets = np.concatenate((byte_end[starts] - width[starts], byte_end[-1:])).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined.encode())]).dictionary_encode()
    counts = np.fromiter(map(transducer.count, byte_strings(words.dictionary)), np.int64)
    running = np.concatenate(([0], np.cumsum(counts[words.indices.to_numpy()])))
    return np.diff(running[np.concatenate(([0], np.searchsorted(starts, ends)))])


@functools.lru_cache(maxsize=2)
def compiled(path: str) -> CountTransducer:
    return CountTransducer(path)


def count_texts(texts: list[str | None], path: str = VOCABULARY) -> np.ndarray:
    transducer, added = compiled(path), added_tokens(path)
    out = np.zeros(len(texts), np.int64)
    for a, b in slices([len(t or "") for t in texts], CHUNK):
        cut = [added.split((t or "").encode("utf-8", "replace").decode()) for t in texts[a:b]]
        pieces = np.array([len(c) for c in cut])
        found = count_pieces([p for c in cut for p in c[::2]], transducer)
        first = np.cumsum((pieces + 1) // 2) - (pieces + 1) // 2
        out[a:b] = np.add.reduceat(found, first) + pieces // 2
    return out


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, path: str = VOCABULARY) -> DataFrame:
    """The key, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens) of every row."""
    prepare(df.sparkSession)

    def each(texts: pd.Series) -> pd.Series:
        return pd.Series(count_texts(texts.tolist(), path))

    counted = df.select(
        col(key).alias(key), F.octet_length(F.coalesce(col(text), F.lit(""))).cast("long").alias("n_bytes"),
        F.pandas_udf(each, "long")(col(text)).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
