"""Phrases whose words stand together more often than their parts suggest.

All phrases of up to five words are counted in the manner of ERA suffix-tree
construction, with vertical partitioning.

1. One pass counts every word per language and finds heavy beginnings: those
   (of one to four words) that more than 1 / `SHARE` of the suffixes of some
   batch begin with. Every beginning that holds such a share of all suffixes
   is among them, and there can be no more than 2 x `SHARE` for each length.
2. A second pass cuts the texts into suffixes of at most five words. A suffix
   ends before a word that is too rare for any candidate (a fixed table of
   2^24 bits says which may be frequent). Suffixes are grouped by
   their first word; a heavy beginning is divided by its next word, again and
   again, so each group stays within a memory budget however uneven the words are. Equal suffixes of a stretch of text
   travel once, those of a stretch that go to the same place in one row, in order, and the `CODES` most frequent words as one character each.
3. Each group is sorted by itself. In sorted order the suffixes are the leaves
   of a suffix tree cut at depth five, and every inner node is a stretch of
   them; its count is the sum of its leaves. Groups are read as streams.
   Nodes above the depth at which a heavy beginning was divided are spread over
   groups and summed after it.

Each candidate is then cut after each of its words and scored by exact decimal arithmetic.

Null and empty texts have no words; a null language is `und`. Words that
repeat, copies of rows and overlapping occurrences all count. Very long texts
are suffixes like any others, cut into stretches of bounded size. Ties follow the stated order, which is
total. An empty table gives an empty one. Only the two chosen columns are read.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, prepare
from sorterlog.llm.token_ids import byte_strings
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.staging import stage

LEAST = 100
LONGEST = 5
TOP = 2000
#: A beginning is heavy if it holds more than one in so many suffixes.
SHARE = 2048
#: Suffixes of one group, about.
GROUP = 4_000_000
#: Places for each partition, so that hashing them deals out evenly.
PLACES = 4
#: Buckets of words that may be frequent, as a power of two.
BUCKET_BITS = 24
#: Bytes of text of a language that are cut at once, bytes of all languages that wait for it, and suffix rows that are counted at once.
STRETCH, WAITING, BLOCK = 6_000_000, 12_000_000, 64_000
#: Words with a character of their own, from `FIRST_CODE` on; other words follow `PLAIN`, which no character is.
CODES, FIRST_CODE, PLAIN = 50_000, 0x21, b"\x02"
#: Parts of a language that are ranked separately first.
RANK_PARTS = 32
SEED = 42
WORD, BLANK, BREAK = 0, 1, 2
#: Characters that end a piece and characters that end a word.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
KINDS = np.zeros(256, np.uint8)
KINDS[list(BLANKS)] = BLANK
KINDS[list(BREAKS)] = BREAK
CUT = re.compile(b"[" + re.escape(BREAKS) + b"]")
MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclasses.dataclass
class Words:
    """The words of some texts of one language, each followed by one blank in `data`."""

    data: bytes
    begin: np.ndarray  # where each word begins in data, and the end
    code: np.ndarray  # equal words have equal codes, from 1 on
    left: np.ndarray  # how many words of the piece begin here or later
    distinct: list[bytes]
    hashes: np.ndarray  # of the distinct words with their language


def word_hash(lang: Column, word: Column) -> Column:
    return F.xxhash64(F.concat(lang, F.lit("\x01"), word))


def lower_bytes(text: str | None) -> Iterator[bytes]:
    """A text in lower case (A-Z only) with an end of a piece after it; long ones are cut at ends of pieces."""
    data = (text or "").encode("utf-8", "replace").lower() + b"\n"
    while len(data) > STRETCH:
        cut = CUT.search(data, STRETCH).end()
        yield data[:cut]
        data = data[cut:]
    yield data


def words_of(data: bytes, lang: str) -> Words | None:
    raw = np.frombuffer(data, np.uint8)
    kind = KINDS[raw]
    word = kind == WORD
    before = np.concatenate(([False], word[:-1]))
    keep = word | before  # a word and the separator after it
    begins = np.flatnonzero(word & ~before)
    if not len(begins):
        return None
    kept = np.where(word, raw, 32)[keep].astype(np.uint8).tobytes()
    begin = np.concatenate((np.cumsum(keep)[begins] - 1, [len(kept)]))
    piece = np.cumsum(kind == BREAK)[begins]
    last = np.append(np.flatnonzero(piece[1:] != piece[:-1]), len(begins) - 1)
    left = last[np.searchsorted(last, np.arange(len(begins)))] - np.arange(len(begins)) + 1
    words = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(begin.astype(np.int32)), pa.py_buffer(kept)]).dictionary_encode()
    distinct = [w[:-1] for w in byte_strings(words.dictionary)]
    start = lang.encode() + b"\x01"
    hashes = np.fromiter((xxhash.xxh64_intdigest(start + w, SEED) for w in distinct), np.uint64, len(distinct))
    return Words(kept, begin, words.indices.to_numpy().astype(np.int64) + 1, left, distinct, hashes)


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of stretches of text of one language each, from batches of (lang, text)."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    waiting = 0

    def taken(lang: str) -> Iterator[tuple[str, Words]]:
        del sizes[lang]
        if (words := words_of(b"".join(held.pop(lang)), lang)) is not None:
            yield lang, words

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for data in lower_bytes(text):
                held.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data)
                waiting += len(data)
                full = lang if sizes[lang] >= STRETCH else max(sizes, key=sizes.get) if waiting >= WAITING else None
                if full is not None:
                    waiting -= sizes[full]
                    yield from taken(full)
    for lang in list(held):
        yield from taken(lang)


def strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def heavy_beginnings(words: Words) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Beginnings of 2 to 4 words that hold more than 1 / SHARE of the suffixes: their length, one of them each, their counts."""
    at, rank = np.arange(len(words.code)), words.code
    least = max(len(words.code) / SHARE, 2)
    for size in range(1, LONGEST):
        same, first, count = np.unique(rank, return_index=True, return_counts=True)
        heavy = count > least
        if not heavy.any():
            return
        if size > 1:
            one = at[first[heavy]]
            yield size, [words.data[a : b - 1] for a, b in zip(words.begin[one].tolist(), words.begin[one + size].tolist(), strict=True)], count[heavy]
        place = np.searchsorted(same[heavy], rank)
        place[place == heavy.sum()] = 0
        going = (same[heavy][place] == rank) & (words.left[at] > size)
        at = at[going]
        if not len(at):
            return
        rank = place[going] * (len(words.distinct) + 1) + words.code[at + size]


def counted(table: DataFrame) -> DataFrame:
    """(size, lang, phrase, n): every word of every language, and what batches found of heavy beginnings."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in by_language(batches):
            counts = np.bincount(words.code - 1, minlength=len(words.distinct))
            for size, found, n in ((1, words.distinct, counts), *heavy_beginnings(words)):
                yield pa.record_batch([pa.array(np.full(len(found), size, np.int32)), pa.array([lang] * len(found), pa.string()), strings(found), pa.array(n, pa.int64())], ["size", "lang", "phrase", "n"])

    parts = table.mapInArrow(each, "size int, lang string, phrase string, n long")
    return parts.groupBy("size", "lang", "phrase").agg(F.sum("n").alias("n"))


def maybe_frequent(words: DataFrame, least: int) -> np.ndarray:
    """For each bucket of word hashes whether its words occur `least` times together; 2^BUCKET_BITS bits."""
    bucket = word_hash(F.col("lang"), F.col("phrase")).bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))
    bucket = words.groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    place, block = F.expr("bitmap_bit_position(b + 1)"), F.expr("bitmap_bucket_number(b + 1)")
    found = bucket.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(place).alias("bits")).collect()  # at most 2^BUCKET_BITS / 32768 rows
    width = 32768
    out = np.zeros(1 << BUCKET_BITS, bool)
    for r in found:
        at = (r["block"] - 1) * width
        out[at : at + width] = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")[: len(out) - at]
    return np.packbits(out)


def beginning_hash(hashes: list[np.ndarray]) -> Iterator[np.ndarray]:
    """A hash of the first word, of the first two words and so on."""
    total = np.zeros(len(hashes[0]), np.uint64)
    for h in hashes:
        total = (total ^ h) * MIX
        total = total ^ (total >> np.uint64(29))
        yield total


def heavy_hashes(heavy: list[tuple[str, str]]) -> list[np.ndarray]:
    """Sorted hashes of heavy beginnings of 1 to 4 words."""
    out: list[list[int]] = [[] for _ in range(LONGEST - 1)]
    for lang, phrase in heavy:
        start = lang.encode() + b"\x01"
        words = [np.array([xxhash.xxh64_intdigest(start + w, SEED)], np.uint64) for w in phrase.encode().split(b" ")]
        *_, last = beginning_hash(words)
        out[len(words) - 1].append(int(last[0]))
    return [np.sort(np.array(o, np.uint64)) for o in out]


def suffixes(words: Words, frequent: np.ndarray, heavy: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The different suffixes: where one stands, its words, the hash of the beginning that names its group, the depth where its nodes stay in one group, its count."""
    bucket = (words.hashes & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)
    known = np.concatenate(([False], (frequent[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1).astype(bool)))[words.code]
    size = known.astype(np.int64)
    for k in range(1, LONGEST):
        size[:-k] += (size[:-k] == k) & (words.left[:-k] > k) & known[k:]
    at = np.flatnonzero(size > 1)
    size = size[at]
    codes = [np.where(size > k, words.code[np.minimum(at + k, len(words.code) - 1)], 0) for k in range(LONGEST)]
    if len(words.distinct) < 1 << 21:  # three words and two words fit one number each
        order = np.lexsort((codes[3] << 21 | codes[4], codes[0] << 42 | codes[1] << 21 | codes[2]))
    else:
        order = np.lexsort(codes[::-1])
    new = np.zeros(len(at), bool)
    new[:1] = True
    for c in codes:
        new[1:] |= c[order][1:] != c[order][:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(at)))
    one = order[first]
    at, size = at[one], size[one]
    depth = np.ones(len(at), np.int8)  # the first beginning that is not heavy
    group = np.zeros(len(at), np.uint64)
    hashes = [words.hashes[np.maximum(c[one] - 1, 0)] for c in codes]
    for k, h in enumerate(beginning_hash(hashes)):  # the order of rows stays, so equal beginnings are neighbours
        here = (depth == k + 1) & (size > k)
        group[here] = h[here]
        if k < len(heavy):
            depth[here & np.isin(h, heavy[k])] += 1
    return at, size, group, depth, count


def coded(words: Words, codes: dict[bytes, bytes]) -> Words:
    """The same words with their codes in `data`."""
    written = [codes.get(w) or PLAIN + w + b" " for w in words.distinct]
    sizes = np.fromiter(map(len, written), np.int64, len(written))[words.code - 1]
    data = b"".join(map(written.__getitem__, (words.code - 1).tolist()))
    return dataclasses.replace(words, data=data, begin=np.concatenate(([0], np.cumsum(sizes))))


def decoded(phrase: bytes, words: list[bytes]) -> bytes:
    parts = phrase.split(b" ")
    return b" ".join(p[1:] if p[:1] == PLAIN else words[ord(p.decode()) - FIRST_CODE] for p in parts)


def grouped(table: DataFrame, frequent: np.ndarray, heavy: list[np.ndarray], common: list[tuple[str, bytes]], places: int) -> DataFrame:
    """(place, depth, lang, suffixes, counts): what a stretch has for one of `places`; every word of a suffix is coded and followed by a blank, suffixes end at line ends, which no word has."""
    shared = table.sparkSession.sparkContext.broadcast((frequent, heavy, common))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, heavy, common = shared.value
        codes: dict[str, dict[bytes, bytes]] = {}
        for i, (lang, word) in enumerate(common):
            codes.setdefault(lang, {})[word] = chr(FIRST_CODE + i).encode() + b" "
        for lang, words in by_language(batches):
            at, size, group, depth, count = suffixes(words, frequent, heavy)
            words = coded(words, codes.get(lang, {}))
            place = (group % np.uint64(places)).astype(np.int64)  # all suffixes of a beginning go to one place
            order = np.argsort(place * (LONGEST + 1) + depth, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(place[order] * (LONGEST + 1) + depth[order], prepend=-1)), len(order)).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                for i in range(a, b, BLOCK):
                    some = order[i : min(b, i + BLOCK)]
                    ends = words.begin[at[some] + size[some]].tolist()
                    texts = b"\n".join([words.data[i:j] for i, j in zip(words.begin[at[some]].tolist(), ends, strict=True)])
                    one = some[:1]
                    yield pa.record_batch([
                        pa.array(place[one].astype(np.int32)), pa.array(depth[one]), pa.array([lang], pa.string()), strings([texts]), pa.array([count[some].astype(np.int32)], pa.list_(pa.int32())),
                    ], ["place", "depth", "lang", "suffixes", "counts"])

    return table.mapInArrow(each, "place int, depth byte, lang string, suffixes string, counts array<int>")


def laid_out(blocks: DataFrame) -> DataFrame:
    """(depth, lang, suffix, n) of the rows of `grouped`."""
    pair = F.arrays_zip(F.split("suffixes", "\n").alias("suffix"), F.col("counts").alias("n"))
    each = blocks.select("depth", "lang", F.explode(pair).alias("s"))
    return each.select("depth", "lang", "s.suffix", F.col("s.n").cast("long").alias("n"))


class Tree:
    """Counts of the nodes of a suffix tree whose leaves come sorted; only the open path is held."""

    def __init__(self, least: int) -> None:
        self.least = least
        self.lang, self.last = None, b""
        self.open: list[list | None] = [None] * LONGEST  # for each depth: phrase, count, whether it is spread over groups

    def close(self, depth: int) -> Iterator[tuple[str, bytes, int, int]]:
        node, self.open[depth - 1] = self.open[depth - 1], None
        if node is not None and (node[1] >= self.least or node[2]):
            yield self.lang, node[0], depth, node[1]

    def close_all(self) -> list[tuple[str, bytes, int, int]]:
        return [r for depth in range(2, LONGEST + 1) for r in self.close(depth)]

    def add(self, lang: str, data: np.ndarray, offsets: np.ndarray, n: np.ndarray, divided: np.ndarray) -> list[tuple[str, bytes, int, int]]:
        """Leaves of one language in order; returns the nodes that ended."""
        out = []
        if lang != self.lang:
            out += self.close_all()
            self.lang, self.last = lang, b""
        rows, raw = len(n), data.tobytes()
        at, sizes = offsets[:-1], np.diff(offsets)
        blanks = np.flatnonzero(data[offsets[0] : offsets[-1]] == 32) + offsets[0]
        owner = np.searchsorted(offsets, blanks, side="right") - 1
        words = np.bincount(owner, minlength=rows)
        ends = np.full((rows, LONGEST), np.iinfo(np.int64).max)  # bytes up to each word's blank
        nth = np.arange(len(blanks)) - np.repeat(np.cumsum(words) - words, words)
        ends[owner, nth] = blanks - at[owner] + 1
        common = np.zeros(rows, np.int64)
        first = raw[at[0] : offsets[1]]
        common[0] = next((i for i, (a, b) in enumerate(zip(first, self.last, strict=False)) if a != b), min(len(first), len(self.last)))
        if rows > 1:
            short = np.minimum(sizes[1:], sizes[:-1])
            until = np.cumsum(short)
            step = np.arange(until[-1]) - np.repeat(until - short, short)
            differ = data[np.repeat(at[1:], short) + step] != data[np.repeat(at[:-1], short) + step]
            wrong = np.where(differ, step, np.iinfo(np.int64).max)
            common[1:] = np.minimum(np.minimum.reduceat(wrong, until - short), short)
        shared = (ends <= common[:, None]).sum(axis=1)  # whole words in common with the row before
        for depth in range(2, LONGEST + 1):
            begins = np.flatnonzero(shared < depth)
            if not len(begins) or begins[0]:  # the open node goes on
                begins = np.concatenate(([0], begins))
            total = np.add.reduceat(n, begins)
            deep, spread = words[begins] >= depth, divided[begins] > depth
            if shared[0] >= depth and self.open[depth - 1] is not None:
                total[0] += self.open[depth - 1][1]
                spread[0] |= self.open[depth - 1][2]
            else:
                out += self.close(depth)
            wanted = deep & ((total >= self.least) | spread)
            wanted[-1] = False
            for i in np.flatnonzero(wanted).tolist():
                a = at[begins[i]]
                out.append((lang, raw[a : a + ends[begins[i], depth - 1] - 1], depth, int(total[i])))
            a = at[begins[-1]]
            self.open[depth - 1] = [raw[a : a + ends[begins[-1], depth - 1] - 1], int(total[-1]), bool(spread[-1])] if deep[-1] else None
        self.last = raw[at[-1] : offsets[-1]]
        return out


def node_counts(sorted_suffixes: DataFrame, least: int, common: list[tuple[str, bytes]]) -> DataFrame:
    """(lang, phrase, size, n) of the nodes of depth 2 and more, from partitions that are sorted by language and suffix."""

    shared = sorted_suffixes.sparkSession.sparkContext.broadcast([w for _, w in common])

    def rows(found: list[tuple[str, bytes, int, int]]) -> Iterator[pa.RecordBatch]:
        if found:
            lang, phrase, size, n = zip(*found, strict=True)
            yield pa.record_batch([pa.array(lang), strings([decoded(p, shared.value) for p in phrase]), pa.array(size, pa.int32()), pa.array(n, pa.int64())], ["lang", "phrase", "size", "n"])

    def block(tree: Tree, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        langs, suffix = table.column("lang").chunk(0).dictionary_encode(), table.column("suffix").chunk(0)
        codes = langs.indices.to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)])).tolist()
        n, divided = table.column("n").to_numpy(), table.column("depth").to_numpy()
        _, offsets, data = suffix.buffers()
        offsets = np.frombuffer(offsets, np.int32)[suffix.offset : suffix.offset + len(suffix) + 1].astype(np.int64)
        data = np.frombuffer(data, np.uint8)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield from rows(tree.add(langs.dictionary[codes[a]].as_py(), data[: offsets[b]], offsets[a : b + 1], n[a:b], divided[a:b]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, size = Tree(least), [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                yield from block(tree, held)
                held, size = [], 0
        if size:
            yield from block(tree, held)
        yield from rows(tree.close_all())

    return sorted_suffixes.select("lang", "suffix", "n", "depth").mapInArrow(each, "lang string, phrase string, size int, n long")


def frequent_phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of all phrases of 1 to 5 words that occur `least` times in a language, and (lang, total) words."""
    prepare(df.sparkSession)
    table = df.select(F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"), col(text).alias("text"))
    known = stage(counted(table), "word-counts")
    words = known.where("size = 1")
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("total")), "language-words")
    total = totals.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    heavy = known.where(F.col("n") * 2 * SHARE > total).select("lang", "phrase").collect()  # at most 2 SHARE for each size
    common = [(r["lang"], r["phrase"].encode()) for r in words.orderBy(F.desc("n"), "lang", "phrase").limit(CODES).select("lang", "phrase").collect()]
    groups = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // GROUP))
    spread = grouped(table, maybe_frequent(words, least), heavy_hashes([tuple(r) for r in heavy]), common, groups * PLACES)
    leaves = laid_out(spread.repartition(groups, "place")).sortWithinPartitions("lang", "suffix")
    nodes = node_counts(leaves, least, common).groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    frequent = nodes.unionByName(words.select("lang", "phrase", "size", "n")).where(F.col("n") >= least)
    return stage(frequent, "frequent-phrases"), totals


def collocations(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r, n and score, all but the texts longs."""
    frequent, totals = frequent_phrases(df, text, lang, least)
    found = frequent.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"))
    inner = F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))
    covered = found.where("size > 2").select("lang", F.explode(inner).alias("phrase"), "a").distinct()  # a longer phrase as frequent hides these; one word longer is enough
    kept = found.join(covered, ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("one"), F.expr("substring_index(phrase, ' ', k - size)").alias("rest"))
    parts = broadcast_if_small(frequent.select("lang", "phrase", "n"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("one"), F.col("n").alias("l")), ["lang", "one"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(broadcast_if_small(totals), "lang")
    score = F.expr("(1000 * cast(a as decimal(18,0)) * cast(total as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least_cut = cuts.groupBy("lang", "phrase", "a", F.col("total").alias("n")).agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = least_cut.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    some = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
