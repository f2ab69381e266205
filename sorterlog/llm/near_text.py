"""Near copies by exact Jaccard similarity of word shingles.

Two texts are linked if their sets of 5-word shingles overlap by at least 4/5
of their union; groups are the components of all links. Texts with equal sets
form one class, so copies cost one row.

The first candidates are those of operator 7 (`simhash.py`): classes whose
fingerprints its vantage-point trees link, or whose fingerprints are equal. They
are verified like all others. Near copies with edited words mostly differ in more bits,
so the other candidates come from a prefix join: with the shingles of every text in one common order, a text of n shingles that
is linked shares at least ceil(4n/5) of them, so both texts hold a common
shingle among their first n - ceil(4n/5) + 1. Only prefixes are joined, and of
these only shingles that two of them may share (a fixed table of bits says so);
a pair is tried only if the places of the shared shingle leave room for enough
overlap. Each set has a mask of the parities of its shingles, about four bits
for each; two masks, folded to one length, differ in no more bits than the sets differ in shingles,
which rules out nearly all pairs that are not linked. The rest is verified on the whole sets.

The order puts frequent shingles last: a table of `FREQUENCY_BITS` buckets
counts the shingles of all texts. It affects only how many candidates
there are, never which links are found.

Of shingles that the very same prefixes share only the first one is tried: it stands before the others
in each of them, so it leaves the most room. Near copies share most of their prefixes, so this makes a pair
once, not once for each common shingle. A shingle that many prefixes share is not paired at once: first all its texts
are tried against one of them, a text of its largest group, which differs between shingles and rounds, and texts that links
have already joined need no further trial. Such rounds go on while too many pairs are open and each round
leaves nine tenths of them or fewer (texts that only share a common line are never joined), then all
pairs that are still in different groups are tried; of a shingle that makes very many of them only those that sizes and masks do not rule out are laid out. Verification goes the same
way: each text first against one partner, then only pairs in different
groups. So the groups are exact. Tables of a round are deleted after it.

Empty and null texts have an empty set and form one class. Texts below five
words have one shingle. Rows that repeat key and text stay once. Long texts are taken whole, an empty table gives
an empty one, ties go to the smallest key (null last), further columns may have
any names. Results are exact up to equal 64-bit hash values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorterlog.llm.components import components
from sorterlog.llm.shared import col, fresh, prepare, slices
from sorterlog.llm.simhash import fingerprint
from sorterlog.llm.simhash import links as fingerprint_links
from sorterlog.llm.token_ids import byte_strings
from sorterlog.operators.sizing import broadcast_if_small
from sorterlog.sources.staging import stage, unstage

WIDTH = 5
#: Characters whose words are hashed at once; a worker holds some arrays of that length.
CHUNK = 250_000
#: Buckets that count how frequent shingles are, and buckets that tell which are held twice, as powers of two.
FREQUENCY_BITS, HELD_BITS = 22, 26
#: Parts of the table of frequencies that are summed separately, and tables that are summed at once.
PARTS, FAN_IN = 64, 64
STAR_ROUNDS = 3
VERIFY_ROUNDS = 3
PAIRS_A_ROW = 8
#: Different texts that the texts of the same shingles are tried against in a round, at most.
CENTRES = 4
#: Pairs of one shingle from which on masks are looked at before a pair is laid out.
HOT_PAIRS = 10_000
#: Likely pairs that are compared at once: so many for each set, or so many in all. More are tried in rounds.
PAIRS_A_SET, PAIRS_AT_ONCE = 2, 20_000
#: Copies of a set, at most, that meet the many partners it may have.
SALTS = 64
LEAST_MASK, MASK_SHARE = 64, 4
MIX = np.uint64(0x9E3779B97F4A7C15)
WHITE = np.zeros(256, bool)
WHITE[list(b" \t\n\r\x0b\x0c")] = True


def _mixed(total: np.ndarray, word: np.ndarray) -> np.ndarray:
    total = (total ^ word) * MIX
    return total ^ (total >> np.uint64(29))


def _hashes(texts: list[str | None], width: int) -> Iterator[np.ndarray]:
    data = [(t or "").encode("utf-8", "replace").lower() + b" " for t in texts]  # bytes.lower changes A-Z only
    raw = np.frombuffer(b"".join(data), np.uint8)
    white = WHITE[raw]
    before = np.concatenate(([True], white[:-1]))
    starts, ends = np.flatnonzero(~white & before), np.flatnonzero(white & ~before)
    if not len(starts):
        yield from (np.zeros(0, np.uint64) for _ in texts)
        return
    offsets = np.append(np.column_stack((starts, ends)).ravel(), len(raw)).astype(np.int32)  # words and what is between them in turn
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).take(pa.array(np.arange(0, len(offsets) - 1, 2))).dictionary_encode()
    known = byte_strings(words.dictionary)
    word = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))[words.indices.to_numpy()]
    total = np.zeros(len(word), np.uint64)
    for k in range(min(width, len(word))):
        total[: len(word) - k] = _mixed(total[: len(word) - k], word[k:])
    cuts = np.searchsorted(starts, np.cumsum([0, *map(len, data)]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(total[a : b - width + 1])
        else:  # fewer words: the whole sequence
            one = np.full(min(b - a, 1), b - a, np.uint64)
            for w in word[a:b]:
                one = _mixed(one, w)
            yield one


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """The different shingle hashes of each text, sorted."""
    for a, b in slices([len(t or "") for t in texts], CHUNK):
        yield from _hashes(texts[a:b], width)


def bucket(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - bits)).astype(np.int64)


def prefix(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The part of the set that any linked set must touch, rarest first; `levels` tells how frequent the shingles of a bucket are."""
    n = len(shingles)
    if not n:
        return shingles
    return shingles[np.lexsort((shingles, levels[bucket(shingles, FREQUENCY_BITS)]))][: n - (4 * n + 4) // 5 + 1]


def mask(shingles: np.ndarray) -> np.ndarray:
    """Whether each bucket holds an odd number of the shingles, as signed longs; a power of two of buckets that grows with the set."""
    bits = LEAST_MASK
    while bits < MASK_SHARE * len(shingles):
        bits *= 2
    odd = np.bincount((shingles % np.uint64(bits)).astype(np.int64), minlength=bits) % 2
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def differing_bits(a: str, b: str) -> Column:
    """Bits in which two masks differ; the longer one is folded on itself, as each bucket is two of a mask twice as long."""

    def folded(name: str, other: str) -> Column:
        half = F.expr(f"size({name}) div 2")
        return F.when(F.size(name) > F.size(other), F.zip_with(F.slice(name, F.lit(1), half), F.slice(name, half + 1, half), lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(name))

    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)


def frequency_levels(df: DataFrame, text: str) -> np.ndarray:
    """For each bucket how many texts' shingles fall into it, counted over all texts, 65,535 at most; only how they compare matters.

    While half of the buckets or more are empty, a logarithm in one byte tells enough. As the input grows, every bucket
    fills with rare shingles. A count of its own still shows through then
    (it adds to a sum that varies by its root only), which a logarithm of the sum would hide.
    """
    size = (1 << FREQUENCY_BITS) // PARTS

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(1 << FREQUENCY_BITS, np.uint32)
        for batch in batches:
            found = [bucket(s, FREQUENCY_BITS) for s in shingle_sets(batch["text"].tolist())]
            if found:
                place, count = np.unique(np.concatenate(found), return_counts=True)
                table[place] += count.astype(np.uint32)
        level = np.minimum(table, 65535).astype(np.uint16).reshape(PARTS, size)
        task = np.random.default_rng().integers(1 << 31)  # which tables meet does not matter
        for i in np.flatnonzero(level.any(axis=1)).tolist():
            yield pd.DataFrame({"part": [i], "task": [task], "counts": [level[i].tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(size, np.uint32)
        for counts in group["counts"]:
            total += np.frombuffer(counts, np.uint16)
        return pd.DataFrame({"part": group["part"].iloc[:1], "task": group["task"].iloc[:1], "counts": [np.minimum(total, 65535).astype(np.uint16).tobytes()]})

    schema = "part int, task long, counts binary"
    tables, width = df.select(col(text).alias("text")).mapInPandas(each, schema), df.rdd.getNumPartitions()
    while width > 1:
        width = -(-width // FAN_IN)
        tables = tables.groupBy("part", F.pmod("task", F.lit(width)).alias("some")).applyInPandas(add, schema)
    out = np.zeros((PARTS, size), np.float64)
    for r in tables.collect():  # at most PARTS rows; toLocalIterator() would run the pass twice and leave its shuffle files
        out[r["part"]] += np.frombuffer(r["counts"], np.uint16)
    if 2 * np.count_nonzero(out) <= out.size:
        return np.log2(out.ravel() + 1).astype(np.uint8)
    return np.minimum(out.ravel(), 65535).astype(np.uint16)


def text_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """doc_id, text_hash, fp (the fingerprint of operator 7), cls (equal for equal sets), n, prefix and mask of every row."""
    order = prepare(df.sparkSession).sparkContext.broadcast(frequency_levels(df, text))

    def each(texts: pd.Series) -> pd.DataFrame:
        sets = list(shingle_sets(texts.tolist()))
        return pd.DataFrame({
            "cls": np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64),
            "n": np.array([len(s) for s in sets], np.int64),
            "prefix": [prefix(s, order.value).view(np.int64) for s in sets],
            "mask": [mask(s) for s in sets],
        })

    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    sets = F.pandas_udf(each, "cls long, n long, prefix array<long>, mask array<long>")
    rows = df.select(col(key).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), F.pandas_udf(prints, "long")(col(text)).alias("fp"), sets(col(text)).alias("s"))
    return rows.select("doc_id", "text_hash", "fp", "s.*")


def fingerprint_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes that operator 7 links: stars of its edges between fingerprints, and of the classes of one fingerprint."""
    first = stage(classes.groupBy("fp").agg(F.min("cls").alias("cls")), "fingerprint-classes")
    edges = fingerprint_links(first.select("fp"))
    for side in ("a", "b"):
        edges = edges.join(first.select(F.col("fp").alias(side), F.col("cls").alias(f"c{side}")), side)
    equal = classes.select("fp", F.col("cls").alias("ca")).join(first.withColumnRenamed("cls", "cb"), "fp").select("ca", "cb")
    pairs = edges.select("ca", "cb").union(equal).where("ca <> cb")
    pairs = stage(pairs.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "fingerprint-pairs")
    unstage(first)
    return pairs


def _room(a: str, b: str) -> Column:
    """Whether two sets whose first common shingle is this one may be similar enough."""
    return 9 * F.least(F.expr(f"{a}.n - {a}.pos"), F.expr(f"{b}.n - {b}.pos")) >= 4 * F.expr(f"{a}.n + {b}.n")


def _likely(na: str, nb: str, ma: str, mb: str) -> Column:
    """Whether sizes and masks leave it open that two sets are similar enough."""
    size = F.greatest(na, nb) * 4 <= F.least(na, nb) * 5
    return size & (9 * differing_bits(ma, mb) <= F.col(na) + F.col(nb))


def shared_postings(classes: DataFrame) -> DataFrame:
    """(cls, n, posts) with the places and values (pos, tok) of the prefix shingles that two classes may hold; few others slip through."""
    spark, width = classes.sparkSession, 32768
    held = classes.select(F.explode("prefix").alias("tok")).groupBy("tok").agg(F.count("*").alias("c")).where("c > 1")
    place = (F.shiftrightunsigned("tok", 64 - HELD_BITS) + 1).alias("b")
    found = held.select(place).groupBy(F.expr("bitmap_bucket_number(b)").alias("block")).agg(F.bitmap_construct_agg(F.expr("bitmap_bit_position(b)")).alias("bits"))
    table = np.zeros(1 << HELD_BITS, bool)
    for r in found.collect():  # at most 2^HELD_BITS / 32768 rows
        table[(r["block"] - 1) * width : r["block"] * width] = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")
    bits = spark.sparkContext.broadcast(np.packbits(table))

    def each(prefixes: pd.Series) -> pd.Series:
        out = []
        for p in prefixes:
            at = bucket(np.asarray(p, np.int64).view(np.uint64), HELD_BITS)
            out.append(np.flatnonzero(bits.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(np.int32))
        return pd.Series(out)

    kept = classes.select("cls", "n", "prefix", F.pandas_udf(each, "array<int>")("prefix").alias("places"))
    post = F.transform("places", lambda p: F.struct(p.cast("long").alias("pos"), F.get("prefix", p).alias("tok")))
    return kept.select("cls", "n", post.alias("posts"))  # a filter on the places would be pushed down and run the function twice


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets overlap by 4/5 or more. A set travels once for each pair as b, and `SALTS` times at most as a."""
    salt = F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt")
    right = pairs.join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", salt, "sb")
    left = pairs.select("a", salt).distinct().join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a")
    both = right.join(left, ["a", "salt"])
    return both.where(9 * F.size(F.array_intersect("sa", "sb")) >= 4 * (F.size("sa") + F.size("sb"))).select("a", "b")


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links among the pairs (a, b) of classes that join the same classes as all links among them do; none if there are none."""

    def each(found: pd.Series) -> pd.Series:
        return pd.Series([s.view(np.int64) for s in shingle_sets(found.tolist())])

    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"), F.col("mask").alias(f"m{side}")), side)
    open_ = stage(pairs.where(_likely("na", "nb", "ma", "mb")).select("a", "b"), "likely-pairs")
    if open_.isEmpty():
        unstage(open_)
        return None
    nodes = open_.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = stage(classes.join(nodes, "cls", "left_semi").select("cls", F.col("least.doc_id").alias("id"), F.col("least.text_hash").alias("h")), "wanted")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("h"))
    chosen = texts.join(broadcast_if_small(wanted), same).select("cls", "text").dropDuplicates(["cls"])
    sets = stage(chosen.select("cls", F.pandas_udf(each, "array<long>")("text").alias("shingles")), "shingle-sets")
    links, rounds = None, VERIFY_ROUNDS if open_.count() > max(PAIRS_AT_ONCE, PAIRS_A_SET * wanted.count()) else 0
    for step in range(rounds + 1):
        if open_.isEmpty():
            break
        last = step == rounds
        some = open_ if last else open_.groupBy("b").agg(F.min("a").alias("a"))
        found = stage(compared(some, sets), "text-links")
        links = found if links is None else links.union(found)
        if last:
            break
        roots = components(links)
        rest = open_.join(some, ["a", "b"], "left_anti")
        for side in ("a", "b"):
            rest = rest.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
        left, before = stage(rest.where(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b"), "likely-pairs"), open_
        unstage(before)
        open_ = left
    unstage(open_, wanted, sets)
    return links


def _paired(open_: DataFrame, *held: str) -> DataFrame:
    """Pairs x, y of texts that share a shingle and are in different groups; one of them is not in the shingle's largest group. Masks that are held rule pairs out."""
    x = open_.where("root <> big").select("tok", F.struct("cls", "pos", "root", *held).alias("x"))
    y = open_.select("tok", "big", F.struct("cls", "pos", "root", *held).alias("y"))
    apart = (F.col("x.root") != F.col("y.root")) & ((F.col("y.root") == F.col("big")) | (F.col("x.cls") < F.col("y.cls")))
    open_pair = apart & _room("x", "y")
    if "mask" in held:
        open_pair &= _likely("x.n", "y.n", "x.mask", "y.mask")
    return x.join(y, "tok").where(open_pair).select("x.cls", F.col("y.cls").alias("other"))


def links(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(cls, root) for the classes that have a link: the components of all links between classes."""
    pairs = fingerprint_pairs(classes)
    edges = verified(pairs, classes, texts)
    unstage(pairs)
    roots = None if edges is None else stage(components(edges), "shared-roots")
    shared = held = stage(shared_postings(classes), "shared-shingles")
    before = None
    for step in range(STAR_ROUNDS + 1):
        rooted = shared.withColumn("root", F.col("cls"))
        if roots is not None:  # classes, not their shingles, meet their roots
            rooted = shared.join(roots.select(F.col("node").alias("cls"), F.col("root").alias("r")), "cls", "left").withColumn("root", F.coalesce("r", "cls"))
        rooted = rooted.select("cls", "n", "root", F.inline("posts"))
        turn = [F.lit(step), F.pmod("tok", F.lit(CENTRES))]
        one = F.struct(F.xxhash64("cls", *turn).alias("h"), "cls", "n", "pos", "root")
        held_by = [F.xxhash64("cls", F.lit(seed)) for seed in ("g", "h")]
        by_root = rooted.groupBy("tok", "root").agg(F.count("*").alias("c"), F.min(one).alias("one"), F.min(F.struct(held_by[0].alias("g"), "pos")).alias("place"), *[F.bit_xor(v).alias(k) for k, v in zip("gh", held_by, strict=True)])
        most = F.max(F.struct("c", F.xxhash64("root", *turn).alias("h"), "root", "one"))
        tops = by_root.groupBy("tok").agg(
            F.sum("c").alias("rows"), most["root"].alias("big"), most["c"].alias("big_rows"), most["one"].alias("one"), F.min("place").alias("place"), F.count("*").alias("groups"),
            F.bit_xor("g").alias("g"), F.bit_xor("h").alias("h"),
        ).where("groups > 1")  # shingles whose texts are not yet in one group
        first = F.min_by(F.struct("tok", "big", "big_rows", "one"), "place.pos").alias("first")  # places in the same text
        tops = stage(tops.groupBy("rows", "g", "h").agg(first).select("rows", "first.*"), "shared-tops")
        pairs_of = F.expr("(rows - big_rows) * rows")
        total = tops.agg(F.sum("rows").alias("rows"), F.sum(pairs_of).alias("pairs")).first()
        if not total["rows"]:
            unstage(tops)
            break
        open_ = stage(rooted.join(tops.select("tok", "big", "one", (pairs_of > HOT_PAIRS).alias("hot")), "tok"), "shared-open")
        unstage(held, tops)
        held = open_
        idle = before is not None and 10 * total["pairs"] > 9 * before
        every = step == STAR_ROUNDS or idle or total["pairs"] <= PAIRS_A_ROW * total["rows"]
        before = total["pairs"]
        if every:
            masked = open_.where("hot").join(classes.select("cls", "mask"), "cls")
            tried = _paired(open_.where("not hot"), "n").union(_paired(masked, "n", "mask"))
        else:
            tried = open_.select(F.struct("cls", "n", "pos", "root").alias("x"), F.col("one").alias("y")).where((F.col("x.root") != F.col("y.root")) & _room("x", "y"))
            tried = tried.select("x.cls", F.col("y.cls").alias("other"))
        pairs = stage(tried.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct(), "shared-pairs")
        found = verified(pairs, classes, texts)
        unstage(pairs)
        if found is not None:
            edges = found if edges is None else edges.union(found)
            roots = stage(components(edges), "shared-roots")
        if every:
            break
        shared = open_.groupBy("cls", "n").agg(F.collect_list(F.struct("pos", "tok")).alias("posts"))
    unstage(held)
    return roots if roots is not None else classes.select(F.col("cls").alias("node"), F.col("cls").alias("root")).limit(0)


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of linked texts stays, one with the group's smallest key; the columns stay as they are."""
    rows = text_rows(df, key, text)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    classes = stage(rows.groupBy("cls").agg(F.min(order).alias("least"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("mask").alias("mask"), F.min("fp").alias("fp")), "text-classes")
    texts = df.select(col(key).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    roots = links(classes, texts).withColumnRenamed("node", "cls")
    rooted = classes.select("cls", "least").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = rooted.groupBy("root").agg(F.min("least").alias("least"))
    winners = stage(least.select(F.col("least.doc_id").alias("winner"), F.col("least.text_hash").alias("winner_hash")), "winners")
    same = F.col("doc_id").eqNullSafe(F.col("winner")) & (F.col("text_hash") == F.col("winner_hash"))
    held = fresh(df, "row")
    kept = df.select(F.struct(*[col(c) for c in df.columns]).alias(held), col(key).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"))
    kept = kept.join(winners, same, "left_semi")
    if texts.join(winners, same, "left_semi").count() > winners.count():  # rows that repeat key and text
        kept = kept.dropDuplicates(["doc_id", "text_hash"])
    return kept.select(f"{held}.*")
