"""Token ids in binary shard files with a minimal perfect hash index.

Rows are sorted into shards by key. A shard file holds

    magic | ids | keys | index | JSON footer | length of the footer

where the ids of all its documents follow one another, in 16 bits if the
vocabulary allows, else in 32. The index maps (key, copy) to a slot in
constant time: a key tries one bit per level, and the number of set bits
before it is its slot. A slot holds a fingerprint of the key, and the place
and number of the document's ids. Keys that the shard does not hold are told by
the fingerprint, up to one in four billion.

Every task writes a file of a new name and reports it; the manifest lists only
reported files, so what lost or repeated tasks leave behind is never read.

Null texts count as empty. Null keys sort first. Rows with the same key follow
one another by text hash, as copies 0, 1, ... An empty table gives a manifest
without rows. Keys are integers.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, prepare
from sorterlog.llm.token_ids import END, VOCABULARY, encoder
from sorterlog.sources.staging import stage

MAGIC = b"TOKENS01"
SHARD_CHARACTERS = 16_000_000
LEVELS = 48
ROOM = 2.0


def mix(values: np.ndarray, seed: int) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, absent: np.ndarray, copies: np.ndarray, seed: int) -> np.ndarray:
    value = mix(keys.astype(np.int64).view(np.uint64), seed) ^ np.where(copies > 0, mix(copies, seed + 1), np.uint64(0))
    return np.where(absent, mix(copies, seed + 2), value)


def build_index(hashes: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes in 64-bit words, the bits of all levels, and the slot of each hash. Hashes differ from one another."""
    slot, sizes, words = np.full(len(hashes), -1, np.int64), [], []
    left = np.arange(len(hashes))
    for level in range(LEVELS):
        if not len(left):
            break
        size = int(np.ceil(ROOM * len(left) / 64)) * 64
        at = (mix(hashes[left], level) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size // 64)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[at]]
    if len(left):
        raise ValueError("hashes repeat")
    bits = np.concatenate(words) if words else np.zeros(0, "<u8")
    slot = find_slots(hashes, sizes, bits)
    return sizes, bits, slot


def find_slots(hashes: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each hash, -1 where no level has it."""
    before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
    slot, base, left = np.full(len(hashes), -1, np.int64), 0, np.arange(len(hashes))
    for level, size in enumerate(sizes):
        at = mix(hashes[left], level) % np.uint64(64 * size)
        word, bit = base + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = bits[word]
        hit = (value >> bit) & np.uint64(1) == 1
        lower = value & ((np.uint64(1) << bit) - np.uint64(1))
        slot[left[hit]] = before[word[hit]] + np.bitwise_count(lower[hit])
        left, base = left[~hit], base + size
    return slot


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def copies_of(keys: np.ndarray, absent: np.ndarray) -> np.ndarray:
    """For sorted keys the number of equal keys before each."""
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (absent[1:] != absent[:-1])
    at = np.arange(len(keys))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def index_sections(keys: np.ndarray, absent: np.ndarray, copies: np.ndarray, begin: np.ndarray, count: np.ndarray) -> tuple[dict, list[bytes]]:
    for seed in range(100):
        hashes = key_hash(keys, absent, copies, seed)
        if len(np.unique(hashes)) == len(hashes):
            break
    sizes, bits, slot = build_index(hashes)
    table = np.zeros(len(keys), [("mark", "<u4"), ("begin", "<u8"), ("count", "<u8")])
    table["mark"][slot] = mix(hashes, 77) >> np.uint64(32)
    table["begin"][slot], table["count"][slot] = begin, count
    parts = [keys.astype("<i8").tobytes(), absent.astype(np.uint8).tobytes(), copies.astype("<i8").tobytes(), bits.tobytes(), table.tobytes()]
    return {"seed": seed, "levels": sizes, "sizes": [len(p) for p in parts]}, parts


class Shard:
    """One shard file, opened for keyed access."""

    def __init__(self, uri: str) -> None:
        store, path = open_store(uri)
        self.file = store.open_input_file(path)
        size = self.file.size()
        tail = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.footer = json.loads(self.file.read_at(tail, size - 8 - tail))
        at, parts = self.footer["index_at"], []
        for n in self.footer["sizes"]:
            parts.append(self.file.read_at(n, at) if n else b"")
            at += n
        self.keys, self.absent = np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8).astype(bool)
        self.copies, self.bits = np.frombuffer(parts[2], "<i8"), np.frombuffer(parts[3], "<u8")
        self.table = np.frombuffer(parts[4], [("mark", "<u4"), ("begin", "<u8"), ("count", "<u8")])
        self.width = self.footer["width"]

    def find(self, keys: np.ndarray, absent: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and count of each document's ids in this shard; count -1 where the shard has no such document."""
        hashes = key_hash(keys, absent, copies, self.footer["seed"])
        slot = find_slots(hashes, self.footer["levels"], self.bits)
        ok = slot >= 0
        ok[ok] = self.table["mark"][slot[ok]] == (mix(hashes[ok], 77) >> np.uint64(32)).astype(np.uint32)
        begin, count = np.zeros(len(keys), np.int64), np.full(len(keys), -1, np.int64)
        begin[ok], count[ok] = self.table["begin"][slot[ok]], self.table["count"][slot[ok]]
        return begin, count

    def ids(self, begin: int, count: int) -> np.ndarray:
        raw = self.file.read_at(count * self.width, len(MAGIC) + begin * self.width)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")


def write(df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, shard_characters: int = SHARD_CHARACTERS) -> DataFrame:
    """Write shard files and `manifest` (shard, file, first_key, last_key, documents, start, ids) below `folder`; the manifest is returned."""
    spark = prepare(df.sparkSession)
    rows = df.select(col(key).cast("long").alias("key"), F.coalesce(col(text), F.lit("")).alias("text"))
    characters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, int(characters // shard_characters))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text").asc()]
    store, path = open_store(folder)
    store.create_dir(path, recursive=True)

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        width = 2 if coder.vocabulary_size <= 1 << 16 else 4
        shard, keys, counts, out = TaskContext.get().partitionId(), [], [], None
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.bin"
        for batch in batches:
            if out is None:
                target, at = open_store(name)
                out = target.open_output_stream(at)
                out.write(MAGIC)
            keys.append(batch.column(0))
            for ids in coder.encode(batch.column(1).to_pylist()):
                out.write(np.append(ids, np.uint32(END)).astype(f"<u{width}").tobytes())
                counts.append(len(ids) + 1)
        if out is None:
            return
        count = np.array(counts, np.int64)
        column = pa.chunked_array(keys).combine_chunks()
        absent = np.array(column.is_null())
        value = np.array(column.fill_null(0))
        total = int(count.sum())
        footer, parts = index_sections(value, absent, copies_of(value, absent), np.cumsum(count) - count, count)
        raw = json.dumps(footer | {"width": width, "index_at": len(MAGIC) + total * width}).encode()
        for part in (*parts, raw, len(raw).to_bytes(8, "little")):
            out.write(part)
        out.close()
        ends = [None if a else int(v) for v, a in ((value[0], absent[0]), (value[-1], absent[-1]))]
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "file": name, "first_key": ends[0], "last_key": ends[1], "documents": len(count), "ids": total}],
            pa.schema([("shard", pa.int32()), ("file", pa.string()), ("first_key", pa.int64()), ("last_key", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64())]),
        )

    parts = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order)
    written = stage(parts.mapInArrow(save, "shard int, file string, first_key long, last_key long, documents long, ids long"), "shards")
    done = sorted(written.collect(), key=lambda r: r["shard"])  # one row per shard
    starts = np.cumsum([0] + [r["ids"] for r in done]).tolist()
    manifest = spark.createDataFrame(
        [(*r, s) for r, s in zip(done, starts, strict=False)], "shard int, file string, first_key long, last_key long, documents long, ids long, start long",
    )
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_back(manifest: DataFrame) -> DataFrame:
    """Every document of the files, found by its key through the index: key, copy, start, n_tokens, ids_crc32."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["file"])
                for a in range(0, len(shard.keys), 20_000):
                    keys, absent, copies = shard.keys[a : a + 20_000], shard.absent[a : a + 20_000], shard.copies[a : a + 20_000]
                    begin, count = shard.find(keys, absent, copies)
                    crc = [zlib.crc32(shard.ids(b, n).tobytes()) for b, n in zip(begin.tolist(), count.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, mask=absent), pa.array(copies), pa.array(begin + row["start"]), pa.array(count), pa.array(crc, pa.int64())],
                        ["key", "copy", "start", "n_tokens", "ids_crc32"],
                    )

    few = manifest.select("file", "start", "shard")
    return few.repartitionByRange(max(1, few.count()), "shard").mapInArrow(load, "key long, copy long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """The ids of every stored copy of the wanted keys: key, copy, ids. Keys that are not stored give no row."""
    ends = [F.coalesce(F.col(c), F.lit(-(1 << 63)).cast("long")).alias(c) for c in ("first_key", "last_key")]
    bounds = F.broadcast(manifest.select("shard", "file", *ends))  # one row per shard
    wanted = keys.select(col(key).cast("long").alias("key")).distinct()
    near = wanted.join(bounds, F.coalesce("key", F.lit(-(1 << 63)).cast("long")).between(F.col("first_key"), F.col("last_key")))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, Shard] | None = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if opened is None or opened[0] != row["file"]:
                    opened = (row["file"], Shard(row["file"]))
                copy = 0
                while True:
                    absent = np.array([row["key"] is None])
                    begin, count = opened[1].find(np.array([row["key"] or 0]), absent, np.array([copy]))
                    if count[0] < 0:
                        break
                    out.append({"key": row["key"], "copy": copy, "ids": opened[1].ids(int(begin[0]), int(count[0]))})
                    copy += 1
            yield pa.RecordBatch.from_pylist(out, pa.schema([("key", pa.int64()), ("copy", pa.int64()), ("ids", pa.list_(pa.uint32()))]).set(2, pa.field("ids", pa.list_(pa.int64()))))

    return near.repartition("shard").sortWithinPartitions("shard").select("key", "file").mapInArrow(fetch, "key long, copy long, ids array<long>")
