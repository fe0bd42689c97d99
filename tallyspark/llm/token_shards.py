"""Token ids of documents in binary shards, with a minimal perfect hash index in each for access by key.

A shard is a plain file: the ids of its documents in ascending key order, little-endian, 16 bits each where the vocabulary
fits (else 32), each document closed by the end id 0; then a footer and a 16-byte trailer (footer length, mark) before a
last end id. Spark's text writer writes it, a document a line, with the end id as line separator: so shards
come to any file system Spark writes to, by its commit protocol, and a repeated task leaves no second copy.

The footer maps keys to offsets in constant time. A minimal perfect hash sends the n distinct keys to slots
0..n-1: each level hashes the keys left into twice as many bits, keeps those alone on their bit and passes the others to
the next level; the rank of a key's bit is its slot. A slot holds a 32-bit fingerprint of its key (a foreign key
passes with a chance of 2^-32), its first record and the count of its records; records hold their offset in ids.

Shards are cut by range of key, at sums of bytes: tasks add up the bytes of each key, make runs of neighbouring keys of a
part of a shard each, and the driver (a few values a shard) joins runs to shards. So long documents with neighbouring keys
fill as many shards as they need; only a single document larger than a shard makes a larger one. A key that is too heavy
for a shard is dealt over several, row by row.

Defined results. Null or empty text: the end id alone. Null key: the smallest, found like any other. Repeated keys: all of their
records, in no given order. Empty table: no shards, empty result. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import join_small, materialise, small_batches

END_ID = 0
#: Bytes of text that a shard holds about.
SHARD_BYTES = 32 << 20
#: Bytes that a row's place in the footer takes about, besides its text.
ROW_BYTES = 32
_MARK = b"IDSHARD1"
_NULL = -(1 << 63)  # a null key's place; the key with this value itself shares it, and its records


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit mix of each key (multiply and shift, odd constants of the golden ratio and its kin)."""
    h = keys.astype(np.int64).view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(31))


class PerfectHash:
    """Slots 0..n-1 for n distinct keys, and fingerprints of theirs."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes  # words of all levels, bits of each level
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))])

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        words, sizes, left, level = [], [], keys, 0
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            at = (_mix(left, level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left, level = left[~alone[at]], level + 1
        return cls(np.concatenate(words) if words else np.zeros(0, "<u8"), np.array(sizes, np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for those that no level holds."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = self.starts[level] + (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            held = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[held]] = (self.rank[at >> 6] + below)[held]
            left = left[~held]
        return out

    @staticmethod
    def prints(keys: np.ndarray) -> np.ndarray:
        return (_mix(keys, 99) >> np.uint64(32)).astype("<u4")


def footer(part: int, keys: np.ndarray, lengths: np.ndarray) -> bytes:
    """Keys in ascending order, with repeats; lengths in ids, with the end id."""
    distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
    index = PerfectHash.build(distinct)
    slots = index.slots(distinct)
    prints, firsts, counts = (np.zeros(len(distinct), d) for d in ("<u4", "<u4", "<u4"))
    prints[slots], firsts[slots], counts[slots] = PerfectHash.prints(distinct), first, count
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    arrays = [index.sizes.astype("<i8"), index.bits.astype("<u8"), offsets, keys.astype("<i8"), prints, firsts, counts]
    head = struct.pack("<8q", part, *[len(a) for a in arrays])
    body = head + b"".join(a.tobytes() for a in arrays)
    return body + struct.pack("<q", len(body)) + _MARK


class Shard:
    """A shard read back: its ids and its index."""

    def __init__(self, content: bytes, width: int):
        self.width = width
        tail = len(content) - width  # the last end id
        if content[tail - 8:tail] != _MARK:
            raise ValueError("not a token shard")
        size = struct.unpack("<q", content[tail - 16:tail - 8])[0]
        body = memoryview(content)[tail - 16 - size:tail - 16]
        self.part, *counts = struct.unpack("<8q", body[:64])
        at, arrays = 64, []
        for kind, n in zip(("<i8", "<u8", "<i8", "<i8", "<u4", "<u4", "<u4"), counts, strict=True):
            arrays.append(np.frombuffer(body, kind, n, at))
            at += n * np.dtype(kind).itemsize
        sizes, bits, self.offsets, self.keys, self.fingerprints, self.firsts, self.counts = arrays
        self.index = PerfectHash(bits, sizes)
        self.content = content

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first record, records) of each key; no records for a key that the shard doesn't hold."""
        slots = self.index.slots(keys)
        known = slots >= 0
        known[known] = self.fingerprints[slots[known]] == PerfectHash.prints(keys[known])
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], count[known] = self.firsts[slots[known]], self.counts[slots[known]]
        return first, count

    def payload(self, record: int) -> bytes:
        """The raw ids of a record, with the end id."""
        a, b = self.offsets[record], self.offsets[record + 1]
        return bytes(memoryview(self.content)[a * self.width:b * self.width])

    def ids(self, record: int) -> np.ndarray:
        return np.frombuffer(self.payload(record), f"<u{self.width}")


def id_width(vocabulary: str) -> int:
    """2 bytes an id where every id of the vocabulary fits, else 4."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(vocabulary).get_vocab().values()) < 1 << 16 else 4


def _cuts(spark: SparkSession, rows: DataFrame, shard_bytes: int) -> list[tuple[int, int]]:
    """(lowest key, number of shards that its keys are dealt over), ascending; more than one shard for a single heavy key alone."""
    weight = F.octet_length("text").cast("long") + ROW_BYTES
    sizes = materialise(spark, rows.groupBy("key").agg(F.sum(weight).alias("bytes")), "shard-sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    step = max(1, shard_bytes // 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, held = None, 0
        for batch in batches:
            out = []
            for key, size in zip(batch.column("key").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
                if low is not None and held + size > step:
                    out.append((low, held))
                    low, held = None, 0
                low, held = key if low is None else low, held + size
            yield pa.RecordBatch.from_pydict({"low": pa.array([x[0] for x in out], pa.int64()),
                                              "bytes": pa.array([x[1] for x in out], pa.int64())})
        if low is not None:
            yield pa.RecordBatch.from_pydict({"low": pa.array([low], pa.int64()), "bytes": pa.array([held], pa.int64())})

    ranges = sizes.repartitionByRange(max(1, -(-total // shard_bytes)), "key").sortWithinPartitions("key")
    cuts, held = [], shard_bytes
    for low, size in sorted((r.low, r.bytes) for r in ranges.mapInArrow(run, "low long, bytes long").collect()):
        if held + size > shard_bytes:
            cuts.append((low, max(1, -(-size // shard_bytes))))
            held = 0
        held += size
    return cuts or [(_NULL, 1)]


def _placed(rows: DataFrame, cuts: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with their shard by key: a binary search among the cuts; rows of a heavy key go by a hash."""
    lows = F.lit([low for low, _ in cuts])
    parts = [n for _, n in cuts]
    firsts = F.lit(np.cumsum([0, *parts[:-1]]).tolist())
    steps = F.lit([1 << i for i in reversed(range(len(cuts).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(lows, at + step) <= F.col("key"), at + step).otherwise(at))
    found = rows.withColumn("at", at)
    if max(parts) == 1:
        return found.withColumn("shard", F.col("at").cast("int"))
    part = F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.get(F.lit(parts), F.col("at")))
    return found.withColumn("shard", (F.get(firsts, F.col("at")) + part).cast("int"))


def write_shards(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Write the shards of ``docs`` into the new folder ``path``, keys ascending over the files and inside each."""
    small_batches(spark)
    width = id_width(vocabulary)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL)).alias("key"), text.alias("text"))
    cuts = _cuts(spark, rows, shard_bytes)
    shards = sum(n for _, n in cuts)
    dealt = _placed(rows, cuts).repartitionById(shards, "shard").sortWithinPartitions("key")
    rows = dealt.select("key", F.col("text").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .tokens import coder

        own, keys, lengths = coder(vocabulary, f"<u{width}"), [], []
        for batch in batches:
            texts = batch.column("text")
            keys.append(batch.column("key").to_numpy())
            for at in range(0, len(texts), 512):
                found = own.ids(texts.slice(at, 512).to_pylist())
                lengths += [len(x) // width + 1 for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["line"])
        if lengths:
            end = footer(TaskContext.get().partitionId(), np.concatenate(keys), np.array(lengths, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary())], names=["line"])

    lines = rows.mapInArrow(run, "line binary").select(F.col("line").cast("string").alias("value"))
    lines.write.option("lineSep", "\0" * width).text(path)  # the separator is the end id


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where("length > 0")
            .select("path", "content"))


def read_shards(spark: SparkSession, path: str, vocabulary: str) -> DataFrame:
    """One row per record, found through the index: key, shard, local_start, n_tokens, ids_crc32 (of 32-bit ids)."""
    width = id_width(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                shard = Shard(content.as_py(), width)
                keys = np.unique(shard.keys)
                first, count = shard.find(keys)
                if (count == 0).any() or count.sum() != len(shard.keys):
                    raise ValueError(f"shard {shard.part}: its index misses keys")
                records = np.repeat(first, count) + np.concatenate([np.arange(c) for c in count])
                crc = [zlib.crc32(shard.ids(r).astype("<u4").tobytes()) for r in records]
                yield pa.RecordBatch.from_pydict({
                    "key": np.repeat(keys, count), "shard": np.full(len(records), shard.part, np.int64),
                    "local_start": shard.offsets[records], "n_tokens": shard.offsets[records + 1] - shard.offsets[records],
                    "ids_crc32": np.array(crc, np.int64)})

    return _files(spark, path).mapInArrow(run, "key long, shard long, local_start long, n_tokens long, ids_crc32 long")


def fetch(spark: SparkSession, path: str, vocabulary: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """The payloads of the wanted keys: key, n_tokens, ids (raw bytes). Each shard holding a wanted key's range is asked
    for its keys by its index; keys that no shard holds give no row."""
    width = id_width(vocabulary)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                shard = Shard(content.as_py(), width)
                yield pa.RecordBatch.from_pydict({"path": [name], "low": [int(shard.keys[0])], "high": [int(shard.keys[-1])]})

    directory = materialise(spark, _files(spark, path).mapInArrow(spans, "path string, low long, high long"), "shard-spans")
    listed = directory.orderBy("low", "high").collect()  # a few values a shard
    lows, highs = np.array([r.low for r in listed], np.int64), np.array([r.high for r in listed], np.int64)
    paths = [r.path for r in listed]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            a, b = np.searchsorted(highs, key, "left"), np.searchsorted(lows, key, "right")
            count = np.maximum(b - a, 0)
            at = np.repeat(a, count) + np.concatenate([np.arange(c) for c in count] or [np.zeros(0, int)]).astype(int)
            yield pa.RecordBatch.from_pydict({"path": pa.array([paths[i] for i in at], pa.string()), "key": np.repeat(key, count)})

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, wanted in zip(batch.column("content"), batch.column("keys"), strict=True):
                shard, own = Shard(content.as_py(), width), np.array(wanted.as_py(), np.int64)
                first, count = shard.find(own)
                for key, f, c in zip(own.tolist(), first.tolist(), count.tolist(), strict=True):
                    for record in range(f, f + c):
                        ids = shard.payload(record)
                        yield pa.RecordBatch.from_pydict({"key": pa.array([key], pa.int64()),
                                                          "n_tokens": pa.array([len(ids) // width], pa.int64()), "ids": [ids]})

    wanted = keys.select(F.coalesce(F.col(key_col).cast("long"), F.lit(_NULL)).alias("key")).distinct()
    grouped = materialise(spark, wanted.mapInArrow(place, "path string, key long").groupBy("path")
                          .agg(F.collect_list("key").alias("keys")), "shard-keys")  # at most a shard's keys in each
    asked = join_small(_files(spark, path), grouped, "path", "inner", entries=F.size("keys")).select("content", "keys")
    return (asked.mapInArrow(take, "key long, n_tokens long, ids binary")
            .withColumn("key", F.when(F.col("key") != _NULL, F.col("key"))))


def write_and_read(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id",
                   text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards, read them back: key, start (ids of all documents before), n_tokens, ids_crc32, shard."""
    write_shards(spark, docs, path, vocabulary, id_col, text_col, shard_bytes)
    records = materialise(spark, read_shards(spark, path, vocabulary), "shard-records")
    sizes = records.groupBy("shard").agg(F.sum("n_tokens").alias("size"))  # one row a shard
    before = F.coalesce(F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = materialise(spark, sizes.select("shard", before.alias("before")), "shard-starts")
    return (join_small(records, starts, "shard", "inner")
            .select(F.when(F.col("key") != _NULL, F.col("key")).alias("key"),
                    (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard"))
