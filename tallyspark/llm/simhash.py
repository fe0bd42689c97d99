"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components.

A fingerprint has a bit set if over half of the text's shingle hashes (XXH64, seed 42) have it set. Copies share a
fingerprint, so only distinct fingerprints go on. Their 64 bits are split into 6 blocks; two that differ in at most 3
bits differ in at most 3 blocks, so 3 blocks agree. Each fingerprint is keyed by each choice of 3 blocks (20 keys of 31 to
33 bits): chance meetings stay rare at billions of fingerprints, where keys of one block would meet by the square.

Fingerprints with a common key meet in a sorted partition, and each pair's distance is verified. A set of n that
share a key gives at most n - 1 links (each to the least of its component there), so a large group of near copies
makes no square of pairs. A key with more than ``HEAVY`` fingerprints is split before they meet, by further blocks of the bits
left, one of which agrees in a close pair; inside a task sets of more than ``DENSE`` are split in the same way. Links are joined into
components by label propagation.

Defined results. Null or empty text: fingerprint zero, linked like any other. Null id: no candidate for a component's
id (null if a component has no other). Repeated rows: one row each. Empty table: empty result. Other columns, whatever
their names, are ignored (or passed on by :func:`drop_near_copies`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, join_small, materialise, small_batches
from .components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
BLOCKS = 6
DENSE = 1024
#: Fingerprints with a common key beyond which they are keyed again, by a further block each, before they meet in a task.
HEAVY = 8192
_CHUNK = 1 << 17  # hashes counted at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one UTF-8 text. bytes.lower() and bytes.split() take A-Z and [\\x20\\x09-\\x0D] only."""
    from xxhash import xxh64_digest

    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    n = max(1, len(words) - shingle + 1)
    set_bits = np.zeros(64, np.int64)
    lasts = ends[shingle - 1:] or ends[-1:]
    for at in range(0, n, _CHUNK):
        spans = zip(starts[at:min(at + _CHUNK, n)], lasts[at:at + _CHUNK])
        digests = b"".join([xxh64_digest(plain[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
        set_bits += bits.sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: Column, *kept: Column, shingle: int = SHINGLE) -> DataFrame:
    """The ``kept`` columns and ``fp``, the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    rows = docs.select(*kept, F.coalesce(text, F.lit("")).cast("binary").alias("__text"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(names))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*names, "fp"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{fields}, fp long")


def block_masks(distance: int = DISTANCE, blocks: int = BLOCKS) -> list[int]:
    """The bits of every choice of blocks that may agree: ``blocks - distance`` of them."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(each, blocks - distance)]


def _labels_of(close: np.ndarray) -> np.ndarray:
    """The least index reachable by a matrix of links."""
    label = np.arange(len(close))
    while True:
        new = np.where(close, label[None, :], len(close)).min(1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _tree(links: np.ndarray) -> np.ndarray:
    """Links of each node to the least of its component, for an array of links."""
    nodes, ends = np.unique(links, return_inverse=True)
    ends = ends.reshape(links.shape)
    root = np.arange(len(nodes))
    while True:
        new = root.copy()
        np.minimum.at(new, ends[:, 0], root[ends[:, 1]])
        np.minimum.at(new, ends[:, 1], root[ends[:, 0]])
        new = np.minimum(new, new[new])
        if (new == root).all():
            away = root != np.arange(len(nodes))
            return np.stack([nodes[away], nodes[root[away]]], 1)
        root = new


def close_links(found: np.ndarray, free: list[int], distance: int = DISTANCE, dense: int = DENSE) -> np.ndarray:
    """Links (n, 2) that connect what closeness connects among distinct fingerprints that differ in the bits ``free``
    only. More than ``dense`` are split by distance + 1 blocks of those bits, one of which agrees in a close pair."""
    if len(found) <= dense or len(free) <= distance:
        close = np.bitwise_count(found[:, None] ^ found[None, :]) <= distance
        label = _labels_of(close)
        away = label != np.arange(len(found))
        return np.stack([found[away], found[label[away]]], 1)
    links = [np.zeros((0, 2), np.uint64)]
    for i in range(distance + 1):
        block = free[i::distance + 1]
        mask = np.uint64(sum(1 << b for b in block))
        key = found & mask
        order = np.argsort(key, kind="stable")
        edges = np.flatnonzero(np.diff(key[order])) + 1
        rest = [b for b in free if b not in block]
        for group in np.split(order, edges):
            if len(group) > 1:
                links.append(close_links(found[group], rest, distance, dense))
    return _tree(np.concatenate(links))


def _free_bits(mask: int) -> list[int]:
    return [b for b in range(64) if not mask >> b & 1]


def finer_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """The mask with each of distance + 1 blocks of its free bits: two fingerprints that agree in the mask and are close agree
    in one of these, too."""
    free = _free_bits(mask)
    return [mask | sum(1 << b for b in free[i::distance + 1]) for i in range(distance + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _run_links(key: np.ndarray, mask: np.ndarray, found: np.ndarray, distance: int) -> np.ndarray:
    """Links of all complete runs of equal (mask, key) in sorted arrays."""
    new = np.flatnonzero((key[1:] != key[:-1]) | (mask[1:] != mask[:-1])) + 1
    starts = np.concatenate([[0], new])
    sizes = np.diff(np.concatenate([starts, [len(key)]]))
    two = starts[sizes == 2]
    near = np.bitwise_count(found[two] ^ found[two + 1]) <= distance
    links = [np.stack([found[two + 1][near], found[two][near]], 1)]
    for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        free = _free_bits(int(mask[start]) & ((1 << 64) - 1))
        links.append(close_links(found[start:start + size], free, distance))
    return np.concatenate(links)


def keyed_blocks(spark: SparkSession, distinct: DataFrame, distance: int = DISTANCE, heavy: int = HEAVY) -> DataFrame:
    """(mask, key, fp): each fingerprint under its keys, such that every close pair shares one and no key has more than ``heavy`` of them.

    Keys are counted (combined before the shuffle); the members of heavy keys get finer keys instead, until none is heavy. Counts and
    members are written to the shared folder; heavy keys are at most one in ``heavy`` rows."""

    def under(masks: dict[int, list[int]], rows: DataFrame) -> DataFrame:
        """Rows under the masks that follow theirs."""
        table = F.create_map(*[x for m, finer in masks.items() for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(f)) for f in finer]))])
        each = rows.select("fp", F.explode(table[F.col("mask")]).alias("mask"))
        return each.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("key"), "fp")

    level = {0: block_masks(distance)}
    rows = under(level, distinct.select("fp", F.lit(0).cast("long").alias("mask")))
    parts = []
    while True:
        counts = materialise(spark, rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > heavy).select("mask", "key"), "simhash-heavy")
        if counts.isEmpty():
            return reduce(DataFrame.unionByName, [*parts, rows])
        told = join_small(rows, counts.withColumn("heavy", F.lit(True)), ["mask", "key"])
        parts.append(told.where("heavy IS NULL").select("mask", "key", "fp"))
        again = materialise(spark, told.where("heavy").select("mask", "fp").distinct(), "simhash-finer")
        masks = sorted({f for finer in level.values() for f in finer})
        level = {m: finer_masks(m, distance) for m in masks}
        rows = under(level, again).distinct()  # one pair of masks can lead to the same finer one


def near_links(distinct: DataFrame, distance: int = DISTANCE, heavy: int = HEAVY) -> DataFrame:
    """(a, b) links among the distinct fingerprints ``fp``: every pair within ``distance`` bits is connected by them."""
    keyed = keyed_blocks(distinct.sparkSession, distinct, distance, heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []  # the last run so far may go on in the next batch

        def out(key, mask, fp):
            links = _run_links(key, mask, fp.view(np.uint64), distance).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

        for batch in batches:
            if not len(batch):
                continue
            key, mask, fp = (batch.column(c).to_numpy() for c in ("key", "mask", "fp"))
            new = np.flatnonzero((key[1:] != key[:-1]) | (mask[1:] != mask[:-1])) + 1
            first, last = (int(new[0]), int(new[-1])) if len(new) else (len(key), len(key))
            same = held and held[0][0][0] == key[0] and held[0][1][0] == mask[0]
            if held and (not same or len(new)):
                held += [(key[:first], mask[:first], fp[:first])] if same else []
                yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, done = [], first if same else 0
            else:
                done = 0
            if len(new):
                if done < last:
                    yield out(key[done:last], mask[done:last], fp[done:last])
                held = [(key[last:], mask[last:], fp[last:])]
            else:
                held.append((key, mask, fp))
        if held:
            yield out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return (keyed.repartition(F.col("mask"), F.col("key")).sortWithinPartitions("mask", "key", "fp")
            .mapInArrow(run, "a long, b long").distinct())


def _classes(spark: SparkSession, found: DataFrame, distance: int) -> DataFrame:
    """(fp, root, component_id) of the distinct fingerprints of ``found`` (id, fp)."""
    distinct = materialise(spark, found.groupBy("fp").agg(F.min("id").alias("least")), "simhash-classes")
    roots = components(spark, near_links(distinct.select("fp"), distance)).select(F.col("node").alias("fp"), "root")
    least = roots.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("component"))
    members = roots.join(least, "root").select("fp", "root", "component")
    every = distinct.join(members, "fp", "left")
    return materialise(spark, every.select("fp", F.coalesce("root", "fp").alias("root"),
                                           F.coalesce("component", "least").alias("component_id")), "simhash-members")


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (16 hex digits), component_id (the smallest id reachable)."""
    found = materialise(spark, fingerprints(docs, F.col(text_col), F.col(id_col).alias("id"), shingle=shingle), "simhash")
    return found.join(_classes(spark, found, distance), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stay, with all of their columns: of each component, one row with its smallest id.

    Rows are told apart by two 64-bit hashes of id and text. Only the rows that go, and those that stand for several equal
    rows, are joined with the documents; the documents are moved only if these are very many."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    marks = [F.xxhash64(F.lit(i), F.coalesce(F.col(id_col).cast("string"), F.lit("")), text) for i in (1, 2)]
    found = materialise(spark, fingerprints(docs, F.col(text_col), F.col(id_col).alias("id"), marks[0].alias("m1"),
                                            marks[1].alias("m2"), shingle=shingle), "simhash")
    rows = materialise(spark, found.join(_classes(spark, found, distance), "fp")
                       .groupBy("root", "m1", "m2").agg(F.min("id").alias("id"), F.count("*").alias("n")), "simhash-rows")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "m1", "m2")).alias("first")
    groups = materialise(spark, rows.groupBy("root").agg(first, F.sum("n").alias("size")).where("size > 1"), "simhash-groups")
    stays = (F.col("m1") == F.col("first.m1")) & (F.col("m2") == F.col("first.m2"))
    told = materialise(spark, rows.join(groups, "root").withColumn("stays", stays).where("NOT stays OR n > 1")
                       .select("m1", "m2", "stays"), "simhash-told")
    m1, m2, stay = (free_name(docs, n) for n in ("m1", "m2", "stays"))
    marked = join_small(docs.withColumn(m1, marks[0]).withColumn(m2, marks[1]), told.toDF(m1, m2, stay), [m1, m2])
    once = marked.where(F.col(stay).isNull()).select(*docs.columns)
    return once.unionByName(marked.where(F.col(stay)).dropDuplicates([m1, m2]).select(*docs.columns))
