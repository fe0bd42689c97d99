"""Exchange of the whole vocabulary between the classes of :mod:`class_lm`, in Spark, until it settles.

1. The training texts are cut once and kept as numbers (:func:`encode`): the ids of a :class:`class_lm.Stream`, and the words outside
   the head beside them.
2. Each word outside the head gets a number and, in one row, all its neighbours (:func:`word_rows`): words of the head, the end, and other
   words outside the head, by a join on the word. Nothing is merged or shared out.
3. Rounds (:func:`settle`): every word, frequent or rare, moves to the class that fits its neighbours' classes best; a word of the head
   by the exact change of the mutual information, any other, whose tokens are too few to move a class, by what its tokens gain
   (:func:`class_lm.gains`). The pairs of classes of moved words are then counted anew. Words move together, so a round can lose
   information: it is taken back then, and half as many words, by their numbers' hash, move at once from there on.
4. The end: a round adds less than ``SETTLED`` of the information (carried over from the words whose turn it was to all), or still
   loses when one in ``PARTS`` words moves at once.

The classes of all words are held as one byte a word (two past 256 classes) by the driver and the tasks; words, their neighbours and the
texts stay in Spark. Repeated texts count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from copy import copy

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .class_lm import Stream, _pieces, _xlogx, gains
from .common import materialise

#: Share of the mutual information that a round must add, carried over to all words, or the classes have settled.
SETTLED = 1e-3
#: Words are told apart for moves in so many parts at most.
PARTS = 64
#: Numbers of a row of encoded texts.
SLICE = 1 << 18
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROWS = 4_096  # words whose neighbours are counted by class at once
_BLOCK = 64  # words of the head whose exact gains are worked out at once


def encode(train: DataFrame, head: list[bytes]) -> DataFrame:
    """(ids, rare): the numbers of a piece's words with one more before and one after, and the words outside the head among all but the
    first. A number is its word's place in ``head``, len(head) for any other word and len(head) + 1 for the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(head, pa.binary())
        for piece in _pieces(batches):
            stream = Stream(piece.column("text"), names)
            ids = np.append(stream.ids, len(head) + 1).astype(np.int32)
            rare = np.flatnonzero(ids == len(head))
            words = stream.flat.take(pa.array(np.flatnonzero(stream.ids[stream.at] == len(head))))
            for lo in range(1, len(stream.ids), SLICE):
                hi = min(lo + SLICE, len(stream.ids))
                a, b = np.searchsorted(rare, [lo, hi + 1]).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([ids[lo - 1:hi + 1].tobytes()], pa.binary()),
                                                  pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), words.slice(a, b - a))],
                                                 names=["ids", "rare"])

    return train.mapInArrow(run, "ids binary, rare array<binary>")


def _numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    for batch in batches:
        rare = batch.column("rare") if "rare" in batch.schema.names else None
        for i in range(batch.num_rows):
            yield np.frombuffer(batch.column("ids")[i].as_buffer(), np.int32), None if rare is None else rare[i].values


def tally(sources: list[tuple[DataFrame, Callable]], width: int) -> np.ndarray:
    """Sums by code, below ``width`` (a fixed bound), of the (codes, 1 or -1) that each source's function finds in the batches of its tasks. A core
    takes one task of each source, however many files there are: its sums are what is exchanged."""

    def counting(codes: Callable):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width, np.int32)
            for found, sign in codes(batches):
                np.add.at(total, found, sign)
            at = np.flatnonzero(total)
            for lo in range(0, len(at), 50_000):
                part = at[lo:lo + 50_000]
                yield pa.RecordBatch.from_pydict({"code": part.astype(np.int32), "n": total[part].astype(np.int64)})
        return run

    spark = sources[0][0].sparkSession
    each, kept = None, spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # a round's sums are on the disk no longer than it takes to add them up
    for df, codes in sources:
        one = df.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(counting(codes), "code int, n long")
        each = one if each is None else each.unionByName(one)
    sums = each.groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    spark.conf.set(_CLEANUP, kept) if kept is not None else spark.conf.unset(_CLEANUP)
    total = np.zeros(width, np.int64)
    total[sums["code"].to_numpy()] = sums["n"].to_numpy()
    return total


def tally_ids(encoded: DataFrame, code: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """:func:`tally` of ``code(ids)`` over the rows of encoded texts."""
    return tally([(encoded.select("ids"), lambda batches: ((code(ids), 1) for ids, _ in _numbers(batches)))], width)


def pair_codes(state: np.ndarray, wide: int) -> Callable[[np.ndarray], np.ndarray]:
    """Code of each pair of neighbours in a row of encoded texts, ``state`` by number."""

    def code(ids: np.ndarray) -> np.ndarray:
        by = state[ids]
        return by[:-2] * wide + by[1:-1]

    return code


def _lists(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column without nulls, row after row, and how many each row has."""
    size = np.dtype(kind).itemsize
    bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // size
    data = column.buffers()[2]
    flat = np.frombuffer(data, kind, len(data) // size) if data is not None and len(data) else np.zeros(0, kind)
    return flat[bounds[0]:bounds[-1]], np.diff(bounds)


def _binary_lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """A binary column of ``n`` rows: the ``values`` of each row."""
    order = np.argsort(rows, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]) * values.itemsize
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(values[order].tobytes())])


def word_rows(spark: SparkSession, encoded: DataFrame, h: int) -> tuple[DataFrame, int, type]:
    """(id, word, c, near) of each word outside the head, how many there are, and the type of numbers in ``near``. Ids go on from ``h`` + 2;
    ``near``: 2 x the neighbour's id, and 1 more for one that follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, rare in _numbers(batches):
            at = np.flatnonzero(ids[1:-1] == h) + 1
            if len(at):
                after = np.arange(1, len(at) + 1)
                met = rare.take(pa.array(after, mask=ids[at + 1] != h))
                yield pa.RecordBatch.from_arrays([rare.slice(0, len(at)), pa.array(ids[at - 1].astype(np.int64) * (h + 2) + ids[at + 1]), met],
                                                 names=["word", "code", "after"])

    met = encoded.mapInArrow(run, "word binary, code long, after binary").repartition("word")
    seen = met.groupBy("word").agg(F.collect_list(F.struct("code", "after")).alias("seen"))
    seen = materialise(spark, seen.select(F.monotonically_increasing_id().alias("at"), "word", "seen"), "lm-contexts")
    part = F.shiftright("at", 33)
    sizes = {r.p: r.n for r in seen.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a task
    first = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])])
    types = int(first[-1])
    kind = np.int32 if 2 * (h + 2 + types) < 1 << 31 else np.int64
    number: Column = F.get(F.lit(first + h + 2), part.cast("int")) + F.col("at").bitwiseAND((1 << 33) - 1)
    numbered = seen.select(number.alias("id"), "word", "seen")
    pairs = (numbered.select(F.col("id").alias("a"), F.explode(F.filter("seen.after", lambda w: w.isNotNull())).alias("word"))
             .join(numbered.select(F.col("id").alias("b"), "word"), "word"))
    both = F.array(F.struct(F.col("a").alias("id"), (2 * F.col("b") + 1).alias("near")), F.struct(F.col("b").alias("id"), (2 * F.col("a")).alias("near")))
    beside = pairs.select(F.inline(both)).repartition("id").groupBy("id").agg(F.collect_list("near").alias("beside"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(lo, _ROWS)
                n, code = rows.num_rows, rows.column("code").flatten().to_numpy()
                count, others = rows.column("code").value_lengths().to_numpy(), rows.column("beside")
                more = pc.fill_null(others.value_lengths(), 0).to_numpy()
                row, before, after = np.repeat(np.arange(n), count), code // (h + 2), code % (h + 2)
                a, b = before != h, after != h
                near = np.concatenate([2 * before[a], 2 * after[b] + 1, others.flatten().to_numpy()]).astype(kind)
                row = np.concatenate([row[a], row[b], np.repeat(np.arange(n), more)])
                yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("word"), pa.array(count.astype(np.int64)), _binary_lists(row, near, n)],
                                                 names=["id", "word", "c", "near"])

    joined = numbered.select("id", "word", F.col("seen.code").alias("code")).join(beside, "id", "left").select("id", "word", "code", "beside")
    return materialise(spark, joined.mapInArrow(gather, "id long, word binary, c long, near binary"), "lm-neighbours"), types, kind


class Counts:
    """What a round knows of all pairs of neighbours, given the class of each word: ``table`` by both classes, ``near`` by word of the head (or
    end), side and the neighbour's class, ``twice``: how often a word of the head follows itself."""

    def __init__(self, encoded: DataFrame, rows: DataFrame, h: int, k: int, kind: type):
        self.encoded, self.rows, self.h, self.k, self.kind = encoded.select("ids"), rows.select("id", "near"), h, k, kind
        self.twice = tally_ids(encoded, lambda ids: ids[1:-1][(ids[:-2] == ids[1:-1]) & (ids[1:-1] < h)], h + 2)
        self.wide = (h + 2) * 2 * k

    def of(self, total: np.ndarray) -> Counts:
        new = copy(self)
        new.total = total
        new.near = total[:self.wide].reshape(self.h + 2, 2, self.k)
        new.table = t = total[self.wide:].reshape(self.k, self.k).astype(float)
        new.information = _xlogx(t).sum() - _xlogx(t.sum(0)).sum() - _xlogx(t.sum(1)).sum() + _xlogx(t.sum())
        return new

    def all_pairs(self, label: np.ndarray) -> Counts:
        return self.of(self._sums([(label, 1)], None))

    def moved(self, old: np.ndarray, new: np.ndarray) -> Counts:
        """After moves: only pairs with a word that moved are counted anew."""
        return self.of(self.total + self._sums([(old, -1), (new, 1)], old != new))

    def _sums(self, labels: list[tuple[np.ndarray, int]], changed: np.ndarray | None) -> np.ndarray:
        h, k, wide, kind = self.h, self.k, self.wide, self.kind

        def texts(batches):
            for ids, _ in _numbers(batches):
                a, b = ids[:-2], ids[1:-1]
                some = (a != h) & (b != h)
                if changed is not None:
                    at = changed[ids]
                    some &= at[:-2] | at[1:-1]
                a, b = a[some], b[some]
                for label, sign in labels:
                    x, y = label[a].astype(np.int32), label[b].astype(np.int32)
                    yield wide + x * k + y, sign
                    to, of = (slice(None),) * 2 if changed is None else (changed[b], changed[a])
                    yield ((2 * a + 1) * k + y)[to], sign
                    yield (2 * b * k + x)[of], sign

        def words(batches):
            for batch in batches:
                near, count = _lists(batch.column("near"), kind)
                mine = np.repeat(batch.column("id").to_numpy(), count)
                if changed is not None:
                    some = changed[mine] | changed[near >> 1]
                    near, mine = near[some], mine[some]
                other, follows = near >> 1, (near & 1).astype(bool)
                head = other < h + 2
                before = head & ~follows
                near_head = head if changed is None else head & changed[mine]
                for label, sign in labels:
                    x, y = label[mine].astype(np.int32), label[other].astype(np.int32)
                    yield (2 * other[near_head] + ~follows[near_head]) * k + x[near_head], sign
                    yield wide + x[follows] * k + y[follows], sign
                    yield wide + y[before] * k + x[before], sign

        return tally([(self.encoded, texts), (self.rows, words)], wide + k * k)


def exact_gains(table: np.ndarray, out: np.ndarray, into: np.ndarray, twice: np.ndarray, own: np.ndarray) -> np.ndarray:
    """What each word (a row of ``out`` and ``into``, by class of the next and the previous word) adds in every class, the rest as it stands:
    :func:`class_lm.exchange` for many words at a time."""
    r = np.arange(len(own))
    out, into, same = out.copy(), into.copy(), twice[:, None]
    out[r, own] -= twice
    into[r, own] -= twice
    t = np.repeat(table[None], len(own), 0)
    t[r, own] -= out
    t[r, :, own] -= into
    t[r, own, own] -= twice
    logs = np.repeat(_xlogx(table)[None], len(own), 0)
    logs[r, own], logs[r, :, own] = _xlogx(t[r, own]), _xlogx(t[r, :, own])
    gain = _xlogx(t + out[:, None, :]).sum(2) - logs.sum(2) + _xlogx(t + into[:, :, None]).sum(1) - logs.sum(1)
    d = t[:, np.arange(len(table)), np.arange(len(table))]
    gain += _xlogx(d + out + into + same) - _xlogx(d + out) - _xlogx(d + into) + _xlogx(d)
    left, right = t.sum(2), t.sum(1)
    gain -= _xlogx(left + out.sum(1)[:, None] + into + same) - _xlogx(left + into)
    gain -= _xlogx(right + into.sum(1)[:, None] + out + same) - _xlogx(right + out)
    return gain


def _turn(ids: np.ndarray, parts: int, turn: int) -> np.ndarray:
    """Whether it is each word's turn, by a hash of its number and the turn's: once in ``parts`` turns or so."""
    mixed = (ids.astype(np.uint64) + np.uint64(1) << np.uint64(20) ^ np.uint64(turn)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(40)) % np.uint64(parts) == 0


def _better(fit: np.ndarray, own: np.ndarray, classes: int) -> np.ndarray:
    """Each word's best class; its own one where that is as good. Ties to the first class."""
    best, r = fit[:, :classes].argmax(1), np.arange(len(own))
    return np.where((own < classes) & (fit[r, best] <= fit[r, own] + 1e-9), own, best)


def move_head(found: Counts, label: np.ndarray, h: int, classes: int, parts: int, turn: int) -> np.ndarray:
    """The words of the head that move, and their new classes as a second row."""
    word = np.arange(h)[_turn(np.arange(h), parts, turn)]
    best = np.zeros(len(word), np.int64)
    for lo in range(0, len(word), _BLOCK):
        w = word[lo:lo + _BLOCK]
        own = label[w].astype(np.int64)
        best[lo:lo + _BLOCK] = _better(exact_gains(found.table, found.near[w, 1].astype(float), found.near[w, 0].astype(float), found.twice[w], own), own, classes)
    moved = best != label[word]
    return np.stack([word[moved], best[moved]])


def move_rest(rows: DataFrame, found: Counts, label: np.ndarray, classes: int, parts: int, turn: int, kind: type) -> np.ndarray:
    """The same for the words outside the head, where they are."""
    k = len(found.table)
    fits = np.concatenate(gains(found.table, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, _ROWS):
                part = batch.slice(lo, _ROWS)
                ids = part.column("id").to_numpy()
                near, count = _lists(part.column("near"), kind)
                at = np.repeat(np.arange(len(ids)) * 2 * k, count) + (near & 1) * k + label[near >> 1]
                fit = np.bincount(at, minlength=len(ids) * 2 * k).reshape(len(ids), 2 * k) @ fits
                own = label[ids].astype(np.int64)
                best = _better(np.concatenate([fit, np.zeros((len(ids), k - classes))], 1), own, classes)
                moved = (best != own) & _turn(ids, parts, turn)
                yield pa.RecordBatch.from_pydict({"id": ids[moved], "label": best[moved].astype(np.int16)})

    got = rows.select("id", "near").mapInArrow(run, "id long, label short").toArrow()
    return np.stack([got["id"].to_numpy(), got["label"].to_numpy()]).astype(np.int64)


def settle(encoded: DataFrame, rows: DataFrame, types: int, kind: type, label: np.ndarray, classes: int) -> tuple[np.ndarray, Counts]:
    """The class of every word by its id (the head's are given to begin with), and the counts for them."""
    h, k = len(label), classes + 2
    label = np.concatenate([label, [classes, classes + 1], np.full(types, classes)]).astype(np.uint8 if k <= 256 else np.uint16)
    found = Counts(encoded, rows, h, k, kind).all_pairs(label)

    def moved(words: np.ndarray) -> np.ndarray:
        new = label.copy()
        new[words[0]] = words[1]
        return new

    if types:  # no word outside the head has a class yet
        label = moved(move_rest(rows, found, label, classes, 1, 0, kind))
        found = found.all_pairs(label)
    parts, turn = 1, 0
    while True:
        words = np.concatenate([move_head(found, label, h, classes, parts, turn), move_rest(rows, found, label, classes, parts, turn, kind)], 1)
        rise = 0.0
        if words.shape[1]:
            new = moved(words)
            then = found.moved(label, new)
            rise = then.information - found.information
            if rise > 0:
                label, found = new, then
        turn += 1
        if rise < 0 and parts < PARTS:
            parts *= 2
        elif rise * parts <= SETTLED * found.information:
            return label, found


def with_labels(rows: DataFrame, label: np.ndarray) -> DataFrame:
    """(word, label, c) of the words outside the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(label[batch.column("id").to_numpy()].astype(np.int32)), batch.column("c")],
                                             names=["word", "label", "c"])

    return rows.select("id", "word", "c").mapInArrow(run, "word binary, label int, c long")
