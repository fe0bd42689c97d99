"""T5/S7 for lexicons of any length: a rare-gram index, with phrases verified where the texts are read.

Each phrase is keyed by one of its runs of so many characters (the longest of ``RUNS`` that it holds), the one that occurs least often in
the texts, so that no key is met often however common the phrase's first letters are. Three steps:

1. The lexicon's grams are counted in all texts: numpy over batches inside the tasks, (gram, count) pairs summed by a shuffle.
2. A phrase with a gram that occurs nowhere can't occur and is left out; of the others each takes its rarest gram, of
   equally rare ones the last (beginnings are shared more often).
3. The index, in pieces of at most ``PIECE`` phrases, is broadcast; texts look their grams up (a table of bits lets few others through)
   and compare the phrases at the places that the grams' offsets give, by numpy, a character of all candidates at a time. The result is a column: texts meet no join and no exchange.

Equal results to testing every phrase in every text. Grams are told apart by 64-bit hashes; a clash costs a comparison only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_path

#: Lengths of the keys; texts are looked up once for each length that the lexicon needs.
RUNS = (6, 4, 3, 2, 1)
#: Phrases of a broadcast piece (about 200 bytes each); a longer lexicon takes several pieces, one after the other in each row.
PIECE = 250_000
#: Characters looked up at a time: their hashes fit a core's cache.
CHUNK = 1 << 16
HIT = "struct<ord:bigint,category:string,phrase:string,severity:string,alternative:string>"
_HIT_ARROW = pa.list_(pa.struct([("ord", pa.int64()), *[(n, pa.string()) for n in ("category", "phrase", "severity", "alternative")]]))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` characters; runs of different lengths get different hashes."""
    count = max(0, len(points) - n + 1)
    found = np.full(count, n, np.uint64)
    for i in range(n):
        found *= _ODD
        found += points[i:i + count]
    found *= _ODD  # the upper bits depend on all characters
    return found


def run_length(phrase: str) -> int:
    return next(n for n in RUNS if n <= len(phrase))


class Grams:
    """A sorted set of gram hashes: which runs of a text are in it, and which of them they are."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = min(22, max(10, int(len(keys)).bit_length() + 4))  # about one run in sixteen, or fewer, passes by chance
        self.shift = np.uint64(64 - bits)
        self.known = np.zeros(1 << bits, bool)
        self.known[keys >> self.shift] = True

    def found(self, points: np.ndarray, lengths: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(places, numbers of the keys that start there, length of these) for ``CHUNK`` characters at a time."""
        for n in lengths if len(self.keys) else ():
            for at in range(0, len(points), CHUNK):
                run = grams(points[at:at + CHUNK + n - 1], n)
                place = np.flatnonzero(self.known[run >> self.shift])
                run = run[place]
                number = np.minimum(np.searchsorted(self.keys, run), len(self.keys) - 1)
                same = self.keys[number] == run
                yield place[same] + at, number[same], n


def _parts(texts: list[str | None]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The texts joined in parts of about ``CHUNK`` characters: (part, first character of each text, number of each text)."""
    held, starts, numbers, size = [], [], [], 0
    for i, text in enumerate(texts):
        if text:
            held.append(text)
            starts.append(size)
            numbers.append(i)
            size += len(text)
        if size >= CHUNK:
            yield "".join(held), np.array([*starts, size]), np.array(numbers)
            held, starts, numbers, size = [], [], [], 0
    if held:
        yield "".join(held), np.array([*starts, size]), np.array(numbers)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """The numbers of the parts (none below 0), sorted, each once."""
    numbers = np.sort(np.concatenate(parts))
    return numbers[np.flatnonzero(np.diff(numbers, prepend=-1))]


class Piece:
    """Phrases by their rarest grams."""

    def __init__(self, entries: list[tuple]):
        entries = sorted(entries, key=lambda e: (e[3]["ord"], e[3]["category"] or "", e[3]["phrase"], e[3]["severity"] or "", e[3]["alternative"] or ""))
        self.hits = pa.array([e[3] for e in entries], _HIT_ARROW.value_type)  # (gram, its offset, lower-case phrase, hit), numbered in the order of the results
        self.phrases = [e[2] for e in entries]
        self.offsets = np.array([e[1] for e in entries], np.int64)
        self.sizes = np.array([len(p) for p in self.phrases], np.int64)
        self.points = np.concatenate([np.zeros(0, "<u4"), *map(code_points, self.phrases)])
        self.begins = np.cumsum(self.sizes) - self.sizes
        keys = np.array([e[0] for e in entries], np.int64).view(np.uint64)
        self.by_key = np.argsort(keys, kind="stable")
        distinct, self.first, self.many = np.unique(keys[self.by_key], return_index=True, return_counts=True)
        self.grams = Grams(distinct)
        self.lengths = sorted({run_length(p) for p in self.phrases})

    def find(self, texts: list[str | None]) -> pa.Array:
        """The phrases in each text, in the order of the results: an array of numbers of phrases."""
        pairs = [np.zeros(0, np.int64)]  # text * phrases + phrase
        for part, starts, numbers in _parts(texts):
            points = code_points(part)
            for place, number, _ in self.grams.found(points, self.lengths):
                pairs.append(self._verified(points, place, number, starts, numbers))
        text, phrase = np.divmod(_distinct(pairs), max(1, len(self.phrases)))
        ends = np.searchsorted(text, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(phrase, pa.int64()))

    def _verified(self, points, place, number, starts, numbers) -> np.ndarray:
        """Candidates whose whole phrase stands at its place, inside one text."""
        many = self.many[number]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        phrase = self.by_key[np.repeat(self.first[number], many) + nth]
        start = np.repeat(place, many) - self.offsets[phrase]
        owner = np.searchsorted(starts, np.repeat(place, many), "right") - 1
        inside = (start >= starts[owner]) & (start + self.sizes[phrase] <= starts[owner + 1])
        phrase, start, owner = phrase[inside], start[inside], owner[inside]
        right, at = [np.zeros(0, np.int64)], 0
        while len(phrase):  # one character of all candidates at a time; those that differ go
            same = points[start + at] == self.points[self.begins[phrase] + at]
            phrase, start, owner, at = phrase[same], start[same], owner[same], at + 1
            done = self.sizes[phrase] == at
            if done.any():
                right.append(numbers[owner[done]] * len(self.phrases) + phrase[done])
                phrase, start, owner = phrase[~done], start[~done], owner[~done]
        return _distinct(right)


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(no, gram, offset): each phrase's grams."""
    for batch in batches:
        no, gram, offset = [], [], []
        for i, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = grams(code_points(low), run_length(low)).view(np.int64)
            no += [i] * len(found)
            gram += found.tolist()
            offset += range(len(found))
        yield pa.RecordBatch.from_arrays([pa.array(no, pa.int64()), pa.array(gram, pa.int64()), pa.array(offset, pa.int32())],
                                         names=["no", "gram", "offset"])


def gram_counts(texts: DataFrame, low: str, wanted: np.ndarray, lengths: list[int]) -> DataFrame:
    """(gram, n): how often each of the ``wanted`` grams (sorted) occurs in all texts."""
    known = texts.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Grams(known.value)
        total = np.zeros(len(wanted.keys), np.int64)
        for batch in batches:
            for part, starts, _ in _parts(batch.column(0).to_pylist()):
                for place, number, n in wanted.found(code_points(part), lengths):
                    whole = place + n <= starts[np.searchsorted(starts, place, "right")]  # not over the end of a text
                    total += np.bincount(number[whole], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(wanted.keys[some].view(np.int64)), pa.array(total[some])], names=["gram", "n"])

    return texts.select(low).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def rare_gram_index(texts: DataFrame, low: str, lexicon: DataFrame) -> DataFrame:
    """(gram, offset, low, hit): the phrases of the lexicon (ord, category, phrase, severity, alternative) that may occur in the texts,
    each with its rarest gram and that gram's place in it; written to the shared folder."""
    spark = texts.sparkSession
    path = shared_path(spark, f"lexicon/{uuid.uuid4().hex}")
    named = lexicon.select(F.lower("phrase").alias("low"), F.struct(F.col("ord").cast("bigint").alias("ord"), "category", "phrase", "severity", "alternative")
                           .alias("hit")).filter(F.length("low") > 0).withColumn("no", F.monotonically_increasing_id())
    named.write.parquet(f"{path}/phrases")
    phrases = spark.read.schema(named.schema).parquet(f"{path}/phrases")
    phrases.select("no", "low").mapInArrow(_grams_of, "no long, gram long, offset int").write.parquet(f"{path}/grams")
    each = spark.read.schema("no long, gram long, offset int").parquet(f"{path}/grams")
    # distinct grams of a lexicon: bounded by the runs that its alphabet's words have, 8 bytes each
    wanted = np.sort(each.select("gram").distinct().toArrow()["gram"].to_numpy().view(np.uint64))
    run = F.coalesce(*[F.when(F.length("low") >= n, F.lit(n)) for n in RUNS])
    lengths = [r[0] for r in phrases.select(run).distinct().collect()]
    counts = gram_counts(texts, low, wanted, lengths)
    placed = each.join(counts, "gram", "left").groupBy("no").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.col("offset")).alias("back"), "gram")).alias("rare")).filter("rare.n > 0")
    index = placed.join(phrases, "no").select("rare.gram", (-F.col("rare.back")).alias("offset"), "low", "hit", "no")
    index.write.parquet(f"{path}/index")
    return spark.read.schema(index.schema).parquet(f"{path}/index")


def _finder(held):
    @F.arrow_udf(f"array<{HIT}>")
    def find(texts: pa.Array) -> pa.Array:
        numbers = held.value.find(texts.to_pylist())
        return pa.ListArray.from_arrays(numbers.offsets, held.value.hits.take(numbers.values))

    return find


def phrase_hits(texts: DataFrame, low: str, lexicon: DataFrame, piece: int = PIECE) -> Column:
    """The lexicon's phrases that occur in the text of column ``low`` (lower-cased): an array of hits in lexicon order."""
    spark = texts.sparkSession
    index = rare_gram_index(texts, low, lexicon)
    pieces = max(1, -(-index.count() // piece))
    columns = []
    for i in range(pieces):
        rows = index.filter(F.pmod(F.xxhash64("no"), F.lit(pieces)) == i).select("gram", "offset", "low", "hit").toArrow().to_pylist()
        if not rows:
            continue
        held = spark.sparkContext.broadcast(Piece([(r["gram"], r["offset"], r["low"], r["hit"]) for r in rows]))
        columns.append(_finder(held)(F.col(low)))
    if not columns:
        return F.array().cast(f"array<{HIT}>")
    return columns[0] if len(columns) == 1 else F.array_sort(F.concat(*columns))
