"""Packing documents into sequences by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut into pieces of at most ``SEQUENCE`` ids. Full pieces are sequences of their own. The
other pieces are dealt to groups of about ``GROUP`` pieces; each group is one differencing problem: partial partitions
into m windows are merged, those with the largest imbalance first, the fullest windows of one with the emptiest of the
other, until one partition is left. It starts with the fewest windows that could hold the group; whenever the fullest
window exceeds the capacity, the window count rises and the group is partitioned again.

Cuts are free, so one document in ``LADDER`` (chosen by a checksum of its ids) has its last piece cut into halves,
quarters, ... down to ``SMALLEST`` ids: these small pieces even out the windows, and padding falls from about 3 % to
less than 1 % of a group.

Every group has a bounded number of pieces, whatever the documents' ids or lengths. The pieces are written once
into the shared folder (tokenising is the costly part), so a lost executor costs only its groups.

Defined results. Null or empty text: the end id alone. Repeated rows or ids: packed one by one, each with its own pieces.
Null ids are carried along. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, small_batches

SEQUENCE = 2048
END_ID = 1
GROUP = 1300
LADDER = 4
SMALLEST = 8
_WINDOW_BITS = 20  # windows of a group


def difference(sizes: list[int], windows: int) -> list[tuple[int, list[int]]]:
    """Partition the items into windows: (sum, items) of each one used, the emptiest first."""
    heap = [(-size, i, [(size, [i])]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    tag = len(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(a) < len(b):
            a, b = b, a
        both = len(a) + len(b) - windows  # windows that get a part of either
        if both <= 0 and len(b) == 1:
            insort(a, b[0], key=_sum)
        elif both <= 0:
            a = sorted(a + b, key=_sum)
        else:
            down = b[::-1]
            alone = len(b) - both  # b's fullest meet empty windows of a
            a = sorted([(x[0] + y[0], x[1] + y[1]) for x, y in zip(a[:both], down[alone:], strict=True)]
                       + a[both:] + down[:alone], key=_sum)
        least = a[0][0] if len(a) == windows else 0
        tag += 1
        heapq.heappush(heap, (least - a[-1][0], tag, a))
    return heap[0][2] if heap else []


def _sum(window):
    return window[0]


def pack_group(sizes: list[int], capacity: int = SEQUENCE) -> list[list[int]]:
    """Windows (lists of items) of sums up to ``capacity``, near equal, as few as differencing finds."""
    total = sum(sizes)
    count = -(-total // capacity)
    while True:
        found = difference(sizes, count)
        if not found or found[-1][0] <= capacity:
            return [items for _, items in found]
        excess = found[-1][0] - total / count  # try the count whose mean leaves room for the same imbalance
        wanted = -(-total // max(capacity - excess, 1)) if excess < capacity / 2 else 0
        count = max(count + 1, min(int(wanted), count + max(1, count // 50)))


def cut(n: int, crc: int, capacity: int = SEQUENCE) -> list[int]:
    """Lengths of the pieces of a document of n ids."""
    full, rest = divmod(n, capacity)
    pieces = [capacity] * full
    if crc % LADDER == 0:
        while rest > SMALLEST:
            pieces.append((rest + 1) // 2)
            rest //= 2
    return pieces + [rest] * (rest > 0)


def tokenise_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                    end_id: int = END_ID, capacity: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens and, on request, ids (bytes)."""
    kind = docs.select(id_col).schema[0].dataType
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    ids_field = ", ids binary" if keep_ids else ""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import coder

        own = coder(vocabulary)
        for batch in batches:
            texts, keys = batch.column("text"), batch.column("doc_id")
            for at in range(0, len(texts), 512):
                out: list = [[] for _ in range(6)]
                for i, ids in enumerate(own.ids(texts.slice(at, 512).to_pylist()), at):
                    ids += end
                    n, start = len(ids) // 4, 0
                    for length in cut(n, zlib.crc32(ids), capacity):
                        piece = ids[4 * start:4 * (start + length)]
                        for column, v in zip(out, (i, start, length, zlib.crc32(piece), n, piece), strict=True):
                            column.append(v)
                        start += length
                arrays = [keys.take(pa.array(out[0], pa.int64())), *[pa.array(x, pa.int64()) for x in out[1:5]]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if keep_ids:
                    arrays.append(pa.array(out[5], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long{ids_field}")


def pack_documents(spark: SparkSession, docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = END_ID, capacity: int = SEQUENCE, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    small_batches(spark)
    pieces = materialise(spark, tokenise_pieces(docs, vocabulary, id_col, text_col, end_id, capacity, keep_ids), "pieces")
    groups = max(1, -(-pieces.count() // GROUP))
    kind = pieces.schema["doc_id"].dataType.simpleString()

    def run(key: tuple, group: pa.Table) -> pa.Table:
        number, lengths = key[0].as_py(), group["length"].to_pylist()
        open_ = [i for i, n in enumerate(lengths) if n < capacity]
        windows = [[i] for i, n in enumerate(lengths) if n == capacity]
        windows += [[open_[j] for j in w] for w in pack_group([lengths[i] for i in open_], capacity)]
        window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for w, items in enumerate(windows):
            at = 0
            for i in items:
                window[i], offset[i] = (number << _WINDOW_BITS) + w, at
                at += lengths[i]
        return group.drop_columns(["grp"]).append_column("sequence_id", pa.array(window)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    ids_field = ", ids binary" if keep_ids else ""
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long{ids_field}, "
              "sequence_id long, offset long")
    return dealt.groupBy("grp").applyInArrow(run, schema)
