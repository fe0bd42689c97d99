"""Facts of long texts, an Arrow batch at a time: letters by class, phrases that occur, figures after their labels.

The gates ask each text for thirty phrases and two letter counts. Here a batch's characters are classed by one table look-up in numpy, and
a text is decoded and lower-cased once for all its phrases. The rules stay Spark Columns over the facts.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from . import patterns as P


def _table(*classes: str) -> np.ndarray:
    """Bit i of a code point's entry: it is in ``classes[i]`` (all of the basic plane; the last entry is for what lies beyond)."""
    table = np.zeros(0x10000, np.uint8)
    for bit, chars in enumerate(classes):
        table[[ord(c) for c in chars]] |= 1 << bit
    return table


LETTERS = _table(P.MN_LETTER_CHARS, P.LATIN_CHARS)
SHARE = _table(P.MN_SHARE_CHARS)


#: Bytes of text classed at a time, few enough that the arrays stay in a core's cache.
CHUNK = 1 << 16


def class_counts(texts: pa.Array, table: np.ndarray, classes: int) -> list[np.ndarray]:
    """Characters of each class for each text (null: 0), counted over many texts' bytes at once."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return [np.zeros(0, np.int64)] * classes
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out = [np.zeros(len(texts), np.int64) for _ in range(classes)]
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        some = raw[offsets[first]:offsets[last]]
        points = np.frombuffer(some.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        kinds = table[np.minimum(points, 0xFFFF)]
        starts = _before((some & 0xC0) != 0x80)[offsets[first:last + 1] - offsets[first]]  # a character starts at every other byte
        for i, counts in enumerate(out):
            counts[first:last] = np.diff(_before((kinds >> i) & 1)[starts])
        first = last
    return out


def _before(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place, the end included."""
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])


def _struct(texts: pa.Array, columns: dict[str, np.ndarray]) -> pa.Array:
    """A row of facts a text, null for a null text."""
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns.values()], list(columns), mask=texts.is_null())


def _row(names, kind) -> StructType:
    row = StructType()
    for name in names:
        row.add(name, kind)
    return row


# types as objects: workers import this module too, and a type's text is read by the driver only
@F.arrow_udf(_row(("mn", "latin"), LongType()))
def _letters(texts: pa.Array) -> pa.Array:
    mn, latin = class_counts(texts, LETTERS, 2)
    return _struct(texts, {"mn": mn, "latin": latin})


@F.arrow_udf(LongType())
def _share_chars(texts: pa.Array) -> pa.Array:
    return pa.array(class_counts(texts, SHARE, 1)[0], pa.int64(), mask=np.asarray(texts.is_null()))


# Spark may work a deterministic Python function out again wherever its column is used; these are used by many rules.
letters = _letters.asNondeterministic()
share_chars = _share_chars.asNondeterministic()


def facts(text: Column, low: list[str], verbatim: list[str] = (), values: list[Column] = ()) -> Column:
    """``mn`` and ``latin`` letters of a text, and which phrases it holds: bit i of ``low`` for the i-th phrase in the lower-cased text, of
    ``verbatim`` for the i-th as written, of ``values`` for the i-th column's text (null: not held). Null for a null text."""
    low, verbatim = [p.lower() for p in low], list(verbatim)

    @F.arrow_udf(_row(("mn", "latin", "low", "verbatim", "values"), LongType()))
    def found(texts: pa.Array, *values: pa.Array) -> pa.Array:
        mn, latin = class_counts(texts, LETTERS, 2)
        lows, verbatims, held = (np.zeros(len(texts), np.int64) for _ in range(3))
        wanted = zip(*[v.to_pylist() for v in values]) if values else ((),) * len(texts)
        for row, (t, ws) in enumerate(zip(texts.to_pylist(), wanted)):
            if t is None:
                continue
            small = t.lower()
            lows[row] = sum(1 << i for i, p in enumerate(low) if p in small)
            verbatims[row] = sum(1 << i for i, p in enumerate(verbatim) if p in t)
            held[row] = sum(1 << i for i, w in enumerate(ws) if w is not None and w in t)
        return _struct(texts, {"mn": mn, "latin": latin, "low": lows, "verbatim": verbatims, "values": held})

    return found.asNondeterministic()(text, *values)


def bit(mask: Column, i: int) -> Column:
    return mask.bitwiseAND(F.lit(1 << i)) != 0


_WS = "[" + re.escape(P.WS_CHARS) + "]"


def figures(text: Column, labelled: list[tuple[str, str, str]]) -> Column:
    """For each (key, label, unit) the digits of the first ``label <digits> unit`` in the lower-cased text, as written; null when absent."""
    keys = [k for k, _, _ in labelled]
    patterns = [re.compile(f"{re.escape(label.lower())}{_WS}+(\\d+){_WS}+{re.escape(unit.lower())}") for _, label, unit in labelled]

    @F.arrow_udf(_row(keys, StringType()))
    def read(texts: pa.Array) -> pa.Array:
        columns = [[] for _ in patterns]
        for t in texts.to_pylist():
            small = (t or "").lower()
            for column, pattern in zip(columns, patterns):
                m = pattern.search(small)
                column.append(m.group(1) if m else None)
        return pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], keys)

    return read.asNondeterministic()(text)
