"""Token ids of whole texts by the ``tokenizers`` library, with a memo of its results by unit of text.

The library takes about a second per MB. Both vocabularies split a text into pre-tokens before merging, and merges stay
inside a pre-token; so where a text is cut between pre-tokens, its ids are those of the parts. :class:`Coder` cuts texts
at blanks and line ends and between a letter and a mark (so a word is one part whatever follows it), looks each part up in a
memo of at most ``MEMO`` parts and has the library encode the parts that are new, many in one call. Texts with white space that the cuts don't cover (runs of blanks, tabs and such)
are encoded whole by the library, and so are texts that contain an added token's name (``<|endoftext|>``), which the
library gives one id. ``tests/llm`` compares the results with the library's on awkward texts.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that a worker remembers (about 200 bytes each), in two halves: when the newer is full it becomes the older, whose
#: parts come back as they are met.
MEMO = 600_000
_CODERS: dict = {}

_MARKS = b".,!?;:%$#&*|"  # a run of these after a letter begins a pre-token of its own
_GLUE = b"\xff"  # begins a part that was cut off a letter: no byte of UTF-8
_KINDS = np.zeros(256, np.uint8)  # bits: a mark, an ASCII letter, the last byte of a Latin-1 letter of two bytes
_KINDS[list(_MARKS)] = 1
_KINDS[[*range(65, 91), *range(97, 123)]] = 2
_KINDS[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = 4  # without the signs of multiplication and division


#: Bytes of text that are cut and looked up together.
PIECE = 2 << 20


def _spread(texts: list[bytes], line: bool) -> pa.Array:
    """The texts with a blank and ``_GLUE`` before each mark that stands after a letter of Latin-1, and a blank before each line end (without
    ``line``: in its place)."""
    joined = b"".join(texts)
    old = np.frombuffer(joined, np.uint8)
    if len(old) and old.max() == _GLUE[0]:
        joined.decode()  # not UTF-8: an error
    kinds = _KINDS[old]
    letter = kinds[:-1] == 2
    letter[1:] |= (kinds[1:-1] == 4) & (old[:-2] == 0xC3)
    marks = np.flatnonzero((kinds[1:] == 1) & letter) + 1
    ends = np.flatnonzero(old == 10)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    marks = marks[~np.isin(marks, bounds)]  # a text's first byte follows no letter of its own
    if not line:
        old = old.copy()
        old[ends] = 32
    places = np.concatenate([marks, marks, ends] if line else [marks, marks])
    signs = np.repeat(np.array([32, _GLUE[0], 32], np.uint8), [len(marks), len(marks), len(places) - 2 * len(marks)])
    new = np.insert(old, places, signs)
    bounds = bounds + 2 * np.searchsorted(marks, bounds) + (np.searchsorted(ends, bounds) if line else 0)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(new)])


def _by_size(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Consecutive texts in groups of about ``PIECE`` bytes."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def coder(path: str, kind: str = "<u4") -> "Coder":
    """The worker's coder for this vocabulary file: it stays between tasks."""
    if (path, kind) not in _CODERS:
        _CODERS[path, kind] = Coder(path, kind=kind)
    return _CODERS[path, kind]


class Coder:
    """``ids(texts)``: the ids of UTF-8 texts, as by ``encode(text, add_special_tokens=False)``, as little-endian unsigned integers
    of 32 bits, or of 16 (``kind``) for a vocabulary that fits."""

    def __init__(self, path: str, memo: int = MEMO, kind: str = "<u4"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.lib.get_added_tokens_decoder().values()]
        vocab = self.lib.get_vocab()
        self.width = max(vocab.values()) + 1
        self.kind = np.dtype(kind)
        if self.width > 1 << 8 * self.kind.itemsize:
            raise ValueError("the vocabulary's ids don't fit")
        self.word_ends = self.lib.normalizer is not None  # lower case and word ends, else bytes with their blanks
        mark = (lambda t: t.endswith("</w>")) if self.word_ends else (lambda t: t.startswith("Ġ"))
        self.edge = np.zeros(self.width, bool)  # ids that end a word, or begin one with its blank
        self.edge[[i for t, i in vocab.items() if mark(t)]] = True
        self.line = np.zeros(self.width, bool)  # the line end's id
        if not self.word_ends:
            self.line[vocab["Ċ"]] = True
        self.size, self.memo, self.older, self.first = memo, {b"": b"" if self.word_ends else None}, {}, {b"": b""}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        for part in _by_size(texts):
            out += self._word_ids(part) if self.word_ends else self._byte_ids(part)
        return out

    def _names(self, text: bytes) -> bool:
        """Whether an added token's name stands in the text: inside words too, across any cut."""
        return any(name in text for name in self.added)

    # --- words: white space is dropped, so each cut at a blank or line end is safe ---------------------------------

    def _word_ids(self, texts):
        lows = [t.lower() for t in texts]  # bytes.lower() takes A-Z only
        whole = {i: self.whole([texts[i].decode()])[0] for i, t in enumerate(lows) if self._names(t)}
        plain = [i for i in range(len(texts)) if i not in whole]
        found, _, _ = self._parts_ids([lows[i] for i in plain], False)
        whole.update(zip(plain, found, strict=True))
        return [whole[i] for i in range(len(texts))]

    # --- bytes: a blank belongs to the word after it; runs of white space are left to the library --------------------

    def _byte_ids(self, texts):
        out: list = [None] * len(texts)
        odd, plain = [], []
        for i, t in enumerate(texts):
            rough = b"  " in t or b" \n" in t or b"\n\n\n" in t or b"\n\n " in t or t.endswith((b"\n\n", b" "))
            (odd if rough or self._names(t) else plain).append(i)
        found, firsts, sure = self._parts_ids([texts[i] for i in plain], True)
        for i, ids, part, safe in zip(plain, found, firsts, sure, strict=True):
            first = self._first(part) if safe else None
            if first is None:  # a part that isn't safe on its own
                odd.append(i)
            else:
                out[i] = first + ids
        for i in odd:
            out[i] = self.whole([texts[i].decode()])[0]
        return out

    def _parts_ids(self, texts: list[bytes], skip_first: bool) -> tuple[list[bytes], list[bytes], list[bool]]:
        """Per text: the ids of its parts one after the other, its first part (left out of the ids with ``skip_first``), and whether the
        other parts are all safe on their own. Cutting, telling equal parts and putting ids together are Arrow's and numpy's; Python
        sees each distinct part once."""
        if not texts:
            return [], [], []
        lists = pc.split_pattern(_spread(texts, not self.word_ends), b" ")
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        which, parts = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        firsts = [parts[i] for i in which[bounds[:-1]]]
        use = np.ones(len(which), bool)
        if skip_first:
            use[bounds[:-1]] = False
        wanted = np.zeros(len(parts), bool)
        wanted[which[use]] = True
        self._learn({p for p, w in zip(parts, wanted.tolist(), strict=True) if w})
        known = [self.memo[p] if w else b"" for p, w in zip(parts, wanted.tolist(), strict=True)]
        unsafe = np.array([k is None for k in known], bool)
        sizes = np.array([0 if k is None else len(k) for k in known], np.int64) // self.kind.itemsize
        flat = np.frombuffer(b"".join(k or b"" for k in known), self.kind)
        starts = np.cumsum(sizes) - sizes
        counts = np.where(use, sizes[which], 0)
        ends = np.concatenate([[0], np.cumsum(counts)])
        # a part's ids lie together in ``flat``: the places of all ids in order
        ids = flat[np.arange(ends[-1]) + np.repeat(starts[which] - ends[:-1], counts)].tobytes()
        cuts = (ends[bounds] * self.kind.itemsize).tolist()
        bad = np.concatenate([[0], np.cumsum(unsafe[which] & use)])[bounds]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], firsts, (np.diff(bad) == 0).tolist()

    def _first(self, part: bytes) -> bytes | None:
        """Ids of a part without a blank before it; None if the part must not be cut off."""
        if part not in self.first:
            if len(self.first) > self.size // 4:
                self.first = {b"": b""}
            self.first[part] = self.whole([part.decode()])[0] if _sure(part) else None
        return self.first[part]

    # --- new parts ---------------------------------------------------------------------------------------------------

    def _learn(self, parts: set) -> None:
        new = parts.difference(self.memo)
        if not new:
            return
        if len(self.memo) + len(new) > self.size // 2:  # only parts that are new take room
            self.older, self.memo = self.memo, {b"": b""}
            if not self.word_ends:
                self.memo[b""] = None  # an empty part is a run of blanks
            new = parts.difference(self.memo)
        back = new & self.older.keys()
        self.memo.update(zip(back, map(self.older.__getitem__, back), strict=True))
        new -= back
        words, lines, rest = [], [], []
        simple = [p for p in new if p.isalpha()]  # ASCII letters, the most common case
        self._learn_simple(simple)
        for p in new.difference(simple):
            glued = p[:1] == _GLUE
            line = not self.word_ends and p[:1] == b"\n"
            word = p[1:] if line or glued else p
            if not glued and _letters(word):
                (lines if line else words).append(p)
            elif self.word_ends or _sure(word) or p == b"\n":
                rest.append((p, (word if glued else p if line or self.word_ends else b" " + p).decode()))
            else:
                self.memo[p] = None
        self._learn_words(words, "" if self.word_ends else " ", self.edge)
        self._learn_words(lines, "", self.line)
        for at in range(0, len(rest), 10_000):
            chunk, texts = zip(*rest[at:at + 10_000], strict=True)
            self.memo.update(zip(chunk, self.whole(list(texts)), strict=True))

    def _learn_simple(self, words: list[bytes]) -> None:
        """Words of ASCII letters: no normalisation changes them and each is one pre-token, so the library's model takes them as they are."""
        model, kind, first = self.lib.model.tokenize, self.kind.char, "" if self.word_ends else "Ġ"
        for w in words:
            self.memo[w] = array(kind, [t.id for t in model(first + w.decode())]).tobytes()

    def _learn_words(self, words: list[bytes], blank: str, edge: np.ndarray) -> None:
        """Words of letters alone, with a blank or line end before each: encoded in one text, whose ids show where
        each begins (or, with word ends, ends)."""
        for at in range(0, len(words), 10_000):
            chunk = words[at:at + 10_000]
            texts = [blank + w.decode() for w in chunk]
            packed = self.whole([(" " if self.word_ends else "").join(texts)])[0]
            size = self.kind.itemsize
            found = np.flatnonzero(edge[np.frombuffer(packed, self.kind)])
            cuts = size * np.append(0, found + 1) if self.word_ends else size * np.append(found, len(packed) // size)
            if len(cuts) != len(chunk) + 1 or cuts[0] != 0 or cuts[-1] != len(packed):
                self.memo.update(zip(chunk, self.whole(texts), strict=True))
                continue
            cuts = cuts.tolist()
            self.memo.update(zip(chunk, [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))


def _letters(part: bytes) -> bool:
    """Letters of Latin-1 alone: one pre-token in either vocabulary, and no case mapping that adds characters."""
    if part.isalpha() or part.isascii():
        return part.isalpha()
    text = part.decode()
    return text.isalpha() and max(text) < "Ā"


def _sure(part: bytes) -> bool:
    """Begins and ends with characters that are no white space under any definition."""
    text = part.decode()
    return bool(text) and all("!" <= c <= "~" or c.isalnum() for c in (text[0], text[-1]))
