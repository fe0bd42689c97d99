import random
import zlib

import numpy as np
import pytest

from tallyspark.llm import packing, token_shards as TS
from tallyspark.llm.common import fresh_path
from tallyspark.llm.queries import vocabulary
from tallyspark.llm.tokens import Coder

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
PARTS = ["a", "B", "don't", "x.", "...", "  ", "\n", "\n\n", "\t", " ", "é", "É.", "ß", "ǅ", "İ", " ", "​", "᠎",
         "\x1c", "\x85", "12", "3.5", "²", "ª", "!!", "'s", "<|endoftext|>", "<|startoftext|>", "漢字", "́", "é", "😀",
         "_", "½", "\r\n", "µ", "they're", "word", "Word,", "　"]


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_coder_equals_the_library(name):
    random.seed(9)
    texts = ["".join(random.choice(PARTS) + random.choice(["", "", " ", "\n"]) for _ in range(random.randint(0, 14)))
             for _ in range(8000)] + ["", " ", "\n", "word " * 5000]
    own = Coder(vocabulary(name), memo=700)
    for at in range(0, len(texts), 250):
        part = texts[at:at + 250]
        assert own.ids([t.encode() for t in part]) == own.whole(part)


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_coder_equals_a_fresh_tokenizer(name):
    from tokenizers import Tokenizer

    random.seed(4)
    names = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>"]
    texts = ["".join(random.choice(PARTS + names * 3) + random.choice(["", "", " ", "\n"]) for _ in range(random.randint(0, 9)))
             for _ in range(3000)] + ["end<|endoftext|>next", "<|ENDOFTEXT|>", "a <|endoftext|>\n"]
    own, lib = Coder(vocabulary(name), memo=700), Tokenizer.from_file(vocabulary(name))
    want = [np.array(lib.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert [x for at in range(0, len(texts), 250) for x in own.ids([t.encode() for t in texts[at:at + 250]])] == want
    assert len(own.ids([b"end<|endoftext|>next"])[0]) == 4 * 3


def odd_docs(spark):
    rows = [(3, "some words here"), (3, "some words here"), (1, None), (2, ""), (None, "no id"), (None, None), (-5, "below zero"),
            (7, "many words " * 9000)] + [(10 + i, "text of some length " * (i % 60)) for i in range(120)]
    return rows, spark.createDataFrame([(*r, "c", 1) for r in rows], "doc_id long, text string, length string, key int")


def test_packing_odd_rows(spark):
    rows, df = odd_docs(spark)
    got = packing.pack_documents(spark, df, vocabulary(WORD)).collect()
    assert sum(r.doc_id is None for r in got) >= 2
    sums = {}
    for r in got:
        sums.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in sums.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= 2048
    assert packing.pack_documents(spark, df.limit(0), vocabulary(WORD)).count() == 0
    whole = packing.pack_documents(spark, df.where("doc_id = 7"), vocabulary(WORD), keep_ids=True).orderBy("start").collect()
    own = Coder(vocabulary(WORD))
    assert b"".join(bytes(r.ids) for r in whole) == own.whole(["many words " * 9000])[0] + b"\1\0\0\0"


def test_differencing_is_exact_and_tight():
    random.seed(2)
    for sizes in ([random.randint(1, 2047) for _ in range(700)], [2047] * 40, [1], [5, 5, 5], [1024] * 33, []):
        windows = packing.pack_group(list(sizes))
        assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in w) <= 2048 for w in windows)
    sizes = [n for _ in range(800) for n in packing.cut(random.randint(1, 9000), random.getrandbits(32)) if n < 2048]
    windows = packing.pack_group(sizes)
    assert 1 - sum(sizes) / (2048 * len(windows)) < 0.01


@pytest.mark.parametrize("shard", [TS.SHARD_BYTES, 3000])
def test_shards_round_trip(spark, shard):
    rows, df = odd_docs(spark)
    path = fresh_path(spark, "test-shards")
    got = TS.write_and_read(spark, df, path, vocabulary(BYTE), shard_bytes=shard).collect()
    own = Coder(vocabulary(BYTE))
    data = [own.whole([t or ""])[0] + bytes(4) for _, t in rows]
    want = sorted((k if k is not None else -(1 << 63), len(d) // 4, zlib.crc32(d)) for (k, _), d in zip(rows, data))
    assert sorted((r.key if r.key is not None else -(1 << 63), r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    keys = [r.key for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: -(1 << 63) if k is None else k)
    wanted = spark.createDataFrame([(3,), (7,), (999,), (None,), (10,)], "doc_id long")
    found = {}
    for r in TS.fetch(spark, path, vocabulary(BYTE), wanted).collect():
        found.setdefault(r.key, []).append(np.frombuffer(bytes(r.ids), "<u2").astype("<u4").tobytes())
    for key in (3, 7, None, 10):
        assert sorted(found[key]) == sorted(d for (k, _), d in zip(rows, data) if k == key)
    assert 999 not in found


def shard_sizes(spark, rows, shard):
    path = fresh_path(spark, "test-shards")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = TS.write_and_read(spark, df, path, vocabulary(BYTE), shard_bytes=shard).collect()
    assert len(got) == len(rows)
    at, keys = 0, []
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        keys.append(r.key)
    assert keys == sorted(k for k, _ in rows)
    texts, sizes = dict(rows), {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + len(texts[r.key])
    return sizes


def test_shards_are_cut_by_bytes(spark):
    """Long documents with neighbouring ids, after many short ones."""
    rows = [(i, "web page") for i in range(3000)] + [(3000 + i, "a book's words " * 400) for i in range(60)]
    sizes = shard_sizes(spark, rows, 30_000)
    assert max(sizes.values()) <= 30_000 and len(sizes) < 3 * sum(sizes.values()) / 30_000 + 3060 * TS.ROW_BYTES / 30_000


def test_one_heavy_key_fills_many_shards(spark):
    rows = [(i, "short") for i in range(50)] + [(7, "the same long text " * 100) for _ in range(200)]
    rows = [(k, t if k != 7 else "the same long text " * 100) for k, t in rows]
    sizes = shard_sizes(spark, rows, 30_000)
    assert max(sizes.values()) < 3 * 30_000 and len(sizes) >= 10


def test_empty_table(spark):
    _, df = odd_docs(spark)
    assert TS.write_and_read(spark, df.limit(0), fresh_path(spark, "test-shards"), vocabulary(BYTE)).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-2**63, 2**63 - 1, 50_000))
    index = TS.PerfectHash.build(keys)
    assert sorted(index.slots(keys).tolist()) == list(range(len(keys)))
    assert index.sizes.sum() < 5 * len(keys)
    body = TS.footer(4, np.sort(keys), np.ones(len(keys), np.int64)) + bytes(2)
    shard = TS.Shard(body, 2)
    foreign = rng.integers(-2**63, 2**63 - 1, 20_000)
    assert shard.find(foreign)[1].sum() <= 1 and (shard.find(keys)[1] == 1).all() and shard.part == 4


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_a_word_is_learnt_once_whatever_mark_follows(name):
    random.seed(5)
    words = ["word", "Stra\u00dfe", "\u00e9t\u00e9", "x", "\u00d7", "\u00f7", "\u0416\u0443\u043a", "e\u0301", "\u6f22", "\U0001f600", "12", "don't", "'s", "a\u00c3", "_"]
    marks = ["***", ",", ".", "...", "$#&", "!'s", ".b", "|x|", ";\u00e9;", "%\n", "?\n\n", "", "\n", ":\u00ff"]
    texts = [" ".join(random.choice(words) + random.choice(marks) for _ in range(random.randint(0, 9))) for _ in range(4000)] + ["", ".", "a", "a."]
    own = Coder(vocabulary(name), memo=500)
    for at in range(0, len(texts), 500):
        assert own.ids([t.encode() for t in texts[at:at + 500]]) == own.whole(texts[at:at + 500])
    own = Coder(vocabulary(name))
    many = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]
    own.ids([" ".join(w + m for w in many).encode() for m in ("", "***", ",", "...", "$$$", "!")])
    assert len(own.memo) < len(many) + 50
    with pytest.raises(UnicodeDecodeError):
        own.ids([b"a \xff."])
