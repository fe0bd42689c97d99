"""The pipeline's stages and result against brute force over plain Python values."""

import hashlib
import math
import re
import zlib

import numpy as np

import corpus_pipeline
from tallyspark.llm import mixing, packing
from tallyspark.llm.queries import vocabulary
from tallyspark.llm.tokens import Coder
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


def poisson_count(u, mean):
    k, p = 0, math.exp(-mean)
    total = p
    while total < u:
        k += 1
        p *= mean / k
        total += p
    return k


def plain_exact(rows):
    keep = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        keep.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r)
    return list(keep.values())


def plain_near(rows):
    least = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows])
    return [r for r, c in zip(rows, least) if r["doc_id"] == c]


def plain_mixing(rows):
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"])
    weights = {s: n ** mixing.TEMPERATURE for s, n in sizes.items()}
    whole, weight, out = sum(sizes.values()), sum(weights.values()), []
    for r in rows:
        rate = weights[r["source"]] / weight * mixing.EPOCHS * whole / sizes[r["source"]]
        u = (int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        out += [r] * poisson_count(u, rate)
    return out


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_stages_and_result(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mixing", "packing"]
    for name, plain in (("language_id", lambda x: x), ("exact_dedup", plain_exact), ("simhash_near_dedup", plain_near),
                        ("source_mixing", plain_mixing)):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns
        want = plain(rows)
        got = [r.asDict() for r in out.collect()]
        assert sorted(got, key=str) == sorted(want, key=str), name
        docs, rows = spark.createDataFrame(got, docs.schema), want
    check_packing(rows, corpus_pipeline.run(spark, SF).collect())


def check_packing(rows, got):
    own = Coder(vocabulary("word_bpe_49k.json"))
    want = {}
    for r in rows:
        text = own.whole([r["text"] or ""])[0] + np.array([packing.END_ID], "<u4").tobytes()
        want.setdefault(r["doc_id"], []).append(text)
    count = {k: len(v) for k, v in want.items()}
    pieces = {}
    for p in got:
        data = want[p.doc_id][0]
        assert zlib.crc32(data[4 * p.start:4 * (p.start + p.length)]) == p.ids_crc32 and p.doc_tokens == len(data) // 4
        pieces.setdefault(p.doc_id, []).append((p.start, p.length))
    assert pieces.keys() == want.keys()
    for key, found in pieces.items():  # each copy in full
        spans = sorted(found)
        assert sum(n for _, n in spans) == count[key] * len(want[key][0]) // 4
        starts = sorted(set(spans))
        assert all(spans.count(s) == count[key] for s in starts)
        assert [s for s, _ in starts] == [sum(n for _, n in starts[:i]) for i in range(len(starts))]
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for found in sequences.values():
        at = 0
        for offset, n in sorted(found):
            assert offset == at
            at += n
        assert at <= packing.SEQUENCE


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        docs = docs if out.columns != docs.columns else out
