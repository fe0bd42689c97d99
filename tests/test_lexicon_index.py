"""The rare-gram index against testing every phrase in every text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import lending_jobs as LJ
from tallyspark.operators import lexicon_index as LI

SCHEMA = "ord int, category string, phrase string, severity string, alternative string"


def drawn(rnd, n, most):
    return ["".join(rnd.choice("abcя 😀É\n") for _ in range(rnd.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("piece,chunk", [(250_000, 1 << 20), (40, 7)])
def test_equals_every_phrase_in_every_text(spark, monkeypatch, piece, chunk):
    monkeypatch.setattr(LI, "CHUNK", chunk)
    rnd = random.Random(piece)
    phrases = [p for p in drawn(rnd, 300, 9) if p] + ["a", "A", "zz not there", "é", "ab" * 40, ""]
    texts = drawn(rnd, 80, 120) + [None, "", "a", "AB" * 50, "x" + "ab" * 45 + "É"]
    lex = spark.createDataFrame([(i // 2, "c", p, "low", "r") for i, p in enumerate(phrases)] + [(9999, "c", None, "low", "r")], SCHEMA)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string").withColumn("low", F.lower("text"))
    got = df.withColumn("hits", LI.phrase_hits(df, "low", lex, piece)).collect()
    for r in got:
        want = sorted((i // 2, p) for i, p in enumerate(phrases) if p and r.low is not None and p.lower() in r.low)
        assert sorted((h.ord, h.phrase) for h in r.hits) == want and [h.ord for h in r.hits] == [o for o, _ in want]


def test_rarest_gram_is_the_key_and_absent_phrases_go(spark):
    texts = spark.createDataFrame([("the cat the dog the owl zebra",)] * 50 + [("the quagga",)], "low string")
    lex = spark.createDataFrame([(0, "c", "the quagga", "low", "r"), (1, "c", "the unicorn", "low", "r"), (2, "c", "owl", "low", "r")], SCHEMA)
    index = {r.low: r for r in LI.rare_gram_index(texts, "low", lex).collect()}
    assert sorted(index) == ["owl", "the quagga"]  # no gram of 'unicorn' occurs
    assert index["the quagga"].offset >= 1  # not the hot beginning 'the '


def test_no_text_in_a_join_or_exchange(spark):
    lex = spark.createDataFrame([(i, "c", f"phrase {i}", "low", "r") for i in range(500)], SCHEMA)
    df = spark.createDataFrame([(1, "has phrase 77")], "k long, text string")
    plan = LJ.compliance_scan_table(df, "text", lex)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_gram_hashes_differ_by_length():
    points = LI.code_points("aaaaaaaa")
    assert len({int(LI.grams(points, n)[0]) for n in (1, 2, 3, 4)}) == 4
    assert len(LI.grams(points, 4)) == 5 and not len(LI.grams(points[:2], 4)) and np.unique(LI.grams(points, 3)).size == 1


def test_find_numbers_hits_in_lexicon_order_once_each():
    phrases = ["abcdef", "cdefgh", "bcd", "zz", "abcdefabcdef"]
    entries = [(int(LI.grams(LI.code_points(p), LI.run_length(p)).view(np.int64)[-1]), len(p) - LI.run_length(p), p,
                {"ord": 9 - i, "category": None, "phrase": p, "severity": None, "alternative": None}) for i, p in enumerate(phrases)]
    piece = LI.Piece(entries)
    texts = ["abcdef" * 1000, None, "", "abc", "def", "xbcdefgh", "z", "zz" * 5]
    named = [[piece.phrases[i] for i in found] for found in piece.find(texts).to_pylist()]
    assert piece.lengths == [2, 3, 6]
    assert named == [["abcdefabcdef", "bcd", "abcdef"], [], [], [], [], ["bcd", "cdefgh"], [], ["zz"]]  # none over the end of a text
    assert LI.Piece([]).find(["a"]).to_pylist() == [[]]
