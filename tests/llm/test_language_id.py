import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tallyspark.llm import language_id as L


def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def binary(df, label="lang"):
    return df.select(F.col(label).alias("label"), F.col("text").cast("binary").alias("text"))


def test_held_out_accuracy(spark):
    df = docs(spark)
    model = L.train(binary(df.where("doc_id % 2 = 0")))
    held = df.where("doc_id % 2 = 1")
    got = L.identify(spark, held, F.col("text"), None, None, F.col("lang"), model=model).collect()
    assert np.mean([r.lang == r.text_language for r in got]) > 0.98
    assert np.mean([r.accepted for r in got]) > 0.98


def domain(host):
    labels = (host or "").split(".")
    if not host or all(x.isdigit() for x in labels):
        return None
    wide = len(labels) > 2 and labels[-2] in L.SECOND_LABELS and len(labels[-1]) == 2
    return ".".join(labels[-3 if wide else -2:])


def brute(model, rows, own=False):
    """The fusion over plain values: rows of (text, declared, host)."""
    k, log_u = len(model.languages), math.log(L.BUCKETS)
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    ll = [plain_likelihoods(model, t or "", d if own else None) for t, d, _ in rows]
    worded = [n > 0 and x.max() >= -n * log_u for n, x in ll]
    p = [soft(x * L.TEMPER) for _, x in ll]
    mass = sum(x for x, w in zip(p, worded) if w)
    common = (mass + 1) / (mass.sum() + k)
    parts = [(d, domain(h), h.split(".")[-1] if h and "." in h and domain(h) else None, h) for _, d, h in rows]

    def sums(at):
        out = {}
        for x, w, q in zip(p, worded, parts):
            if w and q[at] is not None:
                n, s = out.get(q[at], (0, 0))
                out[q[at]] = n + 1, s + x
        return out

    tables = [sums(i) for i in range(4)]
    out = []
    for (_, x), w, own, q in zip(ll, worded, p, parts):
        if not w:
            out.append(("und", 0.0))
            continue
        e = x * L.TEMPER
        for at, weight in ((0, 1.0), (2, L.SUFFIX_WEIGHT)):
            if q[at] in tables[at]:
                n = max(len(tables[at]), 1)
                prior_of = 1 / n if at else L.KAPPA * np.array([0.1 / n + 0.9 * (x == q[0]) for x in model.languages])
                e = e + weight * np.log((tables[at][q[at]][1] + prior_of) / (mass + (1 if at else L.KAPPA)))
        prior = common
        for at in (1, 3):
            if q[at] in tables[at]:
                n, s = tables[at][q[at]]
                prior = (np.maximum(s - own, 0) + L.KAPPA * prior) / (n - 1 + L.KAPPA)
        post = soft(e + np.log(prior))
        out.append((model.languages[int(post.argmax())], float(post.max())))
    return out


def plain_trigrams(text):
    """Hashes of the byte trigrams of a text, letters in lower case, one blank between runs of them."""
    kept = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in text.encode())
    kept = b" " + b" ".join(x for x in kept.split(b" ") if x) + b" " if kept.strip(b" ") else b" "
    return [((a << 16 | b << 8 | c) * 2654435761 % 2 ** 32) >> 16 for a, b, c in zip(kept, kept[1:], kept[2:])]


def plain_likelihoods(model, text, own):
    grams = plain_trigrams(text)
    every = model.counts.sum(1)
    out = []
    for i, name in enumerate(model.languages):
        counts, size = model.counts[:, i], model.counts[:, i].sum()
        taken = Counter(grams) if name == own else {}
        size -= sum(taken.values())
        prior = L.BACKGROUND * (every / every.sum() + 1 / L.BUCKETS) / 2
        out.append(sum(math.log((counts[g] - taken.get(g, 0) + prior[g]) / (size + L.BACKGROUND)) for g in grams))
    return len(grams), np.array(out)


def test_training_counts_equal_brute_force(spark):
    rows = docs(spark).where("doc_id % 9 = 0").collect()
    model = L.train(binary(docs(spark).where("doc_id % 9 = 0").unionByName(
        docs(spark).limit(3).withColumn("lang", F.lit("qx")))))  # no language code
    assert model.languages == sorted({r.lang for r in rows})
    for i, name in enumerate(model.languages):
        want = Counter(g for r in rows if r.lang == name for g in plain_trigrams(r.text or ""))
        assert {g: c for g, c in enumerate(model.counts[:, i]) if c} == want


RARE = {
    "nb": ["Det er ikke lett å si hva som skjer når været skifter så fort ved kysten, men folk som bor der vet det godt nok.",
           "Vi gikk opp til hytta på fjellet i går kveld, og der så vi at snøen ennå lå dyp mellom bjørkene ved vannet.",
           "Hun har skrevet mange bøker om livet i byen, og nå vil hun gjerne fortelle hvordan det var å vokse opp der.",
           "Kommunen sier at den nye skolen skal stå ferdig til høsten, slik at elevene kan begynne der etter ferien."],
    "hu": ["A városban sok régi ház áll, amelyeket a tulajdonosok az elmúlt években szépen felújítottak és újra megnyitottak.",
           "Tegnap este a barátaimmal elmentünk a színházba, ahol egy nagyon érdekes darabot láttunk a régi időkről.",
           "Az egyetem hallgatói szerint a könyvtár mindig nyitva van, mégis kevesen járnak oda tanulni a hétvégén.",
           "Nem tudom, hogy mikor érkezik meg a vonat, de remélem, hogy még ma este otthon lehetünk mindannyian."]}


def test_rare_languages_stay_themselves_and_rejects_go(spark):
    df = docs(spark).select("doc_id", "text", "lang", "source")
    rows = [(90_000 + 10 * j + i, text, code, "src1") for j, (code, texts) in enumerate(RARE.items()) for i, text in enumerate(texts)]
    bad = [(95_000, "漢字かな漢字" * 30, "en", "src0"), (95_001, "12 34 !! 56", "en", "src0"), (95_002, None, "de", "src1")]
    both = df.unionByName(spark.createDataFrame([*rows, *bad], df.schema))
    got = {r.doc_id: r for r in L.identify(spark, both, F.col("text"), F.col("lang"), F.col("source"), F.col("doc_id")).collect()}
    assert [got[r[0]].language for r in rows] == [r[2] for r in rows] and all(got[r[0]].accepted for r in rows)
    assert not any(got[r[0]].accepted for r in bad)
    clean = [r for r in got.values() if r.doc_id < 90_000]
    assert np.mean([r.accepted and r.language == r.declared for r in clean]) > 0.99
    kept = {r.doc_id for r in L.accepted_rows(spark, both).select("doc_id").collect()}
    assert kept == {k for k, r in got.items() if r.accepted}


def test_own_text_is_left_out(spark):
    some = docs(spark).limit(60).collect()
    rows = [(r.text[:300], r.lang, "x.fr") for r in some]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, text string, d string, h string")
    model = L.train(df.select(F.col("d").alias("label"), F.col("text").cast("binary").alias("text")))
    got = L.identify(spark, df, F.col("text"), F.col("d"), F.col("h"), F.col("id")).orderBy("id").collect()
    for r, (language, post) in zip(got, brute(model, rows, own=True), strict=True):
        assert r.language == language and abs(r.posterior - post) < 1e-9


def test_fusion_equals_brute_force(spark):
    some = docs(spark).limit(120).collect()
    hosts = ["a.x.fr", "b.x.fr", "c.y.de", "z.de", "localhost", None, "p.q.co.uk", "r.co.uk", "10.1.2.3"]
    rows = [(r.text[:8 + i], [r.lang, None, "fr", "en"][i % 4], hosts[i % 9]) for i, r in enumerate(some)]
    rows += [(None, "en", "a.x.fr"), ("", None, None), ("12 34 !!", "de", "z.de"), ("漢字かな漢字" * 20, "ja", "q.jp")]
    model = L.train(binary(docs(spark)))
    df = spark.createDataFrame([(i, *r, 0.5) for i, r in enumerate(rows)], "id int, text string, d string, h string, posterior double")
    got = L.identify(spark, df, F.col("text"), F.col("d"), F.col("h"), F.col("id"), model=model).orderBy("id").collect()
    for r, (language, post) in zip(got, brute(model, rows), strict=True):
        assert r.language == language and abs(r.posterior - post) < 1e-9, (r, language, post)
    assert [r.accepted for r in got[-4:]] == [False] * 4


def test_evidence_moves_short_texts(spark):
    model = L.train(binary(docs(spark)))
    rows = [("en", 1, "de", "shop.example.de")] + [(t, 9, "de", "shop.example.de") for t in ["der und die schen"] * 30] + [
        ("en", 2, None, None)]
    df = spark.createDataFrame(rows, "text string, id int, d string, h string")
    got = L.identify(spark, df, F.col("text"), F.col("d"), F.col("h"), F.col("id"), model=model)
    by = {r.id: r for r in got.where("id < 3").collect()}
    assert by[1].language == "de" and by[1].posterior > 0.9


def test_addresses_and_markup(spark):
    df = spark.createDataFrame([("https://u@Blog.Example.FR:80/x?y", '<!DOCTYPE html><HTML class="a" lang="fr-CA"><p>Bonjour<script>var x</script></p>'),
                                (None, None), ("not an url", "<html><p>&amp;plain")], "url string, html string")
    got = df.select(L.address_host(F.col("url")).alias("h"), L.markup_language(F.col("html")).alias("l"),
                    F.trim(L.markup_text(F.col("html"))).alias("t")).collect()
    assert [tuple(r) for r in got] == [("blog.example.fr", "fr", "Bonjour"), (None, None, None), (None, None, "plain")]


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, None, None, None, 1), (2, "", "en", "s", 2)],
                               "doc_id long, text string, lang string, source string, m1 int")
    assert L.accepted_rows(spark, df).count() == 0  # nothing to learn from: all unknown
    assert L.accepted_rows(spark, df.limit(0)).columns == df.columns
    big = docs(spark).selectExpr("doc_id", "text", "lang", "source", "1 AS m1")
    odd = spark.createDataFrame([(None, "the and of that", "en", "src0", 1), (7, None, "en", "src0", 1),
                                 (9001, "der die und " * 300_000, "de", None, 1)], big.schema)
    kept = L.accepted_rows(spark, big.unionByName(odd))
    assert kept.columns == big.columns and kept.count() == big.count() + 2


def test_trigrams_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = ("Ein Satz, der 12 mal steht.  " * 40).encode()
    whole = np.concatenate(list(L.trigrams(text)))
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(L, "_CHUNK", size)
        assert np.array_equal(np.concatenate(list(L.trigrams(text))), whole)
