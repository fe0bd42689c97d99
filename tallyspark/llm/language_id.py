"""Language identification by Bayesian evidence fusion.

log P(language | document) = text log-likelihood (tempered) + log P(declared | language) + weight x log P(suffix | language)
+ log prior(language | host), normalised over the languages.

* Text: a naive Bayes model of byte trigrams (hashed to 2^16), counted over all labelled rows. Every label that is a language
  code (``CODES``) is a language, however few rows have it: its counts are smoothed with ``BACKGROUND`` trigrams drawn half
  from all languages, half evenly, so that a language of few rows expects what it hasn't seen, and one of many doesn't.
  A labelled row's own trigrams are taken out of its language's counts, so that a label isn't its own evidence.
  ``TEMPER`` takes back some of the certainty that naive independence of trigrams feigns.
* Declared language (of the markup, or a column): how often a language's documents declare each, by text alone, smoothed
  with ``KAPPA`` documents of which the share ``TRUST`` declares the language's own code.
* Address suffix: how often a language's documents come from it, at half weight, since hosts already tell part of it.
* Host prior: posteriors by text, summed by host, smoothed with those of its domain, and these with those of all:
  (sum + KAPPA x parent) / (number + KAPPA). A document's own share is taken out of its host's and domain's sums.

A text that the best language explains worse than uniform trigrams, or that has no letters, has no language ("und").
A document is accepted if its language isn't "und", its posterior reaches ``ACCEPT``, and it is among the wanted languages.

Texts are read twice (counts, likelihoods); all else works on a narrow table of likelihoods, with grouped sums combined
before the shuffle, so that a hot host costs nothing extra. Tables by host, declared value and suffix may be long:
they are broadcast only behind a count. The model has at most a column a language code. A host that is a number has no domain
and no suffix; under country codes, the usual second labels (``co.uk``) belong to the suffix when domains are cut.

Defined results. Null or empty text: "und". No declared language, host or suffix: that evidence is left out (and the
prior is that of all documents). Null id: carried along. Repeated rows: one row each. No labelled rows: everything is
"und". Empty table: empty result. Other columns are ignored (or passed on by :func:`accepted_rows`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, join_small, materialise, small_batches

BUCKETS = 1 << 16
TEMPER = 0.1
KAPPA = 10.0
SUFFIX_WEIGHT = 0.5
ACCEPT = 0.5
#: Trigrams and documents of prior belief, see above.
BACKGROUND = 2000.0
TRUST = 0.9
#: The two-letter language codes of ISO 639-1, and three of 639-3 that web pages declare.
CODES = """aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en
eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz ia id ie ig ii ik io is it iu ja jv ka kg ki kj
kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my na nb nd ne ng nl nn no nr nv ny oc
oj om or os pa pi pl ps pt qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to
tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu ceb fil yue""".split()
#: Second labels under which country domains are given out.
SECOND_LABELS = ("ac", "co", "com", "edu", "go", "gob", "gov", "ne", "net", "or", "org")
_CHUNK = 1 << 20  # bytes hashed at a time

_FOLD = np.full(256, 32, np.uint8)  # letters in lower case and bytes of other scripts stay, all else is a blank
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigrams(text: bytes) -> Iterator[np.ndarray]:
    """Hashed byte trigrams of the folded text, runs of blanks as one, in arrays of bounded size."""
    before = np.array([32], np.uint8)
    for at in range(0, len(text), _CHUNK):
        b = _FOLD[np.frombuffer(text, np.uint8, min(_CHUNK, len(text) - at), at)]
        b = np.concatenate([before, b, [32] if at + _CHUNK >= len(text) else []]).astype(np.uint8)
        b = b[np.concatenate([[True], (b[1:] != 32) | (b[:-1] != 32)])]
        before = b[-2:]
        w = b.astype(np.uint32)
        if len(b) > 2:
            yield ((w[:-2] << 16 | w[1:-1] << 8 | w[2:]) * np.uint32(2654435761)) >> np.uint32(16)


def declared_language(value: Column) -> Column:
    """The primary subtag of a language tag, in lower case; null if there is none."""
    tag = F.lower(F.regexp_extract(value, r"^\s*([A-Za-z]{2,8})", 1))
    return F.when(tag != "", tag)


def address_host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def markup_language(html: Column) -> Column:
    return declared_language(F.regexp_extract(html, r"(?i)<html[^>]*\slang\s*=\s*[\"']?([A-Za-z-]+)", 1))


def markup_text(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&[A-Za-z]+;", " ")


def host_domain(host: Column) -> Column:
    """The registered part of a host; null for numbers."""
    second = "|".join(SECOND_LABELS)
    named = F.regexp_extract(host, rf"([^.]+\.(?:{second})\.[a-z]{{2}}|[^.]+\.[^.]+|[^.]+)$", 1)
    return F.when(~_numeric(host), named)


def _numeric(host: Column) -> Column:
    return host.rlike(r"^[0-9.]+$|^\[")


class Model:
    """Languages, counts and log probabilities (buckets x languages)."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.at = {name: i for i, name in enumerate(languages)}
        self.counts = counts
        every = counts.sum(1)
        self.prior = BACKGROUND * (every / max(every.sum(), 1) + 1 / BUCKETS) / 2
        self.sizes = counts.sum(0)
        self.logp = np.log((counts + self.prior[:, None]) / (self.sizes + BACKGROUND)) if languages else np.zeros((BUCKETS, 0))

    def likelihoods(self, text: bytes, label: str | None = None) -> tuple[int, np.ndarray]:
        """(number of trigrams, log-likelihood by language). ``label``: the language under which this very text was counted."""
        n, total, i = 0, np.zeros(len(self.languages)), self.at.get(label)
        own = None if i is None else np.zeros(BUCKETS)
        for found in trigrams(text):
            n += len(found)
            total += self.logp[found].sum(0)
            if own is not None:
                np.add.at(own, found, 1)
        if n and own is not None:
            seen = np.flatnonzero(own)
            mine = own[seen]
            left = np.log((self.counts[seen, i] - mine + self.prior[seen]) / (self.sizes[i] - n + BACKGROUND))
            total[i] = (mine * left).sum()
        return n, total


def train(labelled: DataFrame, label: str = "label", text: str = "text") -> Model:
    """Counts over all rows of ``labelled`` (label, text as binary) whose label is a language code."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            for name, body in zip(batch.column("label").to_pylist(), batch.column("text"), strict=True):
                own = total.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                own[BUCKETS] += 1
                for found in trigrams(body.as_py()):
                    own[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
            if len(total) > 40:
                yield from out(total)
        yield from out(total)

    def out(total):
        for name, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_pydict({"label": [name] * len(at), "bucket": at, "n": own[at]})
        total.clear()

    rows = labelled.select(F.col(label).alias("label"), F.col(text).alias("text")).where(F.col("label").isin(CODES))
    sums = rows.mapInArrow(run, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    sums = materialise(labelled.sparkSession, sums, "language-counts")
    kept = [r.label for r in sums.select("label").distinct().orderBy("label").collect()]
    counts = np.zeros((BUCKETS + 1, len(kept)))
    for lo in range(0, len(kept), 16):  # at most 2^20 counts at a time
        names = kept[lo:lo + 16]
        for got in sums.where(F.col("label").isin(names)).toArrow().to_batches():
            at = np.array([lo + names.index(x) for x in got["label"].to_pylist()], np.int64)
            counts[got["bucket"].to_numpy(), at] = got["n"].to_numpy()
    return Model(kept, counts[:BUCKETS])


def _text_only(ll: np.ndarray) -> np.ndarray:
    """The posteriors by text alone, with equal priors."""
    odds = np.exp((ll - ll.max()) * TEMPER)
    return odds / odds.sum()


def _sums(rows: DataFrame, by: str, k: int) -> DataFrame:
    return (rows.where(F.col(by).isNotNull() & F.col("worded")).groupBy(by)
            .agg(F.count("*").alias("n"), *[F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(k)]))


def identify(spark: SparkSession, docs: DataFrame, text: Column, declared: Column | None = None, host: Column | None = None,
             *kept: Column, model: Model | None = None, wanted: list[str] | None = None) -> DataFrame:
    """The ``kept`` columns, then declared, text_language, text_posterior, language, posterior, accepted. Without a
    ``model``, one is trained on all rows, labelled by what they declare."""
    small_batches(spark)
    none = F.lit(None).cast("string")
    rows = docs.select(*kept, (none if declared is None else declared_language(declared)).alias("declared"),
                       (none if host is None else host).alias("host"), F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    names = rows.columns[:-3]
    itself = model is None  # the rows were counted themselves
    model = model or train(rows, "declared")
    k = len(model.languages)
    if not k:
        return rows.select(*names, "declared", none.alias("text_language"), F.lit(0.0).alias("text_posterior"),
                           F.lit("und").alias("language"), F.lit(0.0).alias("posterior"), F.lit(False).alias("accepted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("declared").to_pylist() if itself else [None] * batch.num_rows
            found = [model.likelihoods(t.as_py(), x) for t, x in zip(batch.column("text"), own, strict=True)]
            floats = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([n for n, _ in found], pa.int64()), pa.array([x.tolist() for _, x in found], floats),
                 pa.array([_text_only(x).tolist() for _, x in found], floats)], names=[*batch.schema.names[:-1], "n", "ll", "p"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    scored = rows.mapInArrow(run, f"{fields}, n long, ll array<double>, p array<double>")
    uniform = F.col("n") * F.lit(-float(np.log(BUCKETS)))
    best = F.array_max("ll")
    scored = (scored.withColumn("worded", (F.col("n") > 0) & (best >= uniform))
              .withColumn("domain", host_domain(F.col("host")))
              .withColumn("suffix", F.when((F.instr("host", ".") > 0) & ~_numeric(F.col("host")), F.substring_index("host", ".", -1))))
    scored = materialise(spark, scored, "language-rows")
    tongues = range(k)

    every = scored.where("worded").agg(F.count("*"), *[F.sum(F.col("p")[i]) for i in tongues]).first()
    mass = [float(every[i + 1] or 0.0) for i in tongues]
    total = sum(mass)
    common = [(m + 1) / (total + k) for m in mass]
    joined = scored
    evidence = [F.col("ll")[i] * F.lit(TEMPER) for i in tongues]
    for by, weight in (("declared", 1.0), ("suffix", SUFFIX_WEIGHT)):
        table = materialise(spark, _sums(scored, by, k), f"language-{by}")
        values = max(table.count(), 1)
        weight_of, own_share = (KAPPA, TRUST) if by == "declared" else (1.0, 0.0)
        given = [(F.col(f"s{i}") + F.lit(weight_of) * (F.lit((1 - own_share) / values)
                  + F.when(F.col(by) == model.languages[i], own_share).otherwise(0.0))) / F.lit(mass[i] + weight_of) for i in tongues]
        table = table.select(F.col(by).alias(f"{by}_value"), F.array(*[F.log(g) for g in given]).alias(f"{by}_log"))
        joined = join_small(joined, table, F.col(by) == F.col(f"{by}_value"))
        evidence = [e + F.lit(weight) * F.coalesce(F.col(f"{by}_log")[i], F.lit(0.0)) for i, e in enumerate(evidence)]
    for by in ("domain", "host"):
        sums = F.array(*[F.col(f"s{i}") for i in tongues])
        table = materialise(spark, _sums(scored, by, k), f"language-{by}").select(
            F.col(by).alias(f"{by}_value"), F.col("n").alias(f"{by}_n"), sums.alias(f"{by}_sums"))
        joined = join_small(joined, table, F.col(by) == F.col(f"{by}_value"))

    def smoothed(by: str, i: int, parent: Column) -> Column:
        own = F.when(F.col("worded"), F.col("p")[i]).otherwise(0.0)
        sums = F.greatest(F.col(f"{by}_sums")[i] - own, F.lit(0.0))
        n = F.col(f"{by}_n") - F.when(F.col("worded"), 1).otherwise(0)
        return F.coalesce((sums + F.lit(KAPPA) * parent) / (n + F.lit(KAPPA)), parent)

    prior = [smoothed("host", i, smoothed("domain", i, F.lit(common[i]))) for i in tongues]
    # steps in columns of their own, so that none is written out (and compiled) more than once
    ranked = (joined.withColumn("logs", F.array(*[e + F.log(p) for e, p in zip(evidence, prior, strict=True)]))
              .withColumn("odds", F.transform("logs", lambda x: F.exp(x - F.array_max("logs"))))
              .withColumn("post", F.transform("odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda a, b: a + b))))
    tongue = F.array(*[F.lit(x) for x in model.languages])
    top = lambda c: F.element_at(tongue, F.array_position(c, F.array_max(c)).cast("int"))
    language = F.when(F.col("worded"), top("post")).otherwise(F.lit("und"))
    certain = F.when(F.col("worded"), F.array_max("post")).otherwise(F.lit(0.0))
    fine = F.col("worded") & (certain >= ACCEPT)
    if wanted is not None:
        fine = fine & language.isin(*wanted)
    return ranked.select(*names, "declared", F.when(F.col("n") > 0, top("p")).alias("text_language"),
                         F.when(F.col("n") > 0, F.array_max("p")).otherwise(F.lit(0.0)).alias("text_posterior"),
                         language.alias("language"), certain.alias("posterior"), fine.alias("accepted"))


def accepted_rows(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", source_col: str = "source", wanted: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that are accepted, with all of their columns. Rows are told apart by two 64-bit hashes of id,
    text, declared language and source; only the rejected ones are joined with the documents."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, lang_col, source_col, text_col)]
    marks = [F.xxhash64(F.lit(i), *parts) for i in (1, 2)]
    found = identify(spark, docs, F.col(text_col), F.col(lang_col), F.col(source_col), marks[0].alias("m1"),
                     marks[1].alias("m2"), wanted=wanted)
    gone = materialise(spark, found.where("NOT accepted").select("m1", "m2").distinct(), "language-rejected")
    m1, m2 = free_name(docs, "m1"), free_name(docs, "m2")
    marked = docs.withColumn(m1, marks[0]).withColumn(m2, marks[1])
    return join_small(marked, gone.toDF(m1, m2), [m1, m2], "left_anti").select(*docs.columns)
