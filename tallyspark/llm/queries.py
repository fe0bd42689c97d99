"""The registered queries of the training-data operators, and their DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from . import class_lm, embedding_dedup, exact_dedup, fill_middle, hard_negatives, inner_top, language_id, mixing, packing, simhash, surrogates, token_shards, warc
from .common import fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op5_exact_dedup", r"""
WITH h AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM h GROUP BY text_sha256)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256
FROM h JOIN g USING (text_sha256)""")
def op5(spark, sf_dir):
    return exact_dedup.exact_dedup(spark, table(spark, sf_dir, "documents"))


@query("op8_source_mixing", f"""
WITH sizes AS (SELECT source AS src, CAST(sum(length(text)) AS BIGINT) AS size FROM documents GROUP BY source),
rates AS (
  SELECT src, pow(size, {mixing.TEMPERATURE}) / (SELECT sum(pow(size, {mixing.TEMPERATURE})) FROM sizes) * {mixing.EPOCHS}
         * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes),
steps AS (
  SELECT src, rate, k, exp(-rate + k * ln(rate) - sum(ln(greatest(k, 1))) OVER (PARTITION BY src ORDER BY k)) AS p
  FROM (SELECT src, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates)),
cdf AS (SELECT src, rate, k, sum(p) OVER (PARTITION BY src ORDER BY k) AS c FROM steps),
points AS (
  SELECT doc_id, source, text,
         (CAST('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents),
counted AS (
  SELECT doc_id, source, text, any_value(rate) AS rate, count(*) AS n_copies
  FROM points JOIN cdf ON src = source AND c < u GROUP BY doc_id, source, text)
SELECT doc_id, source, text, round(rate, 6) AS rate, CAST(n_copies AS INTEGER) AS n_copies, CAST(copy AS INTEGER) AS copy,
       md5('shuffle {mixing.SEED}:' || doc_id || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM counted)""")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(spark, docs)
    return mixed.selectExpr("doc_id", "source", "text", "round(rate, 6) AS rate", "n_copies", "copy", "shuffle_key")


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_packing")
def op4(spark, sf_dir):
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op9_token_shards")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = token_shards.write_and_read(spark, docs, fresh_path(spark, "token-shards"), vocabulary("byte_bpe_50k.json"))
    return found.withColumnRenamed("key", "doc_id")


@query("op1_warc", r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p GROUP BY html),
bits AS (
  SELECT page_id, strlen(p.html) AS payload_bytes, first, sha1(p.html) AS digest FROM p JOIN g ON p.html = g.html),
digits AS (
  SELECT page_id, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((CAST('0x' || substr(digest, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1),
           '' ORDER BY i) AS payload_digest
  FROM bits, range(32) AS r(i) GROUP BY page_id)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits JOIN digits USING (page_id)""")
def op1(spark, sf_dir):
    path = fresh_path(spark, "warc")
    warc.write_warc(spark, table(spark, sf_dir, "pages"), path)
    return warc.resolved(spark, warc.read_warc(spark, path)).drop("complete")


@query("op7_simhash")
def op7(spark, sf_dir):
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_class_lm")
def op6(spark, sf_dir):
    return class_lm.score_documents(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), settle=True)


@query("op2_inner_top", f"""
WITH v AS (
  SELECT vec_id, [CAST(floor({inner_top.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum([p[1] * p[2] for p in list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {inner_top.EVERY} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {inner_top.K}""")
def op2(spark, sf_dir):
    return inner_top.top_inner(spark, table(spark, sf_dir, "embeddings"))


@query("op3_language_id")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(spark, docs, F.col("text"), F.col("lang"), F.col("source"), F.col("doc_id"))


@query("language_id_pages")
def language_id_pages(spark, sf_dir):
    """The same over web pages, with all kinds of evidence: markup, address suffix, host and domain."""
    pages = table(spark, sf_dir, "pages")
    return language_id.identify(spark, pages, language_id.markup_text(F.col("html")), language_id.markup_language(F.col("html")),
                                language_id.address_host(F.col("url")), F.col("page_id"))


@query("op10_surrogates")
def op10(spark, sf_dir):
    return surrogates.replace_personal_data(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op12_fill_middle", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS h1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS h2, CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
f AS (
  SELECT doc_id, t, n,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:least(h1, h2)], '') AS p, array_to_string(units[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
         array_to_string(units[greatest(h1, h2) + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f""")
def op12(spark, sf_dir):
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    prefix, middle = fill_middle.part_lengths(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", prefix.alias("prefix_chars"), middle.alias("middle_chars"),
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))


@query("op13_embedding_dedup", f"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x for x in embedding if x <> 0]) > 0),
pairs AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {embedding_dedup.THRESHOLD}),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a), links AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN links ON links.a = vec_id LEFT JOIN least ON least.a = vec_id""")
def op13(spark, sf_dir):
    return embedding_dedup.near_vectors(spark, table(spark, sf_dir, "embeddings"))


@query("op11_hard_negatives", f"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [CAST(floor({hard_negatives.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS other, a.label = c.label AS same,
         CAST(list_sum([p[1] * p[2] for p in list_zip(a.v, c.v)]) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % {hard_negatives.EVERY} = 0 AND a.vec_id <> c.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {hard_negatives.POSITIVES}),
r AS (
  SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
       AND {hard_negatives.LOW_PERCENT} * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM r WHERE rank <= {hard_negatives.NEGATIVES}""")
def op11(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(spark, table(spark, sf_dir, "embeddings"), label)
