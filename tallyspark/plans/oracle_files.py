"""DuckDB SQL of the queries in ``files``: the same results from the tables, without any file between."""

from __future__ import annotations

from . import files as FL
from .oracle import ORACLE, _FIRST_ERROR, _pii3, _red, v3_sql

OWN: dict[str, str] = {}

OWN["jsonl_lines"] = f"""
WITH d AS (SELECT *, doc_id % {FL.LINE_FILES} AS f, CASE WHEN doc_id % 5 = 0 THEN 3 ELSE 1 END AS lines FROM documents)
SELECT doc_id, lpad(CAST(f AS VARCHAR), 2, '0') AS file,
       CAST(sum(lines) OVER (PARTITION BY f ORDER BY doc_id) AS BIGINT) - CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS line,
       source, CAST(length(text) AS INTEGER) AS n_chars FROM d"""

_sets = " UNION ALL ".join(f"SELECT '{n}' AS name, * FROM r WHERE {w}" for n, w in FL.FAIL_SETS.items())
OWN["quality_v3_first_failure"] = f"""
WITH r AS (SELECT gidx, domain, first_violation FROM ({ORACLE['quality_v3_damaged']})),
s AS (SELECT name, gidx % {FL.FAIL_FILES} AS f, gidx, domain, first_violation FROM ({_sets})),
l AS (SELECT *, CAST(sum(CASE WHEN gidx % 5 = 0 THEN 3 ELSE 1 END) OVER (PARTITION BY name, f ORDER BY gidx) AS BIGINT)
                - CASE WHEN gidx % 5 = 0 THEN 1 ELSE 0 END AS line FROM s),
b AS (SELECT name, min(f) AS f FROM l WHERE first_violation IS NOT NULL GROUP BY name),
e AS (SELECT l.name, l.f, min(line) AS line, arg_min(first_violation, line) AS message
      FROM l JOIN b ON l.name = b.name AND l.f = b.f WHERE first_violation IS NOT NULL GROUP BY l.name, l.f),
w AS (SELECT n.name, coalesce(CASE WHEN f < 1 THEN 1 WHEN f < 5 THEN 5 END, {FL.FAIL_FILES}) AS files_read
      FROM (SELECT DISTINCT name FROM s) n LEFT JOIN e ON n.name = e.name),
c AS (SELECT s.name, domain, count(*) AS n FROM s JOIN w ON s.name = w.name WHERE f < files_read GROUP BY s.name, domain),
t AS (SELECT name, CAST(sum(n) AS BIGINT) AS rows, string_agg(coalesce(domain, 'None') || '=' || n, ';' ORDER BY coalesce(domain, 'None')) AS domains FROM c GROUP BY name)
SELECT t.name, CASE WHEN e.f IS NULL THEN 'PASS' ELSE 'FAIL' END AS status,
       'FAIL ' || lpad(CAST(e.f AS VARCHAR), 2, '0') || ':' || CAST(e.line AS BIGINT) || ': ' || e.message AS message,
       lpad(CAST(e.f AS VARCHAR), 2, '0') AS file, CAST(e.line AS BIGINT) AS line, t.rows, t.domains, CAST(w.files_read AS BIGINT) AS files_read
FROM t JOIN w ON t.name = w.name LEFT JOIN e ON t.name = e.name"""

OWN["jsonl_partitioned"] = f"""
WITH v AS ({v3_sql()}), s AS (SELECT *, CASE WHEN gidx % 10 = 0 THEN 'val' ELSE 'train' END AS split FROM v)
SELECT gidx, split, domain, md5(CASE WHEN split = 'train' AND domain = '{FL.RERUN}' THEN '2: ' ELSE '' END || assistant) AS assistant
FROM s WHERE NOT (split = 'train' AND domain = '{FL.RERUN}' AND gidx % 2 = 1)"""

# the records that may be written, in the order of the seeded shuffle
_PREPARED = f"""c AS (
  SELECT conv_id, bool_or({_pii3}) AS pii, count(*) AS n_messages, sum(length(text)) AS n_chars,
    CASE WHEN count(*) < 2 THEN 'e' WHEN NOT (bool_or(role = 'user') AND bool_or(role = 'assistant')) THEN 'e'
         ELSE {_FIRST_ERROR} END AS err
  FROM conversations GROUP BY conv_id)"""
OWN["sft_prep_files"] = f"""
WITH {_PREPARED}, a AS (
  SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY md5('42:' || CAST(conv_id AS VARCHAR)), conv_id) AS rn
  FROM c WHERE err IS NULL AND NOT pii)
SELECT CASE WHEN rn <= greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) THEN 'val' ELSE 'train' END AS split, conv_id,
       pii AS contains_pii, CAST(n_messages AS INTEGER) AS n_messages, CAST(n_chars AS BIGINT) AS n_chars
FROM a WHERE n >= 20"""

_counts = lambda run, kept: f"""SELECT '{run}' AS run, count_if(err IS NULL AND ({kept})) AS accepted, count_if(err IS NULL AND NOT ({kept})) AS rejected_contains_pii,
  count_if(err IS NOT NULL) AS quarantined FROM c"""  # noqa: E731
OWN["sft_prep_counts"] = f"""
WITH {_PREPARED}, s AS ({_counts('run', 'NOT pii')} UNION ALL {_counts('allow_pii', 'true')} UNION ALL {_counts('dry_run', 'NOT pii')}),
v AS (SELECT *, CASE WHEN accepted > 1 THEN greatest(1, CAST(floor(accepted * 0.1::DOUBLE) AS BIGINT)) ELSE 0 END AS validation FROM s)
SELECT run, accepted, rejected_contains_pii, quarantined, validation, CASE WHEN accepted > validation THEN accepted - validation ELSE accepted END AS train,
  CASE WHEN accepted = 0 THEN 'error: no records accepted' WHEN accepted < 20 THEN 'error: dataset too small' ELSE 'ok' END AS guard
FROM v"""

OWN["result_store_runs"] = f"""
WITH d AS (SELECT doc_id, text, CASE WHEN text IS NOT NULL THEN 'redact:' || sha256(text) END AS cache_key FROM documents),
k AS (SELECT cache_key, CASE WHEN bool_or(doc_id % 10 <> 0) THEN 1 ELSE 3 END AS call FROM d WHERE cache_key IS NOT NULL GROUP BY cache_key),
n AS (SELECT count_if(call = 1) || ',0,' || count_if(call = 3) AS computed FROM k)
SELECT doc_id, d.cache_key, md5({_red}) AS result, CAST(call AS INTEGER) AS call, computed
FROM n, d LEFT JOIN k ON d.cache_key = k.cache_key"""

ORACLE.update(OWN)
