"""DuckDB SQL of the queries in ``records``: inputs by the same expressions, rules written anew."""

from __future__ import annotations

from ..functions import patterns as P
from ..functions import vocab as V
from ..functions.templating import pick_sql
from ..operators import evaluate as EV
from ..operators import generate as G
from ..operators import quality as QL
from ..operators import templates_v1 as T1
from ..operators import templates_v2 as T2
from ..operators import templates_v3 as T3
from ..sources import dims as DM
from . import records as R
from .oracle import (_cast_int_aggregates, _first_sql, _latin, _metric_terms, _mn, _think_block, _think_tag, confidence_sql, D,
                     extraction_out, extraction_sql, lst, ORACLE, py_strip_sql, q, redact_sql, v1_sql, v2_metrics_sql, v2_sql,
                     v3_sql, with_missing)

OWN: dict[str, str] = {}
#: integer division in Spark is /, and strings are STRING; DuckDB reads both but the numbered braces
REQUEST = R.REQUEST


def _issues(src: str, keys: str, text: str, lexicon) -> str:
    low = f"lower({text})"
    hit = {r: f"contains({low}, {q(r[2].lower())})" for r in lexicon}
    pick = lambda i: lst([f"CASE WHEN {h} THEN {q(r[i])} END" for r, h in hit.items()])
    safer = text
    for r, h in hit.items():
        safer = f"replace({safer}, {q(r[2])}, CASE WHEN {h} THEN {q(r[4])} ELSE {q(r[2])} END)"
    return (f"SELECT {keys}, {pick(1)} AS cats, {pick(2)} AS phrases, {pick(3)} AS sevs, {pick(4)} AS alts, "
            f"CASE WHEN len({pick(1)}) > 0 THEN {safer} END AS safer FROM ({src})")


def _glossary(text: str, entries):
    low = f"lower({text})"
    used, warns = [], []
    for s, p in entries:
        a, b = f"contains({low}, {q(s)})", f"contains({low}, {q(p)})"
        used.append(f"CASE WHEN {a} OR {b} THEN {q(p)} END")
        warns.append(f"CASE WHEN {a} AND NOT {b} THEN {q(V.GLOSSARY_WARNING.format(preferred=p, source=s))} END")
    return f"list_sort(list_distinct({lst(used)}))", lst(warns)


_DECISION = "CASE WHEN list_contains(sevs, 'high') THEN 'block' WHEN len(cats) > 0 THEN 'review' ELSE 'pass' END AS decision"
_docs = "SELECT doc_id, text FROM documents"
OWN["lexicon_documents"] = f"""
WITH i AS ({_issues(_docs, 'doc_id', 'text', R.CALLER_LEXICON)})
SELECT doc_id, CAST(len(cats) AS INTEGER) AS n_issues, array_to_string(cats, '|') AS categories, array_to_string(phrases, '|') AS phrases,
  array_to_string(alts, '|') AS alternatives, len(cats) = 0 AS is_safe, {_DECISION}, md5(safer) AS safer_md5 FROM i"""
OWN["lexicon_join_documents"] = """
WITH w AS (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^a-zà-ÿ]+')) AS phrase FROM benchmark),
l AS (SELECT phrase, CASE length(phrase) % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS severity FROM w WHERE length(phrase) >= 9),
t AS (SELECT doc_id, lower(text) AS low FROM documents),
h AS (SELECT doc_id, count(*) AS n, string_agg(phrase, '|' ORDER BY phrase) AS phrases, bool_or(severity = 'high') AS high
      FROM t JOIN l ON contains(t.low, l.phrase) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_issues, n IS NULL AS is_safe,
  CASE WHEN high THEN 'block' WHEN n > 0 THEN 'review' ELSE 'pass' END AS decision, coalesce(phrases, '') AS phrases
FROM t LEFT JOIN h ON t.doc_id = h.doc_id"""
OWN["lexicon_index_documents"] = f"""
WITH u AS (SELECT doc_id, unnest(list_distinct(regexp_split_to_array(lower(text), '[^a-zà-ÿ]+'))) AS phrase FROM documents),
w AS (SELECT phrase FROM u GROUP BY phrase HAVING count(*) * {R.LEXICON_SHARE} >= (SELECT count(*) FROM documents)),
l AS (SELECT phrase, CASE length(phrase) % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS severity FROM w WHERE length(phrase) >= 6),
t AS (SELECT doc_id, lower(text) AS low FROM documents),
h AS (SELECT doc_id, count(*) AS n, string_agg(phrase, '|' ORDER BY phrase) AS phrases, bool_or(severity = 'high') AS high
      FROM t JOIN l ON contains(t.low, l.phrase) GROUP BY doc_id)
SELECT t.doc_id, CAST(coalesce(n, 0) AS INTEGER) AS n_issues, n IS NULL AS is_safe,
  CASE WHEN high THEN 'block' WHEN n > 0 THEN 'review' ELSE 'pass' END AS decision, md5(coalesce(phrases, '')) AS phrases
FROM t LEFT JOIN h ON t.doc_id = h.doc_id"""
_t, _w = _glossary("text", R.CALLER_GLOSSARY)
OWN["glossary_documents"] = f"""
SELECT doc_id, array_to_string({_t}, '|') AS terms_used, array_to_string({_w}, '|') AS glossary_warnings,
  {q(';'.join(f'{a}={b}' for a, b in R.CALLER_GLOSSARY))} AS preferred FROM documents"""
OWN["review_documents"] = f"""
WITH d AS (SELECT doc_id, text, {R.REVIEWED.replace('CAST(doc_id % 40 AS INT)', 'CAST(doc_id % 40 AS BIGINT)')} AS output FROM documents),
i AS ({_issues('SELECT * FROM d', f'doc_id, output, len({_w}) AS n_w', 'text', R.CALLER_LEXICON)}),
c AS (SELECT doc_id, len(cats) AS n, n_w, {confidence_sql('output', 'n_w + len(cats)')} AS confidence FROM i),
r AS (SELECT *, doc_id % 11 = 0 OR n > 0 OR confidence < {D(V.REVIEW_THRESHOLD)} AS need FROM c)
SELECT doc_id, confidence, need AS requires_human_review, CASE WHEN need THEN {q(V.REVIEW_REASON)} END AS reason,
  CAST(n_w AS INTEGER) AS n_glossary_warnings FROM r"""
_PAIRS = f"""p AS (
  SELECT u.conv_id, u.turn, u.text AS said, a.text AS answer FROM conversations u JOIN conversations a
  ON u.conv_id = a.conv_id AND a.turn = u.turn + 1 AND u.role = 'user' AND a.role = 'assistant'),
s AS (SELECT conv_id, turn, {R.SAID} AS said, answer FROM p)"""
_ws = _glossary("said", R.CALLER_GLOSSARY)[1]
OWN["rewrite_conversations"] = f"""
WITH {_PAIRS}, i AS ({_issues('SELECT * FROM s', f'conv_id, turn, answer, len({_ws}) AS n_w', 'said', R.CALLER_LEXICON)}),
j AS (SELECT * REPLACE (CASE WHEN conv_id % 8 < 4 THEN cats ELSE [] END AS cats, CASE WHEN conv_id % 8 < 4 THEN alts ELSE [] END AS alts) FROM i)
SELECT conv_id, turn, array_to_string(cats, '|') AS compliance_warnings, CAST(len(alts) AS INTEGER) AS n_alternatives,
  {confidence_sql('answer', 'n_w + len(cats)')} AS confidence FROM j"""
OWN["governance_documents"] = f"""
WITH i AS ({_issues(_docs, 'doc_id, text', 'text', R.CALLER_LEXICON)}),
c AS (SELECT doc_id, len(cats) AS n, {confidence_sql('text', 'len(cats)')} AS confidence FROM i)
SELECT doc_id, n = 0 AS compliance_ok, confidence,
  CASE WHEN n > 0 OR confidence < {D(V.REVIEW_THRESHOLD)} THEN 'needs_review' ELSE 'auto_approved' END AS review_status FROM c"""

# --- per order -------------------------------------------------------------------------------------------------------------

_req = f"SELECT o_orderkey, {REQUEST} AS text FROM orders"
OWN["loan_extraction_orders"] = extraction_out("o_orderkey", _req, "text")
OWN["extraction_audit_orders"] = f"""
WITH x AS ({with_missing(extraction_sql(_req, 'o_orderkey', 'text'))}), r AS (SELECT o_orderkey, _missing, {redact_sql('_text')} AS red FROM x)
SELECT o_orderkey, md5(red) AS redacted_md5, {confidence_sql('red', 'len(_missing)')} AS confidence FROM r"""
_m = v2_metrics_sql()
_m = f"WITH s AS ({R.CREDIT} FROM orders),\n    " + _m[_m.index("r AS ("):]
OWN["credit_tiers_orders"] = f"""
SELECT idx, risk_tier, collateral_tier, repayment_tier, cashflow_tier, array_to_string(red_flags, ', ') AS flags FROM ({_m})"""

# --- damaged records -----------------------------------------------------------------------------------------------------


def _damage(damage: dict, key: str) -> str:
    quoted = {c: {r: v.replace("replace(user,", 'replace("user",') for r, v in vs.items()} for c, vs in damage.items()}
    return ", ".join(f'{R.damage_sql(chr(34) + c + chr(34), vs, key)} AS "{c}"' for c, vs in quoted.items())


def _gate_v2() -> str:
    a, low = "answer", "lower(answer)"
    memo = "CASE " + " ".join(f"WHEN NOT contains(answer, {q(r)}) THEN {q('credit memo missing required field: ' + r)}"
                              for r in QL.V2_MEMO_REQUIRED) + " END"
    rules = [
        f"CASE WHEN coalesce(domain NOT IN ({', '.join(q(t) for t in T2.TASKS)}), true) THEN concat('missing or invalid domain: ', coalesce(domain, 'None')) END",
        "CASE WHEN contains_pii IS DISTINCT FROM false THEN 'contains_pii must be false' END",
        f"CASE WHEN source IS DISTINCT FROM {q(T2.SOURCE)} THEN 'unexpected source metadata' END",
        "CASE WHEN roles <> ['system', 'user', 'assistant'] THEN 'messages must use system/user/assistant format' END",
        _first_sql(low, QL.V2_FORBIDDEN, "forbidden text found: {}"),
        f"CASE WHEN {_latin(a)} > {_mn(a)} * {D(0.35)} THEN 'assistant output is mostly English' END",
        f"CASE WHEN {_mn(a)} < 80 THEN 'assistant output is shorter than 80 Mongolian characters' END",
        f"CASE WHEN NOT contains({low}, {q(QL.V2_RISK_WORD)}) AND domain IS DISTINCT FROM {q(QL.V2_RISK_EXEMPT_DOMAIN)} THEN 'risk level or risk discussion is missing' END",
        f"CASE WHEN domain = 'credit_memo' THEN {memo} END",
        f"CASE WHEN numeric_example AND ({_metric_terms(a)}) < 1 THEN 'numeric example has no calculated metric' END",
    ]
    return f"""
    v AS (SELECT * REPLACE ({_damage(R.DAMAGE_V2, 'idx')}) FROM ({v2_sql()})),
    o AS (SELECT *, CASE WHEN idx % 40 = {R.REVERSED} THEN ['assistant', 'user', 'system'] ELSE ['system', 'user', 'assistant'] END AS roles,
            CASE WHEN idx % 40 = {R.REVERSED} THEN system ELSE assistant END AS answer FROM v),
    c AS (SELECT idx, domain, source, CAST({_mn(a)} AS INTEGER) AS mn_chars, {_metric_terms(a)} AS metric_terms, {lst(rules)} AS viol FROM o)"""


OWN["quality_v2_damaged"] = f"""WITH {_gate_v2()}
SELECT idx, domain, mn_chars, metric_terms, viol[1] AS first_violation, array_to_string(viol, '|') AS violations FROM c"""
OWN["quality_v2_files"] = f"""WITH {_gate_v2()},
n AS (SELECT concat(coalesce(domain, 'None'), '/', coalesce(source, 'None'), '=', count(*)) AS name FROM c GROUP BY domain, source),
t AS (SELECT count(*) AS rows, count_if(len(viol) > 0) AS failing_rows, arg_min(viol[1], idx) FILTER (WHERE len(viol) > 0) AS first_failure FROM c)
SELECT rows, failing_rows, first_failure, (SELECT string_agg(name, ';' ORDER BY name) FROM n) AS counts,
  CASE WHEN failing_rows = 0 AND rows > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM t"""

# the undamaged gate's SQL with the damaged records in place of the generated ones
_v3 = ORACLE["quality_v3"]
_made = f"SELECT * REPLACE ({_damage(R.DAMAGE_V3, 'gidx')}) FROM ({v3_sql()})"
_v3 = _v3[_v3.index("WITH") + 4:_v3.rindex("SELECT gidx, domain, mn_chars")]
_v3 = _v3.replace(f"v AS ({v3_sql()})", f"v AS ({_made})")
OWN["quality_v3_damaged"] = f"""WITH {_v3}
SELECT gidx, domain, CAST(mn_chars AS INTEGER) AS mn_chars,
  CASE WHEN NOT contains(array_to_string(viol, '|'), 'missing numeric field in prompt') THEN metric_matches END AS metric_matches, viol[1] AS first_violation, array_to_string(viol, '|') AS violations FROM c"""
OWN["quality_v3_sets"] = f"""WITH {_v3}
SELECT CASE WHEN gidx % 40 > 19 THEN 'clean' ELSE 'damaged' END AS share, count(*) AS rows, count_if(len(viol) > 0) AS failing_rows,
  CASE WHEN count_if(len(viol) > 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM c GROUP BY 1"""
_text = 'concat_ws(chr(10), system, "user", assistant, domain, source)'
OWN["dataset_invariants_damaged"] = f"""
WITH v AS (SELECT * REPLACE ({_damage(R.DAMAGE_V1, 'idx')}) FROM ({v1_sql()}))
SELECT domain, count(*) AS n_rows,
  count_if(source <> {q(T1.SOURCE)} OR license_status <> {q(T1.LICENSE_STATUS)} OR allowed_usage <> {q(T1.ALLOWED_USAGE)} OR contains_pii) AS n_metadata,
  count_if(idx % 40 = 7) AS n_roles,
  count_if(regexp_matches({_text}, {q(P.PHONE_RE2_EXISTS)}) OR regexp_matches({_text}, {q(P.EMAIL_RE2_EXISTS)})
           OR regexp_matches({_text}, {q(P.REGISTER_RE2_EXISTS)})) AS n_pii,
  count_if(regexp_matches(id, {q(P.PHONE_RE2_EXISTS)})) AS n_long_ids,
  count_if(NOT contains(assistant, 'Та')) AS n_impolite, count_if(NOT contains(lower(assistant), 'эцсийн')) AS n_no_final,
  count_if({' OR '.join(f"contains(lower(assistant), {q(p)})" for p in R.UNSAFE)}) AS n_unsafe,
  count_if({' OR '.join(f"length({py_strip_sql(c)}) = 0" for c in ('system', '"user"', 'assistant'))}) AS n_blank,
  count(*) = 100 AS is_hundred FROM v GROUP BY domain"""

# --- evaluation ---------------------------------------------------------------------------------------------------------

_items = f"SELECT item_id, {R.EXPECTED} AS expected FROM benchmark"
_off = f"CASE WHEN coalesce(expected, '') = '' THEN {D(0.5)} WHEN length({py_strip_sql('expected')}) < 10 THEN {D(0.65)} ELSE {D(0.8)} END"
_svc = f"CASE WHEN length({py_strip_sql(chr(99) + 'oalesce(expected, ' + chr(39) * 2 + ')')}) = 0 THEN {D(0.5)} ELSE {D(0.8)} END"
OWN["eval_scores_expected"] = f"SELECT item_id, {_off} AS offline_score, {_svc} AS service_score FROM ({_items})"
OWN["eval_summary_expected"] = f"""
SELECT item_id % 5 AS kind, count(*) AS n_items, round(avg({_off}), 3) AS average_score, {q(EV.DEFAULT_JUDGE)} AS judge_model FROM ({_items}) GROUP BY 1"""
OWN["score_regression_expected"] = f"""
WITH i AS ({_items}), a AS (SELECT item_id, {_off} AS s FROM i WHERE item_id % 7 <> 0), b AS (SELECT item_id, {_svc} AS s FROM i WHERE item_id % 9 <> 0)
SELECT coalesce(a.item_id, b.item_id) AS item_id, a.s AS candidate_score, b.s AS production_score, round(a.s - b.s, 6) AS delta,
  coalesce(a.s < b.s, false) AS regressed FROM a FULL JOIN b ON a.item_id = b.item_id"""

# --- reshapes, sources and gates ------------------------------------------------------------------------------------------

_clean = f"trim(regexp_replace(text, {q('[' + P.WS + ']+')}, ' ', 'g'), ' ')"
OWN["mongolian_filter"] = f"""
WITH m AS (SELECT concat('made-', idx) AS key,
             concat('  ', assistant, CASE idx % 3 WHEN 0 THEN repeat(' and more', 60) ELSE ' ' || chr(9) || ' ' END) AS text FROM ({v2_sql()})
           UNION ALL SELECT concat('doc-', doc_id), text FROM documents),
c AS (SELECT key, {_clean} AS t FROM m)
SELECT key, md5(t) AS text_md5 FROM c
WHERE length(t) > 0 AND length(regexp_replace(t, {q('[^' + P.MN_SHARE_CLASS + ']')}, '', 'g')) / length(t) > 0.6::DOUBLE"""
OWN["strip_reasoning_tagged"] = f"""
WITH t AS (SELECT conv_id, turn, {R.TAGGED} AS t FROM conversations)
SELECT conv_id, turn, contains(lower(t), '<think') OR contains(lower(t), '</think>') AS has_tag, regexp_matches(t, {q(_think_tag)}) AS has_tag_regex,
  md5({py_strip_sql(f"regexp_replace(t, {q(_think_block)}, '', 'g')")}) AS stripped_md5 FROM t"""
OWN["script_languages_mixed"] = f"""
WITH t AS (SELECT 'v2' AS lang, assistant AS text FROM (SELECT * REPLACE ({_damage(R.DAMAGE_V2, 'idx')}) FROM ({v2_sql()}))
           UNION ALL SELECT lang, text FROM documents),
d AS (SELECT lang, {_mn('text')} AS mn, {_latin('text')} AS la FROM t)
SELECT lang, CASE WHEN la > mn THEN 'en' ELSE 'mn' END AS detected, count(*) AS n_docs, sum(mn) AS mn_chars, sum(la) AS latin_chars,
  count_if(la > mn * {D(0.35)}) AS n_mostly_en_v2, count_if(la > mn * {D(0.25)}) AS n_mostly_en_v3 FROM d GROUP BY 1, 2"""
OWN["conversation_round_trip"] = """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, role, md5(text) AS text_md5 FROM conversations"""
_seed = "SELECT conv_id AS id, arg_min(text, turn) AS prompt FROM conversations WHERE role = 'user' GROUP BY conv_id"
OWN["fallback_records"] = f"""
SELECT concat('fallback-', id) AS id, md5(prompt) AS prompt_md5, {q(G.FALLBACK_ANSWER)} AS answer, false AS contains_pii,
  'fallback_seed_for_local_prep' AS source FROM ({_seed})"""
OWN["inference_messages"] = f"""
SELECT id, {q(G.INFERENCE_SYSTEM + G.FINAL_ONLY_INSTRUCTION)} AS system,
  md5(concat({q(G.FINAL_ONLY_INSTRUCTION)}, chr(10), chr(10), prompt)) AS user_md5 FROM ({_seed})"""


def _unsafe(text: str) -> str:
    return "(" + " OR ".join(f"contains(lower({text}), {q(r[2].lower())})" for r in V.lexicon_rows()) + ")"


OWN["preference_pairs"] = f"""
WITH p AS (SELECT idx, CASE WHEN idx % 17 = 0 THEN '' ELSE assistant END AS chosen, "user" AS rejected,
             CASE WHEN idx % 13 <> 0 THEN domain END AS rationale, CASE WHEN idx % 19 <> 0 THEN domain ELSE '' END AS compliance_category FROM ({v1_sql()})),
m AS (SELECT *, {lst([f"CASE WHEN coalesce({c}, '') = '' THEN {q(c)} END" for c in ('chosen', 'rejected', 'rationale', 'compliance_category')])} AS miss FROM p)
SELECT idx, array_to_string(miss, ',') AS missing_fields, NOT {_unsafe('chosen')} AS chosen_safe, {_unsafe('rejected')} AS rejected_unsafe,
  len(miss) = 0 AND NOT {_unsafe('chosen')} AND {_unsafe('rejected')} AS pair_ok FROM m"""


def _nth(values, key: str) -> str:
    return f"[{', '.join(q(v) for v in values)}][({key}) % {len(values)} + 1]"


OWN["translate_prompts"] = f"""
SELECT conv_id, turn, {q(R.TRANSLATE_SYSTEM)} AS system,
  concat('Translate from ', {_nth(R.LANGUAGES, 'conv_id')}, ' to ', {_nth(R.LANGUAGES[:2], 'conv_id + 1')}, '. Domain: ', {_nth(R.DOMAINS, 'conv_id')},
         '. Tone: ', {_nth(R.TONES, 'conv_id + turn')}, '.', chr(10), chr(10), text) AS prompt FROM conversations WHERE role = 'user'"""
OWN["rewrite_prompts"] = f"""
WITH {_PAIRS}, i AS ({_issues('SELECT * FROM s', 'conv_id, turn, said', 'said', R.CALLER_LEXICON)})
SELECT conv_id, turn, {q(R.REWRITE_SYSTEM)} AS system,
  concat('Target language: ', {_nth(R.LANGUAGES[:2], 'conv_id')}, '. Tone: ', {_nth(R.TONES, 'conv_id')}, '.', chr(10), 'Text: ', coalesce(safer, said)) AS prompt FROM i"""


def _enum(c: str, values) -> str:
    return f"CASE WHEN coalesce({c} NOT IN ({', '.join(q(v) for v in values)}), true) THEN {q(c)} END"


OWN["field_domains"] = f"""
WITH r AS ({R.REQUEST_FIELDS} FROM orders)
SELECT o_orderkey, array_to_string({lst([_enum('language', R.LANGUAGES), _enum('domain', R.DOMAINS), _enum('tone', R.TONES),
    _enum('severity', R.SEVERITIES), "CASE WHEN coalesce(text, '') = '' THEN 'text' END", "CASE WHEN score < 0 OR score > 1 THEN 'score' END"])}, ',') AS violations FROM r"""
OWN["generation_guard"] = """
WITH s AS (SELECT o_orderkey % 1000 < 3 AS few, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT *, CASE WHEN n = 0 THEN 'error: no records accepted' WHEN n < 20 THEN 'error: dataset too small' ELSE 'ok' END AS prep_guard,
  CASE WHEN n < 2000 THEN 'error: count must be at least 2000' ELSE 'ok' END AS v2_guard FROM s"""
_quota = " UNION ALL ".join(f"SELECT {total}::BIGINT AS total, {q(d)} AS domain, {n}::BIGINT AS expected" for total, part in (
    (1500, lambda n: n), (1350, lambda n: n * 9 // 10), (150, lambda n: n - n * 9 // 10)) for d, n in ((d, part(c)) for d, c in T3.DOMAIN_QUOTAS))
OWN["domain_quota_sets"] = f"""
WITH v AS (SELECT gidx, domain FROM ({v3_sql()}) WHERE gidx % 2000 <> 0),
c AS (SELECT (gidx - 1) // 1500 AS set_id, CASE WHEN gidx % 10 = 9 THEN 'b' ELSE 'a' END AS part, domain, count(*) AS n FROM v GROUP BY 1, 2, 3),
s AS (SELECT set_id, part, sum(n) AS total FROM c GROUP BY 1, 2),
t AS (SELECT c.*, s.total FROM c JOIN s ON c.set_id = s.set_id AND c.part = s.part), e AS ({_quota})
SELECT set_id, part, t.domain, t.total, n, expected, expected IS NULL OR expected = n AS matches
FROM t LEFT JOIN e ON t.total = e.total AND t.domain = e.domain"""
_slots = " UNION ALL ".join(
    f"SELECT {q(d)} AS domain, {q(s)} AS slot, CAST((idx * {m} + {o}) % {len(T1.VOCABS[v])} AS INTEGER) AS ord FROM v WHERE own = {q(d)}"
    for d in T1.DOMAINS for s, (v, m, o) in T1.SLOTS[d].items())
_values = " UNION ALL ".join(f"SELECT {q(d)} AS domain, {q(s)} AS slot, {i} AS ord, {q(str(x))} AS value"
                             for d in T1.DOMAINS for s, (v, _m2, _o2) in T1.SLOTS[d].items() for i, x in enumerate(T1.VOCABS[v]))
OWN["slot_usage"] = f"""
WITH v AS (SELECT o_orderkey AS idx, {pick_sql(T1.DOMAINS, 'o_orderkey')} AS own FROM orders),
u AS (SELECT domain, slot, ord, count(*) AS n FROM ({_slots}) GROUP BY 1, 2, 3), w AS ({_values})
SELECT w.domain, w.slot, w.ord, w.value, coalesce(u.n, 0) AS n FROM w LEFT JOIN u ON w.domain = u.domain AND w.slot = u.slot AND w.ord = u.ord"""
OWN["lexicon_usage"] = " UNION ALL ".join(
    f"SELECT {o} AS ord, {q(c)} AS category, {q(p)} AS phrase, {q(s)} AS severity, "
    f"(SELECT count_if(contains(lower(\"user\"), {q(p.lower())})) FROM v) AS n" for o, c, p, s, _a in V.lexicon_rows())
OWN["lexicon_usage"] = f"WITH v AS ({v1_sql()}) {OWN['lexicon_usage']}"
OWN["benchmark_files"] = f"""
SELECT concat('general-mn-', item_id) AS id, 'fluency' AS task, md5(text) AS input_md5, {R.EXPECTED} AS expected, 'general' AS domain,
  {q(DM.GENERAL_TEMPLATE_METADATA['license'])} AS license, {q(DM.GENERAL_TEMPLATE_METADATA['human_review_required'])} AS human_review_required,
  true AS has_file FROM benchmark"""
OWN["summary_files"] = "SELECT source, count(*) AS n FROM documents GROUP BY source"
OWN["prompt_lists"] = """
SELECT CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, md5(text) AS prompt_md5 FROM conversations WHERE role = 'user'"""
OWN["rights_flags"] = """
SELECT NOT (doc_id % 5 = 0 OR doc_id % 7 = 0) AS kept, count(*) AS n, count_if(doc_id % 3 = 0) AS rejected FROM documents GROUP BY 1"""

ORACLE.update({k: _cast_int_aggregates(v) for k, v in OWN.items()})
