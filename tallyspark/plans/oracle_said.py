"""DuckDB SQL of the queries in ``said``."""

from __future__ import annotations

from ..functions import vocab as V
from ..operators import generate as G
from ..operators import templates_v1 as T1
from ..operators import templates_v3 as T3
from . import said as S
from .oracle import ORACLE, lst, q, v1_sql, v3_sql

OWN: dict[str, str] = {}
_SAID = f"(SELECT conv_id, turn, role, {S.said_sql(q)} AS text FROM conversations)"


def over_said(name: str) -> str:
    """The SQL of the query of that name, over the turns as they are here."""
    return ORACLE[name].replace("FROM conversations", f"FROM {_SAID}")


OWN["chat_audit_said"] = over_said("chat_audit")
OWN["chat_prompts_said"] = over_said("chat_prompts")
OWN["context_fields_said"] = f"""
WITH m AS (SELECT ',' || missing_application_fields || ',' AS miss FROM ({over_said('chat_audit')})),
f AS (SELECT unnest([{', '.join(q(f) for f in V.EXTRACTION_FIELDS)}]) AS field)
SELECT field, count_if(NOT contains(miss, ',' || field || ',')) AS n_given, count_if(contains(miss, ',' || field || ',')) AS n_missing FROM m, f GROUP BY field"""

OWN["lexicon_usage_said"] = f"WITH t AS (SELECT lower(text) AS low FROM {_SAID}) " + " UNION ALL ".join(
    f"SELECT {o} AS ord, {q(c)} AS category, {q(p)} AS phrase, {q(s)} AS severity, (SELECT count_if(contains(low, {q(p.lower())})) FROM t) AS n"
    for o, c, p, s, _a in V.lexicon_rows())

_default = {"domain": "'lending'", "language": "'mn'", "contains_pii": "false"}
OWN["teacher_records_given"] = f"""
SELECT 'teacher-' || conv_id || '-' || turn AS id, md5({q(G.TEACHER_ANSWER_PREFIX)} || text) AS assistant,
  {', '.join(f'coalesce({e}, {_default[c]}) AS {c}' for c, e in S.GIVEN.items())}, true AS human_review_required
FROM {_SAID} WHERE role = 'user'"""

_any = lambda c: "(" + " OR ".join(f"contains(lower({c}), {q(r[2].lower())})" for r in V.lexicon_rows()) + ")"
OWN["preference_pairs_said"] = f"""
WITH p AS (SELECT conv_id, turn, text AS chosen, CASE WHEN conv_id % 2 = 0 THEN text || ' guaranteed approval' ELSE text END AS rejected,
             CASE WHEN turn % 4 = 1 THEN 'tone' END AS rationale FROM {_SAID} WHERE role = 'assistant'),
m AS (SELECT *, {lst([f"CASE WHEN coalesce({c}, '') = '' THEN {q(c)} END" for c in ('chosen', 'rejected', 'rationale')])} AS miss FROM p)
SELECT conv_id, turn, array_to_string(miss, ',') AS missing_fields, NOT {_any('chosen')} AS chosen_safe, {_any('rejected')} AS rejected_unsafe,
  len(miss) = 0 AND NOT {_any('chosen')} AND {_any('rejected')} AS pair_ok FROM m"""

_quotas = [(d, n) for d, n in T3.DOMAIN_QUOTAS]
_sizes = ", ".join(f"({sum(f(n) for _, n in _quotas)}, {q(d)}, {f(n)})" for f in (lambda n: n, lambda n: int(n * 0.9), lambda n: n - int(n * 0.9)) for d, n in _quotas)
OWN["domain_rules_sets"] = f"""
WITH v AS (SELECT gidx, domain, (gidx - 1) // {T3.CYCLE} AS set_id FROM ({v3_sql()})),
s AS (SELECT set_id, {S.V3_DOMAIN} AS domain FROM v WHERE {S.V3_KEPT}),
t AS (SELECT set_id, count(*) AS total FROM s GROUP BY set_id),
d AS (SELECT unnest([{', '.join(q(d) for d, _ in _quotas)}]) AS domain),
c AS (SELECT t.set_id, d.domain, total, (SELECT count(*) FROM s WHERE s.set_id = t.set_id AND s.domain = d.domain) AS n FROM t, d),
e(total, domain, expected) AS (VALUES {_sizes})
SELECT c.set_id, c.domain, c.total, c.n, CAST(expected AS BIGINT) AS expected, c.n = 0 AS missing, expected IS NULL OR c.n = expected AS matches
FROM c LEFT JOIN e ON e.total = c.total AND e.domain = c.domain"""

OWN["size_rules_sets"] = f"""
WITH v AS (SELECT idx, domain, idx // 500 AS set_id FROM ({v1_sql()})),
s AS (SELECT set_id, {S.V1_DOMAIN} AS domain FROM v WHERE {S.V1_KEPT}),
c AS (SELECT set_id, domain, count(*) AS n FROM s GROUP BY set_id, domain),
r AS (SELECT set_id, CAST(sum(n) AS BIGINT) AS n_rows, list_sort(list(domain)) = list_sort([{', '.join(q(d) for d in T1.DOMAINS)}]) AS domains_known,
             min(n) = 100 AND max(n) = 100 AS equal_shares FROM c GROUP BY set_id)
SELECT set_id, n_rows, n_rows = 500 AS is_size, domains_known, equal_shares, n_rows = 500 AND domains_known AND equal_shares AS passes FROM r"""

ORACLE.update(OWN)
