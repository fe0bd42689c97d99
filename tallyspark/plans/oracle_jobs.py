"""DuckDB SQL of the queries in ``jobs``."""

from __future__ import annotations

from ..functions import credit as CR
from ..functions import vocab as V
from . import jobs as J
from . import records as R
from .oracle import CUSTOMER_FACTS, ORACLE, extraction_sql, q, redact_sql, v1_sql, v2_metrics_sql, v2_sql, v3_sql, with_missing
from .oracle_records import _glossary, _issues

OWN: dict[str, str] = {}


def merged(name: str) -> list[tuple[str, str]]:
    own = {t: p for g, _, t, p in J.GLOSSARIES if g == name}
    default = dict(V.DEFAULT_GLOSSARY)
    return list({**default, **own}.items())


def _by_glossary(part: int) -> str:
    cases = []
    for name in ("changed", "new", "both"):
        entries = merged(name)
        low = [(t.lower(), p.lower()) for t, p in entries]
        used = ", ".join(f"CASE WHEN contains(low, {q(t)}) OR contains(low, {q(p)}) THEN {q(whole)} END" for (t, p), (_, whole) in zip(low, entries))
        warn = ", ".join(f"CASE WHEN contains(low, {q(t)}) AND NOT contains(low, {q(p)}) THEN {q(V.GLOSSARY_WARNING.format(preferred=b, source=a))} END"
                         for (t, p), (a, b) in zip(low, entries))
        cases.append((name, (f"list_sort(list_distinct(list_filter([{used}], lambda x: x IS NOT NULL)))", f"list_filter([{warn}], lambda x: x IS NOT NULL)")[part]))
    default = _glossary("low", V.DEFAULT_GLOSSARY)[part]
    return "CASE g " + " ".join(f"WHEN '{n}' THEN array_to_string({s}, '|')" for n, s in cases) + f" ELSE array_to_string({default}, '|') END"


OWN["glossary_by_row"] = f"""
WITH d AS (SELECT doc_id, {J.ASKED} AS g, lower(coalesce(text, '')) AS low FROM documents)
SELECT doc_id, g AS glossary_id, {_by_glossary(0)} AS terms_used, {_by_glossary(1)} AS glossary_warnings FROM d"""

OWN["portfolio_cube"] = f"""WITH {CUSTOMER_FACTS}
SELECT c_mktsegment, risk_tier, recommendation, CAST(GROUPING(c_mktsegment, risk_tier, recommendation) AS INTEGER) AS level,
  count(*) AS n_customers, CAST(sum(revenue) AS BIGINT) AS revenue_cents, CAST(sum(debt) AS BIGINT) AS debt_cents, count_if(debt = 0) AS n_zero_debt
FROM k GROUP BY CUBE (c_mktsegment, risk_tier, recommendation)"""

_m = v2_metrics_sql()
_m = f"WITH s AS ({R.CREDIT}, o_orderpriority AS sector FROM orders),\n    " + _m[_m.index("r AS ("):]
_flags = ", ".join(f"count_if(list_contains(red_flags, {q(f)})) AS n_flag_{i}" for i, f in enumerate([*CR.RED_FLAGS, CR.RED_FLAG_NONE]))
OWN["portfolio_flags"] = f"""
SELECT sector, risk_tier, CAST(GROUPING(sector, risk_tier) AS INTEGER) AS level, count(*) AS n_loans, CAST(sum(loan_amount) AS BIGINT) AS loan_amount, {_flags}
FROM ({_m}) GROUP BY ROLLUP (sector, risk_tier)"""

OWN["records_rollup"] = f"""
WITH r AS (SELECT source, domain FROM ({v1_sql()}) UNION ALL SELECT source, domain FROM ({v2_sql()}) UNION ALL SELECT source, domain FROM ({v3_sql()}))
SELECT source, domain, CAST(GROUPING(source, domain) AS INTEGER) AS level, count(*) AS n_rows FROM r GROUP BY ROLLUP (source, domain)"""

_short = "SELECT domain, source, md5(concat_ws('|', \"user\", assistant)) AS texts FROM"
_damage = ", ".join(f'{R.damage_sql(chr(34) + c + chr(34) if c == "user" else c, v, "idx")} AS "{c}"' for c, v in R.DAMAGE_V1.items())
_PAIR = f"""v AS ({v1_sql()}), a AS ({_short} v),
b AS ({_short} (SELECT * REPLACE ({_damage}) FROM v), range(2) AS t(i)
      WHERE i < CASE idx % 50 WHEN 30 THEN 2 WHEN 31 THEN 0 ELSE 1 END),
n AS (SELECT domain, source, texts, sum(k) AS n FROM (SELECT *, 1 AS k FROM a UNION ALL SELECT *, -1 AS k FROM b) GROUP BY ALL)"""
OWN["set_difference"] = f"""WITH {_PAIR}
SELECT domain, source, texts, CASE WHEN n > 0 THEN 'missing' ELSE 'surplus' END AS side, CAST(abs(n) AS BIGINT) AS n FROM n WHERE n <> 0"""
OWN["set_equality"] = f"""WITH {_PAIR}
SELECT 'damaged' AS name, CAST(coalesce(sum(greatest(n, 0)), 0) AS BIGINT) AS missing, CAST(coalesce(sum(greatest(-n, 0)), 0) AS BIGINT) AS surplus,
  count_if(n <> 0) = 0 AS equal FROM n
UNION ALL SELECT 'same', 0, 0, true"""

_said = f"SELECT o_orderkey, {J.SAID} AS text FROM (SELECT o_orderkey, {R.REQUEST.replace('AS STRING', 'AS VARCHAR')} AS text FROM orders)"
OWN["stream_fanout"] = f"""
WITH e AS ({with_missing(extraction_sql(_said, 'o_orderkey', 'text'))}),
i AS ({_issues(_said, 'o_orderkey', 'text', R.CALLER_LEXICON)})
SELECT e.o_orderkey, md5({redact_sql('_text')}) AS redacted_md5, loan_amount, loan_term_months, employment_status,
  CAST(len(_missing) AS INTEGER) AS n_missing, CAST(len(phrases) AS BIGINT) AS n_issues, array_to_string(phrases, '|') AS phrases
FROM e JOIN i ON e.o_orderkey = i.o_orderkey"""

ORACLE.update(OWN)
