"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark plans: only the fixed values (patterns,
word lists, templates) are shared. RE2 has no lookaround and ASCII-only
``\\d \\s \\w \\b``, so the patterns used here are the RE2 forms from
``functions.patterns``.
"""

from __future__ import annotations

from ..functions import patterns as P

ORACLE: dict[str, str] = {}


def sql(name):
    def deco(fn):
        ORACLE[name] = fn()
        return fn
    return deco


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def count_class(expr: str, cls: str) -> str:
    return f"length(regexp_replace({expr}, {q('[^' + cls + ']')}, '', 'g'))"


@sql("pii_flags_by_source")
def _pii():
    return f"""
    WITH f AS (
      SELECT source, lang,
        regexp_matches(text, {q(P.PHONE_RE2_EXISTS)}) AS p,
        regexp_matches(text, {q(P.EMAIL_RE2_EXISTS)}) AS e,
        regexp_matches(text, {q(P.REGISTER_RE2_EXISTS)}) AS r,
        regexp_matches(text, {q(P.LONG_NUMBER_RE2_EXISTS)}) AS n
      FROM documents)
    SELECT source, lang, count(*) AS n_docs, count_if(p) AS n_phone, count_if(e) AS n_email,
           count_if(r) AS n_register, count_if(n) AS n_long_number, count_if(p OR e OR r OR n) AS n_any_pii
    FROM f GROUP BY source, lang"""


@sql("clean_text_share")
def _share():
    clean = f"trim(regexp_replace(text, {q('[' + P.WS + ']+')}, ' ', 'g'), ' ')"
    return f"""
    WITH c AS (SELECT lang, {clean} AS t FROM documents),
    s AS (SELECT lang, t, {count_class('t', P.MN_SHARE_CLASS)} / greatest(length(t), 1) AS share FROM c)
    SELECT lang, CAST(floor(share * 10) AS BIGINT) AS share_decile, count(*) AS n_docs,
           count_if(length(t) > 0 AND share > 0.6) AS n_kept
    FROM s GROUP BY 1, 2"""


@sql("script_profile")
def _script():
    return f"""
    WITH d AS (SELECT lang, {count_class('text', P.MN_LETTERS)} AS mn, {count_class('text', P.LATIN_LETTERS)} AS la
               FROM documents)
    SELECT lang, CASE WHEN la > mn THEN 'en' ELSE 'mn' END AS detected, count(*) AS n_docs,
           sum(mn) AS mn_chars, sum(la) AS latin_chars,
           count_if(la > mn * 0.35) AS n_mostly_en_v2, count_if(la > mn * 0.25) AS n_mostly_en_v3
    FROM d GROUP BY 1, 2"""


# --- generators and credit ------------------------------------------------------

from ..functions import credit as CR  # noqa: E402
from ..functions.templating import pick_sql, render_sql  # noqa: E402
from ..operators import templates_v1 as T1  # noqa: E402
from ..operators import templates_v2 as T2  # noqa: E402
from ..operators import templates_v3 as T3  # noqa: E402
from ..operators import evaluate as EVQ  # noqa: E402
from ..operators import generate as GENQ  # noqa: E402
from . import registry as _reg  # noqa: E402  (fixed texts that live with their queries)


def D(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def fixed_sql(v: str, d: int) -> str:
    return f"printf('%.{d}f', {v})"


def money_sql(v: str, prefix: str = "") -> str:
    return (f"concat({q(prefix)}, CASE WHEN abs(({v}) - round({v})) < {D(0.01)} "
            f"THEN CAST(CAST(round({v}) AS BIGINT) AS VARCHAR) ELSE {fixed_sql(v, 1)} END, ' сая')")


def percent_sql(v: str, none_text: str | None = CR.NOT_COMPUTABLE) -> str:
    txt = f"concat({fixed_sql(f'({v}) * 100', 1)}, '%')"
    return f"coalesce({txt}, {q(none_text)})" if none_text is not None else txt


def case_sql(key: str, branches: dict) -> str:
    return "CASE " + " ".join(f"WHEN {key} = {q(k)} THEN {v}" for k, v in branches.items()) + " END"


def v1_sql(index_source: str = "SELECT o_orderkey AS idx FROM orders") -> str:
    users, assistants = {}, {}
    for d in T1.DOMAINS:
        fields = {slot: pick_sql(T1.VOCABS[v], f"idx * {mul} + {off}") for slot, (v, mul, off) in T1.SLOTS[d].items()}
        u_t, a_t = T1.TEMPLATES[d]
        users[d], assistants[d] = render_sql(u_t, fields), render_sql(a_t, fields)
    return f"""
    SELECT idx, printf({q(T1.ID_FORMAT)}, idx + 1) AS id, domain, {q(T1.SYSTEM)} AS system,
      {case_sql('domain', users)} AS "user", {case_sql('domain', assistants)} AS assistant,
      {q(T1.SOURCE)} AS source, {q(T1.LICENSE_STATUS)} AS license_status,
      {q(T1.ALLOWED_USAGE)} AS allowed_usage, false AS contains_pii
    FROM (SELECT idx, {pick_sql(T1.DOMAINS, 'idx')} AS domain FROM ({index_source}))"""


def v2_metrics_sql(index_source: str = "SELECT o_orderkey AS idx FROM orders") -> str:
    names = [n for n, _ in T2.COLLATERALS]
    values = [v for _, v in T2.COLLATERALS]
    return f"""
    WITH s AS (
      SELECT idx, 80 + (idx % 11) * 18 AS revenue,
        CAST(trunc(CAST(80 + (idx % 11) * 18 AS DOUBLE) * ({D(0.52)} + CAST(idx % 5 AS DOUBLE) * {D(0.05)})) AS BIGINT) AS expense,
        20 + (idx % 9) * 12 AS debt, 6 + (idx % 8) * 5 AS cash, 15 + (idx % 10) * 8 AS loan_amount,
        {pick_sql(T2.TERM_CHOICES, 'idx')} AS term_months, {pick_sql(names, 'idx')} AS collateral,
        {pick_sql(values, 'idx')} AS collateral_value, {pick_sql(T2.SECTORS, 'idx')} AS sector,
        {pick_sql(T2.MISSING_DOCS, 'idx')} AS missing_doc
      FROM ({index_source})),
    r AS (
      SELECT *, revenue - expense AS profit,
        (revenue - expense) / revenue AS profit_margin, expense / revenue AS expense_ratio,
        debt / revenue AS debt_to_revenue, cash / debt AS cash_to_debt,
        loan_amount / term_months AS monthly_repayment, collateral_value / loan_amount AS collateral_coverage
      FROM s),
    t AS (
      SELECT *,
        CASE WHEN profit_margin >= {D(0.28)} AND debt_to_revenue <= {D(0.45)} AND cash_to_debt >= {D(0.25)} THEN {q(CR.LOW)}
             WHEN profit_margin >= {D(0.15)} AND debt_to_revenue <= {D(0.8)} THEN {q(CR.MEDIUM)} ELSE {q(CR.HIGH)} END AS risk_tier,
        CASE WHEN collateral_coverage >= {D(2.0)} THEN {q(CR.LOW)} WHEN collateral_coverage >= {D(1.2)} THEN {q(CR.MEDIUM)} ELSE {q(CR.HIGH)} END AS collateral_tier,
        CASE WHEN monthly_repayment <> 0 THEN profit / monthly_repayment ELSE {D(0.0)} END AS repayment_coverage,
        profit - monthly_repayment AS net_after_debt,
        list_filter([CASE WHEN debt_to_revenue > {D(0.7)} THEN {q(CR.RED_FLAGS[0])} END,
                     CASE WHEN cash_to_debt < {D(0.2)} THEN {q(CR.RED_FLAGS[1])} END,
                     CASE WHEN expense_ratio > {D(0.72)} THEN {q(CR.RED_FLAGS[2])} END,
                     CASE WHEN collateral_coverage < {D(1.3)} THEN {q(CR.RED_FLAGS[3])} END], lambda x: x IS NOT NULL) AS flags0
      FROM r)
    SELECT *,
      CASE WHEN repayment_coverage >= 4 THEN {q(CR.LOW)} WHEN repayment_coverage >= 2 THEN {q(CR.MEDIUM)} ELSE {q(CR.HIGH)} END AS repayment_tier,
      CASE WHEN net_after_debt > loan_amount * {D(0.15)} THEN {q(CR.LOW)} WHEN net_after_debt > 0 THEN {q(CR.MEDIUM)} ELSE {q(CR.HIGH)} END AS cashflow_tier,
      CASE WHEN len(flags0) = 0 THEN [{q(CR.RED_FLAG_NONE)}] ELSE flags0 END AS red_flags
    FROM t"""


def v2_sql(index_source: str = "SELECT o_orderkey AS idx FROM orders") -> str:
    fields = {
        "level": "risk_tier", "profit_m": money_sql("profit"), "margin_p": percent_sql("profit_margin", None),
        "debt_p": percent_sql("debt_to_revenue", None), "cash_p": percent_sql("cash_to_debt", None),
        "expense_p": percent_sql("expense_ratio", None), "repay_m": money_sql("monthly_repayment"),
        "coverage2": fixed_sql("collateral_coverage", 2), "sector": "sector", "missing_doc": "missing_doc",
        "recommendation": "CASE " + " ".join(f"WHEN risk_tier = {q(k)} THEN {q(v)}" for k, v in CR.V2_RECOMMENDATION.items()) + " END",
        "loan_m": money_sql("loan_amount"), "term_months": "CAST(term_months AS VARCHAR)",
        "revenue_m": money_sql("revenue"), "expense_m": money_sql("expense"), "collateral": "collateral",
        "collateral_value_m": money_sql("collateral_value"), "collateral_level": "collateral_tier",
        "repay_cov2": fixed_sql("repayment_coverage", 2), "repay_level": "repayment_tier",
        "flags": "array_to_string(red_flags, ', ')", "debt_m": money_sql("debt"), "cash_m": money_sql("cash"),
        "net_m": money_sql("net_after_debt"), "cashflow_level": "cashflow_tier",
    }
    base = render_sql(T2.BASE_INPUT, {k: f"CAST({k} AS VARCHAR)" for k in
                                      ("sector", "revenue", "expense", "debt", "cash", "loan_amount",
                                       "term_months", "collateral", "collateral_value")})
    users = {t: f"concat({q(T2.USER_PREFIX[t])}, {base})" for t in T2.TASKS}
    assistants = {t: render_sql(T2.ASSISTANT[t], fields) for t in T2.TASKS}
    return f"""
    WITH m AS ({v2_metrics_sql(index_source)}),
    k AS (SELECT *, {pick_sql(T2.TASKS, 'idx')} AS task FROM m)
    SELECT idx, printf({q(T2.ID_FORMAT)}, idx + 1) AS id, task AS domain, {q(T2.SYSTEM)} AS system,
      {case_sql('task', users)} AS "user", {case_sql('task', assistants)} AS assistant,
      {q(T2.SOURCE)} AS source, 'synthetic' AS license_status, 'training_allowed' AS allowed_usage,
      false AS contains_pii, true AS numeric_example, true AS metrics_expected
    FROM k"""


def v3_domain_sql(g: str) -> str:
    pos = f"(({g}) - 1) % {T3.CYCLE}"
    parts, start = [], 0
    for d, qn in T3.DOMAIN_QUOTAS:
        parts.append(f"WHEN {pos} < {start + qn} THEN {q(d)}")
        start += qn
    return "CASE " + " ".join(parts) + " END"


def v3_metrics_sql(index_source: str = "SELECT o_orderkey + 1 AS gidx FROM orders") -> str:
    docs = "[" + ", ".join("[" + ", ".join(q(x) for x in ds) + "]" for ds in T3.DOC_SETS) + "]"
    return f"""
    WITH s AS (
      SELECT gidx, {pick_sql(T3.SECTORS, 'gidx')} AS sector, 60 + (gidx % 15) * 12 AS revenue,
        CAST(round_even(CAST(60 + (gidx % 15) * 12 AS DOUBLE) * {pick_sql([D(r) for r in T3.EXPENSE_RATES], 'gidx').replace("'", "")}, 0) AS BIGINT) AS expense,
        10 + (gidx % 12) * 9 AS debt, 4 + (gidx % 10) * 4 AS cash, 12 + (gidx % 13) * 6 AS loan_amount,
        {pick_sql(T3.TERM_CHOICES, 'gidx')} AS term_months, {docs}[gidx % {len(T3.DOC_SETS)} + 1] AS docs
      FROM ({index_source})),
    r AS (
      SELECT *, revenue - expense AS profit,
        CASE WHEN revenue <> 0 THEN (revenue - expense) / revenue END AS profit_margin,
        CASE WHEN revenue <> 0 THEN expense / revenue END AS expense_ratio,
        CASE WHEN revenue <> 0 THEN debt / revenue END AS debt_to_revenue,
        CASE WHEN debt <> 0 THEN cash / debt END AS cash_to_debt,
        CASE WHEN term_months <> 0 THEN loan_amount / term_months END AS monthly_repayment
      FROM s),
    d AS (
      SELECT *, CASE WHEN profit_margin IS NULL OR profit_margin = 0 THEN {D(0.0)} ELSE profit_margin END AS m_,
        CASE WHEN debt_to_revenue IS NULL OR debt_to_revenue = 0 THEN {D(99.0)} ELSE debt_to_revenue END AS d_,
        CASE WHEN cash_to_debt IS NULL OR cash_to_debt = 0 THEN {D(0.0)} ELSE cash_to_debt END AS c_
      FROM r),
    t AS (
      SELECT *, CASE WHEN m_ >= {D(0.30)} AND d_ <= {D(0.45)} AND c_ >= {D(0.30)} THEN {q(CR.LOW)}
                     WHEN m_ >= {D(0.15)} AND d_ <= {D(0.85)} AND c_ >= {D(0.12)} THEN {q(CR.MEDIUM)} ELSE {q(CR.HIGH)} END AS risk_tier
      FROM d)
    SELECT * EXCLUDE (m_, d_, c_),
      CASE WHEN risk_tier = {q(CR.LOW)} THEN {q(CR.V3_RECOMMENDATION_LOW)}
           WHEN risk_tier = {q(CR.MEDIUM)} AND m_ >= {D(0.20)} THEN {q(CR.V3_RECOMMENDATION_DOCS)}
           WHEN d_ > {D(0.9)} THEN {q(CR.V3_RECOMMENDATION_REDUCE)} ELSE {q(CR.V3_RECOMMENDATION_DECLINE)} END AS recommendation
    FROM t"""


def v3_sql(index_source: str = "SELECT o_orderkey + 1 AS gidx FROM orders") -> str:
    fields = {
        "level": "risk_tier", "revenue_m": money_sql("revenue", "₮"), "expense_m": money_sql("expense", "₮"),
        "profit_m": money_sql("profit", "₮"), "margin_p": percent_sql("profit_margin"),
        "expense_p": percent_sql("expense_ratio"), "debt_p": percent_sql("debt_to_revenue"),
        "cash_p": percent_sql("cash_to_debt"),
        "repayment_line": f"coalesce({render_sql(T3.REPAYMENT_LINE, {'repay_m': money_sql('monthly_repayment', '₮')})}, '')",
        "advice": "recommendation",
        "docs_block": "array_to_string(list_transform(docs, lambda x: concat('- ', x)), chr(10))",
        "docs_inline": "array_to_string(docs, ', ')",
    }
    answers = {}
    for d, _ in T3.DOMAIN_QUOTAS:
        answers[d] = render_sql(T3.ANSWER_TEMPLATE[d], dict(fields, focus=q(T3.FOCUS.get(d, ""))))
    task = case_sql("domain", {d: q(T3.TASK_NAMES[d]) for d, _ in T3.DOMAIN_QUOTAS})
    prompt = render_sql(T3.PROMPT, dict({k: f"CAST({k} AS VARCHAR)" for k in
                                         ("sector", "revenue", "expense", "debt", "cash", "loan_amount", "term_months")},
                                        task=task))
    return f"""
    WITH m AS ({v3_metrics_sql(index_source)}),
    k AS (SELECT *, {v3_domain_sql('gidx')} AS domain FROM m)
    SELECT gidx, concat({q(T3.ID_PREFIX)}, domain, '-', printf('%05d', gidx)) AS id, domain, {q(T3.SYSTEM)} AS system,
      {prompt} AS "user", {case_sql('domain', answers)} AS assistant, {q(T3.SOURCE)} AS source,
      'synthetic' AS license_status, 'training_allowed' AS allowed_usage, false AS contains_pii,
      domain <> 'missing_documents_request' AS numeric_example
    FROM k"""


ORACLE["sft_v1_generate"] = v1_sql()
ORACLE["sft_v2_generate"] = v2_sql()
ORACLE["sft_v3_generate"] = v3_sql()


# --- lending rules ----------------------------------------------------------------------

from ..functions import vocab as V  # noqa: E402
from ..operators import quality as QL  # noqa: E402

V1 = v1_sql()
V1_CTE = f"v AS ({V1})"
NOT_NULL = "lambda x: x IS NOT NULL"


def py_strip_sql(x: str) -> str:
    return f"regexp_replace({x}, {q('^[' + P.WS + ']+|[' + P.WS + ']+$')}, '', 'g')"


def lst(items) -> str:
    return f"list_filter([{', '.join(items)}], {NOT_NULL})"


def lex_hits(low: str):
    return [(f"contains({low}, {q(r[2].lower())})", r) for r in V.lexicon_rows()]


def redact_sql(x: str) -> str:
    """Approximate redaction (RE2 has no lookaround): context characters are
    consumed and put back; two passes catch matches whose left context was
    consumed by the previous match."""
    out = x
    steps = [(P.PHONE_RE2_FIRST, P.TOKEN_PHONE, 1, 5),
             (f"(^|[^{P.RE2_WORD}])([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}})($|[^{P.RE2_WORD}])", P.TOKEN_EMAIL, 1, 3),
             (f"(^|[^{P.RE2_WORD}])([{P.REGISTER_LETTERS}]{{2}}\\p{{Nd}}{{8}})($|[^{P.RE2_WORD}])", P.TOKEN_REGISTER, 1, 3),
             ("(^|\\P{Nd})(\\p{Nd}{10,16})($|\\P{Nd})", P.TOKEN_NUMBER, 1, 3)]
    for pat, tok, g1, g2 in steps:
        for _ in range(2):
            out = f"regexp_replace({out}, {q(pat)}, {q(chr(92) + str(g1) + tok + chr(92) + str(g2))}, 'g')"
    return out


def parse_number_sql(num: str, unit: str) -> str:
    cleaned = f"regexp_replace({num}, '[^0-9.]', '', 'g')"
    return (f"CASE WHEN length({cleaned}) > 0 THEN TRY_CAST(trunc(TRY_CAST({cleaned} AS DOUBLE) * "
            f"CASE WHEN coalesce(length({unit}), 0) > 0 THEN {D(1000000.0)} ELSE {D(1.0)} END) AS BIGINT) END")


def extraction_sql(src: str, key: str, text: str) -> str:
    t = text
    ctx, money, term, inc = P.loan_context_re2(), P.money_re2(), P.term_re2(), P.income_re2()
    find = lambda terms: "CASE " + " ".join(f"WHEN contains(lower({t}), {q(k.lower())}) THEN {q(v)}" for k, v in terms) + " END"
    years = ", ".join(q(y) for y in P.YEAR_UNITS)
    return f"""
    SELECT {key}, {t} AS _text,
      CASE WHEN regexp_extract({t}, {q(ctx)}, 1) <> '' THEN {parse_number_sql(f"regexp_extract({t}, {q(ctx)}, 1)", f"regexp_extract({t}, {q(ctx)}, 2)")}
           ELSE list_filter(list_transform(list_zip(regexp_extract_all({t}, {q(money)}, 1), regexp_extract_all({t}, {q(money)}, 2)),
                  lambda z: {parse_number_sql('z[1]', 'z[2]')}), lambda a: a >= 100000)[1] END AS loan_amount,
      CASE WHEN regexp_extract({t}, {q(term)}, 1) <> '' THEN
        CASE WHEN lower(regexp_extract({t}, {q(term)}, 2)) IN ({years}) THEN TRY_CAST(regexp_extract({t}, {q(term)}, 1) AS BIGINT) * 12
             ELSE TRY_CAST(regexp_extract({t}, {q(term)}, 1) AS BIGINT) END END AS loan_term_months,
      CASE WHEN regexp_extract({t}, {q(inc)}, 1) <> '' THEN {parse_number_sql(f"regexp_extract({t}, {q(inc)}, 1)", f"regexp_extract({t}, {q(inc)}, 2)")} END AS monthly_income,
      {find(V.EMPLOYMENT_TERMS)} AS employment_status,
      {find(V.COLLATERAL_TERMS)} AS collateral,
      {find(V.LOAN_TYPE_TERMS)} AS loan_type,
      CASE WHEN regexp_extract({t}, {q(P.PHONE_RE2_FIRST)}, 2) <> '' THEN right(regexp_replace(regexp_extract({t}, {q(P.PHONE_RE2_FIRST)}, 2), '[^0-9]', '', 'g'), 8) END AS phone_number
    FROM ({src})"""


def with_missing(ext: str) -> str:
    items = [f"CASE WHEN {f} IS NULL THEN {q(f)} END" for f in V.EXTRACTION_FIELDS]
    return f"SELECT *, {lst(items)} AS _missing FROM ({ext})"


def confidence_sql(text: str, n: str) -> str:
    short = f"CASE WHEN length({py_strip_sql(text)}) < {V.CONFIDENCE_SHORT_LEN} THEN {D(V.CONFIDENCE_SHORT_PENALTY)} ELSE {D(0.0)} END"
    warn = f"CASE WHEN ({n}) > 0 THEN least({D(V.CONFIDENCE_WARNING_CAP)}, {D(V.CONFIDENCE_WARNING_STEP)} * ({n})) ELSE {D(0.0)} END"
    return f"greatest({D(V.CONFIDENCE_MIN)}, least({D(V.CONFIDENCE_MAX)}, round({D(V.CONFIDENCE_BASE)} - {short} - {warn}, 2)))"


def issues_cte(src: str, key_cols: str, text: str) -> str:
    low = f"lower({text})"
    hits = lex_hits(low)
    cats = lst([f"CASE WHEN {h} THEN {q(r[1])} END" for h, r in hits])
    phrases = lst([f"CASE WHEN {h} THEN {q(r[2])} END" for h, r in hits])
    sev = lst([f"CASE WHEN {h} THEN {q(r[3])} END" for h, r in hits])
    alts = lst([f"CASE WHEN {h} THEN {q(r[4])} END" for h, r in hits])
    safer = text
    for h, r in hits:
        safer = f"replace({safer}, {q(r[2])}, CASE WHEN {h} THEN {q(r[4])} ELSE {q(r[2])} END)"
    return (f"SELECT {key_cols}, {cats} AS cats, {phrases} AS phrases, {sev} AS sevs, {alts} AS alts, "
            f"CASE WHEN len({cats}) > 0 THEN {safer} END AS safer FROM ({src})")


ORACLE["compliance_issues"] = f"""
WITH {V1_CTE}, i AS ({issues_cte('SELECT * FROM v', 'idx', '"user"')})
SELECT idx, CAST(len(cats) AS INTEGER) AS n_issues, array_to_string(cats, '|') AS categories,
  array_to_string(phrases, '|') AS phrases, len(cats) = 0 AS is_safe,
  CASE WHEN list_contains(sevs, 'high') THEN 'block' WHEN len(cats) > 0 THEN 'review' ELSE 'pass' END AS decision
FROM i"""

ORACLE["compliance_safer_text"] = f"""
WITH {V1_CTE}, i AS ({issues_cte('SELECT * FROM v', 'idx', '"user"')})
SELECT idx, safer AS safer_text, array_to_string(alts, '|') AS alternatives FROM i"""

ORACLE["compliance_report"] = f"""
WITH {V1_CTE}, b AS (SELECT domain, "user" AS text FROM v UNION ALL SELECT domain, assistant AS text FROM v),
i AS ({issues_cte('SELECT * FROM b', 'domain', 'text')}),
e AS (SELECT domain, unnest(list_zip(cats, sevs)) AS z FROM i)
SELECT domain, z[1] AS category, z[2] AS severity, count(*) AS n_issues FROM e GROUP BY 1, 2, 3"""


def glossary_sql(text: str, glossary_id: str | None):
    low = f"lower({text})"
    used, warns = [], []
    for s, p in V.merged_glossary(glossary_id):
        sh, ph = f"contains({low}, {q(s.lower())})", f"contains({low}, {q(p.lower())})"
        used.append(f"CASE WHEN {sh} OR {ph} THEN {q(p)} END")
        warns.append(f"CASE WHEN {sh} AND NOT {ph} THEN {q(V.GLOSSARY_WARNING.format(preferred=p, source=s))} END")
    return f"list_sort(list_distinct({lst(used)}))", lst(warns)


_gt, _gw = glossary_sql('"user"', V.FINANCE_GLOSSARY_ID)
ORACLE["glossary_check"] = f"""
WITH {V1_CTE}
SELECT idx, array_to_string({_gt}, '|') AS terms_used, array_to_string({_gw}, '|') AS glossary_warnings,
  CAST(len({_gw}) AS INTEGER) AS n_warnings FROM v"""


def extraction_out(key: str, src: str, text: str) -> str:
    return f"""
    SELECT {key}, loan_amount, loan_term_months, monthly_income, employment_status, collateral, loan_type, phone_number,
      array_to_string(_missing, ',') AS missing_fields, CAST(len(_missing) AS INTEGER) AS n_missing
    FROM ({with_missing(extraction_sql(src, key, text))})"""


ORACLE["loan_extraction"] = extraction_out("doc_id", "SELECT doc_id, text FROM documents", "text")
ORACLE["loan_extraction_sft"] = f"WITH {V1_CTE} " + extraction_out("idx", "SELECT idx, \"user\" FROM v", '"user"')
ORACLE["missing_fields_report"] = f"""
SELECT source, count(*) AS n_rows, {', '.join(f'count({f}) AS n_{f}' for f in V.EXTRACTION_FIELDS)},
  count_if(len(_missing) = 0) AS n_complete
FROM ({with_missing(extraction_sql('SELECT doc_id, source, text FROM documents', 'doc_id, source', 'text'))})
GROUP BY source"""
ORACLE["confidence_scores"] = f"""
WITH {V1_CTE}, x AS ({with_missing(extraction_sql('SELECT idx, domain, "user" FROM v', 'idx, domain', '"user"'))})
SELECT idx, domain, {confidence_sql(redact_sql('_text'), 'len(_missing)')} AS confidence FROM x"""

_rt, _rw = glossary_sql('"user"', V.FINANCE_GLOSSARY_ID)
ORACLE["review_routing"] = f"""
WITH {V1_CTE},
i AS ({issues_cte('SELECT * FROM v', 'idx, assistant, "user"', '"user"')}),
g AS (SELECT idx, len(cats) AS n_issues, CAST(len({_rw}) AS INTEGER) AS n_glossary_warnings,
             array_to_string({_rt}, '|') AS terms_used,
             {confidence_sql('assistant', f'len({_rw}) + len(cats)')} AS confidence FROM i)
SELECT idx, confidence, (n_issues > 0 OR confidence < {D(V.REVIEW_THRESHOLD)}) AS requires_human_review,
  CASE WHEN n_issues > 0 OR confidence < {D(V.REVIEW_THRESHOLD)} THEN {q(V.REVIEW_REASON)} END AS reason,
  n_glossary_warnings, terms_used FROM g"""

_red = redact_sql("text")
ORACLE["redact_documents"] = f"SELECT doc_id, source, {_red} AS redacted_text, {_red} <> text AS redaction_changed FROM documents"
ORACLE["log_redaction_stream"] = f"SELECT doc_id, source, {_red} AS redacted_text FROM documents"
_tokens = {"n_phone_tokens": P.TOKEN_PHONE, "n_email_tokens": P.TOKEN_EMAIL, "n_register_tokens": P.TOKEN_REGISTER,
           "n_number_tokens": P.TOKEN_NUMBER}
ORACLE["redaction_report"] = f"""
WITH r AS (SELECT source, text, {_red} AS red FROM documents)
SELECT source, count(*) AS n_docs, count_if(red <> text) AS n_changed,
  {', '.join(f"sum((length(red) - length(replace(red, {q(t)}, ''))) // {len(t)}) AS {n}" for n, t in _tokens.items())}
FROM r GROUP BY source"""

_think_block = f"(?is)<think([^{P.RE2_WORD}>][^>]*)?>.*?</think>"
_think_tag = f"(?i)</?think($|[^{P.RE2_WORD}])"
ORACLE["strip_reasoning"] = f"""
WITH s AS (SELECT role, text AS t, {py_strip_sql(f"regexp_replace(text, {q(_think_block)}, '', 'g')")} AS s FROM conversations)
SELECT role, count(*) AS n_docs,
  count_if(contains(lower(t), '<think') OR contains(lower(t), '</think>')) AS n_tag_substring,
  count_if(regexp_matches(t, {q(_think_tag)})) AS n_tag_regex,
  count_if(contains(lower(s), '<think') OR contains(lower(s), '</think>')) AS n_tag_after_strip,
  sum(length(t) - length(s)) AS chars_removed
FROM s GROUP BY role"""


# --- conversations ------------------------------------------------------------------------

ORACLE["conversation_messages"] = """
SELECT conv_id, count(*) AS n_messages, arg_min(role, turn) AS first_role, arg_max(role, turn) AS last_role,
  count_if(role = 'user') AS n_user, count_if(role = 'assistant') AS n_assistant, count_if(role = 'system') AS n_system,
  sum(length(text)) AS total_chars
FROM conversations GROUP BY conv_id"""

ORACLE["latest_user_turn"] = """
SELECT conv_id, coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '') AS latest_user
FROM conversations GROUP BY conv_id"""

# the error of the earliest wrong message: its role is looked at before its content
_ERR = (f"CASE WHEN coalesce(role NOT IN ('system', 'user', 'assistant'), true) THEN 'invalid role ' || coalesce(role, 'None') "
        f"WHEN text IS NULL OR length({py_strip_sql('text')}) = 0 THEN 'empty message content' END")
_FIRST_ERROR = f"arg_min({_ERR}, turn) FILTER (WHERE ({_ERR}) IS NOT NULL)"
ORACLE["message_validation"] = f"""
SELECT conv_id,
  CASE WHEN count(*) < 2 THEN 'messages must contain at least user and assistant entries'
       WHEN NOT (bool_or(role = 'user') AND bool_or(role = 'assistant')) THEN 'messages must include user and assistant roles'
       ELSE {_FIRST_ERROR} END AS error
FROM conversations GROUP BY conv_id"""


def _context_missing(src_alias: str) -> str:
    ctx = {"loan_amount": "CAST(loan_amount AS VARCHAR)", "term": "CAST(loan_term_months AS VARCHAR)",
           "income": "CAST(monthly_income AS VARCHAR)", "employment": "employment_status",
           "collateral": "collateral", "loan_type": "loan_type", "phone_number": "phone_number"}
    aliases = {"loan_amount": ["loan_amount"], "loan_term_months": ["term"], "monthly_income": ["income"],
               "employment_status": ["employment"], "collateral": ["collateral"], "loan_type": ["loan_type"],
               "phone_number": ["phone_number"]}
    falsy = "('', '0', '0.0', 'false', '[]', '{}')"
    items = []
    for f in V.EXTRACTION_FIELDS:
        present = " OR ".join(f"coalesce({ctx[k]} NOT IN {falsy}, false)" for k in aliases[f])
        items.append(f"CASE WHEN NOT ({present}) THEN {q(f)} END")
    return lst(items)


# what all user turns of a conversation tell: of each field the value of the latest turn that has one
_said = extraction_sql("SELECT conv_id, turn, text FROM conversations WHERE role = 'user'", "conv_id, turn", "text")
CONTEXT = f"""SELECT c.conv_id, {', '.join(f'arg_max({f}, e.turn) FILTER (WHERE {f} IS NOT NULL) AS {f}' for f in V.EXTRACTION_FIELDS)}
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ({_said}) e ON e.conv_id = c.conv_id GROUP BY c.conv_id"""
ORACLE["context_missing_fields"] = f"""
WITH x AS ({CONTEXT})
SELECT conv_id, array_to_string({_context_missing('x')}, ',') AS missing_application_fields FROM x"""

_answer = "coalesce(arg_max(text, turn) FILTER (WHERE role = 'assistant'), '')"
_chat = f"""SELECT conv_id, {_answer} AS answer,
  {redact_sql("coalesce(arg_max(text, turn) FILTER (WHERE role = 'user'), '')")} AS said FROM conversations GROUP BY conv_id"""
ORACLE["chat_audit"] = f"""
WITH a AS ({_chat}), i AS ({issues_cte('SELECT * FROM a', 'conv_id, answer, said', 'answer')}), x AS ({CONTEXT}),
m AS (SELECT conv_id, array_to_string({_context_missing('x')}, ',') AS missing_application_fields FROM x)
SELECT i.conv_id, CASE WHEN {count_class('said', P.LATIN_LETTERS)} > {count_class('said', P.MN_LETTERS)} THEN 'en' ELSE 'mn' END AS language,
  {confidence_sql('answer', 'len(cats)')} AS confidence, CAST(len(cats) AS INTEGER) AS n_issues, missing_application_fields
FROM i JOIN m ON i.conv_id = m.conv_id"""


# --- credit ------------------------------------------------------------------------------

V2M = f"m AS ({v2_metrics_sql()})"
V3M = f"m AS ({v3_metrics_sql()})"
ORACLE["credit_ratios_v2"] = f"""WITH {V2M} SELECT idx, profit, profit_margin, expense_ratio, debt_to_revenue,
  cash_to_debt, monthly_repayment, collateral_coverage FROM m"""
ORACLE["credit_ratios_v3"] = f"""WITH {V3M} SELECT gidx, profit, profit_margin, expense_ratio, debt_to_revenue,
  cash_to_debt, monthly_repayment FROM m"""
ORACLE["risk_tiers"] = f"""
WITH a AS (SELECT 'v2' AS version, risk_tier, CAST(NULL AS VARCHAR) AS recommendation FROM ({v2_metrics_sql()})
           UNION ALL SELECT 'v3', risk_tier, recommendation FROM ({v3_metrics_sql()}))
SELECT version, risk_tier, recommendation, count(*) AS n FROM a GROUP BY 1, 2, 3"""
ORACLE["red_flags"] = f"WITH {V2M} SELECT idx, array_to_string(red_flags, ', ') AS flags, CAST(len(red_flags) AS INTEGER) AS n_flags FROM m"
ORACLE["red_flag_frequency"] = f"WITH {V2M}, e AS (SELECT unnest(red_flags) AS flag FROM m) SELECT flag, count(*) AS n FROM e GROUP BY flag"
ORACLE["collateral_tiers"] = f"WITH {V2M} SELECT idx, collateral_coverage, collateral_tier FROM m"
ORACLE["repayment_tiers"] = f"WITH {V2M} SELECT idx, repayment_coverage, repayment_tier FROM m"
ORACLE["cashflow_tiers"] = f"WITH {V2M} SELECT idx, net_after_debt, cashflow_tier FROM m"

CUSTOMER_FACTS = """
  li AS (SELECT l_orderkey, sum(CAST(round((l_extendedprice * (1 - l_discount)) * 100) AS BIGINT)) AS e FROM lineitem GROUP BY 1),
  o AS (SELECT o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS price, o_orderstatus, e
        FROM orders LEFT JOIN li ON o_orderkey = l_orderkey),
  pc AS (SELECT o_custkey, sum(price) AS revenue, sum(CASE WHEN o_orderstatus = 'P' THEN price ELSE 0 END) // 50 AS debt,
                sum(coalesce(e, 0)) AS expense FROM o GROUP BY 1),
  f AS (SELECT c_custkey, c_mktsegment, coalesce(revenue, 0) AS revenue, coalesce(expense, 0) AS expense,
               coalesce(debt, 0) AS debt, greatest(CAST(round(c_acctbal * 100) AS BIGINT), 0) AS cash
        FROM customer LEFT JOIN pc ON c_custkey = o_custkey),
  r AS (SELECT *, revenue - expense AS profit,
          CASE WHEN revenue <> 0 THEN (revenue - expense) / revenue END AS profit_margin,
          CASE WHEN revenue <> 0 THEN debt / revenue END AS debt_to_revenue,
          CASE WHEN debt <> 0 THEN cash / debt END AS cash_to_debt FROM f),
  d AS (SELECT *, CASE WHEN profit_margin IS NULL OR profit_margin = 0 THEN 0.0::DOUBLE ELSE profit_margin END AS m_,
          CASE WHEN debt_to_revenue IS NULL OR debt_to_revenue = 0 THEN 99.0::DOUBLE ELSE debt_to_revenue END AS d_,
          CASE WHEN cash_to_debt IS NULL OR cash_to_debt = 0 THEN 0.0::DOUBLE ELSE cash_to_debt END AS c_ FROM r),
  t AS (SELECT *, CASE WHEN m_ >= 0.30::DOUBLE AND d_ <= 0.45::DOUBLE AND c_ >= 0.30::DOUBLE THEN 'LOW'
                       WHEN m_ >= 0.15::DOUBLE AND d_ <= 0.85::DOUBLE AND c_ >= 0.12::DOUBLE THEN 'MEDIUM' ELSE 'HIGH' END AS tier0 FROM d),
  k AS (SELECT *, CASE tier0 WHEN 'LOW' THEN 'LOWT' WHEN 'MEDIUM' THEN 'MEDT' ELSE 'HIGHT' END AS risk_tier,
          CASE WHEN tier0 = 'LOW' THEN 'REC_LOW' WHEN tier0 = 'MEDIUM' AND m_ >= 0.20::DOUBLE THEN 'REC_DOCS'
               WHEN d_ > 0.9::DOUBLE THEN 'REC_REDUCE' ELSE 'REC_DECLINE' END AS recommendation FROM t)"""
CUSTOMER_FACTS = (CUSTOMER_FACTS.replace("'LOWT'", q(CR.LOW)).replace("'MEDT'", q(CR.MEDIUM)).replace("'HIGHT'", q(CR.HIGH))
                  .replace("'REC_LOW'", q(CR.V3_RECOMMENDATION_LOW)).replace("'REC_DOCS'", q(CR.V3_RECOMMENDATION_DOCS))
                  .replace("'REC_REDUCE'", q(CR.V3_RECOMMENDATION_REDUCE))
                  .replace("'REC_DECLINE'", q(CR.V3_RECOMMENDATION_DECLINE)))
ORACLE["customer_credit_facts"] = f"""WITH {CUSTOMER_FACTS}
SELECT c_custkey, revenue, expense, debt, cash, profit, profit_margin, debt_to_revenue, cash_to_debt, risk_tier, recommendation FROM k"""
ORACLE["customer_risk_rollup"] = f"""WITH {CUSTOMER_FACTS}
SELECT c_mktsegment, risk_tier, recommendation, count(*) AS n_customers, sum(revenue) AS revenue_cents,
  count_if(debt = 0) AS n_zero_debt FROM k GROUP BY 1, 2, 3"""


# --- splits -----------------------------------------------------------------------------------

ORACLE["seeded_split"] = """
WITH n AS (SELECT count(*) AS n FROM documents),
r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn FROM documents)
SELECT doc_id, CASE WHEN rn <= (CASE WHEN n > 1 THEN greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) ELSE 0 END)
  THEN CASE WHEN n > 1 AND greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) >= n THEN 'both' ELSE 'val' END
  ELSE 'train' END AS split
FROM r, n"""
ORACLE["prefix_split"] = f"""
WITH v AS ({v2_sql()}), n AS (SELECT count(*) AS n FROM v),
r AS (SELECT idx, row_number() OVER (ORDER BY idx) AS rn FROM v)
SELECT idx, CASE WHEN rn <= CAST(floor(n * 0.9::DOUBLE) AS BIGINT) THEN 'train' ELSE 'val' END AS split FROM r, n"""
ORACLE["sft_v3_stratified_split"] = f"""
WITH v AS ({v3_sql()}),
r AS (SELECT gidx, domain, row_number() OVER (PARTITION BY domain ORDER BY gidx) AS group_rank,
             count(*) OVER (PARTITION BY domain) AS cnt FROM v)
SELECT gidx, domain, group_rank, CASE WHEN group_rank <= floor(cnt * 0.9::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM r"""
ORACLE["dedup_by_hash"] = """
SELECT source, count(*) AS n_docs, count(DISTINCT sha256(text)) AS n_distinct_payloads,
  count(*) - count(DISTINCT sha256(text)) AS n_cache_hits,
  CAST(sum(round(CONFIDENCE * 100)) AS BIGINT) AS confidence_points FROM documents GROUP BY source""".replace(
    "CONFIDENCE", confidence_sql(redact_sql("text"), "0"))


# --- quality gates -------------------------------------------------------------------------

def _first_sql(low: str, items, msg: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({low}, {q(it.lower())}) THEN {q(msg.format(it))}" for it in items) + " END"


def _mn(x: str) -> str:
    return count_class(x, P.MN_LETTERS)


def _latin(x: str) -> str:
    return count_class(x, P.LATIN_LETTERS)


def _metric_terms(x: str) -> str:
    return " + ".join(f"CAST(contains(lower({x}), {q(t)}) AS INTEGER)" for t in QL.V2_METRIC_TERMS)


def v2_gate_sql() -> str:
    a, low = "assistant", "lower(assistant)"
    memo = "CASE " + " ".join(f"WHEN NOT contains(assistant, {q(r)}) THEN {q('credit memo missing required field: ' + r)}"
                              for r in QL.V2_MEMO_REQUIRED) + " END"
    rules = [
        f"CASE WHEN NOT coalesce(domain IN ({', '.join(q(t) for t in T2.TASKS)}), false) THEN concat('missing or invalid domain: ', coalesce(domain, 'None')) END",
        "CASE WHEN contains_pii IS DISTINCT FROM false THEN 'contains_pii must be false' END",
        f"CASE WHEN source IS DISTINCT FROM {q(T2.SOURCE)} THEN 'unexpected source metadata' END",
        "CAST(NULL AS VARCHAR)",
        _first_sql(low, QL.V2_FORBIDDEN, "forbidden text found: {}"),
        f"CASE WHEN {_latin(a)} > {_mn(a)} * {D(0.35)} THEN 'assistant output is mostly English' END",
        f"CASE WHEN {_mn(a)} < 80 THEN 'assistant output is shorter than 80 Mongolian characters' END",
        f"CASE WHEN NOT contains({low}, {q(QL.V2_RISK_WORD)}) AND domain IS DISTINCT FROM {q(QL.V2_RISK_EXEMPT_DOMAIN)} THEN 'risk level or risk discussion is missing' END",
        f"CASE WHEN domain = 'credit_memo' THEN {memo} END",
        f"CASE WHEN numeric_example IS NOT DISTINCT FROM true AND ({_metric_terms(a)}) < 1 THEN 'numeric example has no calculated metric' END",
    ]
    return f"""
    WITH v AS ({v2_sql()}), c AS (SELECT idx, domain, {_mn(a)} AS mn_chars, {_metric_terms(a)} AS metric_terms,
                                       {lst(rules)} AS viol FROM v)
    SELECT idx, domain, mn_chars, metric_terms, viol[1] AS first_violation, CAST(len(viol) AS INTEGER) AS n_violations FROM c"""


ORACLE["quality_v2"] = v2_gate_sql()


def v3_gate_cte() -> str:
    a = "assistant"
    figs = {k: f"TRY_CAST(nullif(regexp_extract(\"user\", {q(f'(?i){label}[{P.WS}]+([0-9]+)[{P.WS}]+{unit}')}, 1), '') AS BIGINT)"
            for k, label, unit in T3.PROMPT_FIGURES}
    fig_cols = ", ".join(f"{v} AS f_{k}" for k, v in figs.items())
    missing = "CASE " + " ".join(f"WHEN f_{k} IS NULL THEN {q('missing numeric field in prompt: ' + k)}"
                                 for k, _l, _u in T3.PROMPT_FIGURES) + " END"
    div = lambda n, d: f"CASE WHEN ({d}) <> 0 THEN ({n}) / ({d}) END"
    metrics = {
        "Орлого": money_sql("f_revenue", "₮"), "Зардал": money_sql("f_expense", "₮"),
        "Тооцоолсон ашиг": money_sql("f_revenue - f_expense", "₮"),
        "Ашгийн маржин": percent_sql(div("f_revenue - f_expense", "f_revenue")),
        "Зардлын харьцаа": percent_sql(div("f_expense", "f_revenue")),
        "Өр/орлогын харьцаа": percent_sql(div("f_debt", "f_revenue")),
        "Мөнгө/өрийн харьцаа": percent_sql(div("f_cash", "f_debt")),
        "Сарын төлбөрийн ойролцоо тооцоо": money_sql(f"coalesce({div('f_loan_amount', 'f_term_months')}, {D(0.0)})", "₮"),
    }
    mcols = ", ".join(f"{v} AS m{i}" for i, v in enumerate(metrics.values()))
    labels = list(metrics)
    matches = " + ".join(f"CAST(coalesce(contains(lower({a}), {q(lab.lower())}) AND contains({a}, m{i}), false) AS INTEGER)"
                         for i, lab in enumerate(labels))
    strict_mis = "CASE " + " ".join(
        f"WHEN NOT contains({a}, m{labels.index(lab)}) THEN concat({q('metric mismatch for ' + lab + ': expected ')}, m{labels.index(lab)})"
        for lab in T3.STRICT_METRIC_LABELS) + " END"
    req = "CASE " + " ".join(f"WHEN NOT contains({a}, {q(f)}) THEN {q('missing required numeric field: ' + f)}"
                             for f in T3.REQUIRED_NUMERIC_FIELDS) + " END"
    numeric = f"domain IN ({', '.join(q(d) for d in T3.NUMERIC_DOMAINS)})"
    strict = f"domain IN ({', '.join(q(d) for d in T3.STRICT_MEMO_DOMAINS)})"
    rules = [
        f"CASE WHEN NOT coalesce(domain IN ({', '.join(q(d) for d, _ in T3.DOMAIN_QUOTAS)}), false) THEN coalesce('unknown domain ''' || domain || '''', 'unknown domain None') END",
        f"CASE WHEN source IS DISTINCT FROM {q(T3.SOURCE)} THEN 'unexpected source' END",
        "CASE WHEN contains_pii IS DISTINCT FROM false THEN 'contains_pii must be false' END",
        f"CASE WHEN regexp_matches({a}, {q(_think_tag)}) THEN 'thinking tag found' END",
        _first_sql(f"lower({a})", T3.BAD_PHRASES, "banned phrase found: {}"),
        f"CASE WHEN {_latin(a)} > {_mn(a)} * {D(0.25)} THEN 'output is mostly English' END",
        f"CASE WHEN domain = 'credit_memo_numeric' AND {_mn(a)} < 250 THEN 'credit memo output shorter than 250 Mongolian characters' END",
        f"CASE WHEN {strict} THEN {req} END",
        f"CASE WHEN {numeric} THEN {missing} END",
        f"CASE WHEN {numeric} AND {strict} AND ({missing}) IS NULL THEN {strict_mis} END",
        f"CASE WHEN {numeric} AND ({missing}) IS NULL AND ({matches}) < 3 THEN 'numeric output has fewer than 3 calculated metric matches' END",
    ]
    return f"""
    v AS ({v3_sql()}),
    f AS (SELECT *, {fig_cols} FROM v),
    g AS (SELECT *, {mcols} FROM f),
    c AS (SELECT gidx, domain, source, {_mn(a)} AS mn_chars, {matches} AS metric_matches, {lst(rules)} AS viol,
                 f_revenue, f_expense, f_debt, f_cash, f_loan_amount, f_term_months FROM g)"""


ORACLE["quality_v3"] = f"""WITH {v3_gate_cte()}
SELECT gidx, domain, mn_chars, metric_matches, viol[1] AS first_violation, CAST(len(viol) AS INTEGER) AS n_violations FROM c"""
ORACLE["quality_v3_verdict"] = f"""WITH {v3_gate_cte()}
SELECT count(*) AS rows, count_if(viol[1] IS NOT NULL) AS failing_rows,
  min_by(viol[1], CASE WHEN viol[1] IS NOT NULL THEN gidx END) FILTER (WHERE viol[1] IS NOT NULL) AS first_failure,
  count(DISTINCT domain) AS n_domains, count(DISTINCT source) AS n_sources,
  CASE WHEN count_if(viol[1] IS NOT NULL) = 0 AND count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM c"""

_scen = v3_metrics_sql()
ORACLE["prompt_figures_roundtrip"] = f"""WITH {v3_gate_cte()}, s AS ({_scen})
SELECT c.gidx, f_revenue AS parsed_revenue, f_expense AS parsed_expense, f_debt AS parsed_debt, f_cash AS parsed_cash,
  f_loan_amount AS parsed_loan_amount, f_term_months AS parsed_term_months,
  coalesce(f_revenue = s.revenue AND f_expense = s.expense AND f_debt = s.debt AND f_cash = s.cash
           AND f_loan_amount = s.loan_amount AND f_term_months = s.term_months, false) AS roundtrip_ok
FROM c JOIN s ON c.gidx = s.gidx"""

ORACLE["domain_coverage"] = f"""
WITH v AS ({v2_sql()}), r AS (SELECT unnest([{', '.join(q(t) for t in T2.TASKS)}]) AS domain),
c AS (SELECT domain, count(*) AS n FROM v GROUP BY domain)
SELECT r.domain, coalesce(c.n, 0) AS n_rows, coalesce(c.n, 0) = 0 AS missing FROM r LEFT JOIN c ON r.domain = c.domain"""


def _quota_expected() -> str:
    parts, start = [], 0
    for d, qn in T3.DOMAIN_QUOTAS:
        parts.append(f"SELECT {q(d)} AS domain, (n // {T3.CYCLE}) * {qn} + least(greatest(n % {T3.CYCLE} - {start}, 0), {qn}) AS expected FROM n")
        start += qn
    return " UNION ALL ".join(parts)


ORACLE["domain_quota"] = f"""
WITH v AS ({v3_sql()}), n AS (SELECT count(*) AS n FROM v),
e AS ({_quota_expected()}), a AS (SELECT domain, count(*) AS actual FROM v GROUP BY domain)
SELECT coalesce(e.domain, a.domain) AS domain, e.expected, a.actual, e.expected IS NOT DISTINCT FROM a.actual AS matches
FROM e FULL OUTER JOIN a ON e.domain = a.domain"""

_all = "concat_ws(chr(10), id, system, \"user\", assistant, domain, source)"
_unsafe = ["заавал батална", "баталгаатай зөвшөөрнө", "guaranteed approval", "final approval is confirmed"]
ORACLE["dataset_invariants"] = f"""
WITH {V1_CTE}, d AS (SELECT domain, count(*) AS c FROM v GROUP BY domain)
SELECT * FROM (
  SELECT count(*) AS n_rows,
    bool_and(source = {q(T1.SOURCE)} AND license_status = {q(T1.LICENSE_STATUS)} AND allowed_usage = {q(T1.ALLOWED_USAGE)}
             AND contains_pii IS NOT DISTINCT FROM false) AS metadata_ok,
    count_if(regexp_matches({_all}, {q(P.PHONE_RE2_EXISTS)}) OR regexp_matches({_all}, {q(P.EMAIL_RE2_EXISTS)})
             OR regexp_matches({_all}, {q(P.REGISTER_RE2_EXISTS)})) AS n_pii_rows,
    count_if(NOT contains(assistant, 'Та')) AS n_impolite,
    count_if(NOT contains(lower(assistant), 'эцсийн')) AS n_no_final_review,
    count_if({' OR '.join(f"contains(lower(assistant), {q(p)})" for p in _unsafe)}) AS n_unsafe,
    count_if(length({py_strip_sql('system')}) = 0 OR length({py_strip_sql('"user"')}) = 0
             OR length({py_strip_sql('assistant')}) = 0) AS n_blank_messages
  FROM v),
  (SELECT min(c) AS min_domain_rows, max(c) AS max_domain_rows, count(*) AS n_domains FROM d)"""


# --- evaluation ---------------------------------------------------------------------------

_off = (f"CASE WHEN coalesce(length(text), 0) = 0 THEN {D(0.5)} WHEN length({py_strip_sql('text')}) < 10 THEN {D(0.65)} "
        f"ELSE {D(0.8)} END")
_svc = f"CASE WHEN text IS NULL OR length({py_strip_sql('text')}) = 0 THEN {D(0.5)} ELSE {D(0.8)} END"
ORACLE["eval_scores"] = f"SELECT item_id, {_off} AS offline_score, {_svc} AS service_score FROM benchmark"
ORACLE["eval_summary"] = f"""
SELECT count(*) AS n_items, coalesce(round(avg({_off}), 3), 0.0::DOUBLE) AS average_score,
  {q(EVQ.DEFAULT_JUDGE)} AS judge_model FROM benchmark"""
ORACLE["score_regression"] = f"""
SELECT count(*) AS n_items, count_if(({_off}) - ({_svc}) < 0) AS n_regressed,
  round(avg(({_off}) - ({_svc})), 6) AS mean_delta FROM benchmark"""
ORACLE["labelled_quality_report"] = f"""
SELECT quality, toxic, count(*) AS n_docs,
  count_if(regexp_matches(text, {q(P.PHONE_RE2_EXISTS)}) OR regexp_matches(text, {q(P.EMAIL_RE2_EXISTS)})
           OR regexp_matches(text, {q(P.REGISTER_RE2_EXISTS)}) OR regexp_matches(text, {q(P.LONG_NUMBER_RE2_EXISTS)})) AS n_pii_docs
FROM documents JOIN labels USING (doc_id) GROUP BY quality, toxic"""


# --- gates ---------------------------------------------------------------------------------

from ..operators import gates as GTS  # noqa: E402
from ..sources import dims as DMS  # noqa: E402

_man = " UNION ALL ".join(
    f"SELECT {i} AS mord, {q(r[0])} AS manifest_name, {q(r[2])} AS source_url, {q(r[4])} AS allowed_usage, {q(r[3])} AS m_license"
    for i, r in enumerate(DMS.MANIFEST))
DOC_PROV = f"""
  man AS ({_man}),
  dk AS (SELECT doc_id, source, text,
           CASE WHEN regexp_extract(source, '([0-9]+)', 1) <> '' THEN CAST(CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT) % {len(DMS.MANIFEST)} AS INTEGER) END AS mord
         FROM documents),
  p AS (SELECT dk.doc_id, dk.source, man.manifest_name, man.source_url, man.allowed_usage, CASE WHEN man.mord IS NOT NULL THEN {q(_reg.RETRIEVAL_DATE)} END AS retrieval_date,
          nullif(regexp_extract(dk.text, {q(GTS.LICENSE_LINE_RE2)}, 0), '') AS license_status
        FROM dk LEFT JOIN man ON dk.mord = man.mord)"""
_t = lambda c: f"coalesce(CAST({c} AS VARCHAR) <> '', false)"
ORACLE["rights_gate"] = f"""WITH {DOC_PROV}
SELECT source, count(*) AS n_docs, count_if({_t('license_status')} AND {_t('allowed_usage')}) AS n_kept FROM p GROUP BY source"""
ORACLE["provenance_missing"] = f"""WITH {DOC_PROV}
SELECT source, count(*) AS n_docs, {', '.join(f"count_if(NOT {_t(f)}) AS n_missing_{f}" for f in GTS.PROVENANCE_FIELDS)},
  count_if({' AND '.join(_t(f) for f in GTS.PROVENANCE_FIELDS)}) AS n_complete FROM p GROUP BY source"""
ORACLE["usage_eligibility"] = f"""WITH {DOC_PROV}
SELECT source, manifest_name, allowed_usage, count(*) AS n_docs,
  count_if(coalesce(allowed_usage IN ({', '.join(q(u) for u in DMS.TRAINING_USAGES)}), false)) AS n_eligible
FROM p GROUP BY 1, 2, 3"""
ORACLE["source_manifest"] = f"""WITH {DOC_PROV}
SELECT manifest_name, source_url, count(DISTINCT source) AS n_sources, count(*) AS n_docs FROM p GROUP BY 1, 2"""
ORACLE["translation_pairs"] = f"""
WITH man AS ({_man}),
u AS (SELECT conv_id, turn, text AS source_text FROM conversations WHERE role = 'user'),
a AS (SELECT conv_id, turn - 1 AS turn, text AS target_text FROM conversations WHERE role = 'assistant'),
pr AS (SELECT u.conv_id, source_text, target_text, CAST(u.conv_id % {len(DMS.MANIFEST)} AS INTEGER) AS mord
       FROM u JOIN a ON u.conv_id = a.conv_id AND u.turn = a.turn)
SELECT source_text, target_text, m_license AS license_status, allowed_usage, source_url
FROM pr LEFT JOIN man ON pr.mord = man.mord
WHERE coalesce(m_license <> '', false) AND coalesce(allowed_usage <> '', false)"""
ORACLE["teacher_records"] = f"""
SELECT concat('teacher-', CAST(conv_id AS VARCHAR)) AS id, concat({q(GENQ.TEACHER_ANSWER_PREFIX)}, arg_min(text, turn)) AS assistant,
  'lending' AS domain, 'mn' AS language, false AS contains_pii, true AS human_review_required
FROM conversations WHERE role = 'user' GROUP BY conv_id"""


# --- preparation, validation and audit jobs ---------------------------------------------------

_pii3 = (f"(regexp_matches(text, {q(P.PHONE_RE2_EXISTS)}) OR regexp_matches(text, {q(P.EMAIL_RE2_EXISTS)}) "
         f"OR regexp_matches(text, {q(P.REGISTER_RE2_EXISTS)}))")
ORACLE["pii_exclusion"] = f"SELECT source, count(*) AS n_docs, count_if(NOT {_pii3}) AS n_kept FROM documents GROUP BY source"

ORACLE["sft_prep_summary"] = f"""
WITH c AS (
  SELECT conv_id, bool_or({_pii3}) AS pii,
    CASE WHEN count(*) < 2 THEN 'e' WHEN NOT (bool_or(role = 'user') AND bool_or(role = 'assistant')) THEN 'e'
         ELSE {_FIRST_ERROR} END AS err
  FROM conversations GROUP BY conv_id),
s AS (SELECT count_if(err IS NULL AND pii) AS rejected_contains_pii, count_if(err IS NULL AND NOT pii) AS accepted,
             count_if(err IS NOT NULL) AS quarantined FROM c),
v AS (SELECT *, CASE WHEN accepted > 1 THEN greatest(1, CAST(floor(accepted * 0.1::DOUBLE) AS BIGINT)) ELSE 0 END AS validation FROM s)
SELECT rejected_contains_pii, accepted, quarantined, validation,
  CASE WHEN accepted - validation > 0 THEN accepted - validation ELSE accepted END AS train,
  CASE WHEN accepted = 0 THEN 'error: no records accepted' WHEN accepted < 20 THEN 'error: dataset too small' ELSE 'ok' END AS guard
FROM v"""

ORACLE["field_validation"] = """
WITH r AS (
  SELECT unnest(list_filter([CASE WHEN NOT coalesce(role IN ('system', 'user', 'assistant'), false) THEN 'role_enum' END,
                             CASE WHEN NOT coalesce(length(text) >= 1, false) THEN 'content_min_length' END,
                             CASE WHEN NOT coalesce(turn >= 0, false) THEN 'turn_non_negative' END], lambda x: x IS NOT NULL)) AS rule
  FROM conversations)
SELECT rule, count(*) AS n FROM r GROUP BY rule
UNION ALL SELECT 'rows_checked', count(*) FROM conversations"""

ORACLE["message_accessors"] = """
SELECT conv_id, arg_max(text, turn) AS last_content,
  (list(text ORDER BY turn))[2] AS second_content,
  CASE WHEN count(*) < 3 THEN '' ELSE arg_max(text, turn) END AS assistant_v2
FROM conversations GROUP BY conv_id"""

_chat_system = _reg.CHAT_SYSTEM
ORACLE["chat_prompts"] = f"""
WITH x AS ({CONTEXT}),
m AS (SELECT conv_id, {_context_missing('x')} AS miss FROM x)
SELECT conv_id, concat({q(_chat_system)}, CASE WHEN len(miss) > 0 THEN array_to_string(miss, ', ') ELSE 'none' END, '.') AS system_prompt FROM m"""

_ww = glossary_sql('"user"', V.FINANCE_GLOSSARY_ID)[1]
ORACLE["rewrite_audit"] = f"""
WITH {V1_CTE},
i AS ({issues_cte('SELECT * FROM v', 'idx, assistant, "user"', '"user"')})
SELECT idx, array_to_string(cats, '|') AS compliance_warnings, CAST(len(alts) AS INTEGER) AS n_alternatives,
  {confidence_sql('assistant', f'len({_ww}) + len(cats)')} AS confidence FROM i"""

from ..operators import evaluate as EVS  # noqa: E402
ORACLE["benchmark_coverage"] = f"""
WITH {V1_CTE}, r AS (SELECT unnest([{', '.join(q(c) for c in EVS.REQUIRED_CATEGORIES)}]) AS task),
c AS (SELECT domain AS task, count(*) AS n FROM v GROUP BY 1)
SELECT r.task, coalesce(c.n, 0) AS n_items FROM r LEFT JOIN c ON r.task = c.task"""

ORACLE["governance_audit"] = f"""
WITH {V1_CTE}, i AS ({issues_cte('SELECT * FROM v', 'idx, assistant', 'assistant')}),
c AS (SELECT idx, len(cats) = 0 AS compliance_ok, len(cats) AS n, {confidence_sql('assistant', 'len(cats)')} AS confidence FROM i)
SELECT idx, {q(V.MOCK_TEACHER_MODEL)} AS model, 'sft_v1' AS prompt_version, {q(V.FINANCE_GLOSSARY_ID)} AS glossary_version,
  compliance_ok, confidence,
  CASE WHEN n > 0 OR confidence < {D(V.REVIEW_THRESHOLD)} THEN 'needs_review' ELSE 'auto_approved' END AS review_status FROM c"""

ORACLE["benchmark_items"] = f"""
SELECT item_id, length(text) AS input_chars,
  {q(';'.join(sorted(f'{k}={v}' for k, v in DMS.BENCHMARK_TEMPLATE_METADATA.items())))} AS metadata FROM benchmark"""

ORACLE["jsonl_roundtrip"] = f"""
WITH v AS ({v2_sql()})
SELECT id, 3 AS n_messages, domain, md5(assistant) AS assistant_md5 FROM v"""

ORACLE["quality_v2_verdict"] = f"""
WITH c AS ({v2_gate_sql()}), s AS ({v2_sql()})
SELECT count(*) AS rows, count_if(first_violation IS NOT NULL) AS failing_rows,
  min_by(first_violation, CASE WHEN first_violation IS NOT NULL THEN idx END) FILTER (WHERE first_violation IS NOT NULL) AS first_failure,
  count(DISTINCT c.domain) AS n_domains, (SELECT count(DISTINCT source) FROM s) AS n_sources,
  CASE WHEN count_if(first_violation IS NOT NULL) = 0 AND count(*) > 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM c"""


# --- result types ---------------------------------------------------------------------------
# DuckDB returns HUGEINT for count_if / sum over integers, where Spark returns BIGINT.
# Every such aggregate here is over integers, so each is cast to BIGINT.

def _cast_int_aggregates(sql_text: str) -> str:
    import re as _re
    out, i = [], 0
    pat = _re.compile(r"\b(count_if|sum)\(")
    while True:
        m = pat.search(sql_text, i)
        if not m:
            out.append(sql_text[i:])
            return "".join(out)
        out.append(sql_text[i:m.start()])
        depth, j = 1, m.end()
        in_str = False
        while depth:
            ch = sql_text[j]
            if ch == "'":
                in_str = not in_str
            elif not in_str:
                depth += ch == "("
                depth -= ch == ")"
            j += 1
        inner = _cast_int_aggregates(sql_text[m.end():j - 1])
        out.append(f"CAST({m.group(1)}({inner}) AS BIGINT)")
        i = j


ORACLE.update({k: _cast_int_aggregates(v) for k, v in ORACLE.items()})
for _name, _col in (("quality_v2", "mn_chars"), ("quality_v3", "mn_chars"), ("benchmark_items", "input_chars")):
    ORACLE[_name] = f"SELECT * REPLACE (CAST({_col} AS INTEGER) AS {_col}) FROM ({ORACLE[_name]})"


# --- S6 glossary overlay -------------------------------------------------------------------------

_defaults = " UNION ALL ".join(f"SELECT {i}::BIGINT AS ord, {q(t)} AS term, {q(p)} AS preferred"
                               for i, (t, p) in enumerate(V.DEFAULT_GLOSSARY))
ORACLE["glossary_overlay"] = _cast_int_aggregates(f"""
WITH {V1_CTE},
p AS (SELECT idx, regexp_extract("user", {q(_reg.TRANSLATION_TERM_EN)}, 1) AS term,
             regexp_extract(assistant, {q(_reg.TRANSLATION_TERM_MN)}, 1) AS preferred
      FROM v),
f AS (SELECT term, min(idx) AS ord, arg_min(preferred, idx) AS preferred FROM p WHERE term <> '' AND preferred <> '' GROUP BY term),
d AS ({_defaults})
SELECT 'corpus' AS glossary_id, d.ord, d.term, coalesce(f.preferred, d.preferred) AS preferred
FROM d LEFT JOIN f ON d.term = f.term
UNION ALL
SELECT 'corpus', f.ord + {len(V.DEFAULT_GLOSSARY)}, f.term, f.preferred FROM f
WHERE f.term NOT IN (SELECT term FROM d)""")


from . import oracle_records as _own  # noqa: E402,F401  (adds the SQL of the queries in records)
from . import oracle_files as _files  # noqa: E402,F401
from . import oracle_jobs as _jobs  # noqa: E402,F401
from . import oracle_said as _said  # noqa: E402,F401
