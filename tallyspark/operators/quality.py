"""Dataset quality gates (Q1-Q8) as violation columns plus one-row verdicts.

The reference stops at the first failing rule of the first failing row; here
every rule is evaluated on every row, ``violations`` keeps them in rule order
and ``first_violation`` is element 0. The fail-fast message of a whole dataset is
``min_by(first_violation, row order)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import credit as C
from ..functions import scan as SC
from ..functions import text as TX
from ..functions.templating import render
from . import templates_v2 as T2
from . import templates_v3 as T3

# ---------------------------------------------------------------------------
# FIXED VALUES — v2 gate lists and messages.
V2_METRIC_TERMS = ["ашиг", "ашгийн маржин", "өр/орлого", "мөнгө/өр", "зардлын харьцаа",
                   "сарын ойролцоо төлөлт", "барьцааны бүрхэлт", "төлөлтийн дараах"]
V2_FORBIDDEN = ["<think>", "</think>", "chain-of-thought", "reasoning:", "[Огноог нэмнэ]", "[огноог нэмнэ]"]
V2_MEMO_REQUIRED = ["Эрсдэлийн түвшин", "Шийдвэрийн үндэслэл", "Дутуу баримт", "Санал"]
V2_RISK_WORD = "эрсдэл"
V2_RISK_EXEMPT_DOMAIN = "financial_ratio_explanation"
ROLE_SEQUENCE = ["system", "user", "assistant"]
# ---------------------------------------------------------------------------


def _first_held(held, items, msg) -> Column:
    """The message of the first phrase of ``items`` that the text holds, by ``held``: phrase -> Column."""
    return F.coalesce(*[F.when(held(it), F.lit(msg.format(it))) for it in items])


def _with_facts(df: DataFrame, low, verbatim, values=()) -> DataFrame:
    """``_facts`` of the assistant's text, and its letter counts as columns of their own."""
    df = df.withColumn("_facts", SC.facts(F.col("assistant"), low, verbatim, list(values)))
    return df.withColumns({"mn_chars": F.col("_facts.mn").cast("int"), "_latin": F.col("_facts.latin").cast("int")})


def metric_term_count(held) -> Column:
    """How many of the 8 metric terms the lower-cased text holds, by ``held``: phrase -> Column."""
    return sum((held(t).cast("int") for t in V2_METRIC_TERMS), F.lit(0))


def role_sequence_ok(messages: Column) -> Column:
    return F.coalesce(F.transform(messages, lambda m: m["role"]) == F.array(*[F.lit(r) for r in ROLE_SEQUENCE]),
                      F.lit(False))


def v2_violations(df: DataFrame, roles_ok: Column | None = None) -> DataFrame:
    """Q1 over flat v2 records (domain, source, contains_pii, assistant, numeric_example)."""
    asked = [*V2_METRIC_TERMS, *V2_FORBIDDEN, V2_RISK_WORD]
    df = _with_facts(df, asked, V2_MEMO_REQUIRED)
    held = lambda p: SC.bit(F.col("_facts.low"), asked.index(p))
    df = df.withColumn("metric_terms", metric_term_count(held))
    named = lambda p: SC.bit(F.col("_facts.verbatim"), V2_MEMO_REQUIRED.index(p))
    mn = F.col("mn_chars")
    rules = [
        F.when(~F.coalesce(F.col("domain").isin(*T2.TASKS), F.lit(False)),
               F.concat(F.lit("missing or invalid domain: "), F.coalesce(F.col("domain"), F.lit("None")))),
        F.when(~F.col("contains_pii").eqNullSafe(False), F.lit("contains_pii must be false")),
        F.when(~F.col("source").eqNullSafe(T2.SOURCE), F.lit("unexpected source metadata")),
        F.when(~(roles_ok if roles_ok is not None else F.lit(True)),
               F.lit("messages must use system/user/assistant format")),
        _first_held(held, V2_FORBIDDEN, "forbidden text found: {}"),
        F.when(F.col("_latin") > mn * F.lit(0.35), F.lit("assistant output is mostly English")),
        F.when(mn < 80, F.lit("assistant output is shorter than 80 Mongolian characters")),
        F.when(~held(V2_RISK_WORD) & ~F.col("domain").eqNullSafe(V2_RISK_EXEMPT_DOMAIN),
               F.lit("risk level or risk discussion is missing")),
        F.when(F.col("domain") == "credit_memo",
               F.coalesce(*[F.when(~named(r), F.lit(f"credit memo missing required field: {r}"))
                            for r in V2_MEMO_REQUIRED])),
        F.when(F.col("numeric_example").eqNullSafe(True) & (F.col("metric_terms") < 1),
               F.lit("numeric example has no calculated metric")),
    ]
    return (df.withColumn("violations", F.array_compact(F.array(*rules)))
              .withColumn("first_violation", F.get(F.col("violations"), 0)).drop("_latin", "_facts"))


# --- v3 -----------------------------------------------------------------------------

def with_prompt_figures(df: DataFrame, prompt: Column) -> tuple[DataFrame, dict]:
    """The six labelled integers of a v3 prompt (null when absent), matched case-insensitively, as columns ``_f_<key>``."""
    df = df.withColumn("_figures", SC.figures(prompt, T3.PROMPT_FIGURES))
    df = df.withColumns({f"_f_{k}": F.col(f"_figures.{k}").try_cast("bigint") for k, _l, _u in T3.PROMPT_FIGURES}).drop("_figures")
    return df, {k: F.col(f"_f_{k}") for k, _l, _u in T3.PROMPT_FIGURES}


def missing_figure(figs: dict) -> Column:
    """Name of the first absent figure, in declared order."""
    return F.coalesce(*[F.when(figs[k].isNull(), F.lit(f"missing numeric field in prompt: {k}"))
                        for k, _l, _u in T3.PROMPT_FIGURES])


def expected_metrics(figs: dict) -> dict:
    """Q3: label -> expected text, recomputed from the prompt figures."""
    r = C.ratios(figs["revenue"], figs["expense"], figs["debt"], figs["cash"], figs["loan_amount"],
                 figs["term_months"])
    m = lambda x: C.money(x, "₮")
    return {
        "Орлого": m(figs["revenue"]),
        "Зардал": m(figs["expense"]),
        "Тооцоолсон ашиг": m(r["profit"]),
        "Ашгийн маржин": C.percent(r["profit_margin"]),
        "Зардлын харьцаа": C.percent(r["expense_ratio"]),
        "Өр/орлогын харьцаа": C.percent(r["debt_to_revenue"]),
        "Мөнгө/өрийн харьцаа": C.percent(r["cash_to_debt"]),
        "Сарын төлбөрийн ойролцоо тооцоо": m(F.coalesce(r["monthly_repayment"], F.lit(0.0))),
    }


def metric_matches(labels, held, shown) -> Column:
    """Q4: labels that the lower-cased output holds (``held``) and whose value it shows verbatim (``shown``)."""
    return sum((F.coalesce(held(lab) & shown(lab), F.lit(False)).cast("int") for lab in labels), F.lit(0))


def v3_violations(df: DataFrame) -> DataFrame:
    """Q2 over flat v3 records (domain, source, contains_pii, user, assistant).

    Prompt figures, expected metric texts and counts are materialised as columns
    first, so each rule references them instead of re-deriving them."""
    df, fcols = with_prompt_figures(df, F.col("user"))
    metrics = expected_metrics(fcols)
    labels = list(metrics)
    for i, lab in enumerate(labels):
        df = df.withColumn(f"_m{i}", metrics[lab])
    mcols = {lab: F.col(f"_m{i}") for i, lab in enumerate(labels)}
    out = F.col("assistant")
    asked = [*T3.BAD_PHRASES, *labels]
    df = _with_facts(df, asked, T3.REQUIRED_NUMERIC_FIELDS, list(mcols.values()))
    held = lambda p: SC.bit(F.col("_facts.low"), asked.index(p))
    named = lambda f: SC.bit(F.col("_facts.verbatim"), T3.REQUIRED_NUMERIC_FIELDS.index(f))
    shown = lambda lab: SC.bit(F.col("_facts.values"), labels.index(lab))
    df = (df.withColumn("metric_matches", metric_matches(labels, held, shown))
            .withColumn("_fig_missing", missing_figure(fcols)))
    mn = F.col("mn_chars")
    dom = F.col("domain")
    numeric = dom.isin(*T3.NUMERIC_DOMAINS)
    strict = dom.isin(*T3.STRICT_MEMO_DOMAINS)
    fig_missing = F.col("_fig_missing")
    rules = [
        F.when(~F.coalesce(dom.isin(*[d for d, _ in T3.DOMAIN_QUOTAS]), F.lit(False)),
               F.coalesce(F.concat(F.lit("unknown domain '"), dom, F.lit("'")), F.lit("unknown domain None"))),
        F.when(~F.col("source").eqNullSafe(T3.SOURCE), F.lit("unexpected source")),
        F.when(~F.col("contains_pii").eqNullSafe(False), F.lit("contains_pii must be false")),
        F.when(out.contains("<") & TX.has_think_tag_regex(out), F.lit("thinking tag found")),
        _first_held(held, T3.BAD_PHRASES, "banned phrase found: {}"),
        F.when(F.col("_latin") > mn * F.lit(0.25), F.lit("output is mostly English")),
        F.when((dom == "credit_memo_numeric") & (mn < 250),
               F.lit("credit memo output shorter than 250 Mongolian characters")),
        F.when(strict, F.coalesce(*[F.when(~named(f), F.lit(f"missing required numeric field: {f}"))
                                    for f in T3.REQUIRED_NUMERIC_FIELDS])),
        F.when(numeric, fig_missing),
        F.when(numeric & strict & fig_missing.isNull(),
               F.coalesce(*[F.when(~shown(lab),
                                   F.concat(F.lit(f"metric mismatch for {lab}: expected "), mcols[lab]))
                            for lab in T3.STRICT_METRIC_LABELS])),
        F.when(numeric & fig_missing.isNull() & (F.col("metric_matches") < 3),
               F.lit("numeric output has fewer than 3 calculated metric matches")),
    ]
    tmp = [c for c in df.columns if c.startswith("_f_") or c.startswith("_m")] + ["_latin", "_fig_missing", "_facts"]
    return (df.withColumn("violations", F.array_compact(F.array(*rules)))
              .withColumn("first_violation", F.get(F.col("violations"), 0)).drop(*tmp))


def figures_roundtrip(df: DataFrame, keys=("gidx",)) -> DataFrame:
    """G6 -> T23: parse the rendered prompt back and compare with the scenario figures."""
    df, figs = with_prompt_figures(df, F.col("user"))
    ok = F.lit(True)
    for k, _l, _u in T3.PROMPT_FIGURES:
        ok = ok & F.coalesce(figs[k] == F.col(k), F.lit(False))
    return df.select(*keys, *[figs[k].alias(f"parsed_{k}") for k, _l, _u in T3.PROMPT_FIGURES],
                     ok.alias("roundtrip_ok"))


def verdict(checked: DataFrame, order_col: str, keys=("domain", "source")) -> DataFrame:
    """Q8: one-row PASS/FAIL summary; the first failing row's message as fail-fast text."""
    return checked.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("first_violation").isNotNull()).alias("failing_rows"),
        F.min_by(F.col("first_violation"), F.when(F.col("first_violation").isNotNull(), F.col(order_col)))
         .alias("first_failure"),
        *[F.count_distinct(k).alias(f"n_{k}s") for k in keys],
    ).withColumn("status", F.when((F.col("failing_rows") == 0) & (F.col("rows") > 0), "PASS").otherwise("FAIL"))


def domain_coverage(df: DataFrame, required, domain_col: str = "domain") -> DataFrame:
    """Q5: required domains with their counts; zero means missing."""
    spark = df.sparkSession
    req = spark.createDataFrame([(d,) for d in required], "domain string")
    counts = df.groupBy(F.col(domain_col).alias("domain")).agg(F.count(F.lit(1)).alias("n_rows"))
    return (req.join(counts, "domain", "left")
               .select("domain", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
               .withColumn("missing", F.col("n_rows") == 0))


def count_rollup(df: DataFrame, keys=("source", "domain")) -> DataFrame:
    """A1 with totals: rows by source and domain, by source, and in all (``level``: grouping id)."""
    return df.rollup(*keys).agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n_rows"))


def quota_table(spark) -> DataFrame:
    """Q6: (total, domain, expected) for a whole set, its training and its validation part; other sizes have no quota."""
    rows = []
    for share in (lambda n: n, lambda n: int(n * 0.9), lambda n: n - int(n * 0.9)):
        quotas = [(d, share(n)) for d, n in T3.DOMAIN_QUOTAS]
        rows += [(sum(n for _, n in quotas), d, n) for d, n in quotas]
    return spark.createDataFrame(rows, "total bigint, domain string, expected bigint")


def domain_rules(sets: DataFrame, set_col: str, domains, spark=None) -> DataFrame:
    """Q5 and Q6 for many sets at once: one row for each set and required domain, with its rows (``missing``: none), the set's total, and
    whether the count is what a set of that size must have (true for sizes without a quota)."""
    spark = spark or sets.sparkSession
    counts = sets.groupBy(set_col, "domain").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(set_col).agg(F.sum("n").alias("total"))
    wanted = totals.withColumn("domain", F.explode(F.array(*[F.lit(d) for d in domains])))
    met = wanted.join(counts, [set_col, "domain"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    quota = met.join(F.broadcast(quota_table(spark)), ["total", "domain"], "left")  # 18 rows
    return quota.select(set_col, "domain", "total", "n", "expected", (F.col("n") == 0).alias("missing"),
                        (F.col("expected").isNull() | (F.col("n") == F.col("expected"))).alias("matches"))


def size_rules(sets: DataFrame, set_col: str, domains, rows: int = 500) -> DataFrame:
    """Q7's size rules by set: exactly ``rows`` records, exactly the known domains, equally many records of each."""
    counts = sets.groupBy(set_col, "domain").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("domain").isin(*domains)
    each = counts.groupBy(set_col).agg(
        F.sum("n").alias("n_rows"), F.count_if(known).alias("n_known"), F.count_if(~F.coalesce(known, F.lit(False))).alias("n_unknown"),
        F.min("n").alias("least"), F.max("n").alias("most"))
    share = rows // len(domains)
    rules = {"is_size": F.col("n_rows") == rows, "domains_known": (F.col("n_known") == len(domains)) & (F.col("n_unknown") == 0),
             "equal_shares": (F.col("least") == share) & (F.col("most") == share)}
    out = each.withColumns(rules)
    return out.select(set_col, "n_rows", *rules, (F.col("is_size") & F.col("domains_known") & F.col("equal_shares")).alias("passes"))


def quota_for_size(total: int) -> dict[str, int] | None:
    """Q6: the domain counts that a set of ``total`` rows must have; None where no quota is set for the size."""
    for share in (lambda n: n, lambda n: int(n * 0.9), lambda n: n - int(n * 0.9)):
        quotas = {d: share(n) for d, n in T3.DOMAIN_QUOTAS}
        if sum(quotas.values()) == total:
            return quotas
    return None


def cycle_expected_counts(total: int) -> dict:
    """Expected per-domain counts for ``total`` consecutive global indexes 1..total."""
    full, rem = divmod(total, T3.CYCLE)
    out, start = {}, 0
    for d, qn in T3.DOMAIN_QUOTAS:
        out[d] = full * qn + min(max(rem - start, 0), qn)
        start += qn
    return out
