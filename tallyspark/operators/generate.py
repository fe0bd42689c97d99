"""Deterministic, index-driven instruction-set generators (G1-G7) and reshapes.

Each generator maps an index column to a record with narrow Column expressions,
so it scales with whatever table supplies the index (one record per input row,
no shuffle). Slot vocabularies are literal arrays indexed with ``pmod``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import credit as C
from ..functions.templating import pick, render
from . import templates_v1 as T1
from . import templates_v2 as T2
from . import templates_v3 as T3
from ..functions.vocab import MOCK_TEACHER_MODEL


def _messages(system: Column, user: Column, assistant: Column) -> Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant.alias("content")),
    )


def _case(key: Column, branches: dict) -> Column:
    out = None
    for k, v in branches.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


# --- G1: five-domain instruction set (v1) -------------------------------------

def render_v1(df: DataFrame, index_col: str = "idx") -> DataFrame:
    """Row-wise rendering: one record per input row; ``index_col`` is the 0-based generator index."""
    i = F.col(index_col)
    domain = pick(T1.DOMAINS, i)
    users, assistants = {}, {}
    for d in T1.DOMAINS:
        fields = {slot: pick(T1.VOCABS[v], i * mul + off) for slot, (v, mul, off) in T1.SLOTS[d].items()}
        u_t, a_t = T1.TEMPLATES[d]
        users[d], assistants[d] = render(u_t, fields), render(a_t, fields)
    return df.select(
        i.alias("idx"),
        F.format_string(T1.ID_FORMAT, i + 1).alias("id"),
        domain.alias("domain"),
        F.lit(T1.SYSTEM).alias("system"),
        _case(domain, users).alias("user"),
        _case(domain, assistants).alias("assistant"),
        F.lit(T1.SOURCE).alias("source"),
        F.lit(T1.LICENSE_STATUS).alias("license_status"),
        F.lit(T1.ALLOWED_USAGE).alias("allowed_usage"),
        F.lit(False).alias("contains_pii"),
    )


def with_messages(df: DataFrame) -> DataFrame:
    """Flat (system, user, assistant) -> ``messages ARRAY<STRUCT<role,content>>``."""
    return df.withColumn("messages", _messages(F.col("system"), F.col("user"), F.col("assistant"))) \
             .drop("system", "user", "assistant")


# --- G2/G3: v2 scenario facts and ten-task records ------------------------------

def scenario_v2(df: DataFrame, index_col: str = "idx") -> DataFrame:
    i = F.col(index_col)
    revenue = F.lit(80) + F.pmod(i, F.lit(11)) * 18
    rate = F.lit(0.52) + F.pmod(i, F.lit(5)).cast("double") * F.lit(0.05)
    coll_names = [n for n, _ in T2.COLLATERALS]
    coll_values = [v for _, v in T2.COLLATERALS]
    return df.select(
        i.alias("idx"),
        revenue.cast("bigint").alias("revenue"),
        (revenue.cast("double") * rate).cast("bigint").alias("expense"),
        (F.lit(20) + F.pmod(i, F.lit(9)) * 12).cast("bigint").alias("debt"),
        (F.lit(6) + F.pmod(i, F.lit(8)) * 5).cast("bigint").alias("cash"),
        (F.lit(15) + F.pmod(i, F.lit(10)) * 8).cast("bigint").alias("loan_amount"),
        pick(T2.TERM_CHOICES, i).cast("bigint").alias("term_months"),
        pick(coll_names, i).alias("collateral"),
        pick(coll_values, i).cast("bigint").alias("collateral_value"),
        pick(T2.SECTORS, i).alias("sector"),
        pick(T2.MISSING_DOCS, i).alias("missing_doc"),
    )


def metrics_v2(df: DataFrame) -> DataFrame:
    """C1 + C3/C6/C7/C8/C9 over a v2 scenario table."""
    r = C.ratios("revenue", "expense", "debt", "cash", "loan_amount", "term_months", "collateral_value")
    out = df
    for k, v in r.items():
        out = out.withColumn(k, v)
    out = out.withColumn("risk_tier", C.risk_tier_v2("profit_margin", "debt_to_revenue", "cash_to_debt"))
    out = out.withColumn("collateral_tier", C.collateral_tier("collateral_coverage"))
    out = out.withColumn("repayment_coverage", C.repayment_coverage("profit", "monthly_repayment"))
    out = out.withColumn("repayment_tier", C.repayment_tier("repayment_coverage"))
    out = out.withColumn("red_flags", C.red_flags("debt_to_revenue", "cash_to_debt", "expense_ratio",
                                                  "collateral_coverage"))
    out = out.withColumn("net_after_debt", C.net_after_debt("profit", "monthly_repayment"))
    out = out.withColumn("cashflow_tier", C.cashflow_tier("net_after_debt", "loan_amount"))
    return out


def base_input_v2(s=F.col) -> Column:
    return render(T2.BASE_INPUT, {k: s(k).cast("string") for k in
                                  ("sector", "revenue", "expense", "debt", "cash", "loan_amount",
                                   "term_months", "collateral", "collateral_value")})


def render_v2(df: DataFrame, index_col: str = "idx") -> DataFrame:
    """Row-wise rendering of v2 records."""
    m = metrics_v2(scenario_v2(df, index_col))
    col = F.col
    fields = {
        "level": col("risk_tier"), "profit_m": C.money("profit"), "margin_p": C.percent("profit_margin", None),
        "debt_p": C.percent("debt_to_revenue", None), "cash_p": C.percent("cash_to_debt", None),
        "expense_p": C.percent("expense_ratio", None), "repay_m": C.money("monthly_repayment"),
        "coverage2": C.fixed(col("collateral_coverage"), 2), "sector": col("sector"),
        "missing_doc": col("missing_doc"), "recommendation": C.recommendation_v2("risk_tier"),
        "loan_m": C.money("loan_amount"), "term_months": col("term_months").cast("string"),
        "revenue_m": C.money("revenue"), "expense_m": C.money("expense"), "collateral": col("collateral"),
        "collateral_value_m": C.money("collateral_value"), "collateral_level": col("collateral_tier"),
        "repay_cov2": C.fixed(col("repayment_coverage"), 2), "repay_level": col("repayment_tier"),
        "flags": F.array_join(col("red_flags"), ", "), "debt_m": C.money("debt"), "cash_m": C.money("cash"),
        "net_m": C.money("net_after_debt"), "cashflow_level": col("cashflow_tier"),
    }
    task = pick(T2.TASKS, col("idx"))
    base = base_input_v2()
    user = _case(task, {t: F.concat(F.lit(T2.USER_PREFIX[t]), base) for t in T2.TASKS})
    assistant = _case(task, {t: render(T2.ASSISTANT[t], fields) for t in T2.TASKS})
    return m.select(
        "idx",
        F.format_string(T2.ID_FORMAT, col("idx") + 1).alias("id"),
        task.alias("domain"),
        F.lit(T2.SYSTEM).alias("system"),
        user.alias("user"),
        assistant.alias("assistant"),
        F.lit(T2.SOURCE).alias("source"),
        F.lit("synthetic").alias("license_status"),
        F.lit("training_allowed").alias("allowed_usage"),
        F.lit(False).alias("contains_pii"),
        F.lit(True).alias("numeric_example"),
        F.lit(True).alias("metrics_expected"),
    )


# --- G4/G5: v3 scenario facts and quota-driven records --------------------------

def v3_domain_bounds():
    """(domain, start, quota) with start = 0-based offset inside one quota cycle."""
    out, start = [], 0
    for d, q in T3.DOMAIN_QUOTAS:
        out.append((d, start, q))
        start += q
    return out


def v3_domain(global_index: Column) -> Column:
    """Domain of a 1-based global index; the quota layout repeats every cycle."""
    pos = F.pmod(global_index - 1, F.lit(T3.CYCLE))
    out = None
    for d, start, q in v3_domain_bounds():
        cond = pos < start + q
        out = F.when(cond, F.lit(d)) if out is None else out.when(cond, F.lit(d))
    return out


def scenario_v3(df: DataFrame, index_col: str = "gidx") -> DataFrame:
    i = F.col(index_col)
    revenue = F.lit(60) + F.pmod(i, F.lit(15)) * 12
    rate = pick(T3.EXPENSE_RATES, i)
    docs = F.element_at(F.array(*[F.array(*[F.lit(d) for d in ds]) for ds in T3.DOC_SETS]),
                        F.pmod(i, F.lit(len(T3.DOC_SETS))).cast("int") + 1)
    return df.select(
        i.alias("gidx"),
        pick(T3.SECTORS, i).alias("sector"),
        revenue.cast("bigint").alias("revenue"),
        F.bround(revenue.cast("double") * rate, 0).cast("bigint").alias("expense"),
        (F.lit(10) + F.pmod(i, F.lit(12)) * 9).cast("bigint").alias("debt"),
        (F.lit(4) + F.pmod(i, F.lit(10)) * 4).cast("bigint").alias("cash"),
        (F.lit(12) + F.pmod(i, F.lit(13)) * 6).cast("bigint").alias("loan_amount"),
        pick(T3.TERM_CHOICES, i).cast("bigint").alias("term_months"),
        docs.alias("docs"),
        *([F.col("_domain")] if "_domain" in df.columns else []),
    )


def metrics_v3(df: DataFrame, zero_debt_is_low: bool = False) -> DataFrame:
    """C2 + C4 + C5 over a scenario table (revenue, expense, debt, cash, loan_amount, term_months)."""
    r = C.ratios("revenue", "expense", "debt", "cash", "loan_amount", "term_months")
    out = df
    for k, v in r.items():
        out = out.withColumn(k, v)
    out = out.withColumn("risk_tier", C.risk_tier_v3("profit_margin", "debt_to_revenue", "cash_to_debt",
                                                     zero_debt_is_low))
    return out.withColumn("recommendation", C.recommendation_v3("profit_margin", "debt_to_revenue", "risk_tier"))


def prompt_v3(task: Column, s=F.col) -> Column:
    fields = {k: s(k).cast("string") for k in ("sector", "revenue", "expense", "debt", "cash", "loan_amount",
                                              "term_months")}
    fields["task"] = task
    return render(T3.PROMPT, fields)


def render_v3(df: DataFrame, index_col: str = "gidx", domain_col: str | None = None) -> DataFrame:
    """Row-wise rendering of v3 records; ``index_col`` is the 1-based global index and the
    domain follows the quota cycle unless ``domain_col`` supplies it."""
    m = metrics_v3(scenario_v3(df.withColumnRenamed(domain_col, "_domain") if domain_col else df, index_col))
    col = F.col
    domain = col("_domain") if domain_col else v3_domain(col("gidx"))
    money3 = lambda c: C.money(c, "₮")
    docs_block = F.array_join(F.transform(col("docs"), lambda d: F.concat(F.lit("- "), d)), "\n")
    fields = {
        "level": col("risk_tier"), "revenue_m": money3("revenue"), "expense_m": money3("expense"),
        "profit_m": money3("profit"), "margin_p": C.percent("profit_margin"),
        "expense_p": C.percent("expense_ratio"), "debt_p": C.percent("debt_to_revenue"),
        "cash_p": C.percent("cash_to_debt"),
        "repayment_line": F.coalesce(render(T3.REPAYMENT_LINE, {"repay_m": money3("monthly_repayment")}), F.lit("")),
        "advice": col("recommendation"), "docs_block": docs_block,
        "docs_inline": F.array_join(col("docs"), ", "),
    }
    answers = {}
    for d, _q in T3.DOMAIN_QUOTAS:
        f = dict(fields, focus=F.lit(T3.FOCUS.get(d, "")))
        answers[d] = render(T3.ANSWER_TEMPLATE[d], f)
    task = _case(domain, {d: F.lit(T3.TASK_NAMES[d]) for d, _ in T3.DOMAIN_QUOTAS})
    return m.select(
        "gidx",
        F.concat(F.lit(T3.ID_PREFIX), domain, F.lit("-"), F.format_string("%05d", col("gidx"))).alias("id"),
        domain.alias("domain"),
        F.lit(T3.SYSTEM).alias("system"),
        prompt_v3(task).alias("user"),
        _case(domain, answers).alias("assistant"),
        F.lit(T3.SOURCE).alias("source"),
        F.lit("synthetic").alias("license_status"),
        F.lit("training_allowed").alias("allowed_usage"),
        F.lit(False).alias("contains_pii"),
        (domain != "missing_documents_request").alias("numeric_example"),
    )


# --- content-addressed generation ----------------------------------------------------
#
# Every generated field depends on the index only through fixed moduli (vocabulary
# sizes and the scenario formulas), so the content repeats with a fixed period. Each
# distinct content is rendered once into a dimension whose size is bounded by the
# period (not by the data) and attached to the index with a broadcast hash join; the
# per-record work is a lookup plus the record id.

import math  # noqa: E402

V1_PERIOD = math.lcm(len(T1.DOMAINS), *[len(T1.VOCABS[v]) for slots in T1.SLOTS.values() for v, _m, _o in slots.values()])
# v2 scenario moduli: revenue 11, expense rate 5, debt 9, cash 8, loan 10, terms, collaterals,
# sectors, documents, tasks.
V2_PERIOD = math.lcm(11, 5, 9, 8, 10, len(T2.TERM_CHOICES), len(T2.COLLATERALS), len(T2.SECTORS),
                     len(T2.MISSING_DOCS), len(T2.TASKS))
# v3 scenario moduli: revenue 15, expense rates, debt 12, cash 10, loan 13, terms, sectors, document sets.
V3_PERIOD = math.lcm(15, len(T3.EXPENSE_RATES), 12, 10, 13, len(T3.TERM_CHOICES), len(T3.SECTORS), len(T3.DOC_SETS))
CONTENT_COLS = ("domain", "system", "user", "assistant")


def content_v1(spark) -> DataFrame:
    """The V1_PERIOD distinct v1 contents, keyed by ``_k`` = idx mod V1_PERIOD."""
    return render_v1(spark.range(V1_PERIOD).withColumnRenamed("id", "idx")) \
        .select(F.col("idx").alias("_k"), *CONTENT_COLS)


def content_v2(spark) -> DataFrame:
    return render_v2(spark.range(V2_PERIOD).withColumnRenamed("id", "idx")) \
        .select(F.col("idx").alias("_k"), *CONTENT_COLS)


def content_v3(spark) -> DataFrame:
    """Distinct v3 contents keyed by (``_k`` = gidx mod V3_PERIOD, domain): V3_PERIOD x 6 rows."""
    base = spark.range(V3_PERIOD).select(
        F.col("id").alias("gidx"),
        F.explode(F.array(*[F.lit(d) for d, _ in T3.DOMAIN_QUOTAS])).alias("dom"))
    return render_v3(base, "gidx", "dom").select(F.col("gidx").alias("_k"), *CONTENT_COLS)


def v1_keys(df: DataFrame, index_col: str = "idx") -> DataFrame:
    i = F.col(index_col)
    return df.select(i.alias("idx"), F.pmod(i, F.lit(V1_PERIOD)).alias("_k"))


def v2_keys(df: DataFrame, index_col: str = "idx") -> DataFrame:
    i = F.col(index_col)
    return df.select(i.alias("idx"), F.pmod(i, F.lit(V2_PERIOD)).alias("_k"))


def v3_keys(df: DataFrame, index_col: str = "gidx") -> DataFrame:
    i = F.col(index_col)
    return df.select(i.alias("gidx"), F.pmod(i, F.lit(V3_PERIOD)).alias("_k"), v3_domain(i).alias("domain"))


def attach(keys: DataFrame, content: DataFrame) -> DataFrame:
    """Records = index keys joined to their (bounded, broadcast) content dimension."""
    on = ["_k", "domain"] if "domain" in keys.columns else ["_k"]
    return keys.join(F.broadcast(content), on).drop("_k")


def sft_v1(df: DataFrame, index_col: str = "idx") -> DataFrame:
    """G1: one v1 record per input row (0-based index)."""
    r = attach(v1_keys(df, index_col), content_v1(df.sparkSession))
    return r.select("idx", F.format_string(T1.ID_FORMAT, F.col("idx") + 1).alias("id"), *CONTENT_COLS,
                    F.lit(T1.SOURCE).alias("source"), F.lit(T1.LICENSE_STATUS).alias("license_status"),
                    F.lit(T1.ALLOWED_USAGE).alias("allowed_usage"), F.lit(False).alias("contains_pii"))


def sft_v2(df: DataFrame, index_col: str = "idx") -> DataFrame:
    """One v2 record per input row (0-based index)."""
    r = attach(v2_keys(df, index_col), content_v2(df.sparkSession))
    return r.select("idx", F.format_string(T2.ID_FORMAT, F.col("idx") + 1).alias("id"), *CONTENT_COLS,
                    F.lit(T2.SOURCE).alias("source"), F.lit("synthetic").alias("license_status"),
                    F.lit("training_allowed").alias("allowed_usage"), F.lit(False).alias("contains_pii"),
                    F.lit(True).alias("numeric_example"), F.lit(True).alias("metrics_expected"))


def sft_v3(df: DataFrame, index_col: str = "gidx") -> DataFrame:
    """One v3 record per input row (1-based global index; domain from the quota cycle)."""
    r = attach(v3_keys(df, index_col), content_v3(df.sparkSession))
    return r.select("gidx",
                    F.concat(F.lit(T3.ID_PREFIX), F.col("domain"), F.lit("-"), F.format_string("%05d", F.col("gidx"))).alias("id"),
                    *CONTENT_COLS, F.lit(T3.SOURCE).alias("source"), F.lit("synthetic").alias("license_status"),
                    F.lit("training_allowed").alias("allowed_usage"), F.lit(False).alias("contains_pii"),
                    (F.col("domain") != "missing_documents_request").alias("numeric_example"))


def nested_metadata(df: DataFrame, keys=("domain", "source", "license_status", "allowed_usage",
                                         "contains_pii", "numeric_example")) -> DataFrame:
    """Flat record -> ``messages`` + ``metadata`` struct (the v2/v3 file layout)."""
    present = [k for k in keys if k in df.columns]
    return with_messages(df).withColumn("metadata", F.struct(*[F.col(k) for k in present])).drop(*present)


# --- P1-P4 -------------------------------------------------------------------------

TRANSLATION_SYSTEM = "Translate accurately between English and Mongolian."  # FIXED VALUE
TEACHER_SYSTEM = ("You are Qwen3-235B-A22B-Instruct-2507 generating safe Mongolian lending "
                  "SFT data for Lendex and Datagate. Never promise loan approval.")  # FIXED VALUE
TEACHER_ANSWER_PREFIX = (  # FIXED VALUE
    "Таны хүсэлтийг хүлээн авлаа. Зээлийн боломжийг шалгахын тулд зээлийн хэмжээ, "
    "хугацаа, сарын орлого, ажил эрхлэлт, барьцаа, зээлийн төрөл болон холбоо барих "
    "утасны дугаарыг бүрэн өгнө үү. Эцсийн шийдвэр нь нэмэлт хяналт, байгууллагын "
    "шаардлагын дараа гарна."
    "\n\nДаалгаврын агуулга: "
)
FALLBACK_SYSTEM = "Answer safely in Mongolian for lending workflows."  # FIXED VALUE
FALLBACK_ANSWER = "Таны хүсэлтийг шалгаж болно. Эцсийн шийдвэр нь нэмэлт хяналтын дараа гарна."  # FIXED VALUE
FINAL_ONLY_INSTRUCTION = ("Зөвхөн эцсийн хариуг Монгол хэлээр бич. Дотоод бодол, тайлбар, <think> "
                          "хэсэг бүү гарга.")  # FIXED VALUE


def translation_pairs(df: DataFrame) -> DataFrame:
    """F1 + P1: keep rows whose license_status and allowed_usage are both truthy (non-empty),
    then shape them as 3-message chat records with 4-key provenance metadata."""
    keep = (F.coalesce(F.col("license_status"), F.lit("")) != "") & (F.coalesce(F.col("allowed_usage"), F.lit("")) != "")
    return df.filter(keep).select(
        _messages(F.lit(TRANSLATION_SYSTEM), F.col("source_text"), F.col("target_text")).alias("messages"),
        F.struct(*[F.col(k).cast("string").alias(k) for k in
                   ("source_url", "license_status", "retrieval_date", "allowed_usage")]).alias("metadata"),
    )


def teacher_records(seeds: DataFrame) -> DataFrame:
    """Seed prompts -> mock teacher records (domain/language defaults, review flag)."""
    return seeds.select(
        F.concat(F.lit("teacher-"), F.col("id").cast("string")).alias("id"),
        _messages(F.lit(TEACHER_SYSTEM), F.col("prompt"),
                  F.concat(F.lit(TEACHER_ANSWER_PREFIX), F.col("prompt"))).alias("messages"),
        F.coalesce(F.col("domain"), F.lit("lending")).alias("domain"),
        F.coalesce(F.col("language"), F.lit("mn")).alias("language"),
        F.coalesce(F.col("contains_pii").cast("boolean"), F.lit(False)).alias("contains_pii"),
        F.lit("mock_teacher_dry_run").alias("source"),
        F.lit(MOCK_TEACHER_MODEL).alias("model"),
        F.lit("synthetic_seed").alias("license_status"),
        F.lit("training_allowed_after_human_review").alias("allowed_usage"),
        F.lit(True).alias("human_review_required"),
    )


def fallback_records(seeds: DataFrame) -> DataFrame:
    """Seed prompts -> fixed safe answers (used when the input set is absent)."""
    return seeds.select(
        F.concat(F.lit("fallback-"), F.col("id").cast("string")).alias("id"),
        _messages(F.lit(FALLBACK_SYSTEM), F.col("prompt"), F.lit(FALLBACK_ANSWER)).alias("messages"),
        F.lit(False).alias("contains_pii"),
        F.lit("fallback_seed_for_local_prep").alias("source"),
    )


INFERENCE_SYSTEM = ("Та Lendex болон Datagate-д зориулсан монгол хэлний санхүү, зээлийн туслах. "
                    "Та эелдэг, тодорхой хариулж, зээлийн зөвшөөрөл амлахгүй. ")  # FIXED VALUE


def inference_messages(prompts: DataFrame, prompt_col: str = "prompt") -> DataFrame:
    """Prompt -> [system(+final-only instruction), user(final-only instruction + blank line + prompt)]."""
    return prompts.withColumn("messages", F.array(
        F.struct(F.lit("system").alias("role"), F.lit(INFERENCE_SYSTEM + FINAL_ONLY_INSTRUCTION).alias("content")),
        F.struct(F.lit("user").alias("role"),
                 F.concat(F.lit(FINAL_ONLY_INSTRUCTION + "\n\n"), F.col(prompt_col)).alias("content"))))
