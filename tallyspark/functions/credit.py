"""Credit analytics Column builders (C1-C10) and number formatting.

Ratios are DOUBLE; a zero divisor gives null (``try_divide``). Text rendering of
numbers uses ``format_number`` (Java DecimalFormat, HALF_EVEN on the exact binary
value), which renders like Python's ``f"{x:.1f}"``; grouping commas are removed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES — tier labels, recommendation texts, red-flag texts, thresholds.
LOW, MEDIUM, HIGH = "Бага", "Дунд", "Өндөр"
NOT_COMPUTABLE = "тооцох боломжгүй"
V2_RECOMMENDATION = {
    LOW: "Санал: нөхцөлтэй зөвшөөрөх боломжтой, баримтын бүрдлийг баталгаажуулсны дараа шийдвэрлэнэ.",
    MEDIUM: "Санал: нэмэлт баримт, мөнгөн урсгалын баталгаажуулалт хийсний дараа хязгаартай дүнгээр авч үзнэ.",
    HIGH: "Санал: одоогийн нөхцөлөөр шууд зөвшөөрөхгүй, эрсдэлийг бууруулах нэмэлт баталгаа шаардлагатай.",
}
V3_RECOMMENDATION_LOW = "Нөхцөлтэй зөвшөөрөх боломжтой"
V3_RECOMMENDATION_DOCS = "Нэмэлт баримт шаардлагатай"
V3_RECOMMENDATION_REDUCE = "Зээлийн дүнг бууруулах саналтай"
V3_RECOMMENDATION_DECLINE = "Одоогоор зээл олгохгүй байх саналтай"
RED_FLAGS = [
    "өрийн ачаалал орлоготой харьцуулахад өндөр",
    "мөнгөн нөөц өр төлбөрт хүрэлцэхгүй",
    "зардлын харьцаа өндөр",
    "барьцааны бүрхэлт сул",
]
RED_FLAG_NONE = "томоохон улаан дохио бага боловч баримтын тулгалт шаардлагатай"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def div(a, b) -> Column:
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def fixed(x, digits: int) -> Column:
    """Python ``f"{x:.{digits}f}"``."""
    return F.replace(F.format_number(_c(x), digits), F.lit(","), F.lit(""))


def money(x, prefix: str = "") -> Column:
    """Near-integer (< 0.01 away) -> integer, else one decimal; then ' сая'."""
    v = _c(x).cast("double")
    near = F.abs(v - F.round(v)) < 0.01
    body = F.when(near, F.round(v).cast("bigint").cast("string")).otherwise(fixed(v, 1))
    return F.concat(F.lit(prefix), body, F.lit(" сая"))


def percent(x, none_text: str | None = NOT_COMPUTABLE) -> Column:
    v = _c(x)
    txt = F.concat(fixed(v * 100, 1), F.lit("%"))
    return F.coalesce(txt, F.lit(none_text)) if none_text is not None else txt


def ratios(revenue, expense, debt, cash, loan_amount, term_months, collateral_value=None) -> dict:
    """Profit, margin, expense, debt and cash ratios, repayment, coverage."""
    profit = _c(revenue) - _c(expense)
    out = {
        "profit": profit,
        "profit_margin": div(profit, revenue),
        "expense_ratio": div(expense, revenue),
        "debt_to_revenue": div(debt, revenue),
        "cash_to_debt": div(cash, debt),
        "monthly_repayment": div(loan_amount, term_months),
    }
    if collateral_value is not None:
        out["collateral_coverage"] = div(collateral_value, loan_amount)
    return out


def risk_tier_v2(margin, debt_ratio, cash_ratio) -> Column:
    m, d, c = _c(margin), _c(debt_ratio), _c(cash_ratio)
    return (F.when((m >= 0.28) & (d <= 0.45) & (c >= 0.25), F.lit(LOW))
             .when((m >= 0.15) & (d <= 0.8), F.lit(MEDIUM)).otherwise(F.lit(HIGH)))


def _or_default(x, default: float) -> Column:
    """Python ``x or default``: null and 0.0 both take the default."""
    v = _c(x)
    return F.when(v.isNull() | (v == 0), F.lit(default)).otherwise(v)


def risk_tier_v3(margin, debt_ratio, cash_ratio, zero_debt_is_low: bool = False) -> Column:
    """C4 with the reference defaults (margin 0, debt ratio 99, cash ratio 0).

    A debt ratio of exactly 0 falls back to 99 (high risk); pass
    ``zero_debt_is_low=True`` to treat zero debt as a 0 ratio instead."""
    m = _or_default(margin, 0.0)
    d = F.coalesce(_c(debt_ratio), F.lit(99.0)) if zero_debt_is_low else _or_default(debt_ratio, 99.0)
    c = _or_default(cash_ratio, 0.0)
    return (F.when((m >= 0.30) & (d <= 0.45) & (c >= 0.30), F.lit(LOW))
             .when((m >= 0.15) & (d <= 0.85) & (c >= 0.12), F.lit(MEDIUM)).otherwise(F.lit(HIGH)))


def recommendation_v2(tier) -> Column:
    t = _c(tier)
    return (F.when(t == LOW, F.lit(V2_RECOMMENDATION[LOW]))
             .when(t == MEDIUM, F.lit(V2_RECOMMENDATION[MEDIUM])).otherwise(F.lit(V2_RECOMMENDATION[HIGH])))


def recommendation_v3(margin, debt_ratio, tier) -> Column:
    m = _or_default(margin, 0.0)
    d = _or_default(debt_ratio, 99.0)
    t = _c(tier)
    return (F.when(t == LOW, F.lit(V3_RECOMMENDATION_LOW))
             .when((t == MEDIUM) & (m >= 0.20), F.lit(V3_RECOMMENDATION_DOCS))
             .when(d > 0.9, F.lit(V3_RECOMMENDATION_REDUCE)).otherwise(F.lit(V3_RECOMMENDATION_DECLINE)))


def collateral_tier(coverage) -> Column:
    c = _c(coverage)
    return F.when(c >= 2.0, F.lit(LOW)).when(c >= 1.2, F.lit(MEDIUM)).otherwise(F.lit(HIGH))


def repayment_coverage(profit, monthly_repayment) -> Column:
    """profit / monthly payment; 0 when the payment is 0 (or null)."""
    r = _c(monthly_repayment)
    return F.when(F.coalesce(r, F.lit(0.0)) != 0, _c(profit) / r).otherwise(F.lit(0.0))


def repayment_tier(coverage) -> Column:
    c = _c(coverage)
    return F.when(c >= 4, F.lit(LOW)).when(c >= 2, F.lit(MEDIUM)).otherwise(F.lit(HIGH))


def red_flags(debt_ratio, cash_ratio, expense_ratio, coverage) -> Column:
    """Ordered flag texts; the fallback flag when none applies."""
    flags = F.array_compact(F.array(
        F.when(_c(debt_ratio) > 0.7, F.lit(RED_FLAGS[0])),
        F.when(_c(cash_ratio) < 0.2, F.lit(RED_FLAGS[1])),
        F.when(_c(expense_ratio) > 0.72, F.lit(RED_FLAGS[2])),
        F.when(_c(coverage) < 1.3, F.lit(RED_FLAGS[3])),
    ))
    return F.when(F.size(flags) == 0, F.array(F.lit(RED_FLAG_NONE))).otherwise(flags)


def net_after_debt(profit, monthly_repayment) -> Column:
    return _c(profit) - _c(monthly_repayment)


def cashflow_tier(net, loan_amount) -> Column:
    n = _c(net)
    return (F.when(n > _c(loan_amount) * 0.15, F.lit(LOW))
             .when(n > 0, F.lit(MEDIUM)).otherwise(F.lit(HIGH)))
