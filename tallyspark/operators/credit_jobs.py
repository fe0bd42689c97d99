"""Credit facts from the order tables and portfolio roll-ups (C1-C11 at scale).

Money is summed in integer cents so the facts are exact and independent of the
summation order (double sums would differ in the last bits between runs and
engines). Plan: lineitem is aggregated per order first (partial + final hash
aggregate), joined to orders on the order key (the aggregate's hash partitioning
is reused), aggregated per customer, then joined to customer on the customer key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import credit as C
from . import generate as G

PENDING = "P"
DEBT_SHARE = 50  # debt: one fiftieth of the value of pending orders, so that cash and debt are of one size


def cents(col) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c * 100).cast("bigint")


def customer_facts(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """revenue = sum(o_totalprice); debt = 1/50 of the pending orders' sum; expense =
    sum(l_extendedprice * (1 - l_discount)); cash = max(c_acctbal, 0); all in cents."""
    per_order = (lineitem.select("l_orderkey", cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"))
                         .groupBy("l_orderkey").agg(F.sum("net").alias("expense_cents")))
    o = orders.select("o_orderkey", "o_custkey", cents("o_totalprice").alias("price"), "o_orderstatus")
    joined = o.join(per_order, o.o_orderkey == per_order.l_orderkey, "left")
    per_cust = joined.groupBy("o_custkey").agg(
        F.sum("price").alias("revenue"),
        F.floor(F.sum(F.when(F.col("o_orderstatus") == PENDING, F.col("price")).otherwise(F.lit(0))) / DEBT_SHARE)
         .cast("bigint").alias("debt"),
        F.sum(F.coalesce("expense_cents", F.lit(0))).alias("expense"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    c = customer.select("c_custkey", "c_mktsegment", "c_nationkey",
                        F.greatest(cents("c_acctbal"), F.lit(0)).alias("cash"))
    return (c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left")
             .select("c_custkey", "c_mktsegment", "c_nationkey",
                     F.coalesce("revenue", F.lit(0)).alias("revenue"),
                     F.coalesce("expense", F.lit(0)).alias("expense"),
                     F.coalesce("debt", F.lit(0)).alias("debt"), "cash",
                     F.coalesce("n_orders", F.lit(0)).alias("n_orders")))


def customer_risk(facts: DataFrame, zero_debt_is_low: bool = False) -> DataFrame:
    """C2/C4/C5 per customer (no loan request: repayment not applicable)."""
    f = facts.withColumn("loan_amount", F.lit(None).cast("bigint")).withColumn("term_months", F.lit(None).cast("bigint"))
    return G.metrics_v3(f, zero_debt_is_low).drop("loan_amount", "term_months", "monthly_repayment")


def risk_rollup(risk: DataFrame, keys=("c_mktsegment",)) -> DataFrame:
    """C11: tier / recommendation counts per key."""
    return risk.groupBy(*keys, "risk_tier", "recommendation").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("revenue").alias("revenue_cents"),
        F.count_if(F.col("debt") == 0).alias("n_zero_debt"),
    )


def risk_cube(risk: DataFrame, keys=("c_mktsegment", "risk_tier", "recommendation")) -> DataFrame:
    """C11 with all totals: counts and sums for each combination of the keys and each subset of them; ``level`` is the grouping id (a
    bit for each key that is summed over, the first key's the highest), which tells a total's null from a null key."""
    return risk.cube(*keys).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n_customers"), F.sum("revenue").alias("revenue_cents"),
        F.sum("debt").alias("debt_cents"), F.count_if(F.col("debt") == 0).alias("n_zero_debt"))


def flag_rollup(metrics: DataFrame, keys=("sector", "risk_tier")) -> DataFrame:
    """C11 with C8: rows, loan sums and the count of each red flag by the keys, with subtotals and the grand total (``level``: grouping id)."""
    flags = [*C.RED_FLAGS, C.RED_FLAG_NONE]
    return metrics.rollup(*keys).agg(
        F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("n_loans"), F.sum("loan_amount").alias("loan_amount"),
        *[F.count_if(F.array_contains("red_flags", flag)).alias(f"n_flag_{i}") for i, flag in enumerate(flags)])


def red_flag_frequency(metrics: DataFrame) -> DataFrame:
    """C8 report: how often each flag fires."""
    return (metrics.select(F.explode("red_flags").alias("flag"))
                   .groupBy("flag").agg(F.count(F.lit(1)).alias("n")))


def tier_distribution(metrics: DataFrame, tier_cols) -> DataFrame:
    """Tier counts for several tier columns at once (unpivoted)."""
    stacked = F.explode(F.array(*[F.struct(F.lit(t).alias("tier_kind"), F.col(t).alias("tier")) for t in tier_cols]))
    return (metrics.select(stacked.alias("s")).select("s.*")
                   .groupBy("tier_kind", "tier").agg(F.count(F.lit(1)).alias("n")))


__all__ = ["customer_facts", "customer_risk", "risk_rollup", "risk_cube", "flag_rollup", "red_flag_frequency", "tier_distribution", "C"]
