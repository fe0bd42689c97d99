"""Conversation reshapes and checks over turn rows (conv_id, turn, role, text).

Per-conversation checks and reports are written as partially-aggregatable
aggregates (count, bool_or, max_by, min_by), so a conversation holding a large
share of all turns is combined map-side and never gathered into one array or one
task. Only ``to_messages`` (P6, the record layout itself) builds the message
array; use it to write chat records, not inside reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lending as L
from ..functions import text as TX

ROLES = ("system", "user", "assistant")


def to_messages(turns: DataFrame, key="conv_id") -> DataFrame:
    """Turn rows -> ordered ``messages ARRAY<STRUCT<turn,role,content>>``."""
    return turns.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("messages"))


def to_turns(messages: DataFrame, key="conv_id") -> DataFrame:
    """P6 back: messages -> one row per message with its 0-based position."""
    return messages.select(key, F.posexplode("messages").alias("pos", "m")) \
                   .select(key, "pos", F.col("m.role").alias("role"), F.col("m.content").alias("text"))


def latest_user_turn(turns: DataFrame, key="conv_id") -> DataFrame:
    """Last message with role user, else ''."""
    return turns.groupBy(key).agg(
        F.coalesce(F.max_by(F.col("text"), F.when(F.col("role") == "user", F.col("turn"))), F.lit(""))
         .alias("latest_user"))


# FIXED VALUES — error texts of message validation, in rule order
ERR_FEW = "messages must contain at least user and assistant entries"
ERR_ROLES = "messages must include user and assistant roles"
ERR_ROLE = "invalid role "  # with the role's value
ERR_CONTENT = "empty message content"


def validate_messages(messages_col: str = "messages"):
    """F5 on a messages array: the first error, or null. Sizes and roles first; then message by message, role before content."""
    m = F.col(messages_col)
    roles = F.transform(m, lambda x: x["role"])
    wrong = F.transform(m, lambda x: F.when(~F.coalesce(x["role"].isin(*ROLES), F.lit(False)),
                                            F.concat(F.lit(ERR_ROLE), F.coalesce(x["role"], F.lit("None"))))
                        .when(TX.is_blank(x["content"]), F.lit(ERR_CONTENT)))
    return (F.when(F.coalesce(F.size(m), F.lit(0)) < 2, F.lit(ERR_FEW))
             .when(~(F.array_contains(roles, "user") & F.array_contains(roles, "assistant")), F.lit(ERR_ROLES))
             .otherwise(F.get(F.array_compact(wrong), 0)))


def message_validation(turns: DataFrame, key="conv_id") -> DataFrame:
    """F5 over turn rows with aggregates only: the error of the earliest wrong message (role before content)."""
    bad_role = ~F.coalesce(F.col("role").isin(*ROLES), F.lit(False))
    wrong = (F.when(bad_role, F.concat(F.lit(ERR_ROLE), F.coalesce(F.col("role"), F.lit("None"))))
              .when(TX.is_blank("text"), F.lit(ERR_CONTENT)))
    t = turns.select(key, "role", "turn", wrong.alias("_wrong"))
    g = t.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.coalesce(F.bool_or(F.col("role") == "user"), F.lit(False)).alias("_u"),
        F.coalesce(F.bool_or(F.col("role") == "assistant"), F.lit(False)).alias("_a"),
        F.min(F.when(F.col("_wrong").isNotNull(), F.struct("turn", "_wrong"))).alias("_first"))
    err = (F.when(F.col("_n") < 2, F.lit(ERR_FEW)).when(~(F.col("_u") & F.col("_a")), F.lit(ERR_ROLES))
            .otherwise(F.col("_first._wrong")))
    return g.select(key, err.alias("error"))


def conversation_summary(turns: DataFrame, key="conv_id") -> DataFrame:
    """P6 report without building arrays: size, first/last role, role counts, characters."""
    return turns.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_messages"),
        F.min_by("role", "turn").alias("first_role"),
        F.max_by("role", "turn").alias("last_role"),
        F.count_if(F.col("role") == "user").alias("n_user"),
        F.count_if(F.col("role") == "assistant").alias("n_assistant"),
        F.count_if(F.col("role") == "system").alias("n_system"),
        F.sum(F.length("text")).alias("total_chars"))


def message_accessors(turns: DataFrame, key="conv_id") -> DataFrame:
    """Last message, second message (by turn) and the v2 assistant accessor ('' under 3 messages).

    The first two turns and the last one are ranked windows with a limit: Spark drops the other rows of a conversation
    in each task before the shuffle, so a hot conversation ships three rows a task. Counts are partial aggregates."""
    up = F.row_number().over(Window.partitionBy(key).orderBy("turn"))
    down = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("turn")))
    second = turns.withColumn("_r", up).filter("_r <= 2").filter("_r = 2").select(key, F.col("text").alias("second_content"))
    last = turns.withColumn("_r", down).filter("_r <= 1").select(key, F.col("text").alias("last_content"))
    sizes = turns.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return (sizes.join(last, key).join(second, key, "left")
                 .select(key, "last_content", "second_content",
                         F.when(F.col("_n") < 3, F.lit("")).otherwise(F.col("last_content")).alias("assistant_v2")))


CONTEXT_FIELDS = {"loan_amount": "loan_amount", "loan_term_months": "term", "monthly_income": "income",
                  "employment_status": "employment", "collateral": "collateral", "loan_type": "loan_type",
                  "phone_number": "phone_number"}


def borrower_context(turns: DataFrame, key="conv_id") -> DataFrame:
    """Per conversation, what its user turns tell: of each field the value of the latest turn that has one. Fields are
    extracted turn by turn, so the aggregate combines short values, not texts."""
    said = L.with_extraction(turns.filter(F.col("role") == "user").select(key, "turn", "text"), "text", "_e")
    return said.groupBy(key).agg(*[
        F.max(F.when(F.col(f"_e.{f}").isNotNull(), F.struct("turn", F.col(f"_e.{f}").cast("string").alias("v"))))["v"].alias(f"_c_{f}")
        for f in CONTEXT_FIELDS])


def chat_audit(turns: DataFrame, key="conv_id", compliance_sensitive=True) -> DataFrame:
    """Latest user turn -> redacted -> language; last assistant answer -> issues -> confidence; fields that no user
    turn gives."""
    agg = turns.groupBy(key).agg(
        F.coalesce(F.max_by(F.col("text"), F.when(F.col("role") == "user", F.col("turn"))), F.lit("")).alias("latest_user"),
        F.max_by(F.col("text"), F.when(F.col("role") == "assistant", F.col("turn"))).alias("answer"),
    ).join(borrower_context(turns, key), key, "left")
    red = TX.redact_pii(F.col("latest_user"))
    issues = L.compliance_issues(F.coalesce(F.col("answer"), F.lit(""))) if compliance_sensitive \
        else F.array().cast(f"array<{L.ISSUE_TYPE}>")
    context = F.map_from_arrays(F.array(*[F.lit(k) for k in CONTEXT_FIELDS.values()]),
                                F.array(*[F.col(f"_c_{f}") for f in CONTEXT_FIELDS]))
    out = (agg.withColumn("redacted_user", red)
              .withColumn("language", TX.dominant_language(F.col("redacted_user")))
              .withColumn("issues", issues)
              .withColumn("compliance_warnings", L.issue_categories("issues"))
              .withColumn("missing_application_fields", L.context_missing_fields(context))
              .drop(*[f"_c_{f}" for f in CONTEXT_FIELDS]))
    return out.withColumn("confidence", L.heuristic_confidence(F.coalesce(F.col("answer"), F.lit("")),
                                                               F.size("compliance_warnings")))
