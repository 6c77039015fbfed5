"""Corrections to answers: two acceptance rules, approvals and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..sources.policies import AUTO_VALIDATE_ROLES

MIN_AUTHORITY = 3


def _answer(column: str) -> Column:
    """The stripped answer; NULL counts as empty."""
    return strip(F.coalesce(column, F.lit("")))


def intake_a(corrections: DataFrame, auto_roles: list[str] | None = None) -> DataFrame:
    """Rules A: empty (or NULL) and unchanged corrections are refused; trusted roles are validated at once."""
    new, old = _answer("corrected_answer"), _answer("original_answer")
    reason = F.when(new == "", "empty correction").when(new == old, "correction identical to original")
    accepted = F.col("reason").isNull()
    trusted = F.coalesce(F.col("user_role").isin(*(auto_roles or AUTO_VALIDATE_ROLES)), F.lit(False))
    return corrections.withColumn("reason", reason).withColumns(
        {"accepted": accepted, "validated": F.when(accepted, trusted)}
    )


def intake_b(corrections: DataFrame, authority: DataFrame, min_level: int = MIN_AUTHORITY) -> DataFrame:
    """Rules B: the submitter needs enough authority and the correction must be longer than the original."""
    levels = authority.select(F.col("role").alias("_role"), "level")
    new, old = _answer("corrected_answer"), _answer("original_answer")
    level = F.coalesce("level", F.lit(0))
    role = F.coalesce("user_role", F.lit(""))
    reason = (
        F.when(new == "", "empty correction")
        .when(level < min_level, F.concat(F.lit("role '"), role, F.lit("' lacks authority (need manager+)")))
        .when(F.length(new) <= F.length(old), "correction not more detailed than original")
        .otherwise("ok")
    )
    return (
        corrections.join(levels, F.col("user_role") == F.col("_role"), "left")
        .withColumn("reason", reason)
        .withColumn("accepted", F.col("reason") == "ok")
        .drop("_role", "level")
    )


def state(corrections: DataFrame, approvals: DataFrame, key: str = "correction_id") -> DataFrame:
    """Corrections with later approvals applied: an approval log instead of updates in place."""
    approved = approvals.select(F.col(key).alias("_id")).distinct()
    return (
        corrections.join(approved, F.col(key) == F.col("_id"), "left")
        .withColumn("validated", F.coalesce("validated", F.lit(False)) | F.col("_id").isNotNull())
        .drop("_id")
    )


def state_b(corrections: DataFrame, approvals: DataFrame, authority: DataFrame, min_level: int = MIN_AUTHORITY, key: str = "correction_id") -> DataFrame:
    """Approvals under rules B: authority and length are tested again, and an approval that fails them changes nothing."""
    levels = authority.select(F.col("role").alias("_role"), "level")
    fit = (F.coalesce("level", F.lit(0)) >= min_level) & (F.length(_answer("corrected_answer")) > F.length(_answer("original_answer")))
    able = corrections.join(levels, F.col("user_role") == F.col("_role"), "left").where(fit).select(key)
    return state(corrections, approvals.join(able, key, "left_semi"), key)


def metrics(corrections: DataFrame) -> DataFrame:
    """Corrections and validated ones, overall and by role."""
    role = F.coalesce("user_role", F.lit("unknown"))
    valid = F.count_if(F.coalesce("validated", F.lit(False)))
    by_role = corrections.groupBy(role.alias("role")).agg(F.count("*").alias("n"), valid.alias("v"))
    total = by_role.agg(F.lit("all").alias("role"), F.sum("n").alias("n"), F.sum("v").alias("v"))
    n = F.coalesce("n", F.lit(0))
    return total.unionByName(by_role).select(
        "role",
        n.alias("total_corrections"),
        F.coalesce("v", F.lit(0)).alias("validated_corrections"),
        F.coalesce(F.col("v") / F.when(n > 0, n), F.lit(0.0)).alias("validation_rate"),
    )


def length_metrics(corrections: DataFrame) -> DataFrame:
    """Rules B roll-up: accepted share and average length of corrections."""
    return corrections.agg(
        F.count("*").alias("total_corrections"),
        F.coalesce(F.bround(F.avg(F.col("accepted").cast("int")), 3), F.lit(0.0)).alias("validation_rate"),
        F.coalesce(F.bround(F.avg(F.length("corrected_answer")), 1), F.lit(0.0)).alias("avg_correction_length"),
    )


def top_patterns(corrections: DataFrame, k: int = 3, words: int = 3) -> DataFrame:
    """Most frequent first words of corrected questions: counted with map-side combine, then a bounded top-k."""
    tokens = F.filter(F.split(F.lower("original_query"), r"(?U)\s+"), lambda w: w != "")
    pattern = F.concat_ws(" ", F.slice(tokens, 1, words))
    return (
        corrections.where(F.size(tokens) > 0)
        .groupBy(pattern.alias("pattern"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "pattern")
        .limit(k)
    )
