"""Role checks, document access, audit rows and access-controlled search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.policies import AccessPolicy
from . import corpus


def has_permission(requests: DataFrame, policy: AccessPolicy) -> DataFrame:
    """Adds ``allowed`` to (role, capability) requests; an unknown role or capability is denied."""
    rules = policy.capability_rules(requests.sparkSession)
    return requests.join(rules, ["role", "capability"], "left").withColumn("allowed", F.coalesce("allowed", F.lit(False)))


def can_view_field(requests: DataFrame, policy: AccessPolicy) -> DataFrame:
    """Adds ``allowed`` to (role, field) requests; a field off the policy is open and not ``audited``."""
    rules = policy.field_rules(requests.sparkSession)
    listed = F.col("visible_to").isNotNull()
    return (
        requests.join(rules, "field", "left")
        .withColumn("allowed", ~listed | F.coalesce(F.array_contains("visible_to", F.col("role")), F.lit(False)))
        .withColumn("audited", listed)
        .drop("visible_to")
    )


def _tier():
    """The tier that decides and that is logged: NULL and '' are public, any other text stands for itself."""
    return F.lower(F.coalesce(F.nullif("sensitivity", F.lit("")), F.lit("Public")))


def visible_documents(documents: DataFrame, role: str, policy: AccessPolicy) -> DataFrame:
    """Documents one role may open: a semi join to the rules; an unknown tier is denied."""
    rules = policy.tier_rules(documents.sparkSession).where(F.col("role") == role)
    return documents.join(rules, _tier() == F.col("tier"), "left_semi")


def document_checks(documents: DataFrame, policy: AccessPolicy) -> DataFrame:
    """(document, role, allowed) for the policy's fixed list of roles: one audit row per check."""
    rules = policy.tier_rules(documents.sparkSession).select("tier", F.col("role").alias("_role"))
    roles = F.array(*[F.lit(r) for r in policy.roles()])
    checks = documents.withColumn("role", F.explode(roles)).withColumn("_tier", _tier())
    return (
        checks.join(rules, (F.col("_tier") == F.col("tier")) & (F.col("role") == F.col("_role")), "left")
        .withColumn("allowed", F.col("_role").isNotNull())
        .drop("_role", "tier", "_tier")
    )


def audit_rows(checks: DataFrame, at: str) -> DataFrame:
    """Audit log rows of document checks."""
    return checks.select(
        F.lit(at).cast("timestamp_ntz").alias("timestamp"),
        "role",
        F.concat(F.lit("document:"), F.col("id").cast("string")).alias("resource"),
        "allowed",
        F.lit(None).cast("string").alias("field"),
        _tier().alias("sensitivity"),
    )


def field_audit_rows(checks: DataFrame, at: str) -> DataFrame:
    """Audit log rows of field checks; open fields leave no trace."""
    return checks.where("audited").select(
        F.lit(at).cast("timestamp_ntz").alias("timestamp"),
        "role",
        F.concat(F.lit("field:"), F.col("field")).alias("resource"),
        "allowed",
        "field",
        F.lit(None).cast("string").alias("sensitivity"),
    )


def secure_search(documents: DataFrame, requests: list[tuple[str, str | None]], policy: AccessPolicy, limit: int = 5) -> DataFrame:
    """Search results checked for every role: rows with ``allowed`` are what the role sees, all rows are audited."""
    return document_checks(corpus.search(documents, requests, limit), policy)
