"""Parquet readers and the mapping of the given tables to the library's models.

The mapping is the same rule in Spark and in the checking SQL: 25 zones from nation and region, demand
from events (zone = user_id mod 25), documents and conversations as corpus and query log.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.serving import is_airport

ZONE_COUNT = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table, with the schema that it has now."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: zone, name, borough and service zone."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    airport = is_airport(F.col("n_nationkey"))
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").cast("bigint").alias("zone_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("borough"),
        F.col("n_regionkey").alias("borough_id"),
        F.when(airport, "Airports").otherwise("Boro Zone").alias("service_zone"),
        airport.cast("int").alias("service_zone_id"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip: zone, time, kind and fare."""
    return table(spark, sf_dir, "events").select(
        F.pmod("user_id", F.lit(ZONE_COUNT)).alias("zone_id"), "ts", "event_type", F.col("value").alias("fare")
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as a query log: a user turn and the turn that answers it.

    The answer is found by a join on (conversation, turn); times follow from the two numbers.
    """
    c = table(spark, sf_dir, "conversations")
    answers = c.where(F.col("role") != "user").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    minutes = (F.col("conv_id") * 10 + F.col("turn")).cast("int")
    return (
        c.where(F.col("role") == "user")
        .join(answers, ["conv_id", "turn"], "left")
        .select(
            (F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)).alias("ts"),
            F.concat(F.lit("user"), F.pmod("conv_id", F.lit(20)).cast("string")).alias("user_id"),
            F.element_at(F.array(*[F.lit(x) for x in ROLES]), (F.pmod("conv_id", F.lit(len(ROLES))) + 1).cast("int")).alias(
                "user_role"
            ),
            F.col("text").alias("query"),
            F.coalesce("answer", F.lit("")).alias("answer"),
            F.floor(F.length("text") / 4).alias("input_tokens"),
            F.floor(F.length(F.coalesce("answer", F.lit(""))) / 4).alias("output_tokens"),
        )
    )


# The roles of the access policy.
ROLES = ["engineer", "manager", "hr", "finance", "executive"]


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a title, a category and a sensitivity tier."""
    tiers = F.array(*[F.lit(x) for x in ("Public", "Internal", "Confidential", "Restricted")])
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.substring("text", 1, 40).alias("title"),
        F.col("source").alias("category"),
        F.element_at(tiers, (F.pmod("doc_id", F.lit(4)) + 1).cast("int")).alias("sensitivity"),
        F.col("text").alias("content"),
    )


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as an employee directory."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("salary"),
    )
