"""Anomalies in an access log: runs of denials, bulk access, access off hours.

The log has user_id, ts (zone-less), event_id, resource and allowed. Order is by (ts, event_id). No task ever holds a user's whole log: running
totals are taken inside slices of time and shifted by the totals of the slices before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefeat import epoch_micros
from ..plans.ranks import running_sums
from ..session import cut_lineage

MICRO = 1_000_000
SLICE_SECONDS = 3600


def denial_runs(log: DataFrame, least: int, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Runs of at least ``least`` denials of a user without an admitted access between them: gaps and islands.

    Denials with the same number of admitted accesses before them are one run.
    """
    rows = log.select("user_id", "ts", "event_id", F.col("allowed").cast("int").alias("_ok"), F.floor(epoch_micros(F.col("ts")) / (slice_seconds * MICRO)).alias("_slice"))
    numbered = running_sums(rows, ["user_id"], "_slice", ["ts", "event_id"], {"run": "_ok"})
    runs = numbered.where("_ok = 0").groupBy("user_id", "run").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_time"), F.max("ts").alias("last_time"))
    return runs.where(F.col("n") >= least).drop("run")


def bulk_access(log: DataFrame, window_seconds: int, least: int) -> DataFrame:
    """Users who saw at least ``least`` different resources within a sliding window, with the most at any time and the first time it was reached.

    An access counts from its time until the next access to the same resource, or until it leaves the window. The number of
    such stretches open at a time is the number of different resources, so a running sum of openings and closings gives all
    windows at once. The next access within a window lies in the same slice of that length or in the one after.
    """
    width = window_seconds * MICRO
    # Several accesses to a resource at one instant are one.
    at = log.where("allowed").select("user_id", "resource", epoch_micros(F.col("ts")).alias("us")).distinct()
    at = cut_lineage(at.withColumn("_slice", F.floor(F.col("us") / width)))
    cell = ["user_id", "resource", "_slice"]
    ahead = at.groupBy(*cell).agg(F.min("us").alias("_later")).withColumn("_slice", F.col("_slice") - 1)
    following = F.lead("us").over(Window.partitionBy(*cell).orderBy("us"))
    ends = F.least(F.coalesce("_following", "_later", F.col("us") + width), F.col("us") + width)
    open_ = at.withColumn("_following", following).join(ahead, cell, "left").select("user_id", "us", ends.alias("until"))
    points = open_.select("user_id", F.inline(F.array(F.struct(F.col("us").alias("at"), F.lit(1).alias("step")), F.struct(F.col("until").alias("at"), F.lit(-1).alias("step")))))
    # One row for each user and instant, so that closings and openings at one time meet before anything is counted.
    changes = points.groupBy("user_id", "at").agg(F.sum("step").cast("bigint").alias("step"))
    changes = cut_lineage(changes.withColumn("_slice", F.floor(F.col("at") / width)))
    counted = running_sums(changes, ["user_id"], "_slice", ["at"], {"seen": "step"})
    peak = counted.groupBy("user_id").agg(F.max(F.struct("seen", -F.col("at"))).alias("p")).select("user_id", F.col("p.seen").alias("n"), (-F.col("p.col2")).alias("us"))
    # Without the session's time zone.
    moment = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(cast(us as decimal(20, 0)) / 1000000 as decimal(18, 6)))")
    return peak.where(F.col("n") >= least).select("user_id", "n", moment.alias("first_time"), moment.alias("last_time"))


def off_hours(log: DataFrame, opens: int, closes: int, least: int, share: float) -> DataFrame:
    """Users with at least ``least`` accesses at weekends or outside [opens, closes) o'clock, if these are at least ``share`` of theirs."""
    away = (F.weekday("ts") >= 5) | (F.hour("ts") < opens) | (F.hour("ts") >= closes)
    when = F.when(away, F.col("ts"))
    per = log.groupBy("user_id").agg(F.count_if(away).alias("n"), F.count(F.lit(1)).alias("_all"), F.min(when).alias("first_time"), F.max(when).alias("last_time"))
    return per.where((F.col("n") >= least) & (F.col("n") >= F.lit(share) * F.col("_all"))).drop("_all")


def findings(log: DataFrame, denials: int = 5, window_seconds: int = 3600, resources: int = 20, opens: int = 7, closes: int = 19, away: int = 10, share: float = 0.5) -> DataFrame:
    """All three kinds as one table. A run of denials is critical, the others are warnings."""
    log = cut_lineage(log.select("user_id", "ts", "event_id", "resource", "allowed"))
    parts = (
        ("denial_spike", "critical", denial_runs(log, denials)),
        ("bulk_access", "warning", bulk_access(log, window_seconds, resources)),
        ("off_hours", "warning", off_hours(log, opens, closes, away, share)),
    )
    frames = [f.select(F.lit(k).alias("finding"), "user_id", F.lit(s).alias("severity"), "n", "first_time", "last_time") for k, s, f in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])
