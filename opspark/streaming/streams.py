"""Streaming forms: windowed demand, gates with state, cleaning and monitoring per batch, cost tracking.

Inputs are streaming DataFrames. Event times are TIMESTAMP columns of a UTC session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.timefeat import epoch_micros
from ..operators import gates, monitor, quality
from ..session import cut_lineage, folder
from ..sources.literals import literal_table

DEFAULT_DELAY = "1 hour"
MICRO = 1_000_000


def demand_windows(trips: DataFrame, ts: str = "ts", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Trips per zone and 15-minute window. In append mode a window appears once the watermark has closed it."""
    return (
        trips.withWatermark(ts, delay)
        .groupBy("zone_id", F.window(ts, "15 minutes").alias("w"))
        .agg(F.count("*").alias("trip_count"))
        .select("zone_id", F.col("w.start").alias("time_bucket"), "trip_count")
    )


def first_per_key(rows: DataFrame, keys: list[str], ts: str = "time_bucket", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Drops later rows of a key that arrive within the watermark."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


class VersionedState:
    """A small table that every batch reads, merges and writes again, one folder for each batch number.

    A repeated batch reads the version before it once more, so it comes to the same result. The last two versions are kept.
    """

    def __init__(self, path: str, schema: str):
        self.path, self.schema = path, schema

    def start(self, frame: DataFrame) -> None:
        """The version before the first batch."""
        frame.write.mode("overwrite").parquet(f"{self.path}/batch=-1")

    def before(self, spark: SparkSession, number: int) -> DataFrame:
        store, where = folder(spark, f"{self.path}/batch={number - 1}")
        if not store.exists(where):
            if number > 0:
                raise FileNotFoundError(f"the state before batch {number} is gone: {where}")
            return literal_table(spark, [], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch={number - 1}")

    def put(self, frame: DataFrame, number: int) -> None:
        frame.write.mode("overwrite").parquet(f"{self.path}/batch={number}")
        store, where = folder(frame.sparkSession, f"{self.path}/batch={number - 2}")
        store.delete(where, True)


def rate_limit_batches(requests: DataFrame, path: str, cap: int, window_seconds: float) -> DataStreamWriter:
    """The sliding-window gate over a stream: each batch's decisions go to ``path``, one folder for each batch.

    A batch is decided by ``gates.rate_limit``, which never puts a user's log into one frame. It is seeded with the state: the
    admitted requests of each user that a window may still hold (``cap`` at most), which are admitted again and then left
    out. Order across batches is arrival order: a request that is older than its user's last admitted one counts at that time.

    ``requests`` needs user_id, ts (zone-less) and event_id.
    """
    width = int(window_seconds * MICRO)
    state = VersionedState(f"{path}-state", "user_id bigint, ts timestamp_ntz, event_id bigint")

    def handle(batch: DataFrame, number: int) -> None:
        held = state.before(batch.sparkSession, number)
        last = held.groupBy("user_id").agg(F.max("ts").alias("_last"))
        asked = batch.join(last, "user_id", "left").withColumns({"_own": F.col("ts"), "ts": F.greatest("ts", F.coalesce("_last", "ts")), "_held": F.lit(False)})
        seeds = held.withColumn("_held", F.lit(True))
        together = cut_lineage(asked.drop("_last").unionByName(seeds, allowMissingColumns=True))
        decided = cut_lineage(gates.rate_limit(together, cap, window_seconds))
        out = decided.where(~F.col("_held")).withColumn("ts", F.col("_own")).select(*batch.columns, "allowed")
        out.write.mode("overwrite").parquet(f"{path}/batch={number}")
        admitted = decided.where(F.col("allowed"))
        newest = admitted.groupBy("user_id").agg(F.max(epoch_micros(F.col("ts"))).alias("_newest"))
        state.put(admitted.join(newest, "user_id").where(epoch_micros(F.col("ts")) > F.col("_newest") - width).select("user_id", "ts", "event_id"), number)

    return requests.writeStream.foreachBatch(handle)


def budget_batches(requests: DataFrame, path: str, budgets: DataFrame, estimate: float) -> DataStreamWriter:
    """The budget gate over a stream: decisions to ``path``, one folder for each batch; the state is the amount each user has spent.

    ``requests`` needs user_id, ts, event_id, user_role and cost. A batch is decided by ``gates.budget_gate``.
    """
    state = VersionedState(f"{path}-state", "user_id bigint, spent bigint")

    def handle(batch: DataFrame, number: int) -> None:
        before = state.before(batch.sparkSession, number)
        decided = cut_lineage(gates.budget_gate(cut_lineage(batch), budgets, estimate, spent=before))
        decided.write.mode("overwrite").parquet(f"{path}/batch={number}")
        new = decided.where("allowed").select("user_id", gates.to_micros(F.coalesce("cost", F.lit(0.0))).alias("spent"))
        state.put(before.unionByName(new).groupBy("user_id").agg(F.sum("spent").alias("spent")), number)

    return requests.writeStream.foreachBatch(handle)


PROGRESS = "batch long, input_rows long, late_rows long, dropped_rows long, state_rows long, watermark string"


def run_reported(writer: DataStreamWriter, spark: SparkSession, checkpoint: str, path: str | None = None) -> DataFrame:
    """Runs a stream over all the input there is; returns, and appends to ``path``, one row for each trigger.

    ``dropped_rows`` is what the state operators left out behind the watermark (Spark counts after its partial aggregation),
    ``late_rows`` the exact number of ``counting_late``, if the stream has it.
    """
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    seen: dict[int, tuple] = {}

    def look() -> None:
        for p in q.recentProgress:
            late = (p.observedMetrics or {}).get("late")
            dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            states = sum(s.numRowsTotal for s in p.stateOperators)
            seen[p.batchId] = (p.batchId, p.numInputRows, late["rows"] if late is not None else None, dropped, states, (p.eventTime or {}).get("watermark"))

    try:
        while not q.awaitTermination(5):
            look()
        look()
    finally:
        q.stop()
    # One row a trigger.
    rows = literal_table(spark, sorted(seen.values()), PROGRESS)
    if path:
        rows.coalesce(1).write.mode("append").parquet(path)
    return rows


def counting_late(rows: DataFrame, ts: str, width: str, watermark: str | None) -> DataFrame:
    """Counts, without changing the stream, the rows whose window had closed by the watermark with which the trigger starts."""
    late = F.lit(False) if watermark is None else F.window(ts, width)["end"] <= F.lit(watermark).cast("timestamp")
    return rows.withColumn("_late", late).observe("late", F.count_if("_late").alias("rows")).drop("_late")


def clean_batches(rows: DataFrame, clean_path: str, quarantine_path: str, report_path: str, order: str, max_drop_rate: float = quality.MAX_DROP_RATE) -> DataStreamWriter:
    """Validates and cleans each arriving batch; a batch over the drop-rate limit fails the stream.

    Each batch writes to a folder named after its number, so a repeated batch replaces its own output.
    """

    def handle(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            clean, report = quality.clean_guarded(batch, order, max_drop_rate)
            batch.sparkSession.createDataFrame([report]).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(
                f"{report_path}/batch={number}"
            )
            clean.write.mode("overwrite").parquet(f"{clean_path}/batch={number}")
            quality.quarantine(batch, order).write.mode("overwrite").parquet(f"{quarantine_path}/batch={number}")
        finally:
            batch.unpersist()

    return rows.writeStream.foreachBatch(handle)


def monitor_batches(
    rows: DataFrame,
    path: str,
    reference: Callable[[int], str],
    profile: monitor.Profile | None = None,
    score: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    history: DataFrame | None = None,
) -> DataStreamWriter:
    """The eight metrics of every batch against a stored baseline profile, their alerts and the deploy decision.

    Per batch number, ``path`` gets the metrics with their severity, ``path`` + ``-alerts`` the alerts and ``path`` + ``-decisions`` the
    decision, so a repeated batch replaces its own output. Without a profile there is nothing to compare with: then freshness and
    duplicates are measured, and the decision rests on these.

    ``score(batch, series)`` makes a scored frame of a batch; without it a batch comes scored. ``series`` is the state, the last week and day of each
    zone as of the batch before, with the first copy of each new key of this batch. ``history`` starts it. What a batch
    costs depends on its rows, the zones and the size of the profile, not on the length of the history.
    """
    state = VersionedState(f"{path}-state", "zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int")
    if history is not None:
        state.start(monitor.last_week(history))

    def metrics_of(new: DataFrame, number: int) -> DataFrame:
        if profile is None:
            fresh = monitor._long(monitor.freshness(new, reference(number)), "freshness", ["age_minutes", "age_hours", "stale"])
            rate = monitor.duplicate_rate(new)
            return fresh.unionByName(monitor._long(rate, "duplicates", ["rate", "extra_rows", "duplicate_key_count", "total_rows"]))
        return monitor.metrics_against(profile, new, reference(number))

    def handle(batch: DataFrame, number: int) -> None:
        new = batch
        if score is not None:
            new = cut_lineage(batch)
            held = state.before(batch.sparkSession, number)
            first = new.groupBy("zone_id", "time_bucket").agg(F.min_by(F.struct(F.col("trip_count").cast("bigint").alias("trip_count"), F.col("is_holiday").cast("int").alias("is_holiday")), "row_id").alias("first"))
            first = first.select("zone_id", "time_bucket", "first.*").join(held.select("zone_id", "time_bucket"), ["zone_id", "time_bucket"], "left_anti")
            series = cut_lineage(held.unionByName(first))
            new = score(new, series)
            state.put(monitor.last_week(series), number)
        metrics = cut_lineage(metrics_of(new, number))
        alerts = cut_lineage(monitor.evaluate_alerts(metrics))
        keys = ["metric", "grouping", "segment", "field"]
        found = {
            path: metrics.join(alerts.select(*keys, "severity"), keys, "left"),
            f"{path}-alerts": alerts,
            f"{path}-decisions": monitor.decision(alerts),
        }
        for target, frame in found.items():
            frame.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return rows.writeStream.foreachBatch(handle)


def cost_windows(ledger: DataFrame, ts: str = "ts", width: str = "1 day", delay: str = DEFAULT_DELAY) -> DataFrame:
    """Cost per user and window of the query log."""
    return (
        ledger.withWatermark(ts, delay)
        .groupBy("user_id", F.window(ts, width).alias("w"))
        .agg(F.sum("total_cost").alias("cost"), F.count("*").alias("queries"))
        .select("user_id", F.col("w.start").alias("window_start"), "cost", "queries")
    )


def spikes_against(entries: DataFrame, history: DataFrame, sigma: float = 2.0, cost: str = "total_cost") -> DataFrame:
    """Arriving entries above mean + sigma deviations of a static ledger, read when the stream starts."""
    h = history.agg(F.avg(cost).alias("mean"), F.stddev_pop(cost).alias("std"), F.count("*").alias("n")).first()
    if h["n"] < 3 or not h["std"]:
        return entries.where(F.lit(False))
    return entries.where(F.col(cost) > F.lit(h["mean"] + sigma * h["std"]))
