import datetime as dt

import pytest
from pyspark.sql import functions as F

from opspark.operators import features, gates, monitor, quality
from opspark.sources import policies
from opspark.sources.literals import literal_table
from opspark.streaming import streams

from . import test_gates, test_quality


def drain(writer, path):
    q = writer.option("checkpointLocation", path).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert not q.isActive


def parts(spark, frames, path):
    for i, f in enumerate(frames):
        f.coalesce(1).write.mode("append").parquet(path)
    schema = frames[0].schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def in_order(writer_of, spark, frames, tmp_path, name):
    """Runs a stream over several files, one a trigger, and returns its batch folders."""
    path = str(tmp_path / name)
    drain(writer_of(parts(spark, frames, str(tmp_path / f"{name}-in")), path), path + "-checkpoint")
    return path


def test_rate_and_budget_streams_equal_batch_over_several_triggers(spark, tmp_path):
    rows = test_gates.requests(11, n=300, spread=900)
    rows = sorted(((e, 1 if e % 3 == 0 else u, t, "hr" if u % 2 else "engineer", c * 3) for e, u, t, _, c in rows), key=lambda r: (r[2], r[0]))
    frames = [test_gates.log(spark, rows[i : i + 100]) for i in (0, 100, 200)]
    batch = test_gates.log(spark, rows)
    budgets = policies.role_budgets(spark)
    for name, writer, want in (
        ("rate", lambda s, p: streams.rate_limit_batches(s, p, 3, 60), gates.rate_limit(batch, 3, 60)),
        ("budget", lambda s, p: streams.budget_batches(s, p, budgets, 0.01), gates.budget_gate(batch, budgets)),
    ):
        path = in_order(writer, spark, frames, tmp_path, name)
        found = spark.read.parquet(path)
        got = {r.event_id: r.allowed for r in found.collect()}
        assert got == {r.event_id: r.allowed for r in want.collect()} and len(got) == found.count() == 300
        assert {r.batch for r in found.select("batch").distinct().collect()} == {0, 1, 2}
        # Only the last two versions of the state are kept, and they stay small.
        assert sorted(p.name for p in (tmp_path / f"{name}-state").iterdir()) == ["batch=1", "batch=2"]
        assert spark.read.parquet(f"{path}-state/batch=2").groupBy("user_id").count().agg(F.max("count")).first()[0] <= 3


def replayed(writer, frame, number):
    """Calls a stream's batch function as Spark does after a failure."""
    captured = {}

    class Writer:
        def foreachBatch(self, handle):
            captured["handle"] = handle

    class Stream:
        writeStream = Writer()

    writer(Stream())
    captured["handle"](frame, number)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = sorted(test_gates.requests(13, n=200, spread=400), key=lambda r: (r[2], r[0]))
    frames = [test_gates.log(spark, rows[:100]), test_gates.log(spark, rows[100:])]
    budgets = policies.role_budgets(spark)
    for name, build in (("rate", lambda s, p: streams.rate_limit_batches(s, p, 2, 60)), ("budget", lambda s, p: streams.budget_batches(s, p, budgets, 0.01))):
        path = str(tmp_path / name)
        seen = []
        for number in (0, 1, 1):
            replayed(lambda s: build(s, path), frames[number], number)
            seen.append(sorted((r.event_id, r.allowed) for r in spark.read.parquet(path).collect()))
        assert seen[1] == seen[2] and len(seen[1]) == 200
    with pytest.raises(FileNotFoundError):
        replayed(lambda s: streams.rate_limit_batches(s, str(tmp_path / "rate"), 2, 60), frames[0], 7)


def test_late_requests_count_at_arrival(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    first = [(i, 1, start + dt.timedelta(seconds=50 + i), "hr", 1.0) for i in range(3)]
    late = [(9, 1, start, "hr", 1.0), (10, 1, start + dt.timedelta(seconds=112), "hr", 1.0)]
    path = in_order(lambda s, p: streams.rate_limit_batches(s, p, 3, 60), spark, [test_gates.log(spark, first), test_gates.log(spark, late)], tmp_path, "late")
    got = {r.event_id: (r.allowed, r.ts) for r in spark.read.parquet(path).collect()}
    assert [got[i][0] for i in (0, 1, 2, 9, 10)] == [True, True, True, False, True] and got[9][1] == start


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    schema = "zone_id bigint, event_time timestamp"
    runs = [[(1, start + dt.timedelta(minutes=15 * i)) for i in range(20)], [(1, start), (1, start + dt.timedelta(minutes=15 * 18)), (1, start + dt.timedelta(hours=9))]]
    path, mark, reports = str(tmp_path / "in"), None, []
    for k, rows in enumerate(runs):
        literal_table(spark, rows, schema).coalesce(1).write.mode("append").parquet(path)
        stream = streams.counting_late(spark.readStream.schema(schema).parquet(path), "event_time", "15 minutes", mark)
        writer = streams.demand_windows(stream, "event_time").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
        report = streams.run_reported(writer, spark, str(tmp_path / "checkpoint"), str(tmp_path / "out-progress")).collect()
        mark = max(r.watermark for r in report)
        reports.append(report)
    late = [sum(r.late_rows for r in x) for x in reports]
    dropped = [sum(r.dropped_rows for r in x) for x in reports]
    assert late == dropped == [0, 1]
    counts = {r.time_bucket: r.trip_count for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert counts[start] == 1 and counts[start + dt.timedelta(minutes=15 * 18)] == 2
    assert spark.read.parquet(str(tmp_path / "out-progress")).agg(F.sum("late_rows")).first()[0] == 1


def test_clean_stream_splits_and_guards(spark, tmp_path):
    good = test_quality.batch(spark, {3: -5})
    bad = test_quality.batch(spark, {i: -5 for i in range(20)})
    out = [str(tmp_path / x) for x in ("clean", "quarantine", "report")]
    drain(streams.clean_batches(parts(spark, [good], str(tmp_path / "in")), *out, "row_id"), str(tmp_path / "s1"))
    assert spark.read.parquet(out[0]).count() == 119
    assert [r.reason for r in spark.read.parquet(out[1]).collect()] == ["sentinel"]
    assert spark.read.parquet(out[2]).first().rows_dropped == 1
    with pytest.raises(Exception, match="limit"):
        drain(streams.clean_batches(parts(spark, [bad], str(tmp_path / "in2")), *out, "row_id"), str(tmp_path / "s2"))
    assert quality.validate(spark.read.parquet(out[0]).drop("batch")).count() == 0


def test_dedupe_and_monitor_streams(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1, 0, 15)), (1, dt.datetime(2024, 1, 1, 0, 15)), (2, dt.datetime(2024, 1, 1, 0, 15))]
    frame = literal_table(spark, rows, "zone_id bigint, time_bucket timestamp")
    first = streams.first_per_key(parts(spark, [frame, frame], str(tmp_path / "in")), ["zone_id", "time_bucket"])
    path = str(tmp_path / "out")
    drain(first.writeStream.format("parquet").option("path", path), path + "-state")
    assert spark.read.parquet(path).count() == 2
    ntz = frame.withColumn("time_bucket", F.col("time_bucket").cast("timestamp_ntz"))
    base = str(tmp_path / "metrics")
    drain(streams.monitor_batches(parts(spark, [ntz], str(tmp_path / "in2")), base, lambda n: "2024-01-01 06:15:00"), base + "-checkpoint")
    got = {(r.metric, r.field): (r.value, r.severity) for r in spark.read.parquet(base).collect()}
    assert got[("freshness", "age_hours")] == (6.0, "critical") and got[("duplicates", "rate")][1] == "critical"


def test_monitor_stream_has_all_metrics_and_decides(spark, tmp_path):
    """A batch like the baseline passes; one with lower accuracy, drift and nulls is blocked, though fresh and without copies."""
    schema = (
        "zone_id bigint, borough_id int, is_weekend int, hour int, time_bucket timestamp_ntz, trip_count bigint, "
        "lag_1day double, lag_1week double, roll_mean_1day double, yhat double"
    )

    def scored(start, shift):
        t = [start + dt.timedelta(minutes=15 * i) for i in range(192)]
        return literal_table(spark, [(1, 0, 0, x.hour, x, i % 20 + shift, None if shift and i % 2 else 1.0 * (i % 20 + shift), 1.0 * (i % 20), 1.0 * (i % 20), 1.0 * (i % 20 + 1)) for i, x in enumerate(t)], schema)

    baseline = scored(dt.datetime(2024, 1, 1), 0)
    batches = [scored(dt.datetime(2024, 1, 3), 0), scored(dt.datetime(2024, 1, 5), 30)]
    base = str(tmp_path / "metrics")
    reference = ["2024-01-05 00:00:00", "2024-01-07 00:00:00"]
    drain(streams.monitor_batches(parts(spark, batches, str(tmp_path / "in")), base, reference.__getitem__, monitor.profile(baseline)), base + "-checkpoint")
    found = spark.read.parquet(base).collect()
    names = {"accuracy", "null_rate", "ks", "psi", "prediction", "freshness", "duplicates"}
    assert {r.metric for r in found if r.batch == 0} == {r.metric for r in found if r.batch == 1} == names
    alerts = spark.read.parquet(base + "-alerts").collect()
    assert {(r.batch, r.metric) for r in alerts} == {(1, "accuracy"), (1, "null_rate"), (1, "ks"), (1, "psi")}
    decisions = {r.batch: r.decision for r in spark.read.parquet(base + "-decisions").collect()}
    assert decisions == {0: "OK", 1: "BLOCK_DEPLOY_AND_PAGE"}


def test_monitor_stream_carries_its_state_over_triggers(spark, tmp_path):
    """Three files in order, one a trigger: the metrics of three batch runs over all that came before."""
    start, slots = dt.datetime(2024, 1, 1), 96 * 12
    rows = [(z * 100_000 + i, z, start + dt.timedelta(minutes=15 * i), (z * 7 + i * 13) % 11, 0) for z in (1, 2) for i in range(slots)]
    # A copy within a batch, and one that arrives in the next batch.
    rows += [(900_000, 1, start + dt.timedelta(minutes=15 * 800), 99, 0), (900_001, 2, start + dt.timedelta(minutes=15 * 900), 77, 0)]
    frame = literal_table(spark, rows, "row_id bigint, zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int")
    at = lambda i: start + dt.timedelta(minutes=15 * i)
    history = frame.where(F.col("time_bucket") < F.lit(at(760))).select("zone_id", "time_bucket", "trip_count", "is_holiday")
    zones = literal_table(spark, [(1, 0, 0), (2, 1, 0)], "zone_id bigint, borough_id int, service_zone_id int")
    base = features.zone_slot_baseline(history)

    def scored(series):
        table = features.feature_table(series, zones, baseline=base)
        return table.withColumn("yhat", (F.coalesce("lag_1week", "zone_slot_baseline") + F.col("zone_slot_baseline")) / 2)

    def score(batch, series):
        return batch.join(scored(series).drop("trip_count", "is_holiday"), ["zone_id", "time_bucket"], "left")

    cuts = [760, 840, 960, slots]
    late = F.col("row_id") == 900_001
    batches = []
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        inside = (F.col("time_bucket") >= F.lit(at(a))) & (F.col("time_bucket") < F.lit(at(b)))
        batches.append(frame.where((inside & ~late) | (late if k == 2 else F.lit(False))))
    stored = monitor.profile(scored(history))
    path = str(tmp_path / "metrics")
    stream = parts(spark, batches, str(tmp_path / "in"))
    drain(streams.monitor_batches(stream, path, lambda n: "2024-01-13 00:00:00", stored, score, history), path + "-checkpoint")
    found = spark.read.parquet(path)
    # Each batch on its own: all history before it, first copies only.
    before = history
    for k, batch in enumerate(batches):
        first = batch.groupBy("zone_id", "time_bucket").agg(F.min_by(F.struct("trip_count", "is_holiday"), "row_id").alias("f")).select("zone_id", "time_bucket", "f.*")
        before = before.unionByName(first.join(before, ["zone_id", "time_bucket"], "left_anti"))
        both = scored(history).withColumn("is_new", F.lit(False)).unionByName(score(batch, before).drop("row_id").withColumn("is_new", F.lit(True)), allowMissingColumns=True)
        want = {(r.metric, r.grouping, r.segment, r.field): r.value for r in monitor.monitor_metrics(both, "2024-01-13 00:00:00").collect()}
        got = {(r.metric, r.grouping, r.segment, r.field): r.value for r in found.where(F.col("batch") == k).collect()}
        assert got.keys() == want.keys()
        for key, value in want.items():
            assert got[key] == value or abs(got[key] - value) < 1e-9, (k, key, got[key], value)
        assert got["null_rate", "column", "lag_1week", "lag_1week"] == 0.0
    # The state is one week and one day of each zone, whatever came before.
    assert spark.read.parquet(f"{path}-state/batch=2").groupBy("zone_id").count().agg(F.max("count")).first()[0] == 672 + monitor.LATE_SLOTS
