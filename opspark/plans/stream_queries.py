"""Registered queries on forecasts, sinks and streams."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.timefeat import epoch_micros
from ..operators import demand, features, forest, monitor, scoring
from ..session import cut_lineage, scratch
from ..sources import logs, policies, readers, tables
from ..streaming import streams
from . import demand_queries as dq
from . import drift_queries as drq
from . import log_queries as lq
from . import quality_queries as qq
from .sqlbase import FACT, PROFILE, with_

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# Forecasts

NAIVE = f"""last AS (SELECT zone_id, max(time_bucket) AS t0 FROM fact GROUP BY 1),
naive AS (
  SELECT f.zone_id, CAST(epoch(f.time_bucket + INTERVAL 7 DAY - t0) / 900 AS INTEGER) AS step, f.time_bucket + INTERVAL 7 DAY AS time_bucket, CAST(trip_count AS DOUBLE) AS yhat
  FROM fact f JOIN last USING (zone_id) WHERE f.time_bucket + INTERVAL 7 DAY > t0 AND f.time_bucket + INTERVAL 7 DAY <= t0 + INTERVAL 240 MINUTE),
dirs AS (SELECT zone_id, avg(yhat) FILTER (WHERE step <= 4) AS early, avg(yhat) FILTER (WHERE step >= 13) AS late, count(*) AS n FROM naive GROUP BY 1),
outlook AS (SELECT zone_id, early AS demand_next_hour, CASE WHEN n < 16 THEN 'stable' WHEN late > early * 1.1 THEN 'rising' WHEN late < early * 0.9 THEN 'falling' ELSE 'stable' END AS trend_direction FROM dirs)"""


def naive(spark, d) -> DataFrame:
    return scoring.forecast_naive(dq.fact(spark, d))


@query("forecast_naive", with_(f"{FACT}, {NAIVE}", "SELECT zone_id, step, time_bucket, yhat FROM naive"))
def forecast_naive(spark, d):
    return naive(spark, d)


@query("trend_direction", with_(f"{FACT}, {NAIVE}", "SELECT zone_id, trend_direction FROM outlook"))
def trend_direction(spark, d):
    return demand.trend_direction(naive(spark, d), ["zone_id"])


@query(
    "operator_zones_forecast",
    with_(
        f"{PROFILE}, {NAIVE}, {dq.VOLATILITY}, {dq.P75}",
        """, base AS (
          SELECT s.*, o.demand_next_hour AS nxt, o.trend_direction, coalesce(volatility, 0.0) AS vol,
                 CASE WHEN threshold > 0 AND s.avg > threshold
                      THEN CAST(greatest(0.0, round_even((s.avg - threshold) * least(0.30, 0.10 + (s.avg - threshold) / threshold * 0.20), 0)) AS BIGINT) ELSE 0 END AS unmet_demand
          FROM served s JOIN outlook o USING (zone_id) LEFT JOIN p75 USING (zone_id) LEFT JOIN volatility v ON v.zone_id = s.zone_id AND v.hour = s.hour),
        lab AS (SELECT *, CASE WHEN vol > 0.3 THEN 'high' WHEN vol > 0.15 THEN 'medium' ELSE 'low' END AS vl,
                  CASE WHEN unmet_demand > 0 THEN 'tight' WHEN avg > 30 THEN 'balanced' ELSE 'light' END AS ss FROM base)
        SELECT hour, dow, holiday, zone_id, round_even(nxt, 1) AS demand_next_hour,
               CASE WHEN avg > 0 THEN CAST(round_even((nxt - avg) / avg * 100, 0) AS BIGINT) ELSE 0 END AS change_pct, true AS is_forecast, 'model' AS forecast_source, trend_direction,
               CASE WHEN ss = 'tight' AND vl = 'high' THEN 'High demand + volatile. Raise surge cautiously.'
                    WHEN ss = 'tight' AND vl = 'low' THEN 'High demand + stable. Can raise surge aggressively.'
                    WHEN ss = 'balanced' AND trend_direction = 'rising' THEN 'Demand rising. Prepare extra drivers.'
                    WHEN ss = 'tight' AND trend_direction = 'falling' THEN 'Demand falling. Monitor before surge.' END AS action
        FROM lab""".lstrip(),
    ),
)
def operator_zones_forecast(spark, d):
    f = dq.stored_fact(spark, d)
    ahead = scoring.outlook(scoring.forecast_naive(f))
    out = demand.operator_zones(cut_lineage(demand.demand_profile(f)), f, tables.zones(spark, d), outlook=ahead)
    return out.select(
        "hour", "dow", "holiday", "zone_id", "demand_next_hour", "change_pct", "is_forecast", "forecast_source", "trend_direction", "action"
    )


@query(
    "forecast_heatmap_naive",
    with_(
        f"{FACT}, {NAIVE}",
        "SELECT zone_id, time_bucket, round_even(yhat, 2) AS demand, max(round_even(yhat, 2)) OVER () AS max, 2 AS hours_ahead FROM naive WHERE step = 8",
    ),
)
def forecast_heatmap_naive(spark, d):
    return scoring.forecast_heatmap(naive(spark, d), 2)


def _model_table(spark, d, series: DataFrame) -> DataFrame:
    """Features that look at the past only, written once: the model is fitted on them and applied to them."""
    table = features.feature_table(series, tables.zones(spark, d), before=drq.SPLIT, past=True)
    return cut_lineage(scoring.filled(table, scoring.MODEL_FEATURES))


def _trained(table: DataFrame):
    """Boosted trees of the rows before the split."""
    return forest.fit_boosted(table.where(F.col("time_bucket") < F.lit(drq.SPLIT).cast("timestamp_ntz")), scoring.MODEL_FEATURES)


@query("score_batch")
def score_batch(spark, d):
    """Boosted trees fitted on the baseline window, applied to the whole table."""
    table = _model_table(spark, d, dq.stored_fact(spark, d))
    return forest.score_boosted(table, _trained(table), scoring.MODEL_FEATURES).select("zone_id", "time_bucket", "trip_count", "yhat")


@query("forecast_recursive")
def forecast_recursive(spark, d):
    f = dq.stored_fact(spark, d)
    trees = forest.Forest.exported(_trained(_model_table(spark, d, f)), scoring.MODEL_FEATURES)
    return scoring.forecast_recursive(f, features.zone_slot_baseline(f, drq.SPLIT), trees.predict)


@query("forecast_heatmap")
def forecast_heatmap(spark, d):
    return scoring.forecast_heatmap(cut_lineage(forecast_recursive(spark, d)), 4)


# A fixed model of dyadic weights: every prediction is exact in both engines, so the recursion itself is compared.
FIXED_WEIGHTS = {"lag_15min": 0.25, "lag_1h": 0.25, "lag_1week": 0.5}
FIXED = f"""hist AS (SELECT zone_id, max(time_bucket) AS t0, list(CAST(trip_count AS DOUBLE) ORDER BY time_bucket) AS y FROM fact GROUP BY 1),
steps AS (
  SELECT zone_id, 0 AS step, t0, y FROM hist
  UNION ALL
  SELECT zone_id, step + 1, t0, list_append(y, greatest(0.0, 0.25 * y[-1] + 0.25 * y[-4] + 0.5 * y[-672])) FROM steps WHERE step < 16),
ahead AS (SELECT zone_id, CAST(step AS INTEGER) AS step, CAST(t0 + step * INTERVAL 15 MINUTE AS TIMESTAMP) AS time_bucket, round_even(y[-1], 2) AS yhat FROM steps WHERE step > 0)"""


def fixed_model(row: dict[str, np.ndarray]) -> np.ndarray:
    return sum(w * row[c] for c, w in FIXED_WEIGHTS.items())


@query("forecast_recursive_fixed", f"WITH RECURSIVE {FACT}, {FIXED} SELECT zone_id, step, time_bucket, yhat FROM ahead")
def forecast_recursive_fixed(spark, d):
    """The recursive forecast with a given model: predictions become the history of the next steps."""
    f = dq.stored_fact(spark, d)
    return scoring.forecast_recursive(f, features.zone_slot_baseline(f, drq.SPLIT), fixed_model)


# One given tree with dyadic leaves, in both engines.
TREE = ("lag_1h", 0.5, ("lag_1week", 0.5, 0.25, 1.25), ("roll_mean_1h", 1.5, ("lag_15min", 0.75, 0.75, 1.5), 2.5))
TREE_STEPS = FIXED.replace(
    "greatest(0.0, 0.25 * y[-1] + 0.25 * y[-4] + 0.5 * y[-672])",
    """CASE WHEN y[-4] <= 0.5 THEN CASE WHEN y[-672] <= 0.5 THEN 0.25 ELSE 1.25 END
            WHEN (y[-1] + y[-2] + y[-3] + y[-4]) / 4 <= 1.5 THEN CASE WHEN y[-1] <= 0.75 THEN 0.75 ELSE 1.5 END ELSE 2.5 END""",
)


@query("forecast_recursive_tree", f"WITH RECURSIVE {FACT}, {TREE_STEPS} SELECT zone_id, step, time_bucket, yhat FROM ahead")
def forecast_recursive_tree(spark, d):
    """The recursive forecast with one given tree in the form of an exported model."""
    f = dq.stored_fact(spark, d)
    model = forest.Forest.of([TREE], scoring.MODEL_FEATURES)
    return scoring.forecast_recursive(f, features.zone_slot_baseline(f, drq.SPLIT), model.predict)


@query(
    "score_tree",
    with_(
        dq.FEATURE_CTES,
        """SELECT zone_id, time_bucket, (CASE WHEN lag_1h <= 0.5 THEN CASE WHEN lag_1week <= 0.5 THEN 0.25 ELSE 1.25 END
             WHEN before <= 1.5 THEN CASE WHEN lag_15min <= 0.75 THEN 0.75 ELSE 1.5 END ELSE 2.5 END)::DOUBLE AS yhat
           FROM (SELECT *, avg(trip_count) OVER (PARTITION BY zone_id ORDER BY time_bucket RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND INTERVAL 15 MINUTE PRECEDING) AS before FROM feat)
           WHERE time_bucket >= TIMESTAMP '2024-01-16'""",
    ),
)
def score_tree(spark, d):
    """The same tree as a column expression over the features of the second half."""
    table = features.feature_table(dq.stored_fact(spark, d), tables.zones(spark, d), before=drq.SPLIT, past=True)
    model = forest.Forest.of([TREE], scoring.MODEL_FEATURES)
    later = table.where(F.col("time_bucket") >= F.lit(drq.SPLIT).cast("timestamp_ntz"))
    return later.select("zone_id", "time_bucket", model.column().alias("yhat"))


@query(
    "forecast_heatmap_fixed",
    f"WITH RECURSIVE {FACT}, {FIXED} SELECT zone_id, time_bucket, yhat AS demand, max(yhat) OVER () AS max, 3 AS hours_ahead FROM ahead WHERE step = 12",
)
def forecast_heatmap_fixed(spark, d):
    return scoring.forecast_heatmap(cut_lineage(forecast_recursive_fixed(spark, d)), 3)


@query(
    "score_python",
    with_(
        dq.FEATURE_CTES,
        """SELECT zone_id, time_bucket, greatest(0.0, 0.5 * coalesce(lag_1h, 0) + 0.25 * coalesce(lag_1week, 0) - 0.25)::DOUBLE AS yhat
           FROM feat WHERE time_bucket >= TIMESTAMP '2024-01-16'""",
    ),
)
def score_python(spark, d):
    """A Python model over Arrow batches of the feature table; negative predictions become 0."""
    table = features.feature_table(dq.stored_fact(spark, d), tables.zones(spark, d), before=drq.SPLIT).fillna(0.0, ["lag_1h", "lag_1week"])
    later = table.where(F.col("time_bucket") >= F.lit(drq.SPLIT).cast("timestamp_ntz")).select("zone_id", "time_bucket", "lag_1h", "lag_1week")
    scored = scoring.score_with(later, lambda rows: 0.5 * rows["lag_1h"] + 0.25 * rows["lag_1week"] - 0.25, ["lag_1h", "lag_1week"])
    return scored.select("zone_id", "time_bucket", "yhat")


# Sources and sinks


@query(
    "zone_centroid",
    with_(
        f"{FACT.split(', md(')[0]}, {dq.CENTROIDS}, busy AS (SELECT user_id % 25 AS zone_id, count(*) AS trips FROM events GROUP BY 1)",
        "SELECT zone_id, round(lat, 6) AS lat, round(lon, 6) AS lon, trips FROM centroids JOIN busy USING (zone_id) WHERE zone_id % 7 <> 6",
    ),
)
def zone_centroid(spark, d):
    """Polygons around each zone's centre are written as GeoJSON and read back; multi-polygons are skipped."""
    c = dq.centroids(spark, d)

    def corner(dx: float, dy: float):
        return F.array((F.col("lon") + dx).cast("string"), (F.col("lat") + dy).cast("string"))

    ring = F.array(corner(-0.01, -0.02), corner(0.01, -0.02), corner(0.005, 0.02), corner(-0.01, -0.02))
    kind = F.when(F.col("zone_id") % 7 == 6, "MultiPolygon").otherwise("Polygon")
    geometry = F.struct(kind.alias("type"), F.array(ring).alias("coordinates"))
    feature = F.struct(F.struct(F.col("zone_id").cast("string").alias("LocationID")).alias("properties"), geometry.alias("geometry"))
    path = scratch(spark, "geojson")
    c.select(F.array(feature).alias("features")).write.json(path)
    trips = tables.trips(spark, d).groupBy("zone_id").agg(F.count("*").alias("trips"))
    out = readers.zone_centroids(readers.geojson(spark, path, one_document=False)).join(trips, "zone_id")
    return out.select("zone_id", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "trips")


def _spending_log(spark, d) -> str:
    path = scratch(spark, "log")
    entries = lq.cost_ledger_frame(spark, d).select("event_id", "user_id", "ts", "event_type", "total_cost")
    kind = F.col("event_type")
    logs.append_log(entries.where(kind == "purchase"), path, "ts")
    logs.append_log(entries.where(kind != "purchase"), path, "ts")
    return path


@query(
    "log_append",
    with_(lq.LEDGER, "SELECT CAST(ts AS DATE) AS log_date, count(*) AS entries, round(sum(total_cost), 4) AS cost FROM ledger GROUP BY 1"),
)
def log_append(spark, d):
    """Two appends to a log partitioned by day, read back."""
    log = logs.scan_log(spark, _spending_log(spark, d))
    return log.groupBy("log_date").agg(F.count("*").alias("entries"), F.round(F.sum("total_cost"), 4).alias("cost"))


@query(
    "log_scan",
    with_(
        lq.LEDGER,
        "SELECT event_id, user_id, total_cost FROM ledger WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-07' AND total_cost > 100",
    ),
)
def log_scan(spark, d):
    """Days prune partitions; the cost condition is pushed to Parquet."""
    wanted = F.col("log_date").between("2024-01-05", "2024-01-07") & (F.col("total_cost") > 100)
    return logs.scan_log(spark, _spending_log(spark, d), wanted).select("event_id", "user_id", "total_cost")


@query(
    "metrics_report",
    with_(
        f"""{drq.MONITOR},
f1 AS (SELECT metric, grouping, segment, '{{' || string_agg('"' || field || '":' || CAST(round(value * 1000000) AS BIGINT), ',' ORDER BY field) || '}}' AS j FROM metrics WHERE value IS NOT NULL GROUP BY 1, 2, 3),
f2 AS (SELECT metric, grouping, '{{' || string_agg('"' || segment || '":' || j, ',' ORDER BY segment) || '}}' AS j FROM f1 GROUP BY 1, 2)""",
        """SELECT metric, '{' || string_agg('"' || grouping || '":' || j, ',' ORDER BY grouping) || '}' AS report FROM f2 GROUP BY 1""",
    ),
)
def metrics_report(spark, d):
    """The nested report of a monitoring run; values in whole millionths, so that its text is the same everywhere."""
    metrics = drq.all_metrics(spark, d).withColumn("value", F.round(F.col("value") * 1000000).cast("bigint"))
    return logs.report_rows(metrics).select("metric", F.to_json("report").alias("report"))


# Streams


def run(writer, spark: SparkSession, name: str) -> None:
    """Runs a stream over all the input there is and waits for its end."""
    streams.run_reported(writer, spark, scratch(spark, name))


def in_runs(spark: SparkSession, rows: DataFrame, arrival: Column, runs: int, build, name: str, result: str | None = None) -> DataFrame:
    """A stream on a schedule: the rows arrive in turns, and each run takes what is new with the state of the runs before.

    ``build(stream, run, reports)`` gives the writer, where ``reports`` are the progress rows so far. Returns these, with their run; they
    are also written next to the ``result``, if its path is given.
    """
    path, checkpoint = scratch(spark, f"{name}-in"), scratch(spark, f"{name}-checkpoint")
    reports: list[DataFrame] = []
    for k in range(runs):
        rows.where(arrival == k).write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        progress = f"{result}-progress" if result else None
        reports.append(streams.run_reported(build(stream, k, reports), spark, checkpoint, progress).withColumn("run", F.lit(k)))
    return reduce(DataFrame.unionByName, reports)


#: The days on which the second and the third run begin.
RUN_STARTS = ("2024-01-12", "2024-01-22")


def run_of(ts: str, starts: tuple[str, ...] = RUN_STARTS) -> Column:
    return reduce(Column.__add__, [(F.col(ts) >= F.lit(x).cast("timestamp_ntz")).cast("int") for x in starts])


def run_to_table(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    path = scratch(spark, name)
    run(stream.writeStream.outputMode("append").format("parquet").option("path", path), spark, f"{name}-state")
    return spark.read.schema(stream.schema).parquet(path)


def table_of_runs(spark: SparkSession, rows: DataFrame, arrival: Column, make, name: str) -> DataFrame:
    """Append mode over three scheduled runs: the rows that ``make`` makes of the stream, once they are final."""
    path, schemas = scratch(spark, name), []

    def build(stream: DataFrame, k: int, _):
        made = make(stream)
        schemas.append(made.schema)
        return made.writeStream.outputMode("append").format("parquet").option("path", path)

    in_runs(spark, rows, arrival, 3, build, name, path)
    return spark.read.schema(schemas[0]).parquet(path)


def updates_of_runs(spark: SparkSession, rows: DataFrame, arrival: Column, make, name: str, keys: list[str]) -> DataFrame:
    """Update mode over three scheduled runs: each trigger writes the rows it changed to a folder of its number, and the last state of a key counts.

    The watermark can drop closed windows from the state, and a repeated trigger replaces only its own folder.
    """
    path, schemas = scratch(spark, name), []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    def build(stream: DataFrame, k: int, _):
        made = make(stream)
        schemas.append(made.schema)
        return made.writeStream.outputMode("update").foreachBatch(keep)

    in_runs(spark, rows, arrival, 3, build, name, path)
    rest = [c for c in schemas[0].names if c not in keys]
    written = spark.read.schema(StructType([*schemas[0].fields, StructField("batch", LongType())])).parquet(path)
    return written.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(*keys, "last.*")


BUCKETS = "SELECT user_id % 25 AS zone_id, epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) AS bucket_us, count(*) AS trip_count FROM events GROUP BY 1, 2"


def _zone_times(spark, d) -> DataFrame:
    e = tables.table(spark, d, "events")
    return e.select("ts", F.pmod("user_id", F.lit(25)).alias("zone_id"), F.timestamp_micros(epoch_micros(F.col("ts"))).alias("event_time"))


def _windows(stream: DataFrame) -> DataFrame:
    return streams.demand_windows(stream, "event_time")


@query("stream_demand", BUCKETS)
def stream_demand(spark, d):
    """The last update of each window equals the batch aggregate."""
    out = updates_of_runs(spark, _zone_times(spark, d), run_of("ts"), _windows, "demand", ["zone_id", "time_bucket"])
    return out.select("zone_id", F.unix_micros("time_bucket").alias("bucket_us"), "trip_count")


@query(
    "stream_demand_closed",
    BUCKETS + " HAVING max(time_bucket(INTERVAL 15 MINUTE, ts)) + INTERVAL 15 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR",
)
def stream_demand_closed(spark, d):
    """Windowed demand in append mode: the windows the watermark has closed."""
    out = table_of_runs(spark, _zone_times(spark, d), run_of("ts"), _windows, "closed")
    return out.select("zone_id", F.unix_micros("time_bucket").alias("bucket_us"), "trip_count")


@query("stream_rate_limit", lq.ORACLES["rate_limit"])
def stream_rate_limit(spark, d):
    """Three scheduled runs; the state is what a window may still hold of each user's admitted requests."""
    requests = tables.table(spark, d, "events").select("user_id", "ts", "event_id")
    path = scratch(spark, "rate")
    in_runs(spark, requests, run_of("ts"), 3, lambda stream, k, _: streams.rate_limit_batches(stream, path, lq.GATE_CAP, lq.DAY), "rate", path)
    return spark.read.parquet(path).select("event_id", "user_id", "allowed")


@query("stream_budget", lq.ORACLES["budget_gate"])
def stream_budget(spark, d):
    """Three scheduled runs; the state is what each user has spent."""
    budgets = policies.role_budgets(spark)
    path = scratch(spark, "budget")
    in_runs(spark, lq.requests(spark, d), run_of("ts"), 3, lambda stream, k, _: streams.budget_batches(stream, path, budgets, policies.PREFLIGHT_ESTIMATE), "budget", path)
    return spark.read.parquet(path).select("event_id", "user_id", "allowed")


LATE = f"""arrived AS (
  SELECT ts, epoch_us(time_bucket(INTERVAL 15 MINUTE, ts)) + 900000000 AS closes, least(2, a + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END) AS run
  FROM (SELECT event_id, ts, {" + ".join(f"CASE WHEN ts >= TIMESTAMP '{x}' THEN 1 ELSE 0 END" for x in RUN_STARTS)} AS a FROM events)),
marks AS (SELECT r.run, max(epoch_us(ts)) - 3600000000 AS mark FROM (SELECT unnest([1, 2, 3]) AS run) r JOIN arrived ON arrived.run < r.run GROUP BY 1),
judged AS (SELECT a.run, closes, coalesce(closes <= mark, false) AS late FROM arrived a LEFT JOIN marks USING (run))"""


@query(
    "stream_late_rows",
    with_(
        LATE,
        """SELECT run, count(*) AS input_rows, count(*) FILTER (WHERE late) AS late_rows, count(*) FILTER (WHERE late) > 0 AS dropped,
             (SELECT count(*) FROM judged WHERE NOT late AND closes <= (SELECT mark FROM marks WHERE run = 3)) AS closed_trips FROM judged GROUP BY 1""",
    ),
)
def stream_late_rows(spark, d):
    """Windowed demand in three runs; every 97th event comes one run late, and what the watermark drops is counted in each run."""
    e = tables.table(spark, d, "events").select("event_id", "user_id", "ts")
    rows = e.withColumn("event_time", F.timestamp_micros(epoch_micros(F.col("ts"))))
    arrival = F.least(F.lit(2), run_of("ts") + (F.col("event_id") % 97 == 0).cast("int"))
    path = scratch(spark, "late")

    def build(stream: DataFrame, k: int, reports: list[DataFrame]):
        # One value of the run before.
        mark = reports[-1].agg(F.max("watermark")).first()[0] if reports else None
        zones = streams.counting_late(stream, "event_time", "15 minutes", mark).select(F.pmod("user_id", F.lit(25)).alias("zone_id"), "event_time")
        return streams.demand_windows(zones, "event_time").writeStream.outputMode("append").format("parquet").option("path", path)

    report = in_runs(spark, rows, arrival, 3, build, "late", path)
    closed = spark.read.schema("zone_id bigint, time_bucket timestamp, trip_count bigint").parquet(path)
    per_run = report.groupBy("run").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), (F.sum("dropped_rows") > 0).alias("dropped"))
    return per_run.withColumn("closed_trips", closed.agg(F.sum("trip_count")).scalar())


def _dirty_stream(spark, d) -> DataFrame:
    path = scratch(spark, "dirty")
    qq.dirty(spark, d).write.parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


@query("stream_clean", with_(qq.DIRTY, "SELECT * FROM cleaned"))
def stream_clean(spark, d):
    """One batch of the dirty series through the cleaning stream."""
    base = scratch(spark, "clean")
    writer = streams.clean_batches(_dirty_stream(spark, d), f"{base}/clean", f"{base}/quarantine", f"{base}/report", "row_id")
    run(writer, spark, "clean-state")
    return spark.read.parquet(f"{base}/clean").drop("batch")


@query(
    "stream_dedupe",
    with_(qq.DIRTY, "SELECT zone_id, count(*) AS keys FROM (SELECT DISTINCT zone_id, time_bucket FROM dirty) GROUP BY 1"),
)
def stream_dedupe(spark, d):
    stream = _dirty_stream(spark, d).withColumn("event_time", F.timestamp_micros(epoch_micros(F.col("time_bucket"))))
    out = run_to_table(streams.first_per_key(stream, ["zone_id", "time_bucket"], "event_time"), spark, "dedupe")
    return out.groupBy("zone_id").agg(F.count("*").alias("keys"))


MONITOR_STARTS = ("2024-01-21", "2024-01-26")
_BATCHES = [("2024-01-16", "2024-01-21"), ("2024-01-21", "2024-01-26"), ("2024-01-26", "2100-01-01")]


def _monitor_sql(number: int, start: str, end: str) -> str:
    """The metrics of one batch; the features of its rows look back over all that came before."""
    look = """CAST(hour(time_bucket) AS INTEGER) AS hour, CASE WHEN isodow(time_bucket) >= 6 THEN 1 ELSE 0 END AS is_weekend"""
    lags = "lag_15min, lag_1h, lag_2h, lag_1day, lag_1week, roll_mean_1h, roll_mean_2h, roll_mean_1day"
    ctes = f"""{qq.DIRTY},
series AS (
  SELECT zone_id, time_bucket, trip_count, is_holiday FROM fact WHERE time_bucket < TIMESTAMP '{drq.SPLIT}'
  UNION ALL SELECT zone_id, time_bucket, trip_count, is_holiday FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, time_bucket ORDER BY row_id) AS first FROM dirty)
  WHERE first = 1 AND time_bucket >= TIMESTAMP '{drq.SPLIT}'),
feat AS (SELECT *, {dq.LAG_SQL}, {dq.ROLL_SQL}, CAST(hour(time_bucket) * 4 + minute(time_bucket) // 15 AS INTEGER) AS slot_of_day FROM series {dq.WINDOW_SQL}),
slotbase AS (SELECT zone_id, slot_of_day, avg(trip_count) AS zone_slot_baseline FROM feat WHERE time_bucket < TIMESTAMP '{drq.SPLIT}' GROUP BY 1, 2),
known AS (
  SELECT f.*, zone_slot_baseline, borough_id, floor((coalesce(lag_1week, zone_slot_baseline) + zone_slot_baseline) / 2 * 4096) / 4096.0 AS yhat
  FROM feat f LEFT JOIN slotbase b ON b.zone_id = f.zone_id AND b.slot_of_day = f.slot_of_day LEFT JOIN zones z ON z.zone_id = f.zone_id),
scored AS (
  SELECT zone_id, borough_id, {look}, time_bucket, trip_count, is_holiday, {lags}, yhat, false AS is_new FROM known WHERE time_bucket < TIMESTAMP '{drq.SPLIT}'
  UNION ALL
  SELECT d.zone_id, k.borough_id, {look.replace("time_bucket", "d.time_bucket")}, d.time_bucket, d.trip_count, d.is_holiday, {lags}, yhat, true
  FROM dirty d JOIN known k ON k.zone_id = d.zone_id AND k.time_bucket = d.time_bucket WHERE d.time_bucket >= TIMESTAMP '{start}' AND d.time_bucket < TIMESTAMP '{end}')"""
    # Accuracy is measured where both numbers are known.
    tagged = drq.TAGGED.replace("FROM scored", "FROM scored WHERE trip_count IS NOT NULL AND yhat IS NOT NULL")
    rest = drq.MONITOR.removeprefix(drq.SCORED).replace(drq.TAGGED, tagged).replace("max(time_bucket) AS latest", "max(time_bucket) FILTER (WHERE is_new) AS latest")
    copies = "(SELECT sum(n - 1) AS extra, count(*) FILTER (WHERE n > 1) AS keys FROM (SELECT count(*) AS n FROM scored WHERE is_new GROUP BY zone_id, time_bucket))"
    rest = rest.replace("unnest([0.0, 0.0, 0.0, CAST(total AS DOUBLE)]) FROM one", f"unnest([extra / total, CAST(extra AS DOUBLE), CAST(keys AS DOUBLE), CAST(total AS DOUBLE)]) FROM one, {copies}")
    verdict = """CASE WHEN (SELECT count(*) FROM alerts WHERE severity = 'critical') > 0 THEN 'BLOCK_DEPLOY_AND_PAGE' WHEN (SELECT count(*) FROM alerts) > 0 THEN 'MONITOR' ELSE 'OK' END"""
    body = f"""SELECT {number} AS batch, m.metric, m.grouping, m.segment, m.field, CASE WHEN abs(m.value) >= 1e6 THEN round(m.value / 1e6, 3) * 1e6 ELSE round(m.value, 6) + 0 END AS value, severity, {verdict} AS decision
      FROM metrics m LEFT JOIN alerts a ON a.metric = m.metric AND a.grouping = m.grouping AND a.segment = m.segment AND a.field = m.field"""
    return f"SELECT * FROM (WITH {ctes}{rest}\n{body})"


@query("stream_monitor", "\nUNION ALL\n".join(_monitor_sql(i, a, b) for i, (a, b) in enumerate(_BATCHES)))
def stream_monitor(spark, d):
    """The dirty series after the split in three scheduled runs, each against the stored profile of the series before it.

    The features of a row look back over the state (the last week of each zone) and the first copy of each key of its batch.
    """
    split = F.lit(drq.SPLIT).cast("timestamp_ntz")
    columns = ["zone_id", "time_bucket", "trip_count", "is_holiday"]
    history = cut_lineage(dq.fact(spark, d).where(F.col("time_bucket") < split).select(*columns))
    slots = cut_lineage(features.zone_slot_baseline(history))

    def scored(series: DataFrame) -> DataFrame:
        return drq.scored_series(spark, d, series, slots).withColumn("roll_mean_1day", F.round("roll_mean_1day", 9))

    def score(batch: DataFrame, series: DataFrame) -> DataFrame:
        return batch.join(scored(series).drop("trip_count", "is_holiday", "is_new"), ["zone_id", "time_bucket"], "left")

    stored = monitor.profile(cut_lineage(scored(history)))
    base = scratch(spark, "monitor")
    rows = qq.dirty(spark, d).where(F.col("time_bucket") >= split)

    def build(stream: DataFrame, k: int, _):
        return streams.monitor_batches(stream, base, lambda n: drq.REFERENCE, stored, score, history if k == 0 else None)

    in_runs(spark, rows, run_of("time_bucket", MONITOR_STARTS), 3, build, "monitor", base)
    found = spark.read.parquet(base).join(spark.read.parquet(f"{base}-decisions").select("batch", "decision"), "batch")
    # Changes against a base of nearly nothing are huge, and are compared by their leading digits.
    v = F.col("value")
    shown = F.when(F.abs(v) >= 1e6, F.round(v / 1e6, 3) * 1e6).otherwise(F.round(v, 6) + F.lit(0.0))
    return found.select("batch", "metric", "grouping", "segment", "field", shown.alias("value"), "severity", "decision")


@query(
    "stream_costs",
    with_(
        lq.LEDGER,
        "SELECT user_id, epoch_us(date_trunc('day', ts)) AS window_us, round(sum(total_cost), 4) AS cost, count(*) AS queries FROM ledger GROUP BY 1, 2",
    ),
)
def stream_costs(spark, d):
    entries = lq.cost_ledger_frame(spark, d).withColumn("event_time", F.timestamp_micros(epoch_micros(F.col("ts"))))
    out = updates_of_runs(spark, entries, run_of("ts"), lambda s: streams.cost_windows(s, "event_time"), "costs", ["user_id", "window_start"])
    return out.select("user_id", F.unix_micros("window_start").alias("window_us"), F.round("cost", 4).alias("cost"), "queries")


@query("stream_spikes", lq.ORACLES["cost_spikes"])
def stream_spikes(spark, d):
    schema = lq.cost_ledger_frame(spark, d).schema
    path = scratch(spark, "ledger")
    lq.cost_ledger_frame(spark, d).write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    out = run_to_table(streams.spikes_against(stream, spark.read.parquet(path)), spark, "spikes")
    return out.select("event_id", "total_cost")
