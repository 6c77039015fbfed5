"""Registered queries on drift and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift, features, monitor
from ..plans.ranks import value_counts
from ..session import cut_lineage
from ..sources import tables
from . import demand_queries as dq
from .sqlbase import with_

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SPLIT = "2024-01-16"
REFERENCE = "2024-01-31 01:30:00"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Features with a prediction: the mean of last week's value and the zone's slot mean before the split."""
    return scored_series(spark, d, dq.stored_fact(spark, d))


def scored_series(spark: SparkSession, d: str, fact: DataFrame, baseline: DataFrame | None = None) -> DataFrame:
    """The same of a series that is given, with the slot means of its first part or stored ones."""
    f = features.feature_table(fact, tables.zones(spark, d), before=SPLIT, baseline=baseline)
    base = F.col("zone_slot_baseline")
    # On a grid of 1/4096, so that sums are exact in any order.
    yhat = F.floor((F.coalesce("lag_1week", base) + base) / 2 * 4096) / 4096.0
    return drift.windows(f.withColumn("yhat", yhat), SPLIT, SPLIT)


SCORED = f"""{dq.FEATURE_CTES},
scored AS (
  SELECT f.zone_id, borough_id, CAST(hour(time_bucket) AS INTEGER) AS hour, CASE WHEN isodow(time_bucket) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(isodow(time_bucket) - 1 AS INTEGER) AS dayofweek, time_bucket, trip_count, is_holiday, lag_15min, lag_1h, lag_2h, lag_1day, lag_1week,
         roll_mean_1h, roll_mean_2h, roll_mean_1day, zone_slot_baseline,
         floor((coalesce(lag_1week, zone_slot_baseline) + zone_slot_baseline) / 2 * 4096) / 4096.0 AS yhat,
         time_bucket >= TIMESTAMP '{SPLIT}' AS is_new
  FROM feat f LEFT JOIN slotbase b ON b.zone_id = f.zone_id AND b.slot_of_day = f.slot_of_day LEFT JOIN zones z ON z.zone_id = f.zone_id)"""


def errors(where: str) -> str:
    """Accuracy measures of the rows of one condition."""
    f = f"FILTER (WHERE {where})"
    q = "greatest(yhat, 1e-9)"
    return f"""count(*) {f} AS n,
      2 * avg(CASE WHEN trip_count > 0 THEN trip_count * ln(trip_count / {q}) ELSE 0 END - (trip_count - {q})) {f} AS poisson_deviance,
      sqrt(avg(power(trip_count - yhat, 2)) {f}) AS rmse, avg(abs(trip_count - yhat)) {f} AS mae,
      avg(CASE WHEN trip_count > 0 THEN abs(trip_count - yhat) / trip_count END) {f} AS mape, avg(trip_count) {f} AS actual_mean,
      avg(yhat) {f} AS pred_mean, stddev_pop(yhat) {f} AS pred_std"""


TAGGED = """tagged AS (
  SELECT *, unnest(['zone', 'borough', 'borough_weekend', 'hour', 'global']) AS grouping,
         unnest([CAST(zone_id AS VARCHAR), CAST(borough_id AS VARCHAR), 'b' || borough_id || '_w' || is_weekend, CAST(hour AS VARCHAR), 'all']) AS segment
  FROM scored)"""

ACCURACY = f"""{SCORED}, {TAGGED},
nw AS (SELECT grouping, segment, {errors('is_new')} FROM tagged GROUP BY 1, 2),
bs AS (SELECT grouping, segment, {errors('NOT is_new')} FROM tagged GROUP BY 1, 2),
acc AS (
  SELECT nw.*, bs.n AS base_n, bs.poisson_deviance AS base_poisson_deviance, bs.rmse AS base_rmse, bs.mape AS base_mape,
         bs.actual_mean AS base_actual_mean,
         CASE WHEN grouping = 'global' OR bs.poisson_deviance > 1e-9
              THEN (nw.poisson_deviance - bs.poisson_deviance) / nullif(bs.poisson_deviance, 0) END AS deviance_rel_delta,
         (nw.rmse - bs.rmse) / nullif(bs.rmse, 0) AS rmse_rel_delta, nw.mape - bs.mape AS mape_abs_delta
  FROM nw JOIN bs USING (grouping, segment))"""

ACC_COLS = ["poisson_deviance", "rmse", "mae", "mape", "actual_mean", "pred_mean", "deviance_rel_delta", "rmse_rel_delta", "mape_abs_delta"]


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, places) + F.lit(0.0) for n in names})


def r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) + 0 AS {n}" for n in names)


@query("accuracy_global", with_(ACCURACY, f"SELECT n, base_n, {r(*ACC_COLS)} FROM acc WHERE grouping = 'global'"))
def accuracy_global(spark, d):
    out = monitor.accuracy(scored(spark, d)).where(F.col("grouping") == "global")
    return rounded(out.select("n", "base_n", *ACC_COLS), *ACC_COLS)


@query("accuracy_segments", with_(ACCURACY, f"SELECT grouping, segment, n, base_n, {r(*ACC_COLS)} FROM acc"))
def accuracy_segments(spark, d):
    return rounded(monitor.accuracy(scored(spark, d)).select("grouping", "segment", "n", "base_n", *ACC_COLS), *ACC_COLS)


WINDOWS = [("baseline", "2024-01-01", "2024-01-16"), ("corrupt", "2024-01-16", "2024-01-22"), ("drift", "2024-01-22", None)]
REPORT = f"""{SCORED}, {TAGGED},
labelled AS (SELECT *, CASE WHEN time_bucket < TIMESTAMP '2024-01-16' THEN 'baseline' WHEN time_bucket < TIMESTAMP '2024-01-22' THEN 'corrupt' ELSE 'drift' END AS win FROM tagged),
report AS (SELECT win, grouping, segment, {errors('true')}, quantile_cont(yhat, 0.5) AS pred_p50, quantile_cont(yhat, 0.95) AS pred_p95
           FROM labelled GROUP BY 1, 2, 3)"""
REPORT_COLS = ["poisson_deviance", "rmse", "mae", "mape", "actual_mean", "pred_mean", "pred_std", "pred_p50", "pred_p95"]


@query("accuracy_windows", with_(REPORT, f"SELECT win, grouping, segment, n, {r(*REPORT_COLS)} FROM report"))
def accuracy_windows(spark, d):
    return rounded(monitor.accuracy_windows(scored(spark, d), WINDOWS), *REPORT_COLS)


DELTAS = ["rmse_pct", "mae_pct", "mape_pct", "poisson_deviance_pct"]


@query(
    "accuracy_deltas",
    with_(
        REPORT,
        "SELECT grouping, segment, "
        + ", ".join(f"round((n.{c} - b.{c}) / nullif(b.{c}, 0) * 100, 4) + 0 AS {c}_pct" for c in ("rmse", "mae", "mape", "poisson_deviance"))
        + " FROM (SELECT * FROM report WHERE win = 'baseline') b JOIN (SELECT * FROM report WHERE win = 'drift') n USING (grouping, segment)",
    ),
)
def accuracy_deltas(spark, d):
    report = monitor.accuracy_windows(scored(spark, d), WINDOWS)
    return rounded(monitor.headline_deltas(report, "baseline", "drift"), *DELTAS, places=4)


PRED = ["mean", "std", "p50", "p95", "baseline_mean", "baseline_std"]


@query(
    "pred_distribution",
    with_(
        SCORED,
        f"""SELECT {r(*PRED)}, std < 0.25 * baseline_std AS collapsed FROM (
          SELECT avg(yhat) FILTER (WHERE is_new) AS mean, stddev_pop(yhat) FILTER (WHERE is_new) AS std,
                 quantile_cont(yhat, 0.5) FILTER (WHERE is_new) AS p50, quantile_cont(yhat, 0.95) FILTER (WHERE is_new) AS p95,
                 avg(yhat) FILTER (WHERE NOT is_new) AS baseline_mean, stddev_pop(yhat) FILTER (WHERE NOT is_new) AS baseline_std FROM scored)""",
    ),
)
def pred_distribution(spark, d):
    return rounded(monitor.prediction_summary(scored(spark, d)), *PRED)


# Value-count based tests. The SQL works on (grp, value, n_base, n_new) rows.


def sql_counts(source: str, groups: str, value: str = "value") -> str:
    return f"""vc AS (SELECT {groups}, CAST({value} AS DOUBLE) AS value, count(*) FILTER (WHERE NOT is_new) AS n_base, count(*) FILTER (WHERE is_new) AS n_new
      FROM {source} WHERE {value} IS NOT NULL GROUP BY ALL)"""


def sql_histogram(groups: str, bins: int, name: str) -> str:
    return f"""{name}_rg AS (SELECT {groups}, min(value) AS lo, max(value) + 1e-9 AS top, sum(n_base) AS all_base, sum(n_new) AS all_new FROM vc GROUP BY ALL),
    {name}_h AS (
      SELECT {groups}, all_base, all_new, len(list_filter(range(1, {bins}), lambda i: value >= lo + i * ((top - lo) / {bins}))) AS bin,
             sum(n_base) AS n_base, sum(n_new) AS n_new FROM vc JOIN {name}_rg USING ({groups}) GROUP BY ALL)"""


def sql_psi(groups: str) -> str:
    e, a = "greatest(n_base / all_base, 1e-6)", "greatest(n_new / all_new, 1e-6)"
    return sql_histogram(groups, 10, "p") + f""",
    psis AS (SELECT {groups}, sum(({a} - {e}) * ln({a} / {e})) FILTER (WHERE all_base > 0 AND all_new > 0) AS psi FROM p_h GROUP BY ALL)"""


def sql_js(groups: str) -> str:
    p, q = "(n_base / all_base)", "(n_new / all_new)"
    m = f"(({p} + {q}) / 2)"
    return sql_histogram(groups, 20, "j") + f""",
    jss AS (SELECT {groups}, sqrt(greatest(sum(CASE WHEN n_base > 0 THEN {p} * log2({p} / {m}) ELSE 0 END + CASE WHEN n_new > 0 THEN {q} * log2({q} / {m}) ELSE 0 END), 0) / 2) AS js
            FROM j_h WHERE all_base > 0 AND all_new > 0 GROUP BY {groups})"""


def sql_ks(groups: str) -> str:
    t = "(ks * sqrt(n_base * n_new / (n_base + n_new)))"
    return f"""cum AS (
      SELECT {groups}, sum(n_base) OVER (w ORDER BY value) AS cb, sum(n_new) OVER (w ORDER BY value) AS cn, sum(n_base) OVER w AS nb, sum(n_new) OVER w AS nn
      FROM vc WINDOW w AS (PARTITION BY {groups})),
    kd AS (SELECT {groups}, max(abs(cb / nb - cn / nn)) AS ks, CAST(max(nb) AS DOUBLE) AS n_base, CAST(max(nn) AS DOUBLE) AS n_new FROM cum WHERE nb > 0 AND nn > 0 GROUP BY {groups}),
    kss AS (SELECT *, CASE WHEN {t} < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
             lambda k: (CASE WHEN k % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * k * k * {t} * {t}))))) END AS pvalue FROM kd)"""


DRIFT_FEATURES = [
    "trip_count", "lag_15min", "lag_1h", "lag_2h", "lag_1day", "lag_1week", "roll_mean_1h", "roll_mean_2h", "roll_mean_1day",
    "zone_slot_baseline", "is_holiday", "is_weekend", "borough_id", "hour", "dayofweek",
]


def sql_unpivot(columns: list[str], keep: str) -> str:
    return (
        f"long AS (SELECT {keep}, is_new, unnest([" + ", ".join(f"'{c}'" for c in columns) + "]) AS feature, unnest(["
        + ", ".join(f"CAST({c} AS DOUBLE)" if not c.startswith("roll") else f"round({c}, 9)" for c in columns)
        + "]) AS value FROM scored)"
    )


def drift_frame(spark, d) -> DataFrame:
    """Scored frame with rolling means rounded: both engines then see the same distinct values."""
    return scored(spark, d).withColumns({c: F.round(c, 9) for c in features.ROLLING})


@query("psi", with_(f"{SCORED}, {sql_unpivot(DRIFT_FEATURES, 'zone_id')}, {sql_counts('long', 'feature')}, {sql_psi('feature')}",
    """SELECT feature, round(psi, 6) + 0 AS psi, CASE WHEN psi IS NULL THEN 'skip' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END AS interpretation FROM psis"""))  # fmt: skip
def psi(spark, d):
    counts = cut_lineage(drift.feature_counts(drift_frame(spark, d), DRIFT_FEATURES))
    out = drift.psi(counts, ["feature"]).withColumn("interpretation", drift.psi_label(F.col("psi")))
    return rounded(out, "psi")


@query("psi_by_segment", with_(f"{SCORED}, {sql_unpivot(monitor.LAG_FEATURES, 'borough_id')}, {sql_counts('long', 'borough_id, feature')}, {sql_psi('borough_id, feature')}",
    "SELECT borough_id, feature, round(psi, 6) + 0 AS psi FROM psis"))
def psi_by_segment(spark, d):
    counts = cut_lineage(drift.feature_counts(drift_frame(spark, d), monitor.LAG_FEATURES, ["borough_id"]))
    return rounded(drift.psi(counts, ["borough_id", "feature"]), "psi")


EVENT_VALUES = f"ev AS (SELECT event_type, value, ts >= TIMESTAMP '{SPLIT}' AS is_new FROM events)"


def event_values(spark, d) -> DataFrame:
    e = tables.table(spark, d, "events").select("event_type", "value", "ts")
    return drift.windows(e, SPLIT, SPLIT, ts="ts")


@query("ks", with_(f"{EVENT_VALUES}, {sql_counts('ev', 'event_type')}, {sql_ks('event_type')}",
    "SELECT event_type, round(ks, 9) AS ks, round(pvalue, 6) AS pvalue, CAST(n_base AS BIGINT) AS n_base, CAST(n_new AS BIGINT) AS n_new FROM kss"))
def ks(spark, d):
    """KS of the continuous event value by event type."""
    counts = cut_lineage(value_counts(event_values(spark, d), ["event_type"], "value", drift.side_weights()))
    return rounded(rounded(drift.ks(counts, ["event_type"]), "ks", places=9), "pvalue")


@query("ks_by_hour", with_(f"{SCORED}, {sql_counts('scored', 'hour', 'trip_count')}, {sql_ks('hour')}",
    "SELECT hour, round(ks, 9) AS ks, round(pvalue, 6) AS pvalue, CAST(n_base AS BIGINT) AS n_base, CAST(n_new AS BIGINT) AS n_new FROM kss"))
def ks_by_hour(spark, d):
    frame = scored(spark, d).withColumn("value", F.col("trip_count"))
    counts = cut_lineage(value_counts(frame, ["hour"], "value", drift.side_weights()))
    return rounded(rounded(drift.ks(counts, ["hour"]), "ks", places=9), "pvalue")


@query("js_distance", with_(f"{EVENT_VALUES}, {sql_counts('ev', 'event_type')}, {sql_js('event_type')}", "SELECT event_type, round(js, 6) AS js FROM jss"))
def js_distance(spark, d):
    counts = cut_lineage(value_counts(event_values(spark, d), ["event_type"], "value", drift.side_weights()))
    return rounded(drift.js_distance(counts, ["event_type"]), "js")


FD_COLS = ["base_mean", "new_mean", "base_std", "new_std", "ks", "psi", "js"]


@query("feature_drift", with_(
    f"{SCORED}, {sql_unpivot(DRIFT_FEATURES, 'zone_id')}, {sql_counts('long', 'feature')}, {sql_psi('feature')}, {sql_js('feature')}, {sql_ks('feature')}, "
    """mom AS (SELECT feature, count(value) FILTER (WHERE NOT is_new) AS rows_base, count(value) FILTER (WHERE is_new) AS rows_new,
         avg(value) FILTER (WHERE NOT is_new) AS base_mean, avg(value) FILTER (WHERE is_new) AS new_mean,
         stddev_samp(value) FILTER (WHERE NOT is_new) AS base_std, stddev_samp(value) FILTER (WHERE is_new) AS new_std FROM long GROUP BY 1)""",
    f"""SELECT feature, rows_base, rows_new, {r(*FD_COLS)}, round(pvalue, 6) + 0 AS pvalue,
          CASE WHEN psi IS NULL THEN 'skip' WHEN psi < 0.1 THEN 'stable' WHEN psi < 0.25 THEN 'moderate' ELSE 'significant' END AS interpretation,
          row_number() OVER (ORDER BY round(psi, 9) DESC NULLS LAST, feature) AS psi_rank
        FROM mom JOIN psis USING (feature) JOIN jss USING (feature) JOIN kss USING (feature) WHERE rows_base >= 50 AND rows_new >= 50"""))  # fmt: skip
def feature_drift(spark, d):
    return rounded(drift.feature_drift(drift_frame(spark, d), DRIFT_FEATURES), *FD_COLS, "pvalue")


def _mean_part(grouping: str, segment: str, limit: str, having: str = "") -> str:
    base, new = "avg(trip_count) FILTER (WHERE NOT is_new)", "avg(trip_count) FILTER (WHERE is_new)"
    pct = f"CASE WHEN {base} > 0 THEN ({new} - {base}) / {base} * 100 END"
    return f"""SELECT '{grouping}' AS grouping, {segment} AS segment, count(*) FILTER (WHERE NOT is_new) AS base_rows, count(*) FILTER (WHERE is_new) AS new_rows,
      round({base}, 6) + 0 AS base_mean, round({new}, 6) + 0 AS new_mean, round({new} - {base}, 6) + 0 AS delta, round({pct}, 4) + 0 AS pct_change,
      coalesce(abs({pct}) > {limit}, false) AS marked FROM scored GROUP BY 2 {having}"""


@query("mean_drift", with_(SCORED, " UNION ALL ".join([
    _mean_part("zone_id", "CAST(zone_id AS VARCHAR)", "NULL"), _mean_part("borough_id", "CAST(borough_id AS VARCHAR)", "NULL"),
    _mean_part("hour", "CAST(hour AS VARCHAR)", "20"), _mean_part("dayofweek", "CAST(dayofweek AS VARCHAR)", "15"),
    _mean_part("borough_id,is_weekend", "borough_id || '/' || is_weekend", "20",
               "HAVING count(*) FILTER (WHERE NOT is_new) >= 30 AND count(*) FILTER (WHERE is_new) >= 30")])))
def mean_drift(spark, d):
    out = drift.mean_drift(scored(spark, d))
    return rounded(rounded(out, "base_mean", "new_mean", "delta"), "pct_change", places=4)


@query("freshness", with_(SCORED, f"""SELECT max(time_bucket) AS latest, round(epoch(TIMESTAMP '{REFERENCE}' - max(time_bucket)) / 60.0, 6) AS age_minutes,
    round(epoch(TIMESTAMP '{REFERENCE}' - max(time_bucket)) / 3600.0, 6) AS age_hours, epoch(TIMESTAMP '{REFERENCE}' - max(time_bucket)) > 7200 AS stale FROM scored"""))  # fmt: skip
def freshness(spark, d):
    return rounded(monitor.freshness(dq.fact(spark, d), REFERENCE), "age_minutes", "age_hours")


@query("dup_rate", """WITH k AS (SELECT user_id % 25 AS zone_id, time_bucket(INTERVAL 15 MINUTE, ts) AS b, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT CAST(sum(n - 1) AS BIGINT) AS extra_rows, count(*) FILTER (WHERE n > 1) AS duplicate_key_count, CAST(sum(n) AS BIGINT) AS total_rows,
      round(sum(n - 1) / sum(n), 6) AS rate FROM k""")  # fmt: skip
def dup_rate(spark, d):
    """Raw events as if they were rows of the series: zone and bucket repeat."""
    rows = tables.trips(spark, d).withColumn("time_bucket", dq.tf.bucket_start("ts"))
    return rounded(monitor.duplicate_rate(rows), "rate")


MONITOR = f"""{ACCURACY},
long AS (SELECT is_new, g.grouping, g.segment, feature, value FROM (
    SELECT *, unnest(['trip_count', 'lag_1day', 'lag_1week', 'roll_mean_1day', 'yhat']) AS feature,
           unnest([CAST(trip_count AS DOUBLE), lag_1day, lag_1week, round(roll_mean_1day, 9), yhat]) AS value FROM scored) s,
  LATERAL (VALUES ('global', 'all'), ('hour', CAST(hour AS VARCHAR)), ('borough', CAST(borough_id AS VARCHAR))) g(grouping, segment)
  WHERE g.grouping = 'global' OR (g.grouping = 'hour' AND feature = 'trip_count') OR (g.grouping = 'borough' AND feature IN ('lag_1day', 'lag_1week', 'roll_mean_1day'))),
{sql_counts('long', 'grouping, segment, feature')}, {sql_psi('grouping, segment, feature')}, {sql_ks('grouping, segment, feature')},
one AS (SELECT avg(yhat) FILTER (WHERE is_new) AS mean, stddev_pop(yhat) FILTER (WHERE is_new) AS std, quantile_cont(yhat, 0.5) FILTER (WHERE is_new) AS p50,
          quantile_cont(yhat, 0.95) FILTER (WHERE is_new) AS p95, avg(yhat) FILTER (WHERE NOT is_new) AS baseline_mean,
          stddev_pop(yhat) FILTER (WHERE NOT is_new) AS baseline_std, max(time_bucket) AS latest, count(*) FILTER (WHERE is_new) AS total FROM scored),
metrics(metric, grouping, segment, field, value) AS (
  SELECT 'accuracy', grouping, segment, unnest(['n', 'poisson_deviance', 'rmse', 'mape', 'actual_mean', 'pred_mean', 'deviance_rel_delta', 'rmse_rel_delta', 'mape_abs_delta']),
         unnest([CAST(n AS DOUBLE), poisson_deviance, rmse, mape, actual_mean, pred_mean, deviance_rel_delta, rmse_rel_delta, mape_abs_delta]) FROM acc WHERE grouping <> 'hour'
  UNION ALL {" UNION ALL ".join(f"SELECT 'null_rate', 'column', '{c}', '{c}', avg(({c} IS NULL)::INT) FILTER (WHERE is_new) FROM scored" for c in monitor.CRITICAL_COLUMNS)}
  UNION ALL SELECT 'ks', grouping, segment, unnest(['statistic', 'pvalue']), unnest([ks, pvalue]) FROM kss WHERE feature = 'trip_count'
  UNION ALL SELECT 'psi', grouping, segment, feature, psi FROM psis WHERE feature <> 'yhat'
  UNION ALL SELECT 'prediction', 'global', 'all', unnest(['mean', 'std', 'p50', 'p95', 'baseline_mean', 'baseline_std', 'collapsed']),
         unnest([mean, std, p50, p95, baseline_mean, baseline_std, CASE WHEN std < 0.25 * baseline_std THEN 1.0 ELSE 0.0 END]) FROM one
  UNION ALL SELECT 'prediction', 'global', 'all', unnest(['ks_statistic', 'ks_pvalue']), unnest([ks, pvalue]) FROM kss WHERE feature = 'yhat' AND grouping = 'global'
  UNION ALL SELECT 'freshness', 'global', 'all', unnest(['age_minutes', 'age_hours', 'stale']),
         unnest([epoch(TIMESTAMP '{REFERENCE}' - latest) / 60.0, epoch(TIMESTAMP '{REFERENCE}' - latest) / 3600.0, CASE WHEN epoch(TIMESTAMP '{REFERENCE}' - latest) > 7200 THEN 1.0 ELSE 0.0 END]) FROM one
  UNION ALL SELECT 'duplicates', 'global', 'all', unnest(['rate', 'extra_rows', 'duplicate_key_count', 'total_rows']), unnest([0.0, 0.0, 0.0, CAST(total AS DOUBLE)]) FROM one),
limits(m, g, f, op, warn, crit) AS (VALUES {", ".join(str(t).replace("None", "NULL") for t in monitor.THRESHOLDS)}),
tested AS (
  SELECT metrics.*, CASE op WHEN '>=' THEN value >= crit WHEN '>' THEN value > crit ELSE value < crit END AS is_crit,
         CASE op WHEN '>=' THEN value >= warn WHEN '>' THEN value > warn ELSE value < warn END AS is_warn, warn, crit
  FROM metrics JOIN limits ON m = metric AND g = grouping AND (f = '*' OR f = field)),
alerts AS (SELECT CASE WHEN is_crit THEN 'critical' ELSE 'warning' END AS severity, metric, grouping, segment, field, value,
                  CASE WHEN is_crit THEN CAST(crit AS DOUBLE) ELSE CAST(warn AS DOUBLE) END AS threshold FROM tested WHERE is_crit OR is_warn)"""


def all_metrics(spark, d) -> DataFrame:
    frame = scored(spark, d).withColumn("roll_mean_1day", F.round("roll_mean_1day", 9))
    return monitor.monitor_metrics(frame, REFERENCE)


@query("monitor_metrics", with_(MONITOR, "SELECT metric, grouping, segment, field, round(value, 6) + 0 AS value FROM metrics"))
def monitor_metrics(spark, d):
    return rounded(all_metrics(spark, d), "value")


@query("alerts", with_(MONITOR, "SELECT severity, metric, grouping, segment, field, round(value, 6) + 0 AS value, threshold FROM alerts"))
def alerts(spark, d):
    return rounded(monitor.evaluate_alerts(all_metrics(spark, d)), "value")


@query("monitor_decision", with_(MONITOR, """SELECT count(*) FILTER (WHERE severity = 'critical') AS critical_count, count(*) FILTER (WHERE severity = 'warning') AS warning_count,
    CASE WHEN count(*) FILTER (WHERE severity = 'critical') > 0 THEN 'BLOCK_DEPLOY_AND_PAGE' WHEN count(*) > 0 THEN 'MONITOR' ELSE 'OK' END AS decision FROM alerts"""))  # fmt: skip
def monitor_decision(spark, d):
    return monitor.decision(monitor.evaluate_alerts(all_metrics(spark, d)))


@query("pred_collapse", with_(f"{SCORED}, {sql_counts('scored', '1 AS one', 'yhat')}, {sql_ks('one')}, "
    "s AS (SELECT stddev_pop(yhat) FILTER (WHERE is_new) AS std, stddev_pop(yhat) FILTER (WHERE NOT is_new) AS baseline_std FROM scored)",
    "SELECT round(std, 6) AS std, round(baseline_std, 6) AS baseline_std, std < 0.25 * baseline_std AS collapsed, round(ks, 9) AS ks, round(pvalue, 6) AS pvalue FROM s, kss"))
def pred_collapse(spark, d):
    frame = cut_lineage(scored(spark, d).select("yhat", "is_new"))
    counts = cut_lineage(drift.feature_counts(frame, ["yhat"]))
    stats = monitor.prediction_summary(frame).select("std", "baseline_std", "collapsed")
    test = drift.ks(counts, ["feature"]).agg(F.struct(F.max("ks").alias("ks"), F.max("pvalue").alias("pvalue"))).scalar()
    out = stats.select("*", test["ks"].alias("ks"), test["pvalue"].alias("pvalue"))
    return rounded(rounded(out, "std", "baseline_std", "pvalue"), "ks", places=9)


@query("drift_peak_shift", with_(f"{SCORED}, {sql_counts('scored', 'hour', 'trip_count')}, {sql_ks('hour')}, "
    "m AS (SELECT hour, avg(trip_count) FILTER (WHERE NOT is_new) AS base_mean, avg(trip_count) FILTER (WHERE is_new) AS new_mean FROM scored GROUP BY 1)",
    "SELECT hour, round(ks, 6) + 0 AS ks, round(pvalue, 6) + 0 AS pvalue, round(base_mean, 6) AS base_mean, round(new_mean, 6) AS new_mean FROM kss JOIN m USING (hour) ORDER BY kss.ks DESC, hour LIMIT 5"))
def drift_peak_shift(spark, d):
    return rounded(monitor.peak_shift(scored(spark, d)), "ks", "pvalue", "base_mean", "new_mean")


@query("drift_borough_psi", with_(f"{SCORED}, {sql_unpivot(monitor.LAG_FEATURES, 'borough_id')}, {sql_counts('long', 'borough_id, feature')}, {sql_psi('borough_id, feature')}",
    "SELECT borough_id, (SELECT any_value(borough) FROM zones z WHERE z.borough_id = psis.borough_id) AS borough, feature, round(psi, 6) + 0 AS psi, round(max(psi) OVER (PARTITION BY borough_id), 6) + 0 AS max_psi FROM psis"))
def drift_borough_psi(spark, d):
    return rounded(monitor.borough_feature_drift(drift_frame(spark, d), names=tables.zones(spark, d)), "psi", "max_psi")


ZD = ["actual_mean_baseline", "actual_mean_new", "actual_mean_drop", "poisson_dev_baseline", "poisson_dev_new", "dev_rel_delta"]


@query("drift_zone_divergence", with_(ACCURACY, f"""SELECT zone_id, n, {r(*ZD)}, suspect FROM (
    SELECT CAST(segment AS BIGINT) AS zone_id, n, base_actual_mean AS actual_mean_baseline, actual_mean AS actual_mean_new,
      (actual_mean - base_actual_mean) / greatest(base_actual_mean, 1e-9) AS actual_mean_drop, base_poisson_deviance AS poisson_dev_baseline,
      poisson_deviance AS poisson_dev_new, deviance_rel_delta AS dev_rel_delta,
      (actual_mean - base_actual_mean) / greatest(base_actual_mean, 1e-9) NOT BETWEEN -0.40 AND 1.5 AS suspect FROM acc WHERE grouping = 'zone')"""))  # fmt: skip
def drift_zone_divergence(spark, d):
    return rounded(monitor.zone_divergence(scored(spark, d)), *ZD)


@query("drift_worst_zones", with_(ACCURACY, """SELECT CAST(segment AS BIGINT) AS zone_id, round(deviance_rel_delta, 6) + 0 AS dev_rel_delta FROM acc
    WHERE grouping = 'zone' ORDER BY acc.deviance_rel_delta DESC NULLS LAST LIMIT 10"""))  # fmt: skip
def drift_worst_zones(spark, d):
    zones = monitor.zone_divergence(scored(spark, d)).select("zone_id", "dev_rel_delta")
    return rounded(drift.worst(zones, "dev_rel_delta", 10), "dev_rel_delta")


SC = ["actual_mean_baseline", "actual_mean_new", "deviance_baseline", "deviance_new", "deviance_rel_delta", "mape_baseline", "mape_new", "mape_abs_delta"]


@query("drift_segment_concept", with_(ACCURACY, f"""SELECT segment, n, {r(*SC)}, rn = 1 AS is_worst FROM (
    SELECT segment, n, base_actual_mean AS actual_mean_baseline, actual_mean AS actual_mean_new, base_poisson_deviance AS deviance_baseline,
      poisson_deviance AS deviance_new, (poisson_deviance - base_poisson_deviance) / greatest(base_poisson_deviance, 1e-9) AS deviance_rel_delta,
      base_mape AS mape_baseline, mape AS mape_new, mape_abs_delta,
      row_number() OVER (ORDER BY (poisson_deviance - base_poisson_deviance) / greatest(base_poisson_deviance, 1e-9) DESC, segment) AS rn
    FROM acc WHERE grouping = 'borough_weekend')"""))  # fmt: skip
def drift_segment_concept(spark, d):
    return rounded(monitor.segment_concept_drift(scored(spark, d)), *SC)
