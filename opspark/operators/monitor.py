"""Model monitoring: accuracy by segment, the eight metrics, alerts, the deploy decision, drift patterns.

Input is a *scored* frame: zone_id, borough_id, hour, is_weekend, time_bucket, trip_count, lag features,
``yhat`` and the boolean ``is_new``. Metrics leave as one long table
(metric, grouping, segment, field, value); nesting is left to the JSON sink.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefeat import SLOT_MINUTES
from ..functions.scores import error_sums, measures, relative_delta
from ..plans.ranks import exact_quantiles, value_counts
from ..session import cut_lineage
from ..sources.literals import literal_table
from . import drift
from .features import HALO_SLOTS
from .quality import null_rates

# Monitored columns.
LAG_FEATURES = ["lag_1day", "lag_1week", "roll_mean_1day"]
CRITICAL_COLUMNS = [
    "trip_count", "zone_id", "time_bucket", "lag_15min", "lag_1h", "lag_1day", "lag_1week",
    "roll_mean_1h", "roll_mean_1day", "is_holiday",
]

# Alert thresholds (metric, grouping, field, operator, warn, critical). '*' is any field.
THRESHOLDS = [
    ("accuracy", "global", "deviance_rel_delta", ">=", 0.10, 0.20),
    ("accuracy", "zone", "deviance_rel_delta", ">=", None, 0.20),
    ("accuracy", "zone", "mape_abs_delta", ">", None, 0.10),
    ("accuracy", "borough", "deviance_rel_delta", ">=", None, 0.20),
    ("accuracy", "borough", "mape_abs_delta", ">", None, 0.10),
    ("accuracy", "borough_weekend", "deviance_rel_delta", ">=", None, 0.20),
    ("accuracy", "borough_weekend", "mape_abs_delta", ">", None, 0.10),
    ("null_rate", "column", "*", ">=", 0.005, 0.01),
    ("ks", "global", "pvalue", "<", 0.05, 0.01),
    ("ks", "hour", "pvalue", "<", None, 0.01),
    ("psi", "global", "*", ">=", 0.10, 0.25),
    ("psi", "borough", "*", ">=", None, 0.25),
    ("prediction", "global", "collapsed", ">=", None, 1.0),
    ("prediction", "global", "ks_pvalue", "<", None, 0.01),
    ("freshness", "global", "age_hours", ">", 1.0, 2.0),
    ("duplicates", "global", "rate", ">=", 0.001, 0.005),
]
THRESHOLD_SCHEMA = "metric string, grouping string, field string, op string, warn double, critical double"

COLLAPSE_SHARE = 0.25
STALE_MINUTES = 120
CELLS = ["zone_id", "borough_id", "is_weekend", "hour"]
SEGMENTS = {
    "zone": ["zone_id"],
    "borough": ["borough_id"],
    "borough_weekend": ["borough_id", "is_weekend"],
    "hour": ["hour"],
    "global": [],
}


def thresholds(spark: SparkSession) -> DataFrame:
    return literal_table(spark, THRESHOLDS, THRESHOLD_SCHEMA)


def _segment_name(grouping: str, columns: list[str]) -> Column:
    if grouping == "global":
        return F.lit("all")
    if grouping == "borough_weekend":
        return F.concat(F.lit("b"), F.col(columns[0]).cast("string"), F.lit("_w"), F.col(columns[1]).cast("string"))
    return F.col(columns[0]).cast("string")


def in_segments(cells: DataFrame, groupings: list[str] | None = None) -> DataFrame:
    """Repeats each cell row once per segment it belongs to, with ``grouping`` and ``segment``.

    Used on cells, never on raw rows. A NULL key belongs to no segment of that grouping.
    """
    wanted = {g: c for g, c in SEGMENTS.items() if groupings is None or g in groupings}
    tags = [F.struct(F.lit(g).alias("grouping"), _segment_name(g, c).alias("segment")) for g, c in wanted.items()]
    return (
        cells.withColumn("_s", F.explode(F.array(*tags)))
        .withColumns({"grouping": F.col("_s.grouping"), "segment": F.col("_s.segment")})
        .where(F.col("segment").isNotNull())
        .drop("_s")
    )


def accuracy(scored: DataFrame, y: str = "trip_count", p: str = "yhat") -> DataFrame:
    """Accuracy of both windows by zone, borough, borough x weekend, hour and overall, with deltas.

    One pass sums error terms to (zone, borough, weekend, hour) cells with map-side combine; the segments
    are sums of those few thousand cells.
    """
    return accuracy_of_cells(accuracy_cells(scored, y, p))


def accuracy_cells(scored: DataFrame, y: str = "trip_count", p: str = "yhat") -> DataFrame:
    """Error terms of both windows, summed by the smallest cells; cells of several frames add up."""
    sums = {}
    for side, flag in (("b_", ~F.col("is_new")), ("n_", F.col("is_new"))):
        sums.update({side + k: v for k, v in error_sums(F.col(y), F.col(p), flag).items()})
    return scored.groupBy(*CELLS).agg(*[F.sum(v).alias(k) for k, v in sums.items()])


def accuracy_of_cells(cells: DataFrame) -> DataFrame:
    sums = [c for c in cells.columns if c not in CELLS]
    rolled = in_segments(cells).groupBy("grouping", "segment").agg(*[F.sum(k).alias(k) for k in sums])
    new, base = measures("n_"), measures("b_")
    out = rolled.select(
        "grouping", "segment", *[c.alias(k) for k, c in new.items()], *[c.alias(f"base_{k}") for k, c in base.items()]
    )
    dev, base_dev = F.col("poisson_deviance"), F.col("base_poisson_deviance")
    # Segments need a baseline deviance above 1e-9; the overall delta only needs one that is not 0.
    guarded = F.when((F.col("grouping") == "global") | (base_dev > 1e-9), relative_delta(dev, base_dev))
    return out.withColumns(
        {
            "deviance_rel_delta": guarded,
            "rmse_rel_delta": relative_delta(F.col("rmse"), F.col("base_rmse")),
            "mape_abs_delta": F.col("mape") - F.col("base_mape"),
        }
    )


def accuracy_windows(scored: DataFrame, windows: list[tuple[str, str, str | None]]) -> DataFrame:
    """Accuracy and prediction quantiles per named half-open window and segment, from one scan; without an end it is open."""
    t = F.col("time_bucket")
    def within(start: str, end: str | None) -> Column:
        after = t >= F.lit(start).cast("timestamp_ntz")
        return after if end is None else after & (t < F.lit(end).cast("timestamp_ntz"))

    label = F.coalesce(*[F.when(within(a, b), F.lit(n)) for n, a, b in windows])
    last = None if any(w[2] is None for w in windows) else max(w[2] for w in windows)
    rows = (
        scored.where(within(min(w[1] for w in windows), last))
        .withColumn("win", label)
        .where(F.col("win").isNotNull() & F.col("yhat").isNotNull() & F.col("trip_count").isNotNull())
    )
    terms = error_sums(F.col("trip_count"), F.col("yhat"))
    # Cells by prediction value: they give the sums and the exact quantiles from the same shuffle.
    cells = cut_lineage(
        rows.groupBy("win", *CELLS, "yhat").agg(*[F.sum(v).alias(k) for k, v in terms.items()])
    )
    tagged = in_segments(cells)
    by = ["win", "grouping", "segment"]
    sums = tagged.groupBy(*by).agg(*[F.sum(k).alias(k) for k in terms])
    spread = exact_quantiles(tagged, by, "yhat", {"pred_p50": 0.5, "pred_p95": 0.95}, weight=F.col("n"))
    # The deviation around the segment's own mean: a difference of squares would cancel for large means of little spread.
    means = cut_lineage(sums.select(*by, *[c.alias(k) for k, c in measures().items()]))
    off = F.col("yhat") - F.col("pred_mean")
    around = tagged.select(*by, "yhat", F.col("n").alias("_n")).join(means.select(*by, "pred_mean"), by).groupBy(*by).agg(F.sqrt(F.sum(F.col("_n") * off * off) / F.sum("_n")).alias("pred_std"))
    return means.join(around, by).join(spread.drop("n"), by)


def headline_deltas(report: DataFrame, base: str, new: str) -> DataFrame:
    """Percent change of each accuracy measure from one window to another, per segment."""
    names = ["rmse", "mae", "mape", "poisson_deviance"]
    sides = {s: [F.max(F.when(F.col("win") == w, F.col(n))).alias(f"_{s}_{n}") for n in names] for s, w in (("b", base), ("n", new))}
    wide = report.groupBy("grouping", "segment").agg(*sides["b"], *sides["n"])
    return wide.select(
        "grouping",
        "segment",
        *[(relative_delta(F.col(f"_n_{n}"), F.col(f"_b_{n}")) * 100).alias(f"{n}_pct") for n in names],
    )


def freshness(df: DataFrame, reference: str | Column, ts: str = "time_bucket") -> DataFrame:
    """Age of the newest row against a reference time; stale over 120 minutes and when there is no row."""
    ref = F.lit(reference).cast("timestamp_ntz") if isinstance(reference, str) else reference
    age = F.extract(F.lit("DAY"), ref - F.col("latest")) * 86400.0 + F.extract(F.lit("HOUR"), ref - F.col("latest")) * 3600.0
    age = age + F.extract(F.lit("MINUTE"), ref - F.col("latest")) * 60.0
    age = age + F.extract(F.lit("SECOND"), ref - F.col("latest")).cast("double")
    return (
        df.agg(F.max(ts).alias("latest"))
        .withColumn("age_minutes", age / 60.0)
        .withColumn("age_hours", F.col("age_minutes") / 60.0)
        .withColumn("stale", F.coalesce(F.col("age_minutes") > STALE_MINUTES, F.lit(True)))
    )


def duplicate_rate(df: DataFrame, keys: tuple[str, ...] = ("zone_id", "time_bucket")) -> DataFrame:
    n = F.col("n")
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum(n - 1), F.lit(0)).alias("extra_rows"),
            F.count_if(n > 1).alias("duplicate_key_count"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        )
        .withColumn("rate", F.col("extra_rows") / F.greatest(F.col("total_rows"), F.lit(1)))
    )


def segment_counts(scored: DataFrame) -> DataFrame:
    """Value counts of series, lags and predictions for all distribution tests: overall, by hour, by borough."""
    columns = ["trip_count", *LAG_FEATURES, "yhat"]
    long = drift.unpivot(scored, columns, ["hour", "borough_id", "is_new"])
    fine = value_counts(long, ["feature", "hour", "borough_id"], "value", drift.side_weights())
    is_lag = F.col("feature").isin(LAG_FEATURES)
    wanted = (
        (F.col("grouping") == "global")
        | ((F.col("grouping") == "hour") & (F.col("feature") == "trip_count"))
        | ((F.col("grouping") == "borough") & is_lag)
    )
    tagged = in_segments(fine, ["global", "hour", "borough"]).where(wanted)
    return tagged.groupBy("grouping", "segment", "feature", "value").agg(
        F.sum("n_base").alias("n_base"), F.sum("n_new").alias("n_new")
    )


BY = ["grouping", "segment", "feature"]


def prediction_summary(scored: DataFrame) -> DataFrame:
    """Mean, deviation, median and p95 of the predictions of both windows, and whether they collapsed."""
    rows = scored.where(F.col("yhat").isNotNull())
    spread = exact_quantiles(rows, ["is_new"], "yhat", {"p50": 0.5, "p95": 0.95})
    stats = rows.groupBy("is_new").agg(F.avg("yhat").alias("mean"), F.stddev_pop("yhat").alias("std"))
    per_side = stats.join(spread, "is_new")

    def side(new: bool, c: str) -> Column:
        return F.max(F.when(F.col("is_new") == new, F.col(c)))

    return per_side.agg(
        *[side(True, c).alias(c) for c in ("mean", "std", "p50", "p95")],
        *[side(False, c).alias(f"baseline_{c}") for c in ("mean", "std")],
    ).withColumn("collapsed", F.coalesce(F.col("std") < COLLAPSE_SHARE * F.col("baseline_std"), F.lit(False)))


def _long(df: DataFrame, metric: str, fields: list[str], grouping="global", segment="all") -> DataFrame:
    g = F.col("grouping") if "grouping" in df.columns else F.lit(grouping)
    s = F.col("segment") if "segment" in df.columns else F.lit(segment)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields])
    return df.select(F.lit(metric).alias("metric"), g.alias("grouping"), s.alias("segment"), F.inline(pairs))


ACCURACY_FIELDS = [
    "n", "poisson_deviance", "rmse", "mape", "actual_mean", "pred_mean", "deviance_rel_delta", "rmse_rel_delta", "mape_abs_delta",
]


def monitor_metrics(scored: DataFrame, reference: str, critical: list[str] | None = None) -> DataFrame:
    """The eight metrics as one long table.

    The scored frame and its value counts are each written once and read by the metrics that need them,
    so scoring and the feature windows run a single time.
    """
    scored = cut_lineage(scored)
    counts = cut_lineage(segment_counts(scored))
    nulls = null_rates(scored, critical or CRITICAL_COLUMNS)
    return _all_metrics(accuracy(scored), counts, prediction_summary(scored), nulls, scored.where("is_new"), reference)


def _all_metrics(found: DataFrame, counts: DataFrame, predictions: DataFrame, nulls: DataFrame, new: DataFrame, reference: str) -> DataFrame:
    tested = (F.col("feature") == "trip_count") | (F.col("feature") == "yhat")
    ks_all = drift.ks(counts.where(tested), BY)
    psi_all = drift.psi(counts.where(F.col("feature") != "yhat"), BY)
    series = F.col("feature") == "trip_count"
    ks_pred = ks_all.where((F.col("feature") == "yhat") & (F.col("grouping") == "global"))
    parts = [
        _long(found.where(F.col("grouping") != "hour"), "accuracy", ACCURACY_FIELDS),
        nulls.select(
            F.lit("null_rate").alias("metric"),
            F.lit("column").alias("grouping"),
            F.col("column").alias("segment"),
            F.col("column").alias("field"),
            F.col("new_rate").alias("value"),
        ),
        _long(ks_all.where(series).withColumnRenamed("ks", "statistic"), "ks", ["statistic", "pvalue"]),
        psi_all.select(
            F.lit("psi").alias("metric"), "grouping", "segment", F.col("feature").alias("field"), F.col("psi").alias("value")
        ),
        _long(predictions, "prediction", ["mean", "std", "p50", "p95", "baseline_mean", "baseline_std", "collapsed"]),
        _long(
            ks_pred.select(F.col("ks").alias("ks_statistic"), F.col("pvalue").alias("ks_pvalue")),
            "prediction",
            ["ks_statistic", "ks_pvalue"],
        ),
        _long(freshness(new, reference), "freshness", ["age_minutes", "age_hours", "stale"]),
        _long(duplicate_rate(new), "duplicates", ["rate", "extra_rows", "duplicate_key_count", "total_rows"]),
    ]
    return reduce(DataFrame.unionByName, parts)


class Profile(NamedTuple):
    """What is kept of a scored baseline: error terms by cell, counts by value, mean and deviation of the predictions, and the columns."""

    cells: DataFrame
    counts: DataFrame
    predictions: DataFrame
    columns: dict[str, str]


def profile(scored: DataFrame) -> Profile:
    """The stored profile of a baseline. Its size follows the cells and distinct values, not the rows."""
    base = scored.withColumn("is_new", F.lit(False))
    spread = base.where(F.col("yhat").isNotNull()).agg(F.avg("yhat").alias("baseline_mean"), F.stddev_pop("yhat").alias("baseline_std"))
    columns = {n: t for n, t in scored.dtypes if n != "is_new"}
    return Profile(cut_lineage(accuracy_cells(base)), cut_lineage(segment_counts(base)), cut_lineage(spread), columns)


def metrics_against(stored: Profile, new: DataFrame, reference: str, critical: list[str] | None = None) -> DataFrame:
    """The eight metrics of new scored rows against a stored profile, as ``monitor_metrics`` has them for both windows together.

    A column that the rows lack counts as null throughout.
    """
    own = [(F.col(c) if c in new.columns else F.lit(None)).cast(t).alias(c) for c, t in stored.columns.items()]
    new = cut_lineage(new.select(*own).withColumn("is_new", F.lit(True)))
    cells = stored.cells.unionByName(accuracy_cells(new))
    counts = stored.counts.unionByName(segment_counts(new)).groupBy(*BY, "value").agg(F.sum("n_base").alias("n_base"), F.sum("n_new").alias("n_new"))
    base = stored.predictions.agg(F.struct(F.max("baseline_mean").alias("mean"), F.max("baseline_std").alias("std"))).scalar()
    summary = prediction_summary(new).withColumns({"baseline_mean": base["mean"], "baseline_std": base["std"]})
    summary = summary.withColumn("collapsed", F.coalesce(F.col("std") < COLLAPSE_SHARE * F.col("baseline_std"), F.lit(False)))
    return _all_metrics(accuracy_of_cells(cells), cut_lineage(counts), summary, null_rates(new, critical or CRITICAL_COLUMNS), new, reference)


#: Slots that a row may be late and still find its whole week of history.
LATE_SLOTS = 96


def last_week(series: DataFrame, late_slots: int = LATE_SLOTS) -> DataFrame:
    """The rows of each zone in the week up to its newest, and as much more as rows may be late: what the features of later rows look at."""
    newest = series.groupBy("zone_id").agg(F.max("time_bucket").alias("_newest"))
    week = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(SLOT_MINUTES * (HALO_SLOTS + late_slots)))
    return series.join(newest, "zone_id").where(F.col("time_bucket") > F.col("_newest") - week).select("zone_id", "time_bucket", "trip_count", "is_holiday")


def evaluate_alerts(metrics: DataFrame, limits: DataFrame | None = None) -> DataFrame:
    """Metrics that cross a threshold, with severity; the critical tier is tested first.

    The threshold table is a literal (or a caller's small table) and carries the comparison operator.
    """
    limits = thresholds(metrics.sparkSession) if limits is None else limits
    t = limits.select(
        F.col("metric").alias("_m"), F.col("grouping").alias("_g"), F.col("field").alias("_f"), "op", "warn", "critical"
    )
    same = (
        (F.col("metric") == F.col("_m"))
        & (F.col("grouping") == F.col("_g"))
        & ((F.col("_f") == "*") | (F.col("field") == F.col("_f")))
    )

    def crosses(bound: str) -> Column:
        v, b = F.col("value"), F.col(bound)
        return (
            F.when(F.col("op") == ">=", v >= b).when(F.col("op") == ">", v > b).when(F.col("op") == "<", v < b)
        )

    severity = F.when(crosses("critical"), "critical").when(crosses("warn"), "warning")
    return (
        metrics.join(t, same)
        .withColumn("severity", severity)
        .where(F.col("severity").isNotNull())
        .select(
            "severity", "metric", "grouping", "segment", "field", "value",
            F.when(F.col("severity") == "critical", F.col("critical")).otherwise(F.col("warn")).alias("threshold"),
        )
    )


def decision(alerts: DataFrame) -> DataFrame:
    """BLOCK_DEPLOY_AND_PAGE on any critical alert, MONITOR on warnings, else OK."""
    c = F.count_if(F.col("severity") == "critical")
    w = F.count_if(F.col("severity") == "warning")
    return alerts.agg(c.alias("critical_count"), w.alias("warning_count")).withColumn(
        "decision",
        F.when(F.col("critical_count") > 0, "BLOCK_DEPLOY_AND_PAGE").when(F.col("warning_count") > 0, "MONITOR").otherwise("OK"),
    )


# Drift patterns


def peak_shift(df: DataFrame, k: int | None = 5) -> DataFrame:
    """KS test of the series by hour of day with the two means; the ``k`` worst hours, or all."""
    counts = cut_lineage(value_counts(df, ["hour"], "trip_count", drift.side_weights()).withColumnRenamed("trip_count", "value"))
    means = drift.moments(counts, ["hour"]).select("hour", "base_mean", "new_mean")
    tested = drift.ks(counts, ["hour"]).select("hour", "ks", "pvalue").join(means, "hour")
    return tested if k is None else tested.orderBy(F.col("ks").desc(), "hour").limit(k)


def borough_feature_drift(df: DataFrame, columns: list[str] | None = None, names: DataFrame | None = None) -> DataFrame:
    """PSI of the lag features per borough, with the borough's maximum and, from the zone table ``names``, its name."""
    counts = cut_lineage(drift.feature_counts(df, columns or LAG_FEATURES, ["borough_id"]))
    by_borough = Window.partitionBy("borough_id")
    found = drift.psi(counts.where(F.col("borough_id").isNotNull()), ["borough_id", "feature"]).withColumn(
        "max_psi", F.max("psi").over(by_borough)
    )
    if names is None:
        return found
    named = names.groupBy(F.col("borough_id").alias("_b")).agg(F.max("borough").alias("borough"))
    return found.join(named, F.col("borough_id") == F.col("_b"), "left").drop("_b")


def zone_divergence(scored: DataFrame) -> DataFrame:
    """Per-zone deviance change and shift of the mean; suspects moved below -40 % or above +150 %."""
    acc = accuracy(scored).where((F.col("grouping") == "zone") & (F.col("n") > 0) & (F.col("base_n") > 0))
    drop = (F.col("actual_mean") - F.col("base_actual_mean")) / F.greatest(F.col("base_actual_mean"), F.lit(1e-9))
    return acc.select(
        F.col("segment").cast("bigint").alias("zone_id"),
        "n",
        F.col("base_actual_mean").alias("actual_mean_baseline"),
        F.col("actual_mean").alias("actual_mean_new"),
        drop.alias("actual_mean_drop"),
        F.col("base_poisson_deviance").alias("poisson_dev_baseline"),
        F.col("poisson_deviance").alias("poisson_dev_new"),
        F.col("deviance_rel_delta").alias("dev_rel_delta"),
        ((drop < -0.40) | (drop > 1.5)).alias("suspect"),
    )


def segment_concept_drift(scored: DataFrame) -> DataFrame:
    """Deviance and MAPE change per borough x weekend; the worst segment is marked."""
    acc = accuracy(scored).where((F.col("grouping") == "borough_weekend") & (F.col("n") > 0) & (F.col("base_n") > 0))
    base = F.col("base_poisson_deviance")
    rows = acc.select(
        "segment",
        "n",
        F.col("base_actual_mean").alias("actual_mean_baseline"),
        F.col("actual_mean").alias("actual_mean_new"),
        base.alias("deviance_baseline"),
        F.col("poisson_deviance").alias("deviance_new"),
        ((F.col("poisson_deviance") - base) / F.greatest(base, F.lit(1e-9))).alias("deviance_rel_delta"),
        F.col("base_mape").alias("mape_baseline"),
        F.col("mape").alias("mape_new"),
        "mape_abs_delta",
    )
    # Ten rows in practice: two per borough.
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("deviance_rel_delta").desc_nulls_last(), "segment")
    return rows.withColumn("is_worst", F.row_number().over(order) == 1)
