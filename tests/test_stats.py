import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from opspark import cut_lineage
from opspark.functions.scores import ks_pvalue
from opspark.operators import drift, monitor
from opspark.plans import ranks
from opspark.sources.literals import literal_table


def frame(spark, base, new):
    rows = [("g", False, float(x)) for x in base] + [("g", True, float(x)) for x in new]
    return literal_table(spark, rows, "grp string, is_new boolean, value double")


def counts(spark, base, new):
    return cut_lineage(ranks.value_counts(frame(spark, base, new), ["grp"], "value", drift.side_weights()))


def brute_ks(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


def brute_bins(a, b, bins):
    lo, top = min(a + b), max(a + b) + 1e-9
    edges = [lo + i * ((top - lo) / bins) for i in range(bins)]

    def share(xs):
        out = [0] * bins
        for x in xs:
            out[sum(x >= e for e in edges[1:])] += 1
        return [n / len(xs) for n in out]

    return share(a), share(b)


def test_psi_ks_js_against_brute_force(spark):
    rng = random.Random(3)
    a = [round(rng.gauss(0, 1), 3) for _ in range(700)]
    b = [round(rng.gauss(0.4, 1.3), 3) for _ in range(500)]
    c = counts(spark, a, b)
    e, n = brute_bins(a, b, 10)
    want = sum((max(y, 1e-6) - max(x, 1e-6)) * math.log(max(y, 1e-6) / max(x, 1e-6)) for x, y in zip(e, n))
    assert drift.psi(c, ["grp"]).first().psi == pytest.approx(want, abs=1e-9)
    assert drift.ks(c, ["grp"]).first().ks == pytest.approx(brute_ks(a, b), abs=1e-12)
    e, n = brute_bins(a, b, 20)
    mid = [(x + y) / 2 for x, y in zip(e, n)]
    js = math.sqrt(sum(x * math.log2(x / m) for x, m in zip(e, mid) if x) / 2 + sum(y * math.log2(y / m) for y, m in zip(n, mid) if y) / 2)
    assert drift.js_distance(c, ["grp"]).first().js == pytest.approx(js, abs=1e-9)


def test_identical_samples_have_no_drift(spark):
    c = counts(spark, range(100), range(100))
    assert drift.psi(c, ["grp"]).first().psi == 0
    row = drift.ks(c, ["grp"]).first()
    assert row.ks == 0 and row.pvalue == 1
    assert drift.js_distance(c, ["grp"]).first().js == 0


def test_constant_and_one_sided_columns(spark):
    assert drift.psi(counts(spark, [5] * 10, [5] * 20), ["grp"]).first().psi == 0
    assert drift.psi(counts(spark, [1e12] * 10, [1e12] * 20), ["grp"]).first().psi == 0
    empty = counts(spark, [1, 2, 3], [])
    assert drift.psi(empty, ["grp"]).first().psi is None
    assert drift.ks(empty, ["grp"]).count() == 0


def test_disjoint_samples_reach_the_limits(spark):
    c = counts(spark, [0.0] * 50, [10.0] * 50)
    assert drift.ks(c, ["grp"]).first().ks == 1
    assert drift.js_distance(c, ["grp"]).first().js == pytest.approx(1)
    assert drift.psi(c, ["grp"]).first().psi > 0.25


def test_pvalue_of_the_kolmogorov_series(spark):
    got = spark.range(1).select(ks_pvalue(F.lit(0.0607), F.lit(1000), F.lit(1000)).alias("p")).first().p
    t = 0.0607 * math.sqrt(500)
    assert got == pytest.approx(2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * t * t) for k in range(1, 100)))


@pytest.mark.parametrize("skewed", [False, True])
def test_exact_quantiles(spark, skewed):
    rng = random.Random(5)
    xs = [rng.lognormvariate(0, 3) for _ in range(3000)]
    if skewed:
        xs += [xs[0]] * 2000 + [1e15]
    rows = literal_table(spark, [("a", x) for x in xs] + [("b", 7.0)], "g string, x double")
    out = {r.g: r for r in ranks.exact_quantiles(rows, ["g"], "x", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}).collect()}
    s = sorted(xs)

    def q(p):
        at = p * (len(s) - 1)
        lo = math.floor(at)
        return s[lo] + (s[min(lo + 1, len(s) - 1)] - s[lo]) * (at - lo)

    for name, p in (("p50", 0.5), ("p95", 0.95), ("p0", 0.0), ("p100", 1.0)):
        assert out["a"][name] == pytest.approx(q(p), rel=1e-12)
    assert out["a"]["n"] == len(xs) and out["b"]["p50"] == 7.0


def scored(spark, rows):
    schema = "zone_id bigint, borough_id int, is_weekend int, hour int, trip_count bigint, yhat double, is_new boolean"
    return literal_table(spark, rows, schema)


def test_accuracy_measures(spark):
    rows = [(1, 0, 0, 5, y, p, True) for y, p in ((0, 5.0), (0, 5.0), (10, 12.0))] + [(1, 0, 0, 5, 4, 4.0, False)]
    out = {r.grouping: r for r in monitor.accuracy(scored(spark, rows)).collect()}
    assert out["global"].mape == pytest.approx(0.2)
    assert out["global"].base_poisson_deviance == pytest.approx(0)
    assert out["global"].deviance_rel_delta is None
    assert out["borough_weekend"].segment == "b0_w0"
    assert set(out) == {"global", "zone", "borough", "borough_weekend", "hour"}


def test_null_keys_form_no_segment(spark):
    rows = [(1, None, 0, 5, 3, 4.0, True), (1, None, 0, 5, 4, 4.0, False)]
    groups = {r.grouping for r in monitor.accuracy(scored(spark, rows)).collect()}
    assert groups == {"global", "zone", "hour"}


def test_alert_tiers_and_operators(spark):
    rows = [
        ("accuracy", "global", "all", "deviance_rel_delta", 0.20),
        ("accuracy", "borough", "1", "mape_abs_delta", 0.10),
        ("null_rate", "column", "c", "c", 0.005),
        ("ks", "hour", "7", "pvalue", 0.02),
        ("ks", "global", "all", "pvalue", 0.049),
        ("freshness", "global", "all", "age_hours", 2.0),
        ("prediction", "global", "all", "collapsed", 1.0),
        ("psi", "borough", "0", "lag_1day", 0.2),
    ]
    metrics = literal_table(spark, rows, "metric string, grouping string, segment string, field string, value double")
    alerts = monitor.evaluate_alerts(metrics)
    got = {(r.metric, r.grouping, r.severity) for r in alerts.collect()}
    assert got == {
        ("accuracy", "global", "critical"), ("null_rate", "column", "warning"), ("ks", "global", "warning"),
        ("freshness", "global", "warning"), ("prediction", "global", "critical")}
    assert monitor.decision(alerts).first().decision == "BLOCK_DEPLOY_AND_PAGE"
    assert monitor.decision(alerts.where("severity = 'warning'")).first().decision == "MONITOR"
    assert monitor.decision(alerts.limit(0)).first().decision == "OK"


def test_freshness_of_empty_is_stale(spark):
    empty = literal_table(spark, [], "time_bucket timestamp_ntz")
    row = monitor.freshness(empty, "2024-01-01").first()
    assert row.stale and row.age_hours is None


def test_deviation_of_predictions_does_not_cancel(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(z, 0, 0, 5, start + dt.timedelta(minutes=15 * i), 1e9, 1e9 + (i + z) % 2 * 0.25) for z in (1, 2) for i in range(40)]
    frame = literal_table(spark, rows, "zone_id bigint, borough_id int, is_weekend int, hour int, time_bucket timestamp_ntz, trip_count double, yhat double")
    got = monitor.accuracy_windows(frame, [("all", "2024-01-01", None)])
    assert {r.pred_std for r in got.collect()} == {0.125}
