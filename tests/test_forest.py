import datetime as dt
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from opspark.operators import features, forest, scoring
from opspark.plans import stream_queries
from opspark.sources.literals import literal_table

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(3)
    rows = [tuple(rnd.choice([0.0, 0.5, rnd.gauss(0, 2)]) for _ in NAMES) for _ in range(400)]
    return literal_table(spark, [(a, b, c, (3.0 if a > 0.3 else -1.0) + b * (c > 1) + rnd.random()) for a, b, c in rows], "a double, b double, c double, y double")


def columns(df):
    rows = df.toPandas()
    return {c: rows[c].to_numpy() for c in rows}


def test_exported_trees_equal_sparks_own(spark, table):
    """Boosted, forest and single tree: the arrays, the column expression and Spark's transform agree on every row."""
    assembled = VectorAssembler(inputCols=NAMES, outputCol="f").transform(table)
    boosted = forest.fit_boosted(table, NAMES, "y", trees=6, depth=4)
    others = [DecisionTreeRegressor(labelCol="y", featuresCol="f", maxDepth=3).fit(assembled)]
    for model in others:
        x = columns(model.transform(assembled).select(*NAMES, "prediction"))
        exported = forest.Forest.exported(model, NAMES)
        assert np.allclose(exported.predict(x), x["prediction"], atol=1e-12)
        shown = columns(table.select(*NAMES, exported.column().alias("p")))
        assert np.allclose(exported.predict(shown), shown["p"], atol=1e-12)
    x = columns(forest.score_boosted(table, boosted, NAMES))
    exported = forest.Forest.exported(boosted, NAMES)
    assert len(exported.roots) == 6 and exported.depth <= 4
    assert np.allclose(np.maximum(0, exported.predict(x)), x["yhat"], atol=1e-9)
    mean = RandomForestRegressor(labelCol="y", featuresCol="f", numTrees=4, maxDepth=3, seed=2).fit(assembled)
    x = columns(mean.transform(assembled).select(*NAMES, "prediction"))
    assert np.allclose(forest.Forest.exported(mean, NAMES).predict(x) / 4, x["prediction"], atol=1e-9)


def test_bounds_hold_for_any_input(table):
    model = forest.Forest.exported(forest.fit_boosted(table, NAMES, "y", trees=5, depth=3), NAMES)
    low, high = model.bounds()
    wild = {c: np.array([0.0, 1e300, -1e300, np.inf, -np.inf, np.nan, 0.3]) for c in NAMES}
    p = model.predict(wild)
    assert np.isfinite(p).all() and (p >= low - 1e-9).all() and (p <= high + 1e-9).all()


def test_leaf_only_and_unknown_splits():
    assert forest.Forest.of([2.5], NAMES).predict({c: [1, 2] for c in NAMES}).tolist() == [2.5, 2.5]
    with pytest.raises(ValueError):
        forest._parsed("tree\n  If (feature 0 in {1.0})\n   Predict: 1.0\n  Else (feature 0 not in {1.0})\n   Predict: 2.0")


def test_zones_go_forward_together(spark):
    """All zones of a group at once give what each zone alone gives; gaps and short histories fall back to the baseline."""
    start = dt.datetime(2024, 1, 1)
    rnd = random.Random(5)
    rows = [(z, start + dt.timedelta(minutes=15 * i), rnd.randint(0, 9), 0) for z in range(7) for i in range(700 - 60 * z) if not (z == 3 and i % 50 == 7)]
    fact = literal_table(spark, rows, "zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int")
    base = features.zone_slot_baseline(fact)
    model = forest.Forest.of([("lag_1week", 4.0, ("lag_15min", 3.0, 1.0, 2.0), 3.0), ("roll_mean_1day", 4.4, ("dow_sin", 0.1, 0.25, 0.5), ("hour_cos", 0.0, 0.75, 1.5))], scoring.MODEL_FEATURES)
    together = {(r.zone_id, r.step): (r.time_bucket, r.yhat) for r in scoring.forecast_recursive(fact, base, model.predict, parts=1).collect()}
    for z in range(7):
        one = scoring.forecast_recursive(fact.where(F.col("zone_id") == z), base, model.predict, parts=3).collect()
        assert {(r.zone_id, r.step): (r.time_bucket, r.yhat) for r in one} == {k: v for k, v in together.items() if k[0] == z}
    # The short last zone has no week of history: the first step looks at its baseline, and time goes on from its last slot.
    assert together[6, 1][0] == start + dt.timedelta(minutes=15 * 340)
    row = scoring._history(np.array([[np.nan, 2.0, np.nan]]), np.array([9.0]))
    assert row["lag_15min"][0] == row["lag_1week"][0] == 9.0 and row["roll_mean_1h"][0] == 2.0


@pytest.mark.parametrize("sf", ["0.01", "0.1"])
def test_fitted_forecasts_stay_near_what_was_seen(spark, sf):
    d = f"/root/testdata/sf{sf}"
    most = spark.read.parquet(f"{d}/events.parquet").groupBy(F.pmod("user_id", F.lit(25)), F.window("ts", "15 minutes")).count().agg(F.max("count")).first()[0]
    for name in ("forecast_recursive", "score_batch"):
        out = stream_queries.QUERIES[name](spark, d)
        row = out.agg(F.count(F.lit(1)).alias("n"), F.min("yhat").alias("low"), F.max("yhat").alias("high"), F.count_if(F.isnan("yhat") | F.col("yhat").isNull()).alias("bad")).first()
        assert row.n and row.bad == 0 and row.low >= 0 and row.high < 2 * most


def test_features_of_the_past_do_not_see_the_target(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(1, start + dt.timedelta(minutes=15 * i), i, 0) for i in range(20)]
    fact = literal_table(spark, rows, "zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int")
    got = {r.trip_count: (r.roll_mean_1h, r.lag_15min) for r in features.with_lags_and_rolling(fact, past=True).collect()}
    assert got[10] == (7.5, 9.0) and got[0] == (None, None)
