import datetime as dt

import pytest
from pyspark.sql import functions as F

from opspark.functions import serving as sv
from opspark.functions import timefeat as tf
from opspark.operators import demand, features, scoring
from opspark.sources import calendars, readers
from opspark.sources.literals import literal_table

START = dt.datetime(2024, 1, 1)


def series(spark, zones=(4, 13, 24), days=2, value=lambda z, i: z + i % 96):
    rows = [(z, START + dt.timedelta(minutes=15 * i), value(z, i)) for z in zones for i in range(96 * days)]
    return literal_table(spark, rows, "zone_id bigint, time_bucket timestamp_ntz, trip_count bigint")


def zone_dim(spark):
    rows = [(4, "Alphabet", "Manhattan", 0, 0), (13, "Battery", "Manhattan", 0, 0), (24, "Bloom", "Queens", 1, 0)]
    return literal_table(spark, rows, "zone_id bigint, name string, borough string, borough_id int, service_zone_id int")


def test_federal_calendar_counts_and_observed_day():
    days = calendars.federal_holidays(range(2023, 2027))
    assert len(days) == 45
    assert (dt.date(2026, 7, 3), "Independence Day (observed)") in days
    assert (dt.date(2025, 5, 26), "Memorial Day") in days and (dt.date(2024, 11, 28), "Thanksgiving") in days


def test_federal_rule_agrees_with_the_dates_of_every_year(spark):
    years = range(1998, 2045)
    want = dict(calendars.federal_holidays(years))
    days = spark.sql("SELECT explode(sequence(DATE '1998-01-01', DATE '2044-12-31')) AS day")
    got = {r.day: r.name for r in days.select("day", calendars.federal_name(F.col("day")).alias("name")).where("name IS NOT NULL").collect()}
    assert got == want


def test_grid_is_made_by_many_tasks(spark):
    trips = literal_table(spark, [(4, dt.datetime(2024, 1, 2, 3)), (4, dt.datetime(1990, 1, 1))], "zone_id bigint, ts timestamp_ntz")
    series = demand.dense_demand(trips, zone_dim(spark), first=dt.date(2024, 1, 1), last=dt.date(2024, 1, 3))
    assert series.count() == 3 * 3 * 96 and series.agg(F.sum("trip_count")).first()[0] == 1


def test_monday_is_day_zero_and_slots(spark):
    df = literal_table(spark, [(dt.datetime(2024, 1, 1, 13, 44),)], "ts timestamp_ntz")
    row = tf.with_temporal(df, "ts").first()
    assert (row.dayofweek, row.is_weekend, row.slot_of_day, row.weekofyear) == (0, 0, 54, 1)


def test_epoch_micros_matches_python(spark):
    t = dt.datetime(2024, 3, 5, 6, 7, 8, 123457)
    df = literal_table(spark, [(t,)], "ts timestamp_ntz")
    want = int((t - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))
    assert df.select(tf.epoch_micros(F.col("ts"))).first()[0] == want


def test_dense_demand_fills_zeros(spark):
    trips = literal_table(spark, [(4, START + dt.timedelta(minutes=3)), (4, START + dt.timedelta(minutes=4))], "zone_id bigint, ts timestamp_ntz")
    out = demand.dense_demand(trips, zone_dim(spark).select("zone_id"))
    assert out.count() == 3 * 96
    assert out.agg(F.sum("trip_count")).first()[0] == 2
    assert out.where("zone_id = 4 and trip_count = 2").first().time_bucket == START


def test_profile_keeps_unnamed_holiday_under_minus_one(spark):
    rows = [(1, dt.datetime(2024, 1, 1), 4, 1), (1, dt.datetime(2024, 1, 15), 6, 1), (1, dt.datetime(2024, 1, 8), 8, 0)]
    fact = literal_table(spark, rows, "zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int")
    got = {(r.dow, r.holiday): r.avg for r in demand.demand_profile(fact).collect()}
    assert got == {(-1, "New Year's Day"): 4.0, (-1, "regular"): 6.0, (0, "regular"): 8.0}


def test_pick_slice_date_overrides_holiday(spark):
    rows = [(1, 5, -1, "New Year's Day", 2.0), (1, 5, 0, "regular", 3.0)]
    profile = literal_table(spark, rows, "zone_id bigint, hour int, dow int, holiday string, avg double")
    assert [r.avg for r in demand.pick_slice(profile, 5, 0, date="2025-01-01").collect()] == [2.0]
    assert [r.avg for r in demand.pick_slice(profile, 5, 0, date="2025-01-02").collect()] == [3.0]
    assert demand.pick_slice(profile, 6, 0).count() == 0


def test_ranking_ties_and_trend(spark):
    rows = [(z, h, 0, "regular", a) for z, h, a in [(1, 0, 5.0), (2, 0, 5.0), (3, 0, 1.0), (1, 1, 6.0), (2, 1, 4.0), (3, 1, 1.05)]]
    profile = literal_table(spark, rows, "zone_id bigint, hour int, dow int, holiday string, avg double")
    out = {(r.hour, r.rank): r for r in demand.zone_ranking(profile, zone_dim(spark), n=2).collect()}
    assert len(out) == 4
    assert [out[(0, k)].zone_id for k in (1, 2)] == [1, 2]
    assert out[(0, 1)].trend == "flat" and out[(1, 1)].trend == "up" and out[(1, 2)].trend == "down"
    assert out[(1, 1)].is_airport and out[(1, 1)].name == "Zone 1"


def test_lags_over_chunk_borders_match_positions(spark):
    days = 60
    fact = series(spark, zones=(7,), days=days, value=lambda z, i: i)
    out = features.with_lags_and_rolling(fact).orderBy("time_bucket").collect()
    assert len(out) == 96 * days
    for i in (0, 5, 671, 672, 2687, 2688, 2700, 5000, 96 * days - 1):
        for name, k in features.LAGS.items():
            assert getattr(out[i], name) == (i - k if i >= k else None), (i, name)
        for name, k in features.ROLLING.items():
            first = max(0, i - k + 1)
            assert getattr(out[i], name) == pytest.approx((first + i) / 2)


def test_lag_is_null_at_a_gap(spark):
    fact = series(spark, zones=(7,), days=1).where(F.col("time_bucket") != F.lit("2024-01-01 05:00:00").cast("timestamp_ntz"))
    out = features.with_lags(fact)
    row = out.where(F.col("time_bucket") == F.lit("2024-01-01 05:15:00").cast("timestamp_ntz")).first()
    assert row.lag_15min is None and row.lag_1h is not None


def test_feature_order(spark):
    fact = series(spark).withColumn("is_holiday", F.lit(0))
    table = features.feature_table(fact, zone_dim(spark))
    assert table.columns == ["time_bucket", "trip_count", *features.FEATURES] and len(features.FEATURES) == 30


def test_scalar_rules(spark):
    one = spark.range(1)
    row = one.select(
        sv.clamp_fare(F.lit(None).cast("double")).alias("none"),
        sv.clamp_fare(F.lit(500.0)).alias("high"),
        sv.unmet_demand(F.lit(40.0), F.lit(20.0)).alias("unmet"),
        sv.drive_minutes(*[F.lit(x) for x in (40.0, -74.0, 40.5, -74.0, 1, 2)]).alias("far"),
        sv.drive_minutes(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1), F.lit(200)).alias("unknown"),
        sv.outlook(F.lit(10.0), F.lit(12.0), F.lit(16)).alias("up"),
        sv.outlook(F.lit(10.0), F.lit(12.0), F.lit(8)).alias("short"),
    ).first()
    assert (row.none, row.high, row.unmet, row.far, row.unknown, row.up, row.short) == (18.7, 100.0, 6, 45, 9, "rising", "stable")


def test_stay_comes_first_in_a_hot_zone(spark):
    rows = [(z, 8, 0, "regular", a) for z, a in [(4, 10.0), (13, 3.0), (24, 9.0)]]
    profile = literal_table(spark, rows, "zone_id bigint, hour int, dow int, holiday string, avg double")
    fares = literal_table(spark, [(4, 8, 20.0)], "zone_id bigint, hour int, avg_fare double")
    out = demand.recommendations(profile, zone_dim(spark), fares).where("origin_id = 4").orderBy("rank").collect()
    assert out[0].name == "Stay: Alphabet" and out[0].est_yield_max == 80 and out[0].drive_minutes == 0
    assert [r.zone_id for r in out] == [4, 24, 13]


def test_recursive_forecast_feeds_itself(spark):
    fact = series(spark, zones=(7,), days=8, value=lambda z, i: 5)
    base = features.zone_slot_baseline(fact)
    out = scoring.forecast_recursive(fact, base, lambda row: row["lag_15min"] + 1).orderBy("step").collect()
    assert [r.yhat for r in out] == [5.0 + k for k in range(1, 17)]
    assert out[0].time_bucket == START + dt.timedelta(days=8)
    assert scoring.forecast_recursive(fact, base, lambda row: -3.0).agg(F.max("yhat")).first()[0] == 0.0


def test_score_with_python_model(spark):
    table = series(spark, days=1).withColumn("x", F.col("trip_count").cast("double"))
    out = scoring.score_with(table, lambda rows: rows["x"].to_numpy() * 2 - 100, ["x"])
    assert out.where("yhat < 0").count() == 0
    assert out.where("x = 60").first().yhat == 20.0


def test_readers(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n4,Manhattan,Alphabet,Yellow Zone\n")
    assert readers.zone_csv(spark, str(tmp_path / "zones.csv")).first().asDict() == {
        "zone_id": 4, "borough": "Manhattan", "name": "Alphabet", "service_zone": "Yellow Zone"}
    (tmp_path / "z.geojson").write_text(
        '{"features": [{"properties": {"LocationID": "4"}, "geometry": {"type": "Polygon", "coordinates": [[[-74, 40], [-73, 41], [-74, 42]]]}},'
        ' {"properties": {"LocationID": "5"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[1, 2]]]}}]}')
    got = readers.zone_centroids(readers.geojson(spark, str(tmp_path / "z.geojson"))).collect()
    assert [(r.zone_id, r.lat, r.lon) for r in got] == [(4, 41.0, -73.5)]
    (tmp_path / "docs.json").write_text('[{"id": "p1", "title": "T", "category": "HR", "content": "c", "access_roles": ["all"]}]')
    assert readers.documents_json(spark, str(tmp_path / "docs.json")).first().access_roles == ["all"]
    path = str(tmp_path / "fact")
    spark.sql("select 1L as PULocationID, '2024-01-01 00:15:00' as time_bucket, double('NaN') as trip_count").write.parquet(path)
    row = readers.demand_parquet(spark, path).first()
    assert row.trip_count is None and row.time_bucket == dt.datetime(2024, 1, 1, 0, 15) and row.zone_id == 1
