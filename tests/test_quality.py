import datetime as dt

import pytest

from opspark.operators import quality
from opspark.sources.literals import literal_table

SCHEMA = "row_id bigint, zone_id bigint, time_bucket timestamp_ntz, trip_count bigint, is_holiday int"


def batch(spark, changes=None, extra=(), day=dt.datetime(2025, 9, 2)):
    rows = []
    for z in (4, 13, 24):
        for k in range(40):
            rows.append([len(rows), z, day + dt.timedelta(minutes=15 * k), k % 20, 0])
    for i, value in (changes or {}).items():
        rows[i][3] = value
    return literal_table(spark, [tuple(r) for r in rows] + list(extra), SCHEMA)


def checks(df):
    return {(r.check, r.description): r for r in quality.validate(df).collect()}


def test_clean_batch_passes(spark):
    issues = quality.validate(batch(spark))
    assert issues.count() == 0
    assert quality.passed(issues).first().passed


@pytest.mark.parametrize("value", quality.SENTINELS)
def test_each_sentinel_is_one_issue(spark, value):
    found = checks(batch(spark, {0: value, 50: value}))
    row = found[("value_ranges", f"trip_count sentinel value {value} detected")]
    assert len(found) == 1 and row.affected_rows == 2 and row.details["zones"] == "4,13" and row.severity == "critical"


def test_negative_and_over_max_exclude_sentinels(spark):
    found = checks(batch(spark, {0: -7, 1: 466, 2: 465, 3: -1}))
    assert found[("value_ranges", "trip_count negative values outside sentinel set")].details["min"] == "-7.0"
    assert found[("value_ranges", "trip_count > historical max (465)")].affected_rows == 1
    assert len(found) == 3


def test_holiday_flags(spark):
    day = dt.datetime(2025, 9, 1)
    true_flag = literal_table(spark, [(0, 1, day, 3, 1)], SCHEMA)
    false_flag = literal_table(spark, [(0, 1, dt.datetime(2025, 9, 3), 3, 1), (1, 1, dt.datetime(2025, 9, 4), 3, 1)], SCHEMA)
    assert quality.validate(true_flag).count() == 0
    row = quality.validate(false_flag).first()
    assert row.details["affected_dates"] == "2025-09-03,2025-09-04" and row.affected_rows == 2


def test_duplicates(spark):
    copy = (900, 4, dt.datetime(2025, 9, 2), 1, 0)
    row = quality.validate(batch(spark, extra=[copy, copy])).first()
    assert row.check == "duplicates" and row.affected_rows == 2
    assert row.details["duplicate_key_count"] == "1" and row.details["affected_zones"] == "4"


def test_missing_column_is_an_issue(spark):
    df = batch(spark)
    assert quality.check_value_ranges(df.drop("trip_count")).first().description == "column trip_count is missing"
    assert quality.validate(df.drop("time_bucket")).count() == 2
    assert quality.clean(df.drop("is_holiday"), "row_id").count() == 120


def test_empty_and_single_row(spark):
    assert quality.validate(batch(spark).limit(0)).count() == 0
    assert quality.clean_report(batch(spark).limit(0), "row_id").first().original_rows == 0
    assert quality.clean(batch(spark).limit(1), "row_id").count() == 1


def test_clean_keeps_first_and_is_idempotent(spark):
    day = dt.datetime(2025, 9, 2)
    df = batch(spark, {5: 9999}, extra=[(900, 4, day, 17, 0), (901, 4, dt.datetime(2025, 9, 5), 3, 1)])
    clean = quality.clean(df, "row_id")
    assert clean.count() == 120
    assert clean.where("row_id = 900").count() == 0
    assert clean.where("row_id = 901").first().is_holiday == 0
    assert quality.validate(clean).count() == 0
    assert sorted(map(tuple, quality.clean(clean, "row_id").collect())) == sorted(map(tuple, clean.collect()))
    report = quality.clean_report(df, "row_id").first()
    assert (report.dropped_invalid, report.dropped_duplicates, report.rows_modified, report.final_rows) == (1, 1, 1, 120)
    kept_out = {(r.row_id, r.reason) for r in quality.quarantine(df, "row_id").collect()}
    assert kept_out == {(5, "sentinel"), (900, "duplicate")}


def test_guard_raises_over_limit(spark):
    bad = batch(spark, {i: -5 for i in range(7)})
    with pytest.raises(quality.DropRateExceeded):
        quality.clean_guarded(bad, "row_id")
    clean, report = quality.clean_guarded(bad, "row_id", max_drop_rate=0.1)
    assert clean.count() == 113 and report.rows_dropped == 7


def test_hot_key_with_a_third_of_all_rows(spark):
    """Copies of one key: the filter before the shuffle keeps one per task."""
    day = dt.datetime(2025, 9, 2)
    copies = spark.range(1000, 21000).selectExpr("id as row_id", "4L as zone_id", f"timestamp_ntz'{day}' as time_bucket", "1L as trip_count", "0 as is_holiday")
    df = batch(spark).unionByName(copies)
    clean = quality.clean(df, "row_id")
    assert clean.count() == 120 and clean.where("row_id >= 1000").count() == 0
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert quality.clean_report(df, "row_id").first().dropped_duplicates == 20000
    assert quality.quarantine(df, "row_id").count() == 20000
