"""Registered queries on data quality: a demand series with planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefeat import slot_of_day
from ..operators import drift, features, quality
from . import demand_queries as dq
from .sqlbase import FACT, with_

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# Planted defects, by a residue of (zone, slot): the same rule in Spark and SQL.
def dirty(spark: SparkSession, d: str) -> DataFrame:
    """The demand series with sentinels, negatives, an over-maximum value, nulls, copies, false holiday
    flags on two dates and missing flags on a real one."""
    t = F.col("time_bucket")
    number = F.dayofyear(t).cast("bigint") * 96 + slot_of_day(t)
    f = dq.fact(spark, d).withColumn("k", F.pmod(F.col("zone_id") * 7919 + number, F.lit(997)))
    k = F.col("k")
    bad = {1: -5, 2: -1, 3: 9999, 4: 99999, 5: 600, 6: -7}
    trips = F.when(k == 7, F.lit(None).cast("bigint"))
    for residue, value in bad.items():
        trips = trips.when(k == residue, F.lit(value).cast("bigint"))
    copies = F.when(k.between(10, 14), F.array(F.lit(0), F.lit(1))).when(k == 15, F.array(F.lit(0), F.lit(1), F.lit(2)))
    date = F.to_date(t).cast("string")
    flag = (
        F.when(date.isin("2024-01-09", "2024-01-23"), F.lit(1))
        .when((date == "2024-01-15") & (F.col("zone_id") % 5 == 0), F.lit(0))
        .otherwise(F.col("is_holiday"))
    )
    return f.withColumn("copy", F.explode(copies.otherwise(F.array(F.lit(0))))).select(
        ((F.col("zone_id") * 1000000 + number) * 10 + F.col("copy")).alias("row_id"),
        "zone_id",
        "time_bucket",
        (trips.otherwise(F.col("trip_count")) + F.col("copy")).alias("trip_count"),
        flag.alias("is_holiday"),
    )


DIRTY = f"""{FACT},
numbered AS (SELECT *, dayofyear(time_bucket) * 96 + hour(time_bucket) * 4 + minute(time_bucket) // 15 AS num FROM fact),
keyed AS (SELECT *, (zone_id * 7919 + num) % 997 AS k FROM numbered),
dirty AS (
  SELECT (zone_id * 1000000 + num) * 10 + copy AS row_id, zone_id, time_bucket,
         CASE k WHEN 1 THEN -5 WHEN 2 THEN -1 WHEN 3 THEN 9999 WHEN 4 THEN 99999 WHEN 5 THEN 600 WHEN 6 THEN -7 WHEN 7 THEN NULL
                ELSE trip_count END + copy AS trip_count,
         CASE WHEN CAST(time_bucket AS DATE) IN (DATE '2024-01-09', DATE '2024-01-23') THEN 1
              WHEN CAST(time_bucket AS DATE) = DATE '2024-01-15' AND zone_id % 5 = 0 THEN 0 ELSE is_holiday END AS is_holiday
  FROM keyed, (VALUES (0), (1), (2)) c(copy)
  WHERE copy = 0 OR (copy = 1 AND k BETWEEN 10 AND 15) OR (copy = 2 AND k = 15)),
classed AS (
  SELECT *, CASE WHEN trip_count IN (-5, -1, 9999, 99999) THEN 'sentinel' WHEN trip_count < 0 THEN 'negative'
                 WHEN trip_count > 465 THEN 'over_max' ELSE 'ok' END AS class FROM dirty),
holidays_wrong AS (SELECT CAST(time_bucket AS DATE) AS date, count(*) AS n FROM dirty
                   WHERE is_holiday = 1 AND CAST(time_bucket AS DATE) NOT IN (SELECT fd FROM federal) GROUP BY 1),
dups AS (SELECT zone_id, time_bucket, count(*) AS n FROM dirty GROUP BY 1, 2 HAVING count(*) > 1),
firsts AS (SELECT *, row_number() OVER (PARTITION BY zone_id, time_bucket ORDER BY row_id) AS rn FROM classed WHERE class = 'ok'),
cleaned AS (SELECT row_id, zone_id, time_bucket, trip_count,
                   CASE WHEN CAST(time_bucket AS DATE) IN (SELECT fd FROM federal) THEN is_holiday ELSE 0 END AS is_holiday
            FROM firsts WHERE rn = 1)"""

VALUE_RANGES = """SELECT class, CASE WHEN class = 'sentinel' THEN trip_count END AS value, count(*) AS affected_rows,
  CAST(min(trip_count) AS DOUBLE) AS min, CAST(max(trip_count) AS DOUBLE) AS max,
  array_to_string(list_slice(list_sort(list(DISTINCT zone_id)), 1, 20), ',') AS zones
FROM classed WHERE class <> 'ok' GROUP BY 1, 2"""


@query("dirty_series", with_(DIRTY, "SELECT * FROM dirty"))
def dirty_series(spark, d):
    return dirty(spark, d)


@query("dq_value_ranges", with_(DIRTY, VALUE_RANGES))
def dq_value_ranges(spark, d):
    return quality.value_range_findings(dirty(spark, d))


@query("dq_holiday", with_(DIRTY, "SELECT date, n FROM holidays_wrong"))
def dq_holiday(spark, d):
    return quality.false_holidays(dirty(spark, d))


@query(
    "dq_duplicates",
    with_(
        DIRTY,
        """SELECT count(*) AS duplicate_key_count, CAST(sum(n - 1) AS BIGINT) AS extra_rows, count(DISTINCT zone_id) AS affected_zone_count,
             array_to_string(list_slice(list_sort(list(DISTINCT zone_id)), 1, 25), ',') AS affected_zones,
             min(time_bucket) AS first_time, max(time_bucket) AS last_time FROM dups""",
    ),
)
def dq_duplicates(spark, d):
    return quality.duplicate_findings(dirty(spark, d))


ISSUES = f"""{DIRTY},
issues(check_name, severity, description, affected_rows) AS (
  SELECT 'value_ranges', 'critical',
         CASE class WHEN 'sentinel' THEN 'trip_count sentinel value ' || trip_count || ' detected'
                    WHEN 'negative' THEN 'trip_count negative values outside sentinel set'
                    ELSE 'trip_count > historical max (465)' END, count(*) FROM classed WHERE class <> 'ok'
  GROUP BY class, CASE class WHEN 'sentinel' THEN 'trip_count sentinel value ' || trip_count || ' detected'
                    WHEN 'negative' THEN 'trip_count negative values outside sentinel set'
                    ELSE 'trip_count > historical max (465)' END
  UNION ALL SELECT 'holiday_labels', 'critical', 'is_holiday=1 on dates that are not real US Federal holidays', CAST(sum(n) AS BIGINT)
  FROM holidays_wrong HAVING sum(n) > 0
  UNION ALL SELECT 'duplicates', 'critical', 'duplicate (zone, time_bucket) keys detected', CAST(sum(n - 1) AS BIGINT) FROM dups HAVING sum(n - 1) > 0)"""


@query("dq_issues", with_(ISSUES, "SELECT check_name AS \"check\", severity, description, affected_rows FROM issues"))
def dq_issues(spark, d):
    return quality.validate(dirty(spark, d)).select("check", "severity", "description", "affected_rows")


@query(
    "dq_summary",
    with_(ISSUES, "SELECT check_name AS \"check\", count(*) AS issues, CAST(sum(affected_rows) AS BIGINT) AS rows FROM issues GROUP BY 1"),
)
def dq_summary(spark, d):
    return quality.summary(quality.validate(dirty(spark, d)))


@query(
    "dq_passed",
    with_(
        ISSUES,
        """SELECT 'dirty' AS batch, count(*) = 0 AS passed, count(*) AS issues FROM issues
           UNION ALL SELECT 'cleaned', count(*) = 0, count(*) FROM cleaned
             WHERE trip_count < 0 OR trip_count > 465 OR (is_holiday = 1 AND CAST(time_bucket AS DATE) NOT IN (SELECT fd FROM federal))""",
    ),
)
def dq_passed(spark, d):
    raw = dirty(spark, d)
    checks = [("dirty", raw), ("cleaned", quality.clean(raw, "row_id"))]
    rows = [quality.passed(quality.validate(b)).select(F.lit(n).alias("batch"), "passed", "issues") for n, b in checks]
    return rows[0].unionByName(rows[1])


@query("clean_demand", with_(DIRTY, "SELECT * FROM cleaned"))
def clean_demand(spark, d):
    return quality.clean(dirty(spark, d), "row_id")


@query(
    "clean_report",
    with_(
        DIRTY,
        """SELECT (SELECT count(*) FROM dirty) AS original_rows, (SELECT count(*) FROM classed WHERE class <> 'ok') AS dropped_invalid,
             (SELECT count(*) FROM firsts WHERE rn > 1) AS dropped_duplicates,
             (SELECT count(*) FROM firsts WHERE rn = 1 AND is_holiday = 1 AND CAST(time_bucket AS DATE) NOT IN (SELECT fd FROM federal)) AS rows_modified,
             (SELECT count(*) FROM dirty) - (SELECT count(*) FROM cleaned) AS rows_dropped, (SELECT count(*) FROM cleaned) AS final_rows,
             round(1 - (SELECT count(*) FROM cleaned) / (SELECT count(*) FROM dirty), 6) AS drop_rate""",
    ),
)
def clean_report(spark, d):
    return quality.clean_report(dirty(spark, d), "row_id")


@query(
    "quarantine",
    with_(
        DIRTY,
        """SELECT row_id, zone_id, time_bucket, trip_count, is_holiday, class AS reason FROM classed WHERE class <> 'ok'
           UNION ALL SELECT row_id, zone_id, time_bucket, trip_count, is_holiday, 'duplicate' FROM firsts WHERE rn > 1""",
    ),
)
def quarantine(spark, d):
    return quality.quarantine(dirty(spark, d), "row_id")


SPLIT = "2024-01-16"


def both_windows(df: DataFrame) -> DataFrame:
    return drift.windows(df, SPLIT, SPLIT)


@query(
    "null_rates",
    with_(
        f"{DIRTY}, {{}}".format(
            f"lagged AS (SELECT *, time_bucket >= TIMESTAMP '{SPLIT}' AS is_new, {dq.LAG_SQL} FROM cleaned WINDOW w AS (PARTITION BY zone_id ORDER BY time_bucket))"
        ),
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", round(avg(({c} IS NULL)::INT) FILTER (WHERE NOT is_new), 6) AS base_rate,
                 round(avg(({c} IS NULL)::INT) FILTER (WHERE is_new), 6) AS new_rate,
                 round(avg(({c} IS NULL)::INT) FILTER (WHERE is_new) - avg(({c} IS NULL)::INT) FILTER (WHERE NOT is_new), 6) AS delta FROM lagged"""
            for c in ["trip_count", "is_holiday", *features.LAGS]
        ),
    ),
)
def null_rates(spark, d):
    frame = both_windows(features.with_lags(quality.clean(dirty(spark, d), "row_id")))
    out = quality.null_rates(frame, ["trip_count", "is_holiday", *features.LAGS])
    return out.select("column", *[F.round(c, 6).alias(c) for c in ("base_rate", "new_rate", "delta")])


@query(
    "describe_columns",
    with_(
        f"{DIRTY}, d AS (SELECT *, time_bucket >= TIMESTAMP '{SPLIT}' AS is_new FROM dirty)",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", is_new, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
                 round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(quantile_cont({c}, 0.95), 6) AS p95,
                 round(quantile_cont({c}, 0.99), 6) AS p99 FROM d GROUP BY 2"""
            for c in ["trip_count", "is_holiday", "zone_id"]
        ),
    ),
)
def describe_columns(spark, d):
    out = quality.describe_columns(both_windows(dirty(spark, d)), ["trip_count", "is_holiday", "zone_id"])
    return out.select("column", "is_new", "n", "min", "max", *[F.round(c, 6).alias(c) for c in ("mean", "std", "p95", "p99")])


@query(
    "describe_prices",
    """SELECT 'l_extendedprice' AS "column", l_shipdate >= TIMESTAMP '1995-01-01' AS is_new, count(*) AS n, min(l_extendedprice) AS min,
         max(l_extendedprice) AS max, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99
       FROM lineitem GROUP BY 2""",
)
def describe_prices(spark, d):
    """The same statistics over a continuous column with almost as many values as rows."""
    rows = dq.tables.table(spark, d, "lineitem").select(
        "l_extendedprice", (F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")).alias("is_new")
    )
    return quality.describe_columns(rows, ["l_extendedprice"]).select(
        "column", "is_new", "n", "min", "max", F.round("p95", 6).alias("p95"), F.round("p99", 6).alias("p99")
    )


@query(
    "lag_corr",
    with_(
        f"{FACT}, feat AS (SELECT *, {dq.LAG_SQL} FROM fact {dq.WINDOW_SQL})",
        """SELECT zone_id, round(CASE WHEN isnan(corr(lag_1week, trip_count)) THEN NULL ELSE corr(lag_1week, trip_count) END, 6) AS corr,
             count(*) AS n FROM feat GROUP BY 1 HAVING count(*) >= 50""",
    ),
)
def lag_corr(spark, d):
    out = quality.lag_correlation(features.with_lags(dq.fact(spark, d)))
    return out.select("zone_id", F.round("corr", 6).alias("corr"), "n")


@query(
    "holiday_flag_audit",
    with_(
        DIRTY,
        """, rates AS (SELECT CAST(time_bucket AS DATE) AS d0, avg(is_holiday) AS rate FROM dirty GROUP BY 1)
        SELECT fd AS holiday_date, fname AS holiday_name, round(rate, 6) AS rate,
               CASE WHEN rate IS NULL THEN 'no data' WHEN rate >= 0.99 THEN 'FLAGGED' WHEN rate > 0 THEN 'partial' ELSE 'MISSING' END AS status
        FROM federal LEFT JOIN rates ON d0 = fd WHERE year(fd) = 2024""".lstrip(),
    ),
)
def holiday_flag_audit(spark, d):
    return quality.holiday_flag_audit(dirty(spark, d), 2024).withColumn("rate", F.round("rate", 6))


@query(
    "holiday_flag_rates",
    with_(
        DIRTY,
        """SELECT CAST(time_bucket AS DATE) AS date, round(avg(is_holiday), 6) AS rate, count(*) AS rows,
             count(*) FILTER (WHERE is_holiday = 1) AS flagged, any_value(fname) AS holiday_name
           FROM dirty LEFT JOIN federal ON fd = CAST(time_bucket AS DATE) GROUP BY 1""",
    ),
)
def holiday_flag_rates(spark, d):
    return quality.holiday_flag_rates(dirty(spark, d)).withColumn("rate", F.round("rate", 6))


@query(
    "invalid_drilldown",
    with_(
        DIRTY,
        """, g AS (
          SELECT 'zone' AS grouping, CAST(zone_id AS VARCHAR) AS item, count(*) AS rows FROM classed WHERE class <> 'ok' GROUP BY 2
          UNION ALL SELECT 'date', CAST(CAST(time_bucket AS DATE) AS VARCHAR), count(*) FROM classed WHERE class <> 'ok' GROUP BY 2
          UNION ALL SELECT 'value', CAST(trip_count AS VARCHAR), count(*) FROM classed WHERE class <> 'ok' GROUP BY 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY grouping ORDER BY rows DESC, item) AS rank FROM g)
        SELECT grouping, item, rows, rank FROM r WHERE rank <= 10""".lstrip(),
    ),
)
def invalid_drilldown(spark, d):
    return quality.invalid_drilldown(dirty(spark, d))


@query(
    "row_count_delta",
    with_(
        DIRTY,
        f""", b AS (SELECT zone_id, count(*) AS n FROM dirty WHERE time_bucket < TIMESTAMP '{SPLIT}' GROUP BY 1),
        n AS (SELECT zone_id, count(*) AS n FROM dirty WHERE time_bucket >= TIMESTAMP '{SPLIT}' GROUP BY 1)
        SELECT zone_id, coalesce(b.n, 0) AS n_base, coalesce(n.n, 0) AS n_new, coalesce(n.n, 0) - coalesce(b.n, 0) AS delta
        FROM b FULL OUTER JOIN n USING (zone_id)""".lstrip(),
    ),
)
def row_count_delta(spark, d):
    return drift.row_count_delta(both_windows(dirty(spark, d)))
