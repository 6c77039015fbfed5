"""Registered queries on the demand series, each next to its checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import serving as sv
from ..functions import timefeat as tf
from ..operators import demand, features
from ..session import cut_lineage, scratch
from ..sources import calendars, readers, tables
from .sqlbase import FACT, FEDERAL, MONTH_DAY, PROFILE, ZONES, with_

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def fact(spark: SparkSession, d: str) -> DataFrame:
    series = demand.dense_demand(tables.trips(spark, d), tables.zones(spark, d))
    return demand.with_holiday_flag(series)


def profile(spark: SparkSession, d: str) -> DataFrame:
    return demand.demand_profile(fact(spark, d))


def stored_fact(spark: SparkSession, d: str) -> DataFrame:
    """The series written once, for plans that read it more than once."""
    return cut_lineage(fact(spark, d))


def stored_profile(spark: SparkSession, d: str) -> DataFrame:
    """The profile written once: the table the serving operators read."""
    return cut_lineage(profile(spark, d))


@query(
    "scan_pruned",
    "SELECT user_id AS zone_user, ts, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1, 2",
)
def scan_pruned(spark, d):
    rows = tables.table(spark, d, "events").select("user_id", "ts", "event_type").where(F.col("event_type") == "purchase")
    return rows.groupBy(F.col("user_id").alias("zone_user"), "ts").agg(F.count("*").alias("n"))


@query(
    "zone_dim",
    with_(
        ZONES + ", per AS (SELECT user_id % 25 AS zone_id, count(*) AS trips FROM events GROUP BY 1)",
        """SELECT zone_id, name, borough, service_zone, trips FROM zones LEFT JOIN per USING (zone_id)""",
    ),
)
def zone_dim(spark, d):
    per_zone = tables.trips(spark, d).groupBy("zone_id").agg(F.count("*").alias("trips"))
    return tables.zones(spark, d).join(per_zone, "zone_id", "left").select("zone_id", "name", "borough", "service_zone", "trips")


@query("zone_csv", with_(ZONES, "SELECT zone_id, name, borough, service_zone FROM zones"))
def zone_csv(spark, d):
    """The zone dimension written as CSV and loaded by the CSV reader."""
    path = scratch(spark, "zones")
    names = {"zone_id": "LocationID", "borough": "Borough", "name": "Zone", "service_zone": "service_zone"}
    tables.zones(spark, d).select(*[F.col(c).alias(n) for c, n in names.items()]).write.csv(path, header=True)
    return readers.zone_csv(spark, path).select(F.col("zone_id").cast("bigint").alias("zone_id"), "name", "borough", "service_zone")


@query("demand_series", with_(FACT, "SELECT zone_id, time_bucket, trip_count, is_holiday FROM fact"))
def demand_series(spark, d):
    return fact(spark, d).select("zone_id", "time_bucket", "trip_count", "is_holiday")


FARES = """fares AS (
  SELECT user_id % 25 AS zone_id, CAST(hour(ts) AS INTEGER) AS hour, avg(value) AS avg_fare
  FROM events GROUP BY 1, 2)"""


def fares(spark, d):
    """Mean fare of all trips; a trip is an event, whatever its kind."""
    return demand.zone_hour_fare(tables.trips(spark, d))


@query("zone_hour_fare", with_(FARES, "SELECT zone_id, hour, round(avg_fare, 6) AS avg_fare FROM fares"))
def zone_hour_fare(spark, d):
    return fares(spark, d).withColumn("avg_fare", F.round("avg_fare", 6))


@query(
    "fare_clamped",
    with_(
        FARES,
        """SELECT e.event_id, round(least(100.0, greatest(5.0, coalesce(avg_fare, 18.70))), 6) AS fare
           FROM events e LEFT JOIN fares f ON f.zone_id = e.user_id % 25 AND f.hour = hour(e.ts)""",
    ),
)
def fare_clamped(spark, d):
    rides = tables.table(spark, d, "events").select(
        "event_id", F.pmod("user_id", F.lit(tables.ZONE_COUNT)).alias("zone_id"), F.hour("ts").alias("hour")
    )
    return rides.join(fares(spark, d), ["zone_id", "hour"], "left").select(
        "event_id", F.round(sv.clamp_fare(F.col("avg_fare")), 6).alias("fare")
    )


CENTROIDS = "centroids AS (SELECT zone_id, CAST(40.5 AS DOUBLE) + (zone_id * 7 % 25) * CAST(0.02 AS DOUBLE) AS lat, CAST(-74.2 AS DOUBLE) + (zone_id * 11 % 25) * CAST(0.03 AS DOUBLE) AS lon FROM zones)"


def centroids(spark, d):
    z = F.col("zone_id")
    return tables.zones(spark, d).select(
        "zone_id",
        (F.lit(40.5) + (z * 7 % 25) * F.lit(0.02)).alias("lat"),
        (F.lit(-74.2) + (z * 11 % 25) * F.lit(0.03)).alias("lon"),
    )


DRIVE = """least(45, greatest(2, CAST(trunc(sqrt(power(abs(a.lat - b.lat) * 69, 2) + power(abs(a.lon - b.lon) * 54, 2)) / 15 * 60) AS BIGINT)))"""


@query(
    "drive_minutes",
    with_(
        f"{ZONES}, {CENTROIDS}, hops AS (SELECT user_id % 25 AS z1, (user_id % 25 + event_id) % 25 AS z2, count(*) AS trips FROM events GROUP BY 1, 2)",
        f"""SELECT z1 AS from_zone, z2 AS to_zone, trips,
              CAST(CASE WHEN z1 % 5 = 4 THEN greatest(3, abs(z1 - z2) // 20) ELSE {DRIVE} END AS BIGINT) AS minutes
            FROM hops JOIN centroids a ON a.zone_id = z1 JOIN centroids b ON b.zone_id = z2""",
    ),
)
def drive_minutes(spark, d):
    """Trips between zones with their drive time; zones 4, 9, ... have no centroid and use the fallback."""
    e = tables.table(spark, d, "events")
    start = F.pmod("user_id", F.lit(25))
    hops = e.groupBy(start.alias("from_zone"), F.pmod(start + F.col("event_id"), F.lit(25)).alias("to_zone")).agg(
        F.count("*").alias("trips")
    )
    c = centroids(spark, d)
    known = c.where(F.col("zone_id") % 5 != 4)
    a = known.select(F.col("zone_id").alias("from_zone"), F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    b = c.select(F.col("zone_id").alias("to_zone"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    minutes = sv.drive_minutes(*[F.col(x) for x in ("lat1", "lon1", "lat2", "lon2", "from_zone", "to_zone")])
    return hops.join(a, "from_zone", "left").join(b, "to_zone", "left").select("from_zone", "to_zone", "trips", minutes.alias("minutes"))


@query(
    "temporal_features",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
         CAST(isodow(ts) - 1 AS INTEGER) AS dayofweek, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         CAST(month(ts) AS INTEGER) AS month, CAST(dayofyear(ts) AS INTEGER) AS dayofyear,
         CAST(weekofyear(ts) AS INTEGER) AS weekofyear, CAST(year(ts) AS INTEGER) AS year,
         CAST(hour(ts) * 4 + minute(ts) // 15 AS INTEGER) AS slot_of_day,
         CAST(time_bucket(INTERVAL 15 MINUTE, ts) AS TIMESTAMP) AS bucket FROM events""",
)
def temporal_features(spark, d):
    e = tables.table(spark, d, "events").select("event_id", "ts")
    return tf.with_temporal(e, "ts").withColumn("bucket", tf.bucket_start("ts")).drop("ts")


@query(
    "cyclical_features",
    """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 9) + 0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 9) + 0 AS hour_cos,
         round(sin(2 * pi() * (isodow(ts) - 1) / 7), 9) + 0 AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 9) + 0 AS dow_cos,
         round(sin(2 * pi() * month(ts) / 12), 9) + 0 AS month_sin, round(cos(2 * pi() * month(ts) / 12), 9) + 0 AS month_cos
       FROM events""",
)
def cyclical_features(spark, d):
    e = tables.table(spark, d, "events").select("event_id", "ts")
    out = tf.with_cyclical(tf.with_temporal(e, "ts"))
    return out.select("event_id", *[(F.round(c, 9) + F.lit(0.0)).alias(c) for c in tf.CYCLICAL])


@query(
    "holiday_name",
    with_(
        MONTH_DAY,
        """SELECT o_orderkey, coalesce(hname, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Rush' ELSE 'regular' END) AS holiday,
             CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
           FROM orders LEFT JOIN md ON m = month(o_orderdate) AND d = day(o_orderdate)""",
    ),
)
def holiday_name(spark, d):
    """Date context of every order: the calendar's name overrides the requested one."""
    requested = F.when(F.col("o_orderpriority") == "1-URGENT", "Rush").otherwise(calendars.REGULAR)
    o = tables.table(spark, d, "orders").select("o_orderkey", "o_orderdate", requested.alias("asked"))
    return calendars.with_month_day_holiday(o, "o_orderdate", "asked").select(
        "o_orderkey", "holiday", F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day")
    )


@query(
    "holiday_calendar",
    with_(
        FEDERAL,
        """SELECT fd AS holiday_date, fname AS holiday_name, count(event_id) AS events,
             count(event_id) > 0 AS in_data
           FROM federal LEFT JOIN events ON CAST(ts AS DATE) = fd WHERE year(fd) = 2024 GROUP BY 1, 2""",
    ),
)
def holiday_calendar(spark, d):
    per_day = tables.table(spark, d, "events").groupBy(F.to_date("ts").alias("holiday_date")).agg(F.count("*").alias("events"))
    return calendars.federal_calendar(spark, 2024).join(per_day, "holiday_date", "left").select(
        "holiday_date",
        "holiday_name",
        F.coalesce("events", F.lit(0)).cast("bigint").alias("events"),
        F.col("events").isNotNull().alias("in_data"),
    )


@query(
    "holiday_test",
    with_(
        FEDERAL,
        """SELECT CAST(o_orderdate + INTERVAL 26 YEAR AS DATE) AS day, count(*) AS orders, fname IS NOT NULL AS is_real_holiday,
             coalesce(fname, 'regular') AS holiday
           FROM orders LEFT JOIN federal ON fd = CAST(o_orderdate + INTERVAL 26 YEAR AS DATE) GROUP BY 1, 3, 4""",
    ),
)
def holiday_test(spark, d):
    """Exact-date holiday test and name for every day of the order dates moved 26 years on."""
    days = (
        tables.table(spark, d, "orders")
        .groupBy((F.to_date("o_orderdate") + F.expr("INTERVAL 26 YEAR")).cast("date").alias("day"))
        .agg(F.count("*").alias("orders"))
    )
    return calendars.with_federal_holiday(days, F.col("day")).select(
        "day",
        "orders",
        F.col("federal_name").isNotNull().alias("is_real_holiday"),
        F.coalesce("federal_name", F.lit(calendars.REGULAR)).alias("holiday"),
    )


@query(
    "forecast_flag",
    """SELECT CAST(ts AS DATE) AS date, count(*) AS events, CAST(ts AS DATE) > DATE '2024-01-20' AS is_forecast,
         CASE WHEN CAST(ts AS DATE) > DATE '2024-01-20' THEN 'predicted' ELSE 'actual' END AS data_type
       FROM events GROUP BY 1""",
)
def forecast_flag(spark, d):
    days = tables.table(spark, d, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count("*").alias("events"))
    return demand.forecast_flags(days, "2024-01-20")


@query("demand_profile", with_(PROFILE, "SELECT zone_id, hour, dow, holiday, avg FROM profile"))
def demand_profile(spark, d):
    return profile(spark, d)


@query(
    "heatmap",
    with_(
        PROFILE,
        """SELECT hour, dow, holiday, zone_id, round_even(avg, 2) AS demand,
             max(round_even(avg, 2)) OVER (PARTITION BY hour, dow, holiday) AS max FROM served""",
    ),
)
def heatmap(spark, d):
    return demand.heatmap(profile(spark, d))


REQUESTS = """requests AS (
  SELECT DISTINCT CAST(hour(time_bucket) AS INTEGER) AS hour, CAST(isodow(time_bucket) - 1 AS INTEGER) AS dow,
         coalesce(hname, 'regular') AS holiday
  FROM fact LEFT JOIN md ON m = month(time_bucket) AND d = day(time_bucket))"""


@query(
    "kpis",
    with_(
        f"{PROFILE}, {REQUESTS}",
        """, sub AS (
          SELECT r.hour, r.dow, r.holiday, p.zone_id, p.avg,
                 row_number() OVER (PARTITION BY r.hour, r.dow, r.holiday ORDER BY p.avg DESC, p.zone_id) AS rn
          FROM requests r JOIN profile p ON p.hour = r.hour AND p.holiday = r.holiday
               AND p.dow = CASE WHEN r.holiday = 'regular' THEN r.dow ELSE -1 END),
        agg AS (
          SELECT hour, dow, holiday, CAST(sum(CAST(avg AS DECIMAL(18,3))) AS DOUBLE) AS total, count(*) FILTER (WHERE avg > 0) AS active_zones,
                 max(zone_id) FILTER (WHERE rn = 1) AS peak, max(avg) FILTER (WHERE rn = 1) AS peak_avg
          FROM sub GROUP BY 1, 2, 3),
        prev AS (SELECT hour, dow, CAST(sum(CAST(avg AS DECIMAL(18,3))) AS DOUBLE) AS prev FROM profile GROUP BY 1, 2)
        SELECT a.hour, a.dow, a.holiday, CAST(round_even(total, 0) AS BIGINT) AS total_trips, active_zones, peak AS peak_zone_id,
               coalesce(name, 'Zone ' || peak) AS peak_zone_name, CAST(round_even(peak_avg, 0) AS BIGINT) AS peak_zone_trips,
               CASE WHEN prev > 0 THEN round_even((total - prev) / prev * 100, 1) ELSE 0.0 END AS vs_prev_hour_pct
        FROM agg a LEFT JOIN prev p ON p.hour = a.hour - 1 AND p.dow = a.dow LEFT JOIN zones ON zone_id = peak""".lstrip(),
    ),
)
def kpis(spark, d):
    f = stored_fact(spark, d)
    return demand.kpis(cut_lineage(demand.demand_profile(f)), demand.requests_from_dates(f), tables.zones(spark, d))


@query(
    "hour_trend",
    with_(
        PROFILE,
        """SELECT dow, holiday, CAST(h AS INTEGER) AS hour, CAST(round_even(coalesce(CAST(sum(CAST(avg AS DECIMAL(18,3))) AS DOUBLE), 0), 0) AS BIGINT) AS trips
           FROM (SELECT DISTINCT dow, holiday FROM served) k CROSS JOIN range(24) t(h)
                LEFT JOIN served s USING (dow, holiday) WHERE s.hour = h OR s.hour IS NULL GROUP BY 1, 2, 3""",
    ),
)
def hour_trend(spark, d):
    return demand.hour_trend(stored_profile(spark, d))


@query(
    "borough_share",
    with_(
        PROFILE,
        """, parts AS (SELECT hour, dow, holiday, borough, CAST(sum(CAST(avg AS DECIMAL(18,3))) AS DOUBLE) AS part FROM served LEFT JOIN zones USING (zone_id) GROUP BY 1, 2, 3, 4),
        totals AS (SELECT *, CAST(sum(CAST(part AS DECIMAL(18,3))) OVER (PARTITION BY hour, dow, holiday) AS DOUBLE) AS total FROM parts)
        SELECT hour, dow, holiday, borough, round_even(part / total * 100, 1) AS share_pct FROM totals
        WHERE borough IS NOT NULL AND total > 0""".lstrip(),
    ),
)
def borough_share(spark, d):
    return demand.borough_share(profile(spark, d), tables.zones(spark, d))


@query(
    "zone_ranking",
    with_(
        PROFILE,
        """, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY hour, dow, holiday ORDER BY avg DESC, zone_id) AS rank,
                 max(avg) OVER (PARTITION BY hour, dow, holiday) AS top FROM served)
        SELECT r.hour, r.dow, r.holiday, rank, r.zone_id, coalesce(name, 'Zone ' || r.zone_id) AS name, coalesce(borough, '') AS borough,
               round_even(r.avg, 1) AS trips, CASE WHEN top > 0 THEN CAST(round_even(r.avg / top * 100, 0) AS BIGINT) END AS pct_of_max,
               CASE WHEN r.avg > coalesce(p.avg, r.avg) + 0.1 THEN 'up' WHEN r.avg < coalesce(p.avg, r.avg) - 0.1 THEN 'down' ELSE 'flat' END AS trend,
               r.zone_id IN (1, 132, 138) AS is_airport
        FROM ranked r LEFT JOIN served p ON p.zone_id = r.zone_id AND p.dow = r.dow AND p.holiday = r.holiday AND p.hour = greatest(0, r.hour - 1)
             LEFT JOIN zones z ON z.zone_id = r.zone_id
        WHERE rank <= 15""".lstrip(),
    ),
)
def zone_ranking(spark, d):
    return demand.zone_ranking(profile(spark, d), tables.zones(spark, d))


@query("zone_trend", with_(PROFILE, "SELECT zone_id, dow, holiday, hour, round_even(avg, 1) AS trips FROM served"))
def zone_trend(spark, d):
    return demand.zone_trend(profile(spark, d))


@query(
    "zone_level",
    with_(
        PROFILE,
        """, m AS (SELECT *, max(avg) OVER (PARTITION BY hour, dow, holiday) AS hour_max FROM served),
        p AS (SELECT *, CASE WHEN hour_max > 0 THEN CAST(round_even(round_even(avg, 1) / hour_max * 100, 0) AS BIGINT) ELSE 0 END AS demand_pct FROM m)
        SELECT hour, dow, holiday, zone_id, coalesce(name, 'Zone ' || zone_id) AS name, coalesce(borough, '') AS borough,
               round_even(avg, 1) AS trips, demand_pct,
               CASE WHEN demand_pct >= 65 THEN 'High' WHEN demand_pct >= 35 THEN 'Medium' ELSE 'Low' END AS demand_level
        FROM p LEFT JOIN zones USING (zone_id)""".lstrip(),
    ),
)
def zone_level(spark, d):
    return demand.zone_level(profile(spark, d), tables.zones(spark, d))


VOLATILITY = """volatility AS (
  SELECT zone_id, CAST(hour(time_bucket) AS INTEGER) AS hour,
         CASE WHEN avg(trip_count) > 0 THEN stddev_samp(trip_count) / avg(trip_count) ELSE 0.0 END AS volatility
  FROM fact GROUP BY 1, 2 HAVING count(*) > 1)"""
P75 = "p75 AS (SELECT zone_id, quantile_cont(avg, 0.75) AS threshold FROM profile GROUP BY 1)"
NEXT_HOUR = """next_hour AS (
  SELECT c.zone_id, c.hour, c.dow, c.holiday, c.avg AS demand_current, coalesce(n.avg, c.avg) AS demand_next_hour,
         CASE WHEN c.avg > 0 THEN CAST(round_even((coalesce(n.avg, c.avg) - c.avg) / c.avg * 100, 0) AS BIGINT) ELSE 0 END AS change_pct
  FROM served c LEFT JOIN served n ON n.zone_id = c.zone_id AND n.dow = c.dow AND n.holiday = c.holiday AND n.hour = (c.hour + 1) % 24)"""


@query("volatility", with_(f"{FACT}, {VOLATILITY}", "SELECT zone_id, hour, round(volatility, 6) AS volatility FROM volatility"))
def volatility(spark, d):
    return demand.volatility(fact(spark, d)).withColumn("volatility", F.round("volatility", 6))


@query("zone_p75", with_(f"{PROFILE}, {P75}", "SELECT zone_id, round(threshold, 6) AS threshold FROM p75"))
def zone_p75(spark, d):
    return demand.zone_threshold(profile(spark, d)).withColumn("threshold", F.round("threshold", 6))


@query("next_hour", with_(f"{PROFILE}, {NEXT_HOUR}", "SELECT * FROM next_hour"))
def next_hour(spark, d):
    return demand.next_hour(stored_profile(spark, d))


@query(
    "operator_zones",
    with_(
        f"{PROFILE}, {VOLATILITY}, {P75}, {NEXT_HOUR}",
        """, base AS (
          SELECT n.*, coalesce(name, 'Zone ' || n.zone_id) AS name, coalesce(borough, '') AS borough, coalesce(volatility, 0.0) AS vol,
                 CASE WHEN threshold > 0 AND demand_current > threshold
                      THEN CAST(greatest(0.0, round_even((demand_current - threshold) * least(0.30, 0.10 + (demand_current - threshold) / threshold * 0.20), 0)) AS BIGINT)
                      ELSE 0 END AS unmet_demand
          FROM next_hour n LEFT JOIN p75 USING (zone_id) LEFT JOIN volatility v ON v.zone_id = n.zone_id AND v.hour = n.hour
               LEFT JOIN zones z ON z.zone_id = n.zone_id),
        lab AS (
          SELECT *, CASE WHEN vol > 0.3 THEN 'high' WHEN vol > 0.15 THEN 'medium' ELSE 'low' END AS volatility_label,
                 CASE WHEN unmet_demand > 0 THEN 'tight' WHEN demand_current > 30 THEN 'balanced' ELSE 'light' END AS supply_status FROM base)
        SELECT *, row_number() OVER (PARTITION BY hour, dow, holiday ORDER BY unmet_demand DESC, demand_now DESC, zone_id) AS rank FROM (
        SELECT hour, dow, holiday, zone_id, name, borough, round_even(demand_current, 1) AS demand_now,
               round_even(demand_next_hour, 1) AS demand_next_hour, change_pct, unmet_demand,
               CAST(greatest(1, round_even(demand_current / 25, 0)) AS BIGINT) AS drivers_needed,
               CAST(round_even(demand_current * 13.5, 0) AS BIGINT) AS revenue_potential, supply_status, false AS is_forecast,
               'actual' AS forecast_source, volatility_label, round_even(vol, 2) AS volatility_score, 'stable' AS trend_direction,
               CASE WHEN supply_status = 'tight' AND volatility_label = 'high' THEN 'High demand + volatile. Raise surge cautiously.'
                    WHEN supply_status = 'tight' AND volatility_label = 'low' THEN 'High demand + stable. Can raise surge aggressively.' END AS action
        FROM lab)""".lstrip(),
    ),
)
def operator_zones(spark, d):
    f = stored_fact(spark, d)
    return demand.operator_zones(cut_lineage(demand.demand_profile(f)), f, tables.zones(spark, d))


@query(
    "recommendations",
    with_(
        f"{PROFILE}, {FARES}, {CENTROIDS}",
        f""", s AS (SELECT *, max(avg) OVER (PARTITION BY hour, dow, holiday) AS top FROM served),
        priced AS (
          SELECT s.*, coalesce(name, 'Zone ' || s.zone_id) AS name, coalesce(borough, '') AS borough, lat, lon,
                 least(100.0, greatest(5.0, coalesce(avg_fare, 18.70))) AS fare, least(4, CAST(trunc(avg) AS BIGINT)) AS trips_max
          FROM s LEFT JOIN zones z ON z.zone_id = s.zone_id LEFT JOIN centroids c ON c.zone_id = s.zone_id
               LEFT JOIN fares f ON f.zone_id = s.zone_id AND f.hour = s.hour),
        cand AS (
          SELECT a.hour, a.dow, a.holiday, a.zone_id AS origin_id, b.zone_id, b.name, b.borough, b.avg, b.fare, b.trips_max, {DRIVE} AS mins,
                 CASE WHEN b.top > 0 THEN CAST(round_even(b.avg / b.top * 100, 0) AS BIGINT) END AS score
          FROM priced a JOIN priced b ON a.hour = b.hour AND a.dow = b.dow AND a.holiday = b.holiday
          WHERE b.zone_id NOT IN (1, 132, 138) AND a.zone_id <> b.zone_id),
        options AS (
          SELECT hour, dow, holiday, origin_id, zone_id, name, borough, avg, fare, trips_max, mins, score, trips_max * fare / (mins + 20) AS eff FROM cand
          UNION ALL
          SELECT hour, dow, holiday, zone_id, zone_id, 'Stay: ' || name, borough, avg, fare, trips_max, 0, 100, 999.0 FROM priced
          WHERE top > 0 AND avg / top > 0.7),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY hour, dow, holiday, origin_id ORDER BY eff DESC, score DESC, zone_id) AS rank FROM options)
        SELECT hour, dow, holiday, origin_id, rank, zone_id, name, borough, round_even(avg, 1) AS trips, CAST(score AS BIGINT) AS demand_score,
               CAST(mins AS BIGINT) AS drive_minutes, CAST(trunc(fare) AS BIGINT) AS est_yield_min,
               CAST(trunc(trips_max * fare) AS BIGINT) AS est_yield_max, round(eff, 6) AS efficiency_score
        FROM ranked WHERE rank <= 3""".lstrip(),
    ),
)
def recommendations(spark, d):
    return demand.recommendations(stored_profile(spark, d), tables.zones(spark, d), fares(spark, d), centroids(spark, d))


LAG_SQL = ", ".join(
    f"max(trip_count::DOUBLE) OVER (w RANGE BETWEEN INTERVAL {15 * k} MINUTE PRECEDING AND INTERVAL {15 * k} MINUTE PRECEDING) AS {n}"
    for n, k in features.LAGS.items()
)
ROLL_SQL = ", ".join(
    f"avg(trip_count) OVER (w RANGE BETWEEN INTERVAL {15 * (k - 1)} MINUTE PRECEDING AND CURRENT ROW) AS {n}"
    for n, k in features.ROLLING.items()
)
WINDOW_SQL = "WINDOW w AS (PARTITION BY zone_id ORDER BY time_bucket)"


@query("lag_features", with_(FACT, f"SELECT zone_id, time_bucket, trip_count, {LAG_SQL} FROM fact {WINDOW_SQL}"))
def lag_features(spark, d):
    return features.with_lags(fact(spark, d)).drop("is_holiday")


@query(
    "rolling_means",
    with_(
        FACT,
        "SELECT zone_id, time_bucket, " + ", ".join(f"round({n}, 6) AS {n}" for n in features.ROLLING)
        + f" FROM (SELECT zone_id, time_bucket, {ROLL_SQL} FROM fact {WINDOW_SQL})",
    ),
)
def rolling_means(spark, d):
    out = features.with_rolling(fact(spark, d))
    return out.select("zone_id", "time_bucket", *[F.round(c, 6).alias(c) for c in features.ROLLING])


FEATURE_CTES = f"""{FACT},
feat AS (SELECT *, {LAG_SQL}, {ROLL_SQL}, CAST(hour(time_bucket) * 4 + minute(time_bucket) // 15 AS INTEGER) AS slot_of_day FROM fact {WINDOW_SQL}),
slotbase AS (SELECT zone_id, slot_of_day, avg(trip_count) AS zone_slot_baseline FROM feat WHERE time_bucket < TIMESTAMP '2024-01-16' GROUP BY 1, 2)"""


@query(
    "feature_table",
    with_(
        FEATURE_CTES,
        """SELECT time_bucket, trip_count, f.zone_id, CAST(hour(time_bucket) AS INTEGER) AS hour, CAST(minute(time_bucket) AS INTEGER) AS minute,
             CAST(isodow(time_bucket) - 1 AS INTEGER) AS dayofweek, CASE WHEN isodow(time_bucket) >= 6 THEN 1 ELSE 0 END AS is_weekend,
             CAST(month(time_bucket) AS INTEGER) AS month, CAST(dayofyear(time_bucket) AS INTEGER) AS dayofyear,
             CAST(weekofyear(time_bucket) AS INTEGER) AS weekofyear, CAST(year(time_bucket) AS INTEGER) AS year, f.slot_of_day,
             round(sin(2 * pi() * hour(time_bucket) / 24), 6) + 0 AS hour_sin, round(cos(2 * pi() * hour(time_bucket) / 24), 6) + 0 AS hour_cos,
             round(sin(2 * pi() * (isodow(time_bucket) - 1) / 7), 6) + 0 AS dow_sin, round(cos(2 * pi() * (isodow(time_bucket) - 1) / 7), 6) + 0 AS dow_cos,
             round(sin(2 * pi() * month(time_bucket) / 12), 6) + 0 AS month_sin, round(cos(2 * pi() * month(time_bucket) / 12), 6) + 0 AS month_cos,
             is_holiday, CASE WHEN time_bucket >= TIMESTAMP '2025-01-05' THEN 1 ELSE 0 END AS cbd_pricing_active,
             CASE WHEN f.zone_id IN (1, 132, 138) THEN 1 ELSE 0 END AS is_airport_zone, borough_id, service_zone_id,
             round(zone_slot_baseline, 6) + 0 AS zone_slot_baseline, lag_15min + 0 AS lag_15min, lag_1h + 0 AS lag_1h, lag_2h + 0 AS lag_2h,
             lag_1day + 0 AS lag_1day, lag_1week + 0 AS lag_1week, round(roll_mean_1h, 6) + 0 AS roll_mean_1h,
             round(roll_mean_2h, 6) + 0 AS roll_mean_2h, round(roll_mean_1day, 6) + 0 AS roll_mean_1day
           FROM feat f LEFT JOIN slotbase b ON b.zone_id = f.zone_id AND b.slot_of_day = f.slot_of_day LEFT JOIN zones z ON z.zone_id = f.zone_id""",
    ),
)
def feature_table(spark, d):
    out = features.feature_table(stored_fact(spark, d), tables.zones(spark, d), before="2024-01-16")
    doubles = [f.name for f in out.schema.fields if f.dataType.simpleString() == "double"]
    return out.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in doubles})


@query(
    "zone_history",
    with_(
        FACT,
        """SELECT zone_id, time_bucket, trip_count FROM (
             SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY time_bucket DESC) AS rn FROM fact) WHERE rn <= 672""",
    ),
)
def zone_history(spark, d):
    return features.zone_history(fact(spark, d)).select("zone_id", "time_bucket", "trip_count")


@query(
    "zone_constants",
    with_(
        FACT,
        """SELECT zone_id, arg_min(trip_count, time_bucket) AS trip_count, arg_min(is_holiday, time_bucket) AS is_holiday FROM fact GROUP BY 1""",
    ),
)
def zone_constants(spark, d):
    return features.zone_constants(fact(spark, d), ["trip_count", "is_holiday"])


@query(
    "zone_counts",
    with_(
        FACT,
        """SELECT CASE WHEN time_bucket < TIMESTAMP '2024-01-16' THEN 'baseline' ELSE 'new' END AS win, count(DISTINCT zone_id) AS zones,
             count(DISTINCT zone_id) FILTER (WHERE trip_count > 0) AS active_zones, count(DISTINCT CAST(time_bucket AS DATE)) AS dates
           FROM fact GROUP BY 1""",
    ),
)
def zone_counts(spark, d):
    win = F.when(F.col("time_bucket") < F.lit("2024-01-16").cast("timestamp_ntz"), "baseline").otherwise("new")
    return (
        fact(spark, d)
        .groupBy(win.alias("win"))
        .agg(
            F.count_distinct("zone_id").alias("zones"),
            F.count_distinct(F.when(F.col("trip_count") > 0, F.col("zone_id"))).alias("active_zones"),
            F.count_distinct(F.to_date("time_bucket")).alias("dates"),
        )
    )
