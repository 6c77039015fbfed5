"""Common table expressions shared by the checking SQL."""

from __future__ import annotations

from ..sources.calendars import MONTH_DAY_HOLIDAYS, federal_holidays


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


MONTH_DAY = "md(m, d, hname) AS (VALUES " + ", ".join(f"({m}, {d}, {_q(n)})" for m, d, n in MONTH_DAY_HOLIDAYS) + ")"
FEDERAL = "federal(fd, fname) AS (VALUES " + ", ".join(f"(DATE '{d}', {_q(n)})" for d, n in federal_holidays(range(2000, 2040))) + ")"

ZONES = """zones AS (
  SELECT CAST(n_nationkey AS BIGINT) AS zone_id, n_name AS name, r_name AS borough, n_regionkey AS borough_id,
         CASE WHEN n_nationkey IN (1, 132, 138) THEN 'Airports' ELSE 'Boro Zone' END AS service_zone,
         CASE WHEN n_nationkey IN (1, 132, 138) THEN 1 ELSE 0 END AS service_zone_id
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

FACT = f"""{ZONES}, {MONTH_DAY}, {FEDERAL},
grid AS (
  SELECT zone_id, time_bucket
  FROM zones, (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)) + INTERVAL 1425 MINUTE,
                                             INTERVAL 15 MINUTE)) AS time_bucket FROM events)),
counted AS (
  SELECT user_id % 25 AS zone_id, time_bucket(INTERVAL 15 MINUTE, ts) AS time_bucket, count(*) AS n
  FROM events GROUP BY 1, 2),
fact AS (
  SELECT g.zone_id, CAST(g.time_bucket AS TIMESTAMP) AS time_bucket, coalesce(n, 0) AS trip_count,
         CASE WHEN fd IS NULL THEN 0 ELSE 1 END AS is_holiday
  FROM grid g LEFT JOIN counted c ON c.zone_id = g.zone_id AND c.time_bucket = g.time_bucket
       LEFT JOIN federal ON fd = CAST(g.time_bucket AS DATE))"""

PROFILE = f"""{FACT},
profile AS (
  SELECT zone_id, CAST(hour(time_bucket) AS INTEGER) AS hour, CAST(isodow(time_bucket) - 1 AS INTEGER) AS dow,
         'regular' AS holiday, round_even(avg(trip_count), 3) AS avg
  FROM fact WHERE is_holiday = 0 GROUP BY 1, 2, 3
  UNION ALL
  SELECT zone_id, CAST(hour(time_bucket) AS INTEGER), -1, coalesce(hname, 'regular'), round_even(avg(trip_count), 3)
  FROM fact LEFT JOIN md ON m = month(time_bucket) AND d = day(time_bucket)
  WHERE is_holiday = 1 GROUP BY 1, 2, 4),
served AS (SELECT * FROM profile WHERE (dow = -1) = (holiday <> 'regular'))"""


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"
