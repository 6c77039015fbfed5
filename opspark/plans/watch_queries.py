"""Registered queries that watch data, access, latency and models."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomalies, drift, expectations, gates, latency, ledger, records, retraining
from ..plans.ranks import value_counts
from ..session import cut_lineage, scratch
from ..sources import policies, tables
from ..sources.literals import literal_table
from . import demand_queries as dq
from . import drift_queries as drq
from . import log_queries as lq
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


# Drift


def sql_wasserstein(groups: str) -> str:
    return f"""cum AS (
      SELECT {groups}, value, sum(n_base) OVER (w ORDER BY value) AS cb, sum(n_new) OVER (w ORDER BY value) AS cn, sum(n_base) OVER w AS nb, sum(n_new) OVER w AS nn,
             lead(value) OVER (w ORDER BY value) AS nxt FROM vc WINDOW w AS (PARTITION BY {groups})),
    ws AS (SELECT {groups}, sum(abs(cb / nb - cn / nn) * (coalesce(nxt, value) - value)) AS wasserstein, CAST(max(nb) AS BIGINT) AS n_base, CAST(max(nn) AS BIGINT) AS n_new
           FROM cum WHERE nb > 0 AND nn > 0 GROUP BY {groups})"""


@query(
    "wasserstein",
    with_(
        f"{drq.SCORED}, {drq.sql_unpivot(drq.DRIFT_FEATURES, 'borough_id AS segment')}, {drq.sql_counts('long', 'segment, feature')}, {sql_wasserstein('segment, feature')}",
        "SELECT segment, feature, round(wasserstein, 6) + 0 AS wasserstein, n_base, n_new FROM ws",
    ),
)
def wasserstein(spark, d):
    """How far every feature has moved, in its own unit, in each borough."""
    frame = drq.drift_frame(spark, d).withColumn("segment", F.col("borough_id"))
    counts = cut_lineage(drift.feature_counts(frame, drq.DRIFT_FEATURES, ["segment"]))
    return drq.rounded(drift.wasserstein(counts, ["segment", "feature"]), "wasserstein")


@query(
    "wasserstein_values",
    with_(f"{drq.EVENT_VALUES}, {drq.sql_counts('ev', 'event_type')}, {sql_wasserstein('event_type')}", "SELECT event_type, round(wasserstein, 6) + 0 AS wasserstein, n_base, n_new FROM ws"),
)
def wasserstein_values(spark, d):
    """The continuous event value by event type."""
    counts = cut_lineage(value_counts(drq.event_values(spark, d), ["event_type"], "value", drift.side_weights()))
    return drq.rounded(drift.wasserstein(counts, ["event_type"]), "wasserstein")


CHI = f"""cells AS (SELECT user_id % 25 AS zone_id, event_type, count(*) FILTER (WHERE ts < TIMESTAMP '{drq.SPLIT}') AS nb, count(*) FILTER (WHERE ts >= TIMESTAMP '{drq.SPLIT}') AS nn FROM events GROUP BY 1, 2),
tot AS (SELECT zone_id, sum(nb) AS ab, sum(nn) AS an, count(*) - 1 AS dof FROM cells GROUP BY 1),
chi AS (SELECT zone_id, CAST(max(ab) AS BIGINT) AS n_base, CAST(max(an) AS BIGINT) AS n_new, max(dof) AS dof,
  sum(power(nb - (nb + nn) * ab / (ab + an), 2) / ((nb + nn) * ab / (ab + an)) + power(nn - (nb + nn) * an / (ab + an), 2) / ((nb + nn) * an / (ab + an))) AS x
  FROM cells JOIN tot USING (zone_id) WHERE ab > 0 AND an > 0 AND dof > 0 GROUP BY 1)"""


@query(
    "chi_square",
    with_(
        CHI,
        """SELECT zone_id, n_base, n_new, CAST(dof AS INTEGER) AS dof, round(x, 6) + 0 AS chi2,
             round(1 - list_sum(list_transform(range(0, 400), lambda k: exp(-x / 2 + (dof / 2.0 + k) * ln(x / 2) - lgamma(dof / 2.0 + k + 1)))), 9) + 0 AS pvalue FROM chi""",
    ),
)
def chi_square(spark, d):
    """Whether the mix of event types has changed in each zone; the SQL adds up the incomplete gamma function another way."""
    e = tables.table(spark, d, "events").select(F.pmod("user_id", F.lit(25)).alias("zone_id"), "event_type", "ts")
    out = drift.chi_square(drift.windows(e, drq.SPLIT, drq.SPLIT, ts="ts"), ["zone_id"], "event_type")
    return drq.rounded(drq.rounded(out, "chi2"), "pvalue", places=9)


# Expectations

RULES = [
    ("not_null", "user_id", None, None, None, None, 1.0, "critical"),
    ("in_set", "event_type", None, None, ["view", "click"], None, 1.0, "critical"),
    ("in_set", "event_type", None, None, ["view", "click", "purchase", "error"], None, 0.5, "warning"),
    ("between", "value", 0.0, 200.0, None, None, 1.0, "warning"),
    ("between", "value", 0.0, None, None, None, 1.0, "critical"),
    ("between", "value", None, 100.0, None, None, 0.99, "warning"),
    ("regex", "props", None, None, None, '^\\{"k": [0-9]+\\}$', 1.0, "critical"),
    ("regex", "props", None, None, None, '"k": [1-9]', 0.999, "warning"),
    ("columns_match", None, None, None, ["event_id", "ts", "user_id", "event_type", "value", "props"], None, 1.0, "critical"),
    ("columns_match", None, None, None, ["event_id", "ts", "user_id", "kind", "value", "props"], None, 1.0, "warning"),
    ("not_null", "session_id", None, None, None, None, 1.0, "critical"),
]


def _rule_sql(where: str, tested: str, mostly: float, severity: str, text: str) -> str:
    quoted = text.replace("'", "''")
    return f"""SELECT 'expectations' AS "check", '{severity}' AS severity, '{quoted} expected' AS description, count(*) FILTER (WHERE {where}) AS affected_rows FROM events
      HAVING count(*) FILTER (WHERE {tested}) - count(*) FILTER (WHERE {where}) < {mostly} * count(*) FILTER (WHERE {tested})"""


def _rules_sql() -> str:
    parts = []
    for kind, column, low, high, allowed, pattern, mostly, severity in RULES:
        rule = expectations.Rule(kind, column, low, high, allowed, pattern, mostly, severity)
        if kind == "columns_match" or column == "session_id":
            continue
        tested = f"{column} IS NOT NULL"
        where = {
            "not_null": f"{column} IS NULL",
            "in_set": f"{column} NOT IN ({', '.join(repr(a) for a in allowed or ['-'])})",
            "between": " OR ".join([f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)),
            "regex": f"NOT regexp_matches({column}, '{pattern}')",
        }[kind]
        parts.append(_rule_sql(where, "true" if kind == "not_null" else tested, mostly, severity, rule.text()))
    parts.append("""SELECT 'expectations', 'warning', 'columns {event_id, kind, props, ts, user_id, value} expected', 0""")
    parts.append("""SELECT 'expectations', 'critical', 'column session_id is missing', 0""")
    return "\nUNION ALL ".join(parts)


@query("expectation_rules", _rules_sql())
def expectation_rules(spark, d):
    """A table of rules over the events: one scan, failures as issues."""
    rules = expectations.rule_table(literal_table(spark, RULES, expectations.RULES))
    return expectations.check(tables.table(spark, d, "events"), rules).select("check", "severity", "description", "affected_rows")


# Access

ACCESS = """log AS (SELECT user_id % 40 AS user_id, ts, event_id, 'document:' || (event_id % 61) AS resource, event_type <> 'error' AND event_id % 5 > 1 AS allowed FROM events),
num AS (SELECT *, sum(CASE WHEN allowed THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM log),
denials AS (SELECT user_id, count(*) AS n, min(ts) AS first_time, max(ts) AS last_time FROM num WHERE NOT allowed GROUP BY user_id, run HAVING count(*) >= 5),
acc AS (SELECT DISTINCT user_id, resource, epoch_us(ts) AS us FROM log WHERE allowed),
seen AS (SELECT a.user_id, a.us, count(DISTINCT b.resource) AS n FROM acc a JOIN acc b ON b.user_id = a.user_id AND b.us <= a.us AND b.us > a.us - 86400000000 GROUP BY 1, 2),
bulk AS (SELECT user_id, max(n) AS n, arg_max(us, (n, -us)) AS us FROM seen GROUP BY 1 HAVING max(n) >= 10),
away AS (SELECT user_id, count(*) FILTER (WHERE off) AS n, count(*) AS total, min(ts) FILTER (WHERE off) AS first_time, max(ts) FILTER (WHERE off) AS last_time
         FROM (SELECT *, isodow(ts) >= 6 OR hour(ts) < 7 OR hour(ts) >= 19 AS off FROM log) GROUP BY 1)"""


def access_log(spark: SparkSession, d: str) -> DataFrame:
    """The events as accesses of forty users to documents; errors and two fifths of the rest are denied."""
    e = tables.table(spark, d, "events")
    allowed = (F.col("event_type") != "error") & (F.col("event_id") % 5 > 1)
    resource = F.concat(F.lit("document:"), (F.col("event_id") % 61).cast("string"))
    return e.select(F.pmod("user_id", F.lit(40)).alias("user_id"), "ts", "event_id", resource.alias("resource"), allowed.alias("allowed"))


@query(
    "access_anomalies",
    with_(
        ACCESS,
        """SELECT 'denial_spike' AS finding, user_id, 'critical' AS severity, n, first_time, last_time FROM denials
           UNION ALL SELECT 'bulk_access', user_id, 'warning', n, CAST(make_timestamp(us) AS TIMESTAMP), CAST(make_timestamp(us) AS TIMESTAMP) FROM bulk
           UNION ALL SELECT 'off_hours', user_id, 'warning', n, first_time, last_time FROM away WHERE n >= 10 AND n >= 0.64 * total""",
    ),
)
def access_anomalies(spark, d):
    """Runs of denials, users who see many documents within a day, and users who mostly come off hours."""
    return anomalies.findings(access_log(spark, d), denials=5, window_seconds=86400, resources=10, away=10, share=0.64)


# Latency

G = latency.growth(latency.ERROR)
LATENCY = f"""sk AS (SELECT event_type AS component, CAST(ceil(ln(greatest(value, {latency.SMALLEST})) / {math.log(G)!r}) AS BIGINT) AS bucket, count(*) AS n
  FROM events WHERE value IS NOT NULL AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1, 2),
rk AS (SELECT *, sum(n) OVER (PARTITION BY component ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY component) AS total FROM sk)"""


@query(
    "latency_quantiles",
    with_(
        LATENCY,
        "SELECT component, CAST(max(total) AS BIGINT) AS n, "
        + ", ".join(f"round(min(power({G!r}, bucket) * {2 / (G + 1)!r}) FILTER (WHERE upto > floor({q} * (total - 1))), 6) AS {p}" for p, q in latency.QUANTILES.items())
        + " FROM rk GROUP BY 1",
    ),
)
def latency_quantiles(spark, d):
    """Sketches stored by day in two batches; a period in the middle is merged from its days."""
    e = tables.table(spark, d, "events").select("event_type", "value", "ts")
    path = scratch(spark, "latency")
    early = F.col("ts") < F.lit(drq.SPLIT).cast("timestamp_ntz")
    for part in (e.where(early), e.where(~early)):
        latency.store_days(latency.sketch(part, "event_type", "value", "ts"), path)
    out = latency.quantiles(latency.stored(spark, path, "2024-01-05", "2024-01-20"))
    return out.withColumns({p: F.round(p, 6) for p in latency.QUANTILES})


# Retraining

HISTORY = f"""{FACT},
daily AS (SELECT zone_id, CAST(time_bucket AS DATE) AS day, sum(trip_count) AS trips FROM fact GROUP BY 1, 2),
hist AS (SELECT zone_id, day, abs(trips * n - total) * 100 > 15 * total AS alerted FROM (
  SELECT *, sum(trips) OVER (PARTITION BY zone_id) AS total, count(*) OVER (PARTITION BY zone_id) AS n FROM daily)),
al AS (SELECT zone_id, day, row_number() OVER (PARTITION BY zone_id ORDER BY day) AS rn FROM hist WHERE alerted),
fold AS (
  SELECT zone_id, rn, day, false AS due, [day] AS open, DATE '1900-01-01' AS last FROM al WHERE rn = 1
  UNION ALL
  SELECT a.zone_id, a.rn, a.day, a.day > f.last + 4 AND len(list_filter(f.open, lambda x: x > a.day - 7)) + 1 >= 3,
         CASE WHEN a.day > f.last + 4 AND len(list_filter(f.open, lambda x: x > a.day - 7)) + 1 >= 3 THEN [] ELSE list_append(list_filter(f.open, lambda x: x > a.day - 7), a.day) END,
         CASE WHEN a.day > f.last + 4 AND len(list_filter(f.open, lambda x: x > a.day - 7)) + 1 >= 3 THEN a.day ELSE f.last END
  FROM fold f JOIN al a ON a.zone_id = f.zone_id AND a.rn = f.rn + 1)"""


@query("retraining_triggers", f"WITH RECURSIVE {HISTORY}\nSELECT zone_id AS model, day FROM fold WHERE due")
def retraining_triggers(spark, d):
    """A zone's model is due after three alert days in a week, then rests four days; an alert is a day 15 % off the zone's mean."""
    daily = dq.fact(spark, d).groupBy("zone_id", F.to_date("time_bucket").alias("day")).agg(F.sum("trip_count").alias("trips"))
    daily = cut_lineage(daily)
    total = daily.groupBy("zone_id").agg(F.sum("trips").alias("total"), F.count(F.lit(1)).alias("n"))
    history = daily.join(total, "zone_id").withColumn("alerted", F.abs(F.col("trips") * F.col("n") - F.col("total")) * 100 > 15 * F.col("total"))
    return retraining.triggers(history, "zone_id", "day", "alerted", k=3, n=7, cooldown=4)


# Costs, answers and records


@query(
    "costs_by_model",
    with_(
        lq.PRICED,
        """SELECT 'model' AS grouping, model AS item, count(*) AS queries, round(sum(cost), 9) AS cost FROM priced GROUP BY 2
           UNION ALL SELECT 'user_role', user_role, count(*), round(sum(cost), 9) FROM priced GROUP BY 2
           UNION ALL SELECT 'day', CAST(CAST(ts AS DATE) AS VARCHAR), count(*), round(sum(cost), 9) FROM priced GROUP BY 2
           UNION ALL SELECT 'all', 'all', count(*), round(sum(cost), 9) FROM priced""",
    ),
)
def costs_by_model(spark, d):
    """Token costs of the query log by model, role and day."""
    rows = lq.priced(spark, d).withColumn("day", F.to_date("ts"))
    return ledger.costs_by(rows, ["model", "user_role", "day"], cost="cost").withColumn("cost", F.round("cost", 9))


@query(
    "budget_monthly",
    with_(
        f"{lq.BUDGETS}, " + lq.REQUESTS.split("rated AS")[0].rstrip().rstrip(",").replace("SELECT event_id, user_id, ts,", "SELECT event_id, user_id, ts + to_days(CAST(event_id % 90 AS INTEGER)) AS ts,", 1).replace("ORDER BY ts", "ORDER BY events.ts")
        + """, gated AS (SELECT s.*, coalesce(sum(cost) OVER (PARTITION BY user_id, date_trunc('month', ts) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      budget FROM (SELECT * REPLACE (CAST(cost AS DECIMAL(18,6)) AS cost) FROM req) s LEFT JOIN budgets b ON b.role = s.user_role)""",
        "SELECT event_id, user_id, before <= CAST(coalesce(budget, 0) - 0.01 AS DECIMAL(18,6)) AS allowed FROM gated",
    ),
)
def budget_monthly(spark, d):
    """Requests spread over four months; every month has its own budget."""
    days = F.make_dt_interval((F.col("event_id") % 90).cast("int"))
    asked = lq.requests(spark, d).withColumn("ts", F.col("ts") + days)
    return gates.monthly_budget_gate(asked, policies.role_budgets(spark)).select("event_id", "user_id", "allowed")


@query(
    "answer_consistency",
    with_(
        lq.AGAIN,
        """SELECT cache_key, user_role, CAST(sum(n) AS BIGINT) AS asked, count(*) AS answers, round(max(n) / sum(n), 9) AS agreement, min(first) FILTER (WHERE h <> start) AS drifted_at
           FROM (SELECT *, first_value(h) OVER (PARTITION BY cache_key, user_role ORDER BY first, h) AS start FROM (
             SELECT lower(regexp_replace(query, '^\\s+|\\s+$', '', 'g')) AS cache_key, user_role, sha256(regexp_replace(answer, '^\\s+|\\s+$', '', 'g')) AS h, count(*) AS n, min(ts) AS first FROM again GROUP BY 1, 2, 3))
           GROUP BY 1, 2 HAVING sum(n) > 1""",
    ),
)
def answer_consistency(spark, d):
    """Questions asked again, with the share of the most common answer and the time at which it changed."""
    return ledger.answer_consistency(lq.repeated_log(spark, d)).withColumn("agreement", F.round("agreement", 9))


EXPENSES = """expenses AS (SELECT o_orderkey AS expense_id, o_custkey AS employee_id, CASE o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'pending' ELSE 'rejected' END AS status,
  o_orderpriority AS category, o_orderdate AS date, o_totalprice AS amount, o_custkey % 40 AS project_id FROM orders)"""


def expenses(spark: SparkSession, d: str) -> DataFrame:
    """Orders as expense records."""
    status = F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "pending").otherwise("rejected")
    return tables.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("expense_id"), F.col("o_custkey").alias("employee_id"), status.alias("status"), F.col("o_orderpriority").alias("category"),
        F.col("o_orderdate").alias("date"), F.col("o_totalprice").alias("amount"), (F.col("o_custkey") % 40).alias("project_id"),
    )


@query(
    "expense_search",
    with_(
        EXPENSES,
        """SELECT expense_id, employee_id, status, category, date, amount FROM expenses
           WHERE status = 'pending' AND category = '1-URGENT' AND date >= TIMESTAMP '1995-01-01' AND date < TIMESTAMP '1996-07-01'""",
    ),
)
def expense_search(spark, d):
    found = records.find_expenses(expenses(spark, d), status="pending", category="1-URGENT", first="1995-01-01", last="1996-06-30")
    return found.select("expense_id", "employee_id", "status", "category", "date", "amount")


@query(
    "project_totals",
    with_(
        EXPENSES,
        """SELECT project_id, round(CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS DOUBLE) / 100, 2) AS amount, round(coalesce(sum(CAST(round(amount * 100) AS BIGINT)) FILTER (WHERE status = 'approved'), 0) / sum(CAST(round(amount * 100) AS BIGINT)), 9) AS approved_share,
             count(*) AS rows, count(DISTINCT employee_id) AS people FROM expenses GROUP BY 1""",
    ),
)
def project_totals(spark, d):
    out = records.project_totals(expenses(spark, d))
    return out.withColumns({"amount": F.round("amount", 2), "approved_share": F.round("approved_share", 9)})


@query(
    "salary_bands",
    with_(
        lq.PEOPLE,
        """SELECT department, count(*) AS people, round(quantile_cont(CAST(salary AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST(salary AS DOUBLE), 0.5), 6) AS median,
             round(quantile_cont(CAST(salary AS DOUBLE), 0.75), 6) AS p75 FROM people GROUP BY 1 HAVING count(*) >= 5""",
    ),
)
def salary_bands(spark, d):
    """Quartiles of salaries by department: a band shows no single person."""
    out = records.salary_bands(tables.employees(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("p25", "median", "p75")})
