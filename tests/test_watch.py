import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from opspark.functions.scores import chi_square_pvalue, log_gamma_half
from opspark.operators import anomalies, drift, expectations, gates, latency, ledger, records, retraining
from opspark.plans.ranks import running_sums, value_counts
from opspark.session import cut_lineage
from opspark.sources import logs
from opspark.sources.literals import literal_table


def test_chi_square_tail_against_tabled_values(spark):
    # Upper 5 %, 1 % and 0.1 % points of the chi-square table, and closed forms for 2 and 4 degrees of freedom.
    rows = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (11.344866730144373, 3, 0.01), (18.307038053275146, 10, 0.05), (29.58829844507442, 10, 0.001)]
    rows += [(43.772971825742, 30, 0.05), (124.34211340400407, 100, 0.05)]
    rows += [(x, 2, math.exp(-x / 2)) for x in (0.01, 1.0, 7.5, 300.0)] + [(x, 4, math.exp(-x / 2) * (1 + x / 2)) for x in (0.5, 4.0, 40.0)]
    rows += [(x, 1, math.erfc(math.sqrt(x / 2))) for x in (1e-6, 0.2, 2.9, 3.1, 50.0)] + [(0.0, 5, 1.0)]
    got = literal_table(spark, rows, "x double, dof int, p double").withColumn("got", chi_square_pvalue(F.col("x"), F.col("dof"))).collect()
    assert all(abs(r.got - r.p) < 1e-9 for r in got), got
    big = spark.range(1).select(chi_square_pvalue(F.lit(10000.0), F.lit(10000)).alias("p")).first().p
    assert 0.49 < big < 0.5
    gammas = literal_table(spark, [(n, math.lgamma(n / 2)) for n in range(1, 40)], "n int, g double")
    assert all(abs(r.got - r.g) < 1e-9 for r in gammas.withColumn("got", log_gamma_half(F.col("n"))).collect())


def test_chi_square_of_windows(spark):
    rows = [("a", "x", False)] * 30 + [("a", "y", False)] * 10 + [("a", "x", True)] * 20 + [("a", "y", True)] * 20
    rows += [("one", "x", False), ("one", "x", True), ("empty", "x", True), ("empty", "y", True), (None, None, True), (None, "y", False), (None, "y", True)]
    got = {r.g: r for r in drift.chi_square(literal_table(spark, rows, "g string, c string, is_new boolean"), ["g"], "c").collect()}
    assert got["a"].dof == 1 and abs(got["a"].chi2 - 80 * (30 * 20 - 10 * 20) ** 2 / (40 * 40 * 50 * 30)) < 1e-9
    assert got["one"].chi2 is None and got["empty"].pvalue is None and got[None].dof == 1
    whole = drift.chi_square(literal_table(spark, rows[:80], "g string, c string, is_new boolean"), [], "c").first()
    assert whole.chi2 == got["a"].chi2


def test_wasserstein_across_pieces(spark):
    rnd = random.Random(4)
    base, new = [round(rnd.gauss(0, 1), 3) for _ in range(900)], [round(rnd.gauss(0.7, 1.4), 3) for _ in range(700)]
    rows = [("g", v, False) for v in base] + [("g", v, True) for v in new] + [("same", 1.0, False), ("same", 1.0, True), ("half", 2.0, False)]
    counts = cut_lineage(value_counts(literal_table(spark, rows, "g string, value double, is_new boolean"), ["g"], "value", drift.side_weights()))
    got = {r.g: r.wasserstein for r in drift.wasserstein(counts, ["g"]).collect()}
    points = sorted(set(base + new))
    at = lambda xs, v: sum(x <= v for x in xs) / len(xs)
    want = sum(abs(at(base, a) - at(new, a)) * (b - a) for a, b in zip(points, points[1:]))
    assert abs(got["g"] - want) < 1e-9 and got["same"] == 0 and "half" not in got


def test_running_sums_across_parts(spark):
    rows = [(u, i, i // 7, i % 3) for u in (1, 2) for i in range(50)]
    out = running_sums(literal_table(spark, rows, "u int, i int, part int, x int"), ["u"], "part", ["i"], {"upto": "x"})
    assert {(r.u, r.i): r.upto for r in out.collect()} == {(u, i): sum(k % 3 for k in range(i + 1)) for u in (1, 2) for i in range(50)}


def test_expectations_one_scan_and_every_kind(spark):
    df = literal_table(spark, [(1, "a", 5.0), (2, "b", -1.0), (None, "zz", None)], "k int, s string, v double")
    R = expectations.Rule
    rules = [R("not_null", "k"), R("not_null", "k", mostly=0.6), R("in_set", "s", allowed=["a", "b"], severity="warning"), R("between", "v", low=0.0), R("between", "v", low=-5.0, high=5.0)]
    rules += [R("regex", "s", pattern="^[a-z]$"), R("columns_match", allowed=["s", "k", "V"]), R("columns_match", allowed=["k", "s", "w"]), R("regex", "gone", pattern="x")]
    out = expectations.check(df, rules)
    got = {(r.description, r.severity, r.affected_rows) for r in out.collect()}
    assert got == {
        ("k not null expected", "critical", 1),
        ("s in {a, b} expected", "warning", 1),
        ("v between 0.0 and None expected", "critical", 1),
        ("s like /^[a-z]$/ expected", "critical", 1),
        ("columns {k, s, w} expected", "critical", 0),
        ("column gone is missing", "critical", 0),
    }
    details = {r.description: r.details for r in out.collect()}
    assert details["columns {k, s, w} expected"] == {"missing": "w", "unexpected": "v"} and details["v between 0.0 and None expected"]["tested"] == "2"
    assert expectations.check(df.where("false"), rules).where("affected_rows > 0").count() == 0
    with pytest.raises(ValueError):
        expectations.rule_table(literal_table(spark, [("odd", "k")], "kind string, column string"))


def log_rows(n, seed, spread):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 5, 6)
    times = sorted(rnd.randrange(spread) for _ in range(n))
    return [(rnd.randint(1, 3), start + dt.timedelta(seconds=t), i, f"r{rnd.randint(0, 12)}", rnd.random() < 0.5) for i, t in enumerate(times)]


LOG = "user_id bigint, ts timestamp_ntz, event_id bigint, resource string, allowed boolean"


def test_denial_runs(spark):
    rows = log_rows(400, 5, 40_000)
    got = {(r.user_id, r.first_time, r.last_time): r.n for r in anomalies.denial_runs(literal_table(spark, rows, LOG), 3, 600).collect()}
    want, open_ = {}, {}
    for user, t, _, _, ok in [*rows, *[(u, None, 0, "", True) for u in (1, 2, 3)]]:
        if not ok:
            open_.setdefault(user, []).append(t)
        else:
            run = open_.pop(user, [])
            if len(run) >= 3:
                want[(user, run[0], run[-1])] = len(run)
    assert got == want and want


def test_bulk_access_counts_distinct_resources_in_any_window(spark):
    rows = log_rows(300, 6, 9_000)
    rows += [(9, dt.datetime(2024, 1, 5, 6), 900 + i, f"r{i % 4}", True) for i in range(8)]
    got = {r.user_id: (r.n, r.first_time) for r in anomalies.bulk_access(literal_table(spark, rows, LOG), 700, 1).collect()}
    want = {}
    for user in (1, 2, 3, 9):
        own = [(t, x) for u, t, _, x, ok in rows if u == user and ok]
        seen = {t: len({x for s, x in own if t - dt.timedelta(seconds=700) < s <= t}) for t, _ in own}
        most = max(seen.values())
        want[user] = (most, min(t for t, n in seen.items() if n == most))
    assert got == want


def test_off_hours(spark):
    rows = [(1, dt.datetime(2024, 1, 6, 12), 1, "r", True), (1, dt.datetime(2024, 1, 8, 6, 59), 2, "r", True), (1, dt.datetime(2024, 1, 8, 7), 3, "r", True)]
    rows += [(2, dt.datetime(2024, 1, 8, 19), 4, "r", False), (3, dt.datetime(2024, 1, 8, 18, 59), 5, "r", True)]
    got = anomalies.findings(literal_table(spark, rows, LOG), away=1, share=0.6, resources=99).where("finding = 'off_hours'")
    assert {(r.user_id, r.n) for r in got.collect()} == {(1, 2), (2, 1)}


def test_latency_sketches_merge_and_keep_their_error(spark, tmp_path):
    rnd = random.Random(8)
    rows = [("db", math.exp(rnd.gauss(2, 1.5)), dt.datetime(2024, 1, 1 + i % 3)) for i in range(3000)] + [("api", 5.0, dt.datetime(2024, 1, 1)), ("api", None, dt.datetime(2024, 1, 1))]
    frame = literal_table(spark, rows, "component string, ms double, ts timestamp_ntz")
    path = str(tmp_path / "days")
    for day in (1, 2, 3, 2):
        latency.store_days(latency.sketch(frame.where(F.dayofmonth("ts") == day), "component", "ms", "ts"), path)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("*.parquet") if "day=2024-01-01" in str(p)}
    latency.store_days(latency.sketch(frame.where(F.dayofmonth("ts") == 3), "component", "ms", "ts"), path)
    assert before and all(p.stat().st_mtime_ns == t for p, t in before.items())
    got = {r.component: r for r in latency.quantiles(latency.stored(spark, path, "2024-01-01", "2024-01-03")).collect()}
    values = sorted(v for c, v, _ in rows if c == "db")
    for name, q in latency.QUANTILES.items():
        exact = values[int(q * (len(values) - 1))]
        assert abs(got["db"][name] - exact) <= latency.ERROR * exact * 1.0001
    assert got["db"].n == 3000 and got["api"].n == 1 and abs(got["api"].p99 - 5) <= 0.05
    part = {r.component: r.n for r in latency.quantiles(latency.stored(spark, path, "2024-01-02", "2024-01-02")).collect()}
    assert part == {"db": 1000}


def test_retraining_state_machine(spark):
    rnd = random.Random(2)
    first = dt.date(2024, 1, 1)
    rows = [(m, first + dt.timedelta(days=i), rnd.random() < p) for m, p in (("a", 0.5), ("b", 0.2), ("c", 0.0)) for i in range(60) if rnd.random() < 0.9]
    rows += [("a", first, True), ("d", first, None), ("d", None, True)]
    got = {(r.model, r.day) for r in retraining.triggers(literal_table(spark, rows, "model string, day date, alerted boolean"), "model", "day", "alerted", 3, 7, 4).collect()}
    want = set()
    for model in "abcd":
        last, open_ = dt.date(1900, 1, 1), []
        for day in sorted({d for m, d, a in rows if m == model and a and d}):
            open_ = [x for x in open_ if (day - x).days < 7] + [day]
            if (day - last).days > 4 and len(open_) >= 3:
                want.add((model, day))
                last, open_ = day, []
    assert got == want and want


def test_a_repeated_append_is_not_doubled(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [literal_table(spark, [(i, dt.datetime(2024, 1, 1 + i % 3)) for i in range(a, b)], "id bigint, timestamp timestamp_ntz") for a, b in ((0, 10), (10, 14))]
    for part in (0, 1, 1, 0):
        logs.append_log(rows[part], path, batch=f"run{part}")
    found = logs.scan_log(spark, path, F.col("log_date") == "2024-01-02")
    assert logs.scan_log(spark, path).count() == 14 and sorted(r.id for r in found.collect()) == [1, 4, 7, 10, 13]


def test_every_month_has_its_own_budget(spark):
    budgets = literal_table(spark, [("hr", 10.0)], "role string, budget double")
    rows = [(i, 1, dt.datetime(2024, m, 1 + i), "hr", 4.0) for m in (1, 2) for i in range(5)]
    log = literal_table(spark, rows, "event_id bigint, user_id bigint, ts timestamp_ntz, user_role string, cost double")
    got = [(r.ts.month, r.event_id, r.allowed) for r in gates.monthly_budget_gate(log, budgets, estimate=1.0).orderBy("ts").collect()]
    assert got == [(m, i, i < 3) for m in (1, 2) for i in range(5)]


def test_answers_that_change(spark):
    t = dt.datetime(2024, 1, 1)
    day = dt.timedelta(days=1)
    rows = [("What?", "hr", "a", t), (" what? ", "hr", "a ", t + day), ("what?", "hr", "b", t + 2 * day), ("what?", "it", "b", t), ("once", "hr", "x", t), ("same", None, None, t), ("same", None, "", t + day)]
    got = {(r.cache_key, r.user_role): (r.asked, r.answers, r.agreement, r.drifted_at) for r in ledger.answer_consistency(literal_table(spark, rows, "query string, user_role string, answer string, ts timestamp_ntz")).collect()}
    assert got == {("what?", "hr"): (3, 2, 2 / 3, t + 2 * day), ("same", None): (2, 1, 1.0, None)}


def test_salary_bands_show_no_single_person(spark):
    rows = [("a", float(v)) for v in (10, 20, 30, 40, 50)] + [("b", 1.0)] * 4
    got = records.salary_bands(literal_table(spark, rows, "department string, salary double")).collect()
    assert [(r.department, r.people, r.p25, r.median, r.p75) for r in got] == [("a", 5, 20.0, 30.0, 40.0)]


def test_expense_filters(spark):
    rows = [(1, 7, "pending", "x", dt.datetime(2024, 1, 31, 23), 5.5, 3), (2, 7, "approved", "x", dt.datetime(2024, 2, 1), 4.5, 3), (3, None, "approved", "y", None, 0.0, 4)]
    e = literal_table(spark, rows, "expense_id bigint, employee_id bigint, status string, category string, date timestamp_ntz, amount double, project_id bigint")
    ids = lambda **k: sorted(r.expense_id for r in records.find_expenses(e, **k).collect())
    assert ids() == [1, 2, 3] and ids(employee_id=7, last="2024-01-31") == [1] and ids(status="approved", category="x", first="2024-02-01", last="2024-02-01") == [2]
    got = {r.project_id: (r.amount, r.approved_share, r.rows, r.people) for r in records.project_totals(e).collect()}
    assert got == {3: (10.0, 0.45, 2, 1), 4: (0.0, None, 1, 0)}
