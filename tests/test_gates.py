import datetime as dt
import random
from collections import deque

import numpy as np
import pytest

from opspark.operators import gates, ledger
from opspark.sources import policies
from opspark.sources.literals import literal_table

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "event_id bigint, user_id bigint, ts timestamp_ntz, user_role string, cost double"


def log(spark, rows):
    return literal_table(spark, rows, SCHEMA)


def brute_rate(rows, cap, width):
    kept, out = {}, {}
    for e, u, t, *_ in sorted(rows, key=lambda r: (r[2], r[0])):
        times = [x for x in kept.get(u, []) if (t - x).total_seconds() < width]
        out[e] = len(times) < cap
        kept[u] = times + [t] if out[e] else times
    return out


def brute_budget(rows, estimate=0.01):
    budget, spent, out = dict(policies.ROLE_BUDGETS), {}, {}
    for e, u, t, role, cost in sorted(rows, key=lambda r: (r[2], r[0])):
        out[e] = spent.get(u, 0) <= round(budget.get(role, 0.0) * 1e6) - round(estimate * 1e6)
        if out[e]:
            spent[u] = spent.get(u, 0) + round(cost * 1e6)
    return out


def requests(seed, users=4, n=600, spread=3000, hot=0.4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < hot else rng.randrange(users)
        rows.append((i, user, T0 + dt.timedelta(seconds=rng.randrange(spread * 4) / 4), rng.choice(["engineer", "hr"]), round(rng.random() * 3, 2)))
    return rows


@pytest.mark.parametrize("seed,cap,width", [(1, 3, 60), (2, 3, 30), (3, 1, 45), (4, 8, 120), (5, 30, 60)])
def test_rate_limit_matches_a_sequential_replay(spark, seed, cap, width):
    rows = requests(seed)
    got = {r.event_id: r.allowed for r in gates.rate_limit(log(spark, rows), cap, width).collect()}
    assert got == brute_rate(rows, cap, width)


def test_rate_limit_edge_of_the_window(spark):
    rows = [(i, 1, T0 + dt.timedelta(seconds=s), "hr", 0.0) for i, s in enumerate((0, 1, 2, 3, 60, 60.5))]
    got = {r.event_id: r.allowed for r in gates.rate_limit(log(spark, rows), 3, 60).collect()}
    assert got == {0: True, 1: True, 2: True, 3: False, 4: True, 5: False}


def test_calm_logs_need_no_python(spark):
    rows = [(i, i % 5, T0 + dt.timedelta(minutes=5 * i), "hr", 0.0) for i in range(50)]
    out = gates.rate_limit(log(spark, rows), 3, 60)
    assert "MapInPandas" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.where("allowed").count() == 50


def test_no_window_admits_more_than_the_cap(spark):
    rows = requests(9, n=400, spread=600)
    out = [r for r in gates.rate_limit(log(spark, rows), 5, 60).collect() if r.allowed]
    for r in out:
        inside = [x for x in out if x.user_id == r.user_id and 0 <= (r.ts - x.ts).total_seconds() < 60]
        assert len(inside) <= 5


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("mixed", [False, True])
def test_budget_gate_matches_a_sequential_replay(spark, seed, mixed):
    rows = requests(seed, n=900)
    if not mixed:
        rows = [(e, u, t, "engineer" if u % 2 else "hr", c) for e, u, t, _, c in rows]
    got = {r.event_id: r.allowed for r in gates.budget_gate(log(spark, rows), policies.role_budgets(spark), slice_seconds=300).collect()}
    want = brute_budget(rows)
    assert got == want and set(want.values()) == {True, False}


def test_budget_edges(spark):
    def one(spent, estimate, role="engineer"):
        rows = [(1, 1, T0, role, spent), (2, 1, T0 + dt.timedelta(hours=3), role, 1.0)]
        out = gates.budget_gate(log(spark, rows), policies.role_budgets(spark), estimate)
        return {r.event_id: r.allowed for r in out.collect()}

    assert one(50.0, 49.0)[2] and not one(50.0, 51.0)[2]
    assert not one(99.995, 0.01)[2]
    assert one(0.0, 0.01, "stranger") == {1: False, 2: False}


def test_guardrail_order_and_charges(spark):
    rows = [(i, 1, T0 + dt.timedelta(seconds=i), "engineer", 60.0) for i in range(6)]
    out = {r.event_id: r for r in gates.guardrail_replay(log(spark, rows), policies.role_budgets(spark), cap=4).collect()}
    assert [out[i].rejected for i in range(6)] == [None, None, "budget_exceeded", "budget_exceeded", "rate_limit_exceeded", "rate_limit_exceeded"]
    assert sum(r.charged for r in out.values()) == 120.0


def test_spending_uses_the_latest_role(spark):
    rows = [(1, 1, T0, "executive", 30.0), (2, 1, T0 + dt.timedelta(1), "engineer", 90.0), (3, 2, T0, "nobody", 1.0)]
    out = {r.user_id: r for r in ledger.user_spending(log(spark, rows), policies.role_budgets(spark)).collect()}
    assert (out[1].role, out[1].spent, out[1].remaining) == ("engineer", 120.0, 0.0)
    assert out[2].remaining == 0.0


def test_admission_in_pieces_equals_one_pass():
    rng = random.Random(3)
    times = np.array(sorted(rng.randrange(4000) for _ in range(900)))
    for cap, width in ((1, 7), (3, 50), (20, 300)):
        whole = gates.admitted(times, deque(), cap, width)
        kept, parts = deque(), []
        for a in range(0, 900, 130):
            parts.append(gates.admitted(times[a : a + 130], kept, cap, width))
        assert np.concatenate(parts).tolist() == whole.tolist()
        seen: list = []
        for t, ok in zip(times.tolist(), whole.tolist()):
            seen = [k for k in seen if t - k < width]
            assert ok == (len(seen) < cap)
            seen += [t] if ok else []


def test_budget_in_runs_equals_steps():
    rng = random.Random(4)
    costs = np.array([rng.choice([0, 5, 9]) for _ in range(400)])
    limits = np.array([rng.choice([-1, 300, 300, 900]) for _ in range(400)])
    got, spent = gates.within_budget(costs, limits, 0)
    total = 0
    for c, limit, ok in zip(costs.tolist(), limits.tolist(), got.tolist()):
        assert ok == (total <= limit)
        total += c if ok else 0
    assert spent == total


def test_failed_requests_are_logged_but_not_charged(spark):
    rows = [(i, 1, T0 + dt.timedelta(hours=i), "engineer", 60.0, "boom" if i == 0 else None, "salary: 5 ok") for i in range(4)]
    frame = literal_table(spark, rows, SCHEMA + ", error string, answer string")
    out = {r.event_id: r for r in gates.guardrail_replay(frame, policies.role_budgets(spark), 30, 60, policy=policies.AccessPolicy()).collect()}
    assert [out[i].charged for i in range(4)] == [0.0, 60.0, 60.0, 0.0]
    assert [out[i].rejected for i in range(4)] == [None, None, None, "budget_exceeded"]
    assert [out[i].answer for i in range(4)] == ["salary: 5 ok", "salary: [REDACTED] ok", "salary: [REDACTED] ok", None]
    assert out[0].cost == 60.0
