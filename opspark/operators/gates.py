"""Admission gates over a request log: sliding-window rate limit, budget, and both in sequence.

A request frame has user_id, ts (zone-less), event_id; requests are decided in (ts, event_id) order.
"""

from __future__ import annotations

from bisect import insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.timefeat import epoch_micros
from ..session import cut_lineage
from ..sources.policies import PREFLIGHT_ESTIMATE, AccessPolicy

MAX_PER_MINUTE = 30
WINDOW_SECONDS = 60
MICRO = 1_000_000


def _slices(requests: DataFrame, width: int) -> DataFrame:
    return requests.withColumn("_us", epoch_micros(F.col("ts"))).withColumn("_slice", F.floor(F.col("_us") / width))


def _pressure(sliced: DataFrame, cap: int, width: int) -> DataFrame:
    """Slices that need a sequential decision, with their stretch, and slices whose events seed one.

    A slice is as long as the window, so a request's window touches its own slice and the one before.
    When both hold at most ``cap`` requests, every request of the slice is admitted whatever happened
    earlier: the slice is calm, and the state after it is known. Stretches of pressed slices are
    therefore independent of each other. They also end where the window has emptied.
    """
    per = sliced.groupBy("user_id", "_slice").agg(F.count("*").alias("n"), F.min("_us").alias("lo"), F.max("_us").alias("hi"))
    by_user = Window.partitionBy("user_id").orderBy("_slice")
    adjacent = F.coalesce(F.lag("_slice").over(by_user) == F.col("_slice") - 1, F.lit(False))
    before = F.when(adjacent, F.lag("n").over(by_user)).otherwise(F.lit(0))
    emptied = F.coalesce(F.col("lo") - F.lag("hi").over(by_user) >= width, F.lit(True))
    marked = per.withColumn("pressed", F.col("n") + before > cap).withColumn("adjacent", adjacent).withColumn("emptied", emptied)
    pressed_before = F.coalesce(F.lag("pressed").over(by_user), F.lit(False))
    opens = F.col("pressed") & (~F.col("adjacent") | ~pressed_before | F.col("emptied"))
    marked = marked.withColumn("opens", opens).withColumn("stretch", F.max(F.when(F.col("opens"), F.col("_slice"))).over(by_user))
    next_opens = F.lead("opens").over(by_user) & F.lead("adjacent").over(by_user) & ~F.lead("emptied").over(by_user)
    seeds = F.when(F.coalesce(next_opens, F.lit(False)) & ~F.col("pressed"), F.lead("_slice").over(by_user))
    return marked.withColumn("seeds", seeds).where(F.col("pressed") | F.col("seeds").isNotNull()).select(
        "user_id", "_slice", "pressed", F.when(F.col("pressed"), F.col("stretch")).alias("stretch"), "seeds"
    )


def admitted(times: np.ndarray, kept: deque, cap: int, width: int) -> np.ndarray:
    """Flags of the admitted ones among ascending times; ``kept`` holds the admitted times, ascending, before and afterwards.

    A full window opens when its oldest time leaves it, so the search jumps there: rejected requests take no step.
    """
    out = np.zeros(len(times), dtype=bool)
    i, n = 0, len(times)
    while i < n:
        t = times[i]
        while kept and t - kept[0] >= width:
            kept.popleft()
        if len(kept) < cap:
            # A stream may bring a late request after later ones were admitted.
            insort(kept, int(t))
            out[i] = True
            i += 1
        else:
            i += int(np.searchsorted(times[i:], kept[0] + width, side="left"))
    return out


def within_budget(costs: np.ndarray, limits: np.ndarray, spent: int) -> tuple[np.ndarray, int]:
    """Flags of the requests, in order, that find the spending within their limit, and the spending after them.

    Costs are not negative, so under one limit the admitted requests are a prefix: one running sum for each change.
    """
    out = np.zeros(len(costs), dtype=bool)
    starts = np.flatnonzero(np.diff(limits, prepend=limits[:1] - 1)) if len(limits) else []
    for a, b in zip(starts, [*starts[1:], len(costs)]):
        before = spent + np.concatenate(([0], np.cumsum(costs[a:b])))
        count = int(np.searchsorted(before[:-1], limits[a], side="right"))
        out[a : a + count] = True
        spent = int(before[count])
    return out, spent


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring rows with equal keys, as (start, end)."""
    if not len(keys[0]):
        return []
    new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    starts = [0, *(np.flatnonzero(new) + 1).tolist()]
    return list(zip(starts, [*starts[1:], len(keys[0])]))


def _admit_in_order(cap: int, width: int):
    """Decides time-ordered requests of each (user, stretch); keeps at most ``cap`` times in memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, kept = None, deque()
        for rows in batches:
            users, stretches = rows["user_id"].to_numpy(), rows["stretch"].to_numpy()
            times, seeds = rows["_us"].to_numpy(), rows["seed"].to_numpy()
            allowed = np.zeros(len(rows), dtype=bool)
            for a, b in _runs(users, stretches):
                if key != (users[a], stretches[a]):
                    key, kept = (users[a], stretches[a]), deque()
                # The seeds of a stretch are the admitted requests just before it.
                first = a + int(seeds[a:b].sum())
                kept.extend(int(t) for t in times[a:first])
                allowed[first:b] = admitted(times[first:b], kept, cap, width)
            yield rows.assign(allowed=allowed)

    return run


def rate_limit(requests: DataFrame, cap: int = MAX_PER_MINUTE, window_seconds: float = WINDOW_SECONDS) -> DataFrame:
    """Adds ``allowed``: at most ``cap`` admitted requests of a user in any window; rejected ones do not count.

    Only requests under pressure are decided in sequence, all stretches in one pass: a sorted stream that keeps
    ``cap`` times and jumps from admission to admission. Its work grows with the admitted requests, which the cap bounds.
    """
    width = int(window_seconds * MICRO)
    sliced = _slices(requests, width)
    marks = cut_lineage(_pressure(sliced, cap, width))
    pressed = marks.where("pressed").select("user_id", "_slice", "stretch")
    calm = sliced.join(pressed, ["user_id", "_slice"], "left_anti").withColumn("allowed", F.lit(True))
    if pressed.isEmpty():
        return calm.select(*requests.columns, "allowed")
    columns = [*requests.columns, "_us", "stretch", "seed"]
    waiting = sliced.join(pressed, ["user_id", "_slice"]).withColumn("seed", F.lit(False)).select(*columns)
    known = marks.where(F.col("seeds").isNotNull()).select("user_id", "_slice", F.col("seeds").alias("stretch"))
    seeds = sliced.join(known, ["user_id", "_slice"]).withColumn("seed", F.lit(True)).select(*columns)
    batch = waiting.unionByName(seeds)
    ordered = batch.repartition("user_id", "stretch").sortWithinPartitions("user_id", "stretch", "_us", "event_id")
    schema = T.StructType([*batch.schema.fields, T.StructField("allowed", T.BooleanType())])
    decided = ordered.mapInPandas(_admit_in_order(cap, width), schema).where(~F.col("seed"))
    return calm.select(*requests.columns, "allowed").unionByName(decided.select(*requests.columns, "allowed"))


def remaining_quota(decided: DataFrame, at: str, cap: int = MAX_PER_MINUTE, window_seconds: float = WINDOW_SECONDS) -> DataFrame:
    """Requests each user may still make at a time, from the admitted ones of the window before it."""
    now = epoch_micros(F.lit(at).cast("timestamp_ntz"))
    age = now - epoch_micros(F.col("ts"))
    counts = F.col("allowed") & (age >= 0) & (age < int(window_seconds * MICRO))
    return decided.groupBy("user_id").agg(F.greatest(F.lit(0), F.lit(cap) - F.count_if(counts)).cast("bigint").alias("remaining"))


def to_micros(amount: Column) -> Column:
    """Money in whole millionths: sums are then exact in any order."""
    return F.round(amount * MICRO).cast("bigint")


def budget_gate(
    requests: DataFrame,
    budgets: DataFrame,
    estimate: float = PREFLIGHT_ESTIMATE,
    slice_seconds: int = 300,
    default_role: str = "engineer",
    spent: DataFrame | None = None,
) -> DataFrame:
    """Adds ``allowed``: the estimate fits into the user's budget minus the cost of admitted requests.

    Needs user_role and a non-negative cost. With one role per user the admitted requests are a prefix of
    the user's log: spending only grows, so the first rejection is final. Costs are summed per
    (user, time slice), the slice where the budget runs out is found on those sums, and only the
    requests of that one slice are ordered. Users whose role changes are decided in a sorted stream.
    ``spent`` (user_id, spent in millionths) is what users have spent before the log begins.
    """
    limits = budgets.select(F.col("role").alias("_role"), (to_micros(F.col("budget")) - to_micros(F.lit(estimate))).alias("_limit"))
    role = F.coalesce("user_role", F.lit(default_role))
    priced = (
        _slices(requests, slice_seconds * MICRO)
        .join(limits, role == F.col("_role"), "left")
        .withColumn("_limit", F.coalesce("_limit", -to_micros(F.lit(estimate))))
        .withColumn("_cost", to_micros(F.coalesce("cost", F.lit(0.0))))
        .drop("_role")
    )
    if spent is not None:
        earlier = spent.select("user_id", F.col("spent").alias("_spent"))
        priced = priced.join(earlier, "user_id", "left").withColumn("_limit", F.col("_limit") - F.coalesce("_spent", F.lit(0))).drop("_spent")
    per = priced.groupBy("user_id", "_slice").agg(F.sum("_cost").alias("spent"), F.min("_limit").alias("lo"), F.max("_limit").alias("hi"))
    by_user = Window.partitionBy("user_id").orderBy("_slice")
    running = per.withColumn("upto", F.sum("spent").over(by_user))
    # One row per user, written: the join below then has plain shuffles on both sides and AQE can split a heavy user.
    cuts = cut_lineage(
        running.groupBy("user_id").agg(
            F.min(F.when(F.col("upto") > F.col("lo"), F.col("_slice"))).alias("_cut"),
            F.min(F.when(F.col("upto") > F.col("lo"), F.col("upto") - F.col("spent"))).alias("_before"),
            (F.min("lo") != F.max("hi")).alias("_mixed"),
        )
    )
    placed = priced.join(cuts, "user_id")
    single = placed.where(~F.col("_mixed"))
    before_cut = F.coalesce(F.col("_slice") < F.col("_cut"), F.lit(True))
    # Spending that already exceeds the limit in the first slice leaves every later slice rejected.
    clear = single.where(F.col("_cut").isNull() | (F.col("_slice") != F.col("_cut"))).withColumn(
        "allowed", before_cut & (F.col("_limit") >= 0)
    )
    in_cut = Window.partitionBy("user_id").orderBy("_us", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    tight = single.where(F.col("_slice") == F.col("_cut")).withColumn(
        "allowed", F.col("_before") + F.coalesce(F.sum("_cost").over(in_cut), F.lit(0)) <= F.col("_limit")
    )
    keep = [*requests.columns, "allowed"]
    out = clear.select(keep).unionByName(tight.select(keep))
    if cuts.where("_mixed").isEmpty():
        return out
    mixed = placed.where("_mixed").drop("_cut", "_before", "_mixed")
    schema = T.StructType([*mixed.schema.fields, T.StructField("allowed", T.BooleanType())])
    folded = mixed.repartition("user_id").sortWithinPartitions("user_id", "_us", "event_id").mapInPandas(_spend_in_order, schema)
    return out.unionByName(folded.select(keep))


def monthly_budget_gate(requests: DataFrame, budgets: DataFrame, estimate: float = PREFLIGHT_ESTIMATE, **options) -> DataFrame:
    """``budget_gate`` with a budget that begins anew each calendar month: a user's month is decided like a user."""
    month = F.date_format("ts", "yyyy-MM")
    asked = requests.withColumns({"_own": F.col("user_id"), "user_id": F.concat_ws("|", month, F.col("user_id").cast("string"))})
    decided = budget_gate(asked, budgets, estimate, **options)
    return decided.withColumn("user_id", F.col("_own")).select(*requests.columns, "allowed")


def _spend_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Decides time-ordered requests of users whose limit changes; the state is one number per user."""
    user, spent = None, 0
    for rows in batches:
        users, limits, costs = rows["user_id"].to_numpy(), rows["_limit"].to_numpy(), rows["_cost"].to_numpy()
        allowed = np.zeros(len(rows), dtype=bool)
        for a, b in _runs(users):
            if users[a] != user:
                user, spent = users[a], 0
            allowed[a:b], spent = within_budget(costs[a:b], limits[a:b], spent)
        yield rows.assign(allowed=allowed)


def guardrail_replay(
    requests: DataFrame,
    budgets: DataFrame,
    cap: int = MAX_PER_MINUTE,
    window_seconds: float = WINDOW_SECONDS,
    estimate: float = PREFLIGHT_ESTIMATE,
    policy: AccessPolicy | None = None,
) -> DataFrame:
    """Rate gate, then budget gate over the admitted requests; rejected requests are kept and cost 0.

    A request with an ``error`` (if there is such a column) is admitted and logged, but neither charged nor counted against the
    budget. With a policy, the fields that a role may not see are redacted in the ``answer`` of an admitted request, and a
    rejected request has none.
    """
    failed = F.col("error").isNotNull() if "error" in requests.columns else F.lit(False)
    asked = requests.withColumns({"_asked_cost": F.col("cost"), "cost": F.when(failed, F.lit(0.0)).otherwise(F.col("cost"))})
    rated = cut_lineage(rate_limit(asked, cap, window_seconds))
    passed = budget_gate(rated.where("allowed").drop("allowed"), budgets, estimate)
    judged = passed.withColumn("rejected", F.when(~F.col("allowed"), F.lit("budget_exceeded"))).drop("allowed")
    limited = rated.where(~F.col("allowed")).drop("allowed").withColumn("rejected", F.lit("rate_limit_exceeded"))
    out = judged.unionByName(limited).withColumns(
        {"charged": F.when(F.col("rejected").isNull(), F.col("cost")).otherwise(F.lit(0.0)), "cost": F.col("_asked_cost")}
    )
    out = out.drop("_asked_cost")
    if policy is None:
        return out
    shown = tx.redact_json(F.col("user_role"), F.col("answer"), policy.hidden(), policy.hidden_fields(None))
    told = F.when(failed, F.col("answer")).otherwise(shown)
    return out.withColumn("answer", F.when(F.col("rejected").isNull(), told))
