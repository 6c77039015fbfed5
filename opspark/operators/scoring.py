"""Batch scoring and forecasts over real history."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefeat import SLOTS_PER_DAY, slot_index
from .demand import trend_direction
from .features import HALO_SLOTS, LAGS, ROLLING, zone_history

# Inputs of the forecasting models: calendar waves, flags and history.
MODEL_FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "zone_slot_baseline", "lag_15min", "lag_1h", "lag_1day",
    "lag_1week", "roll_mean_1h", "roll_mean_1day",
]
STEP_MINUTES = 15


def filled(table: DataFrame, features: list[str]) -> DataFrame:
    """Missing history is replaced by the zone's slot baseline."""
    base = F.coalesce("zone_slot_baseline", F.lit(0.0))
    return table.withColumns({c: F.coalesce(F.col(c).cast("double"), base) for c in features})


def score_with(table: DataFrame, predict: Callable[[pd.DataFrame], np.ndarray], features: list[str], name: str = "yhat") -> DataFrame:
    """Scores with any Python model, batch by batch: ``predict`` gets the feature columns of one Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.assign(**{name: np.maximum(0.0, np.asarray(predict(rows[features]), dtype=float))})

    return table.mapInPandas(run, f"{_ddl(table)}, {name} double")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def forecast_naive(fact: DataFrame, steps: int = 16, season: int = HALO_SLOTS) -> DataFrame:
    """Seasonal forecast: each of the next slots repeats its value one season earlier.

    Needs the last season of each zone only, found by a window group limit before the shuffle.
    """
    if steps > season:
        raise ValueError("a seasonal forecast reaches one season ahead at most")
    series = Window.partitionBy("zone_id")
    recent = zone_history(fact, season).withColumn("slot", slot_index(F.col("time_bucket")))
    placed = recent.withColumn("_last", F.max("slot").over(series)).withColumn(
        "step", F.col("slot") + season - F.col("_last")
    )
    ahead = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(season * STEP_MINUTES))
    return placed.where(F.col("step").between(1, steps)).select(
        "zone_id", F.col("step").cast("int").alias("step"), (F.col("time_bucket") + ahead).alias("time_bucket"), F.col("trip_count").cast("double").alias("yhat")
    )


def forecast_recursive(
    fact: DataFrame,
    baseline: DataFrame,
    predict: Callable[[dict[str, np.ndarray]], np.ndarray],
    steps: int = 16,
    season: int = HALO_SLOTS,
    parts: int = 64,
) -> DataFrame:
    """Multi-step forecast where each prediction becomes history for the next step, clipped at 0.

    Zones are dealt over ``parts`` groups, and all zones of a group go forward together: ``predict`` gets one array for each
    feature, with one number for each zone. A group holds the last week and the 96 baseline values of its zones, whatever
    the length of the history. Missing history is replaced by the zone's baseline of the predicted slot.
    """
    part = F.pmod(F.xxhash64("zone_id"), F.lit(parts))
    # The two sides may come from one frame, so no name is in both.
    recent = zone_history(fact, season).select(part.alias("part"), "zone_id", slot_index(F.col("time_bucket")).alias("slot"), F.col("trip_count").cast("double").alias("y"))
    slots = baseline.select(part.alias("base_part"), F.col("zone_id").alias("base_zone"), "slot_of_day", "zone_slot_baseline")
    columns = {"zone_id": "int64", "step": "int32", "time_bucket": "datetime64[us]", "yhat": "float64"}

    def run(history: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if not len(history):
            return pd.DataFrame({c: pd.Series([], dtype=t) for c, t in columns.items()})
        zones, z = np.unique(history["zone_id"].to_numpy(), return_inverse=True)
        slot = history["slot"].to_numpy()
        last = np.full(len(zones), slot.min())
        np.maximum.at(last, z, slot)
        y = np.full((len(zones), season + steps), np.nan)
        place = season - 1 - (last[z] - slot)
        y[z[place >= 0], place[place >= 0]] = history["y"].to_numpy()[place >= 0]
        means = np.zeros((len(zones), SLOTS_PER_DAY))
        known = base[base["base_zone"].isin(zones)] if len(base) else pd.DataFrame({"base_zone": [], "slot_of_day": [], "zone_slot_baseline": []}, dtype="int64")
        means[np.searchsorted(zones, known["base_zone"].to_numpy()), known["slot_of_day"].to_numpy()] = known["zone_slot_baseline"].to_numpy()
        rows = np.arange(len(zones))
        out = []
        for step in range(1, steps + 1):
            ahead = last + step
            at = season + step - 1
            row = _calendar(ahead)
            row["zone_slot_baseline"] = means[rows, ahead % SLOTS_PER_DAY]
            row |= _history(y[:, :at], row["zone_slot_baseline"])
            y[:, at] = np.maximum(0.0, np.broadcast_to(np.asarray(predict(row), dtype=float), len(zones)))
            time = pd.to_datetime(ahead * STEP_MINUTES * 60, unit="s")
            out.append(pd.DataFrame({"zone_id": zones, "step": step, "time_bucket": time, "yhat": [round(v, 2) for v in y[:, at].tolist()]}))
        return pd.concat(out, ignore_index=True)

    return recent.groupBy("part").cogroup(slots.groupBy("base_part")).applyInPandas(run, "zone_id bigint, step int, time_bucket timestamp_ntz, yhat double")


def _calendar(slot: np.ndarray) -> dict[str, np.ndarray]:
    """Calendar features of slots since 1970 (a Thursday)."""
    hour = 2 * np.pi * (slot % SLOTS_PER_DAY // 4) / 24
    weekday = (slot // SLOTS_PER_DAY + 3) % 7
    dow = 2 * np.pi * weekday / 7
    return {"hour_sin": np.sin(hour), "hour_cos": np.cos(hour), "dow_sin": np.sin(dow), "dow_cos": np.cos(dow), "is_weekend": (weekday >= 5).astype(float)}


def _history(y: np.ndarray, fallback: np.ndarray) -> dict[str, np.ndarray]:
    """Lags and rolling means of the slots before the predicted one, a row for each zone."""
    out = {}
    for name, n in LAGS.items():
        value = y[:, -n] if n <= y.shape[1] else np.full(len(y), np.nan)
        out[name] = np.where(np.isnan(value), fallback, value)
    for name, n in ROLLING.items():
        tail = y[:, -n:]
        have = ~np.isnan(tail)
        count = have.sum(axis=1)
        out[name] = np.where(count > 0, np.where(have, tail, 0.0).sum(axis=1) / np.maximum(count, 1), fallback)
    return out


def forecast_heatmap(forecast: DataFrame, hours_ahead: int) -> DataFrame:
    """All zones at one forecast step, with the largest value."""
    step = max(1, hours_ahead * 60 // STEP_MINUTES)
    at = forecast.where(F.col("step") == step).select("zone_id", "time_bucket", F.bround("yhat", 2).alias("demand"))
    top = at.agg(F.max("demand")).scalar()
    return at.withColumn("max", top).withColumn("hours_ahead", F.lit(hours_ahead))


def outlook(forecast: DataFrame) -> DataFrame:
    """Next-hour demand (mean of steps 1-4) and trend direction per zone, for the operator table."""
    soon = forecast.where(F.col("step") <= 4).groupBy("zone_id").agg(F.avg("yhat").alias("demand_next_hour"))
    return soon.join(trend_direction(forecast, ["zone_id"]), "zone_id")
