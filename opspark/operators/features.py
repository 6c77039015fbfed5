"""Lag, rolling and constant features of the demand series.

A zone's series is cut into chunks of four weeks; the last week of each chunk is copied into the next
one as a halo, so every window partition has a fixed maximum size however long the history is and
however few zones there are. Frames are ranges over the slot number, so values are found by time, not by
row position, and a missing slot gives NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefeat import CYCLICAL, SLOTS_PER_DAY, slot_index, with_cyclical, with_temporal
from ..functions.serving import is_airport

# Lag distance and rolling length in 15-minute slots.
LAGS = {"lag_15min": 1, "lag_1h": 4, "lag_2h": 8, "lag_1day": 96, "lag_1week": 672}
ROLLING = {"roll_mean_1h": 4, "roll_mean_2h": 8, "roll_mean_1day": 96}

# The feature columns of the model, in their order.
FEATURES = [
    "zone_id",
    "hour",
    "minute",
    "dayofweek",
    "is_weekend",
    "month",
    "dayofyear",
    "weekofyear",
    "year",
    "slot_of_day",
    *CYCLICAL,
    "is_holiday",
    "cbd_pricing_active",
    "is_airport_zone",
    "borough_id",
    "service_zone_id",
    "zone_slot_baseline",
    *LAGS,
    *ROLLING,
]

CHUNK_SLOTS = 28 * SLOTS_PER_DAY
HALO_SLOTS = max(LAGS.values())


def in_chunks(fact: DataFrame) -> DataFrame:
    """Adds ``slot``, ``chunk`` and ``halo``; rows of a chunk's last week appear again as a halo."""
    chunk = F.floor(F.col("slot") / CHUNK_SLOTS)
    late = F.pmod(F.col("slot"), F.lit(CHUNK_SLOTS)) >= CHUNK_SLOTS - HALO_SLOTS
    copies = F.when(late, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return (
        fact.withColumn("slot", slot_index(F.col("time_bucket")))
        .withColumn("halo", F.explode(copies))
        .withColumn("chunk", chunk + F.col("halo").cast("bigint"))
    )


def _in_chunk_windows(fact: DataFrame, lags: dict[str, int], rolling: dict[str, int], past: bool = False) -> DataFrame:
    last = int(past)
    series = Window.partitionBy("zone_id", "chunk").orderBy("slot")
    trips = F.col("trip_count").cast("double")
    wanted = {name: F.max(trips).over(series.rangeBetween(-k, -k)) for name, k in lags.items()}
    wanted.update({name: F.avg(trips).over(series.rangeBetween(-k + 1 - last, -last)) for name, k in rolling.items()})
    return in_chunks(fact).withColumns(wanted).where(~F.col("halo")).drop("halo", "chunk", "slot")


def with_lags(fact: DataFrame) -> DataFrame:
    """Trips at exact earlier times: 15 minutes, 1 and 2 hours, 1 day, 1 week before the row."""
    return _in_chunk_windows(fact, LAGS, {})


def with_rolling(fact: DataFrame) -> DataFrame:
    """Mean of the slots in (t - w, t] for 1 hour, 2 hours and 1 day."""
    return _in_chunk_windows(fact, {}, ROLLING)


def with_lags_and_rolling(fact: DataFrame, past: bool = False) -> DataFrame:
    """All history features from one shuffle. With ``past`` the rolling means end one slot before the row."""
    return _in_chunk_windows(fact, LAGS, ROLLING, past)


def zone_slot_baseline(fact: DataFrame, before: str | None = None) -> DataFrame:
    """Mean trips per zone and slot of day, from rows before ``before`` if given."""
    rows = fact if before is None else fact.where(F.col("time_bucket") < F.lit(before).cast("timestamp_ntz"))
    slot = F.hour("time_bucket") * 4 + F.floor(F.minute("time_bucket") / 15)
    return rows.groupBy("zone_id", slot.cast("int").alias("slot_of_day")).agg(
        F.avg("trip_count").alias("zone_slot_baseline")
    )


def feature_table(
    fact: DataFrame, zones: DataFrame, pricing_start: str = "2025-01-05", before: str | None = None, past: bool = False, baseline: DataFrame | None = None
) -> DataFrame:
    """The 30 model features, the key and the target for every row of the series.

    ``fact`` needs zone_id, time_bucket, trip_count, is_holiday; ``zones`` needs zone_id, borough_id,
    service_zone_id. The baseline table is keyed by (zone, slot of day); a stored one can be given. With ``past`` no feature
    looks at the row's own target.
    """
    base = zone_slot_baseline(fact, before) if baseline is None else baseline
    enriched = (
        with_cyclical(with_temporal(with_lags_and_rolling(fact, past)))
        .join(zones.select("zone_id", "borough_id", "service_zone_id"), "zone_id", "left")
        .join(base, ["zone_id", "slot_of_day"], "left")
        .withColumns(
            {
                "cbd_pricing_active": (F.to_date("time_bucket") >= F.lit(pricing_start).cast("date")).cast("int"),
                "is_airport_zone": is_airport(F.col("zone_id")).cast("int"),
            }
        )
    )
    return enriched.select("time_bucket", "trip_count", *FEATURES)


def zone_history(fact: DataFrame, slots: int = HALO_SLOTS) -> DataFrame:
    """The latest ``slots`` rows of every zone.

    Up to the window-group-limit threshold Spark keeps only the wanted rows before the shuffle.
    """
    latest = Window.partitionBy("zone_id").orderBy(F.col("time_bucket").desc())
    return fact.withColumn("_rn", F.row_number().over(latest)).where(F.col("_rn") <= slots).drop("_rn")


def zone_constants(table: DataFrame, columns: list[str], order: str = "time_bucket") -> DataFrame:
    """First value of each column per zone, by time."""
    first = F.min_by(F.struct(*columns), F.col(order)).alias("_first")
    return table.groupBy("zone_id").agg(first).select("zone_id", *[F.col(f"_first.{c}").alias(c) for c in columns])
