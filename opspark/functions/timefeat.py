"""Calendar, slot and cyclical expressions over zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_MINUTES = 15
SLOTS_PER_DAY = 24 * 60 // SLOT_MINUTES

TEMPORAL = ["hour", "minute", "dayofweek", "is_weekend", "month", "dayofyear", "weekofyear", "year", "slot_of_day"]
CYCLICAL = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"]


def bucket_start(ts: Column | str) -> Column:
    """Start of the 15-minute bucket holding ``ts``; keeps the timestamp type of the input."""
    return F.window(ts, f"{SLOT_MINUTES} minutes")["start"]


def slot_of_day(ts: Column) -> Column:
    return (F.hour(ts) * (60 // SLOT_MINUTES) + F.floor(F.minute(ts) / SLOT_MINUTES)).cast("int")


def slot_index(ts: Column) -> Column:
    """Number of the 15-minute slot since 1970, from calendar parts only (no session time zone)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * SLOTS_PER_DAY + slot_of_day(ts)


def slot_start(day: Column, slot: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), slot.cast("int") * SLOT_MINUTES)


def with_temporal(df: DataFrame, ts: str = "time_bucket") -> DataFrame:
    """Calendar parts; Monday is day 0."""
    t = F.col(ts)
    dow = F.weekday(t)
    return df.withColumns(
        {
            "hour": F.hour(t),
            "minute": F.minute(t),
            "dayofweek": dow,
            "is_weekend": (dow >= 5).cast("int"),
            "month": F.month(t),
            "dayofyear": F.dayofyear(t),
            "weekofyear": F.weekofyear(t),
            "year": F.year(t),
            "slot_of_day": slot_of_day(t),
        }
    )


def with_cyclical(df: DataFrame) -> DataFrame:
    """Sine and cosine of hour, weekday and month; expects the columns of ``with_temporal``."""
    out = {}
    for source, name, period in (("hour", "hour", 24), ("dayofweek", "dow", 7), ("month", "month", 12)):
        angle = F.lit(2.0) * F.pi() * F.col(source) / F.lit(float(period))
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return df.withColumns(out)


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, from calendar parts only."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000000 + (F.extract(F.lit("SECOND"), ts) * 1000000).cast("bigint")
