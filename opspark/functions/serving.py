"""Business rules of the serving tables, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the serving rules.
AIRPORT_ZONES = (1, 132, 138)
FALLBACK_FARE = 18.70
FARE_RANGE = (5.0, 100.0)
REVENUE_PER_TRIP = 13.5
MILES_PER_DEGREE = (69, 54)
MILES_PER_HOUR = 15
DRIVE_RANGE = (2, 45)


def is_airport(zone: Column) -> Column:
    return zone.isin(*AIRPORT_ZONES)


def zone_label(name: Column, zone: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("Zone "), zone.cast("string")))


def clamp_fare(fare: Column) -> Column:
    """Fare with the overall average as fallback, kept inside a plausible range."""
    low, high = FARE_RANGE
    return F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(fare, F.lit(FALLBACK_FARE))))


def drive_minutes(lat1: Column, lon1: Column, lat2: Column, lon2: Column, zone1: Column, zone2: Column) -> Column:
    """Whole minutes at city speed between two centroids; from the zone numbers where one is unknown."""
    per_lat, per_lon = MILES_PER_DEGREE
    dy = F.abs(lat1 - lat2) * per_lat
    dx = F.abs(lon1 - lon2) * per_lon
    miles = F.sqrt(dy * dy + dx * dx)
    low, high = DRIVE_RANGE
    by_distance = F.least(F.lit(high), F.greatest(F.lit(low), (miles / MILES_PER_HOUR * 60).cast("bigint")))
    by_number = F.greatest(F.lit(3), F.floor(F.abs(zone1 - zone2) / 20))
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, by_distance).otherwise(by_number).cast("bigint")


def demand_level(pct: Column) -> Column:
    return F.when(pct >= 65, "High").when(pct >= 35, "Medium").otherwise("Low")


def hour_trend_label(now: Column, before: Column) -> Column:
    return F.when(now > before + 0.1, "up").when(now < before - 0.1, "down").otherwise("flat")


def percent_change(now: Column, after: Column) -> Column:
    return F.when(now > 0, F.bround((after - now) / now * 100)).otherwise(F.lit(0.0)).cast("bigint")


def outlook(early: Column, late: Column, steps: Column) -> Column:
    """Direction of a 16-step forecast; stable when steps are missing."""
    return (
        F.when(steps < 16, "stable").when(late > early * 1.1, "rising").when(late < early * 0.9, "falling").otherwise("stable")
    )


def volatility_label(ratio: Column) -> Column:
    return F.when(ratio > 0.3, "high").when(ratio > 0.15, "medium").otherwise("low")


def unmet_demand(now: Column, threshold: Column) -> Column:
    """Part of the demand above the threshold that goes unserved: 10 % rising to 30 %."""
    over = now - threshold
    share = F.least(F.lit(0.30), F.lit(0.10) + over / threshold * 0.20)
    return (
        F.when((threshold > 0) & (over > 0), F.greatest(F.lit(0.0), F.bround(over * share))).otherwise(F.lit(0.0)).cast("bigint")
    )


def supply_status(unmet: Column, now: Column) -> Column:
    return F.when(unmet > 0, "tight").when(now > 30, "balanced").otherwise("light")


def action_text(status: Column, volatility: Column, trend: Column) -> Column:
    tight, balanced = status == "tight", status == "balanced"
    return (
        F.when(tight & (volatility == "high"), "High demand + volatile. Raise surge cautiously.")
        .when(tight & (volatility == "low"), "High demand + stable. Can raise surge aggressively.")
        .when(balanced & (trend == "rising"), "Demand rising. Prepare extra drivers.")
        .when(tight & (trend == "falling"), "Demand falling. Monitor before surge.")
    )
