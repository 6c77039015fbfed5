"""Dense demand series, the demand profile and the tables served from it.

A *profile* has one row per (zone_id, hour, dow, holiday): regular days under their weekday,
holidays under dow -1 and their name. A *slice* is one (hour, dow, holiday) of it. Every serving
operator answers all slices in one plan; filter the result, or the profile, for a single request.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import serving as sv
from ..functions.timefeat import SLOTS_PER_DAY, bucket_start, slot_start
from ..sources.calendars import REGULAR, federal_name, month_day_calendar, with_month_day_holiday

SLICE = ["hour", "dow", "holiday"]
HOLIDAY_DOW = -1


def dense_demand(
    trips: DataFrame, zones: DataFrame, zone: str = "zone_id", ts: str = "ts", first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Trips per zone and 15-minute bucket, zero rows included, over whole days from ``first`` to ``last``.

    Without these dates the span is that of the trips; give them where a stray timestamp could stretch the grid.
    Trips outside given dates are not counted. The zone days are dealt out before they become slots, so the grid is
    made by as many tasks as a shuffle has.

    Zero rows are unioned in and summed with the counts, so the grid costs no join: one shuffle on
    (zone, bucket) after map-side partial sums, which also absorbs a zone holding most events.
    """
    day = F.to_date(ts)
    span = trips.agg(F.struct(F.min(day).alias("first"), F.max(day).alias("last"))).scalar()
    start = F.lit(first) if first else span["first"]
    end = F.lit(last) if last else span["last"]
    if first or last:
        trips = trips.where(day.between(start, end))
    tasks = int(trips.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = (
        zones.select(zone, F.explode(F.sequence(start, end)).alias("_day"))
        .repartition(tasks, zone, "_day")
        .select(zone, "_day", F.explode(F.sequence(F.lit(0), F.lit(SLOTS_PER_DAY - 1))).alias("_slot"))
        .select(zone, slot_start(F.col("_day"), F.col("_slot")).alias("time_bucket"), F.lit(0).cast("bigint").alias("n"))
    )
    counted = trips.select(zone, bucket_start(ts).alias("time_bucket"), F.lit(1).cast("bigint").alias("n"))
    return counted.unionByName(grid).groupBy(zone, "time_bucket").agg(F.sum("n").alias("trip_count"))


def with_holiday_flag(fact: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """``is_holiday`` = 1 on federal holidays, or on the dates of another calendar."""
    if calendar is None:
        return fact.withColumn("is_holiday", federal_name(F.to_date("time_bucket")).isNotNull().cast("int"))
    dates = calendar.select(F.col("holiday_date").alias("_hd"))
    return (
        fact.join(dates, F.to_date("time_bucket") == F.col("_hd"), "left")
        .withColumn("is_holiday", F.col("_hd").isNotNull().cast("int"))
        .drop("_hd")
    )


def demand_profile(fact: DataFrame) -> DataFrame:
    """Mean trips by (zone, hour, weekday) on regular days and by (zone, hour, holiday) on holidays.

    Both halves come from one aggregation. A flagged date outside the month-day calendar keeps the
    name 'regular' under dow -1.
    """
    named = with_month_day_holiday(
        fact.where(F.col("is_holiday").isin(0, 1)).withColumn("_date", F.to_date("time_bucket")), "_date"
    )
    on_holiday = F.col("is_holiday") == 1
    return (
        named.select(
            "zone_id",
            F.hour("time_bucket").alias("hour"),
            F.when(on_holiday, F.lit(HOLIDAY_DOW)).otherwise(F.weekday("time_bucket")).alias("dow"),
            F.when(on_holiday, F.col("holiday")).otherwise(F.lit(REGULAR)).alias("holiday"),
            "trip_count",
        )
        .groupBy("zone_id", *SLICE)
        .agg(F.bround(F.avg("trip_count"), 3).alias("avg"))
    )


def exact_total(value: str = "avg") -> Column:
    """Sum of profile values (three decimals) in decimal arithmetic: the same whatever the order of rows."""
    return F.sum(F.col(value).cast("decimal(18,3)")).cast("double")


def served(profile: DataFrame) -> DataFrame:
    """The slices a request can name: a weekday that is regular, or dow -1 with a holiday name."""
    return profile.where((F.col("dow") == HOLIDAY_DOW) == (F.col("holiday") != REGULAR))


def pick_slice(profile: DataFrame, hour: int, dow: int, holiday: str = REGULAR, date: str | None = None) -> DataFrame:
    """Rows of one request. A ``date`` on the month-day calendar overrides ``holiday``."""
    if date is not None:
        cal = month_day_calendar(profile.sparkSession)
        day = dt.date.fromisoformat(date)
        found = cal.where((F.col("month") == day.month) & (F.col("day") == day.day)).select("holiday_name").scalar()
        wanted: Column = F.coalesce(found, F.lit(holiday))
    else:
        wanted = F.lit(holiday)
    on_dow = F.when(wanted == REGULAR, F.lit(dow)).otherwise(F.lit(HOLIDAY_DOW))
    return profile.where((F.col("hour") == hour) & (F.col("dow") == on_dow) & (F.col("holiday") == wanted))


def requests_from_dates(fact: DataFrame) -> DataFrame:
    """Distinct (hour, dow, holiday) requests for every date and hour of a demand series.

    ``dow`` stays the weekday; ``slice_dow`` is the profile key (-1 on a named holiday).
    """
    dated = fact.select(F.to_date("time_bucket").alias("_date"), F.hour("time_bucket").alias("hour")).distinct()
    return (
        with_month_day_holiday(dated, "_date")
        .select("hour", F.weekday("_date").alias("dow"), "holiday")
        .distinct()
        .withColumn("slice_dow", F.when(F.col("holiday") == REGULAR, F.col("dow")).otherwise(F.lit(HOLIDAY_DOW)))
    )


def heatmap(profile: DataFrame) -> DataFrame:
    """Zone demand with the maximum of its slice."""
    per_slice = Window.partitionBy(*SLICE)
    return served(profile).select(
        *SLICE, "zone_id", F.bround("avg", 2).alias("demand"), F.max(F.bround("avg", 2)).over(per_slice).alias("max")
    )


def forecast_flags(dates: DataFrame, reference: str, date: str = "date") -> DataFrame:
    """Marks each date as actual or predicted against a reference date."""
    is_forecast = F.col(date) > F.lit(reference).cast("date")
    return dates.withColumns(
        {
            "is_forecast": F.coalesce(is_forecast, F.lit(False)),
            "data_type": F.when(is_forecast, F.lit("predicted")).otherwise(F.lit("actual")),
        }
    )


def hour_trend(profile: DataFrame) -> DataFrame:
    """Fleet total for all 24 hours of each (dow, holiday); absent hours are zero."""
    totals = served(profile).groupBy("dow", "holiday", "hour").agg(exact_total().alias("total"))
    frame = totals.select("dow", "holiday").distinct().withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return frame.join(totals, ["dow", "holiday", "hour"], "left").select(
        "dow", "holiday", "hour", F.bround(F.coalesce("total", F.lit(0.0))).cast("bigint").alias("trips")
    )


def borough_share(profile: DataFrame, zones: DataFrame) -> DataFrame:
    """Share of each borough in the total of its slice, in percent; zones off the dimension count
    in the total but in no borough."""
    by_borough = (
        served(profile)
        .join(zones.select("zone_id", "borough"), "zone_id", "left")
        .groupBy(*SLICE, "borough")
        .agg(exact_total().alias("part"))
    )
    total = F.sum(F.col("part").cast("decimal(18,3)")).over(Window.partitionBy(*SLICE)).cast("double")
    return (
        by_borough.withColumn("total", total)
        .where(F.col("borough").isNotNull() & (F.col("total") > 0))
        .select(*SLICE, "borough", F.bround(F.col("part") / F.col("total") * 100, 1).alias("share_pct"))
    )


def kpis(profile: DataFrame, requests: DataFrame, zones: DataFrame) -> DataFrame:
    """Total, active zones, peak zone and change against the previous hour, per request.

    The previous-hour total is that of the weekday's regular profile even for a holiday request,
    and a request at hour 0 has change 0.
    """
    peak = F.max_by(F.struct("zone_id", "avg"), F.struct(F.col("avg"), -F.col("zone_id")))
    per_slice = profile.groupBy(*SLICE).agg(
        exact_total().alias("total"), F.count_if(F.col("avg") > 0).alias("active_zones"), peak.alias("peak")
    )
    previous = (
        profile.groupBy("hour", "dow").agg(exact_total().alias("prev")).select((F.col("hour") + 1).alias("hour"), "dow", "prev")
    )
    names = zones.select(F.col("zone_id").alias("peak_zone_id"), F.col("name").alias("_name"))
    return (
        requests.join(per_slice.withColumnRenamed("dow", "slice_dow"), ["hour", "slice_dow", "holiday"])
        .join(previous, ["hour", "dow"], "left")
        .withColumn("peak_zone_id", F.col("peak.zone_id"))
        .join(names, "peak_zone_id", "left")
        .select(
            *SLICE,
            F.bround("total").cast("bigint").alias("total_trips"),
            F.col("active_zones").cast("bigint").alias("active_zones"),
            F.col("peak_zone_id").cast("bigint").alias("peak_zone_id"),
            sv.zone_label(F.col("_name"), F.col("peak_zone_id")).alias("peak_zone_name"),
            F.bround("peak.avg").cast("bigint").alias("peak_zone_trips"),
            F.when(F.col("prev") > 0, F.bround((F.col("total") - F.col("prev")) / F.col("prev") * 100, 1))
            .otherwise(F.lit(0.0))
            .alias("vs_prev_hour_pct"),
        )
    )


def zone_ranking(profile: DataFrame, zones: DataFrame, n: int = 15) -> DataFrame:
    """Top ``n`` zones of each slice with share of the maximum and trend against the hour before.

    The row-number filter is pushed below the shuffle (window group limit), so each task forwards
    at most ``n`` rows of a slice. Hour 0 is compared with itself.
    """
    series = Window.partitionBy("zone_id", "dow", "holiday").orderBy("hour")
    before = F.max("avg").over(series.rangeBetween(-1, -1))
    in_slice = Window.partitionBy(*SLICE)
    best = in_slice.orderBy(F.col("avg").desc(), "zone_id")
    top = (
        served(profile)
        .withColumn("prev", F.coalesce(before, F.col("avg")))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .withColumn("top", F.max("avg").over(in_slice))
    )
    return top.join(zones.select("zone_id", "name", "borough"), "zone_id", "left").select(
        *SLICE,
        F.col("rank").cast("bigint").alias("rank"),
        F.col("zone_id").cast("bigint").alias("zone_id"),
        sv.zone_label(F.col("name"), F.col("zone_id")).alias("name"),
        F.coalesce("borough", F.lit("")).alias("borough"),
        F.bround("avg", 1).alias("trips"),
        F.when(F.col("top") > 0, F.bround(F.col("avg") / F.col("top") * 100)).cast("bigint").alias("pct_of_max"),
        sv.hour_trend_label(F.col("avg"), F.col("prev")).alias("trend"),
        sv.is_airport(F.col("zone_id")).alias("is_airport"),
    )


def zone_trend(profile: DataFrame) -> DataFrame:
    """Day curve of every zone; order by hour to read one."""
    return served(profile).select("zone_id", "dow", "holiday", "hour", F.bround("avg", 1).alias("trips"))


def zone_level(profile: DataFrame, zones: DataFrame) -> DataFrame:
    """Demand level of each zone relative to the busiest zone of its slice."""
    hour_max = F.max("avg").over(Window.partitionBy(*SLICE))
    trips = F.bround("avg", 1)
    levelled = served(profile).withColumn("hour_max", hour_max).withColumn(
        "demand_pct",
        F.when(F.col("hour_max") > 0, F.bround(trips / F.col("hour_max") * 100)).otherwise(F.lit(0.0)).cast("bigint"),
    )
    return levelled.join(zones.select("zone_id", "name", "borough"), "zone_id", "left").select(
        *SLICE,
        F.col("zone_id").cast("bigint").alias("zone_id"),
        sv.zone_label(F.col("name"), F.col("zone_id")).alias("name"),
        F.coalesce("borough", F.lit("")).alias("borough"),
        trips.alias("trips"),
        "demand_pct",
        sv.demand_level(F.col("demand_pct")).alias("demand_level"),
    )


def volatility(fact: DataFrame) -> DataFrame:
    """Sample standard deviation over mean of trips by (zone, hour); 0 where the mean is 0."""
    return (
        fact.where(F.col("trip_count").isNotNull())
        .groupBy("zone_id", F.hour("time_bucket").alias("hour"))
        .agg(F.avg("trip_count").alias("m"), F.stddev_samp("trip_count").alias("s"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("zone_id", "hour", F.when(F.col("m") > 0, F.col("s") / F.col("m")).otherwise(F.lit(0.0)).alias("volatility"))
    )


def zone_threshold(profile: DataFrame, quantile: float = 0.75) -> DataFrame:
    """Exact quantile of each zone's profile values.

    Exact ``percentile`` is safe here: a zone has at most 24 x (7 + holidays) profile rows.
    """
    return profile.groupBy("zone_id").agg(F.percentile("avg", F.lit(quantile)).alias("threshold"))


def next_hour(profile: DataFrame) -> DataFrame:
    """Demand now and in the next hour (wrapping at midnight) with the percent change."""
    current = served(profile)
    following = current.select(
        "zone_id", ((F.col("hour") + 23) % 24).alias("hour"), "dow", "holiday", F.col("avg").alias("following")
    )
    joined = current.join(following, ["zone_id", *SLICE], "left")
    after = F.coalesce("following", "avg")
    return joined.select(
        "zone_id",
        *SLICE,
        F.col("avg").alias("demand_current"),
        after.alias("demand_next_hour"),
        sv.percent_change(F.col("avg"), after).alias("change_pct"),
    )


def trend_direction(forecast: DataFrame, keys: list[str], step: str = "step", value: str = "yhat") -> DataFrame:
    """Outlook from forecast steps: mean of steps 13-16 against steps 1-4, with a 10 % band."""
    early = F.avg(F.when(F.col(step).between(1, 4), F.col(value)))
    late = F.avg(F.when(F.col(step).between(13, 16), F.col(value)))
    return (
        forecast.groupBy(*keys)
        .agg(early.alias("early"), late.alias("late"), F.count_if(F.col(step).between(1, 16)).alias("steps"))
        .select(*keys, sv.outlook(F.col("early"), F.col("late"), F.col("steps")).alias("trend_direction"))
    )


def operator_zones(
    profile: DataFrame,
    fact: DataFrame,
    zones: DataFrame,
    threshold_quantile: float = 0.75,
    outlook: DataFrame | None = None,
) -> DataFrame:
    """The operator table: one row per zone and slice, with unmet demand, supply status and action.

    ``outlook`` (zone_id, demand_next_hour, trend_direction) replaces the profile's next hour when
    the request lies in the forecast period.
    """
    demand = next_hour(profile)
    if outlook is not None:
        ahead = outlook.select("zone_id", F.col("demand_next_hour").alias("_next"), F.col("trend_direction").alias("_trend"))
        demand = demand.join(ahead, "zone_id", "left").withColumns(
            {
                "is_forecast": F.col("_next").isNotNull(),
                "demand_next_hour": F.coalesce("_next", "demand_next_hour"),
                "trend_direction": F.coalesce("_trend", F.lit("stable")),
            }
        )
        demand = demand.withColumn("change_pct", sv.percent_change(F.col("demand_current"), F.col("demand_next_hour")))
    else:
        demand = demand.withColumns({"is_forecast": F.lit(False), "trend_direction": F.lit("stable")})
    now = F.col("demand_current")
    enriched = (
        demand.join(zone_threshold(profile, threshold_quantile), "zone_id", "left")
        .join(volatility(fact), ["zone_id", "hour"], "left")
        .join(zones.select("zone_id", "name", "borough"), "zone_id", "left")
        .withColumn("volatility", F.coalesce("volatility", F.lit(0.0)))
        .withColumn("unmet", sv.unmet_demand(now, F.coalesce("threshold", F.lit(0.0))))
        .withColumn("volatility_label", sv.volatility_label(F.col("volatility")))
        .withColumn("supply_status", sv.supply_status(F.col("unmet"), now))
    )
    table = enriched.select(
        *SLICE,
        F.col("zone_id").cast("bigint").alias("zone_id"),
        sv.zone_label(F.col("name"), F.col("zone_id")).alias("name"),
        F.coalesce("borough", F.lit("")).alias("borough"),
        F.bround(now, 1).alias("demand_now"),
        F.bround("demand_next_hour", 1).alias("demand_next_hour"),
        "change_pct",
        F.col("unmet").alias("unmet_demand"),
        F.greatest(F.lit(1), F.bround(now / 25)).cast("bigint").alias("drivers_needed"),
        F.bround(now * sv.REVENUE_PER_TRIP).cast("bigint").alias("revenue_potential"),
        "supply_status",
        "is_forecast",
        F.when(F.col("is_forecast"), F.lit("model")).otherwise(F.lit("actual")).alias("forecast_source"),
        "volatility_label",
        F.bround("volatility", 2).alias("volatility_score"),
        "trend_direction",
        sv.action_text(F.col("supply_status"), F.col("volatility_label"), F.col("trend_direction")).alias("action"),
    )
    # The order of the served table: unmet demand, then demand, within a slice.
    order = Window.partitionBy(*SLICE).orderBy(F.col("unmet_demand").desc(), F.col("demand_now").desc(), "zone_id")
    return table.withColumn("rank", F.row_number().over(order).cast("bigint"))


def zone_hour_fare(rides: DataFrame, fare: str = "fare", ts: str = "ts") -> DataFrame:
    """Average fare by zone and hour; the sum is exact, so the average does not depend on the order of rides."""
    total = F.sum(F.col(fare).cast("decimal(18,6)")).cast("double")
    return rides.groupBy("zone_id", F.hour(ts).alias("hour")).agg((total / F.nullif(F.count(fare), F.lit(0))).alias("avg_fare"))


def recommendations(
    profile: DataFrame,
    zones: DataFrame,
    fares: DataFrame,
    centroids: DataFrame | None = None,
    n: int = 3,
    hot_share: float = 0.7,
    service_minutes: int = 20,
) -> DataFrame:
    """Where a driver in each zone should go next, for every slice.

    Candidates of an origin are the slice's non-airport zones other than the origin; a hot origin
    (above ``hot_share`` of the slice's maximum) is listed first as a stay. Origin and candidate
    meet on the slice key. Its two sides are rows of the zone dimension (hundreds at most), never
    fact rows, and only the ``n`` best per origin cross the ranking shuffle.
    """
    slices = served(profile).withColumn("top", F.max("avg").over(Window.partitionBy(*SLICE)))
    dim = zones.select("zone_id", "name", "borough")
    if centroids is not None:
        dim = dim.join(centroids, "zone_id", "left")
    else:
        dim = dim.withColumns({"lat": F.lit(None).cast("double"), "lon": F.lit(None).cast("double")})
    priced = (
        slices.join(dim, "zone_id", "left")
        .join(fares, ["zone_id", "hour"], "left")
        .withColumn("fare", sv.clamp_fare(F.col("avg_fare")))
        .withColumn("max_trips", F.least(F.lit(4), F.col("avg").cast("bigint")))
    )
    origin = slices.join(dim.select("zone_id", "lat", "lon"), "zone_id", "left").select(
        *SLICE, F.col("zone_id").alias("origin_id"), F.col("lat").alias("o_lat"), F.col("lon").alias("o_lon")
    )
    to_zone = priced.where(~sv.is_airport(F.col("zone_id"))).select(
        *SLICE, "zone_id", "name", "borough", "avg", "top", "fare", "max_trips", "lat", "lon"
    )
    minutes = sv.drive_minutes(
        F.col("o_lat"), F.col("o_lon"), F.col("lat"), F.col("lon"), F.col("origin_id"), F.col("zone_id")
    )
    moves = (
        origin.join(to_zone, SLICE)
        .where(F.col("origin_id") != F.col("zone_id"))
        .withColumn("drive_minutes", minutes)
        .withColumn("efficiency", F.col("max_trips") * F.col("fare") / (F.col("drive_minutes") + service_minutes))
        .withColumn("demand_score", F.when(F.col("top") > 0, F.bround(F.col("avg") / F.col("top") * 100)).cast("bigint"))
        .withColumn("label", sv.zone_label(F.col("name"), F.col("zone_id")))
    )
    stays = (
        priced.where((F.col("top") > 0) & (F.col("avg") / F.col("top") > hot_share))
        .withColumn("origin_id", F.col("zone_id"))
        .withColumns(
            {
                "drive_minutes": F.lit(0).cast("bigint"),
                "efficiency": F.lit(999.0),
                "demand_score": F.lit(100).cast("bigint"),
                "label": F.concat(F.lit("Stay: "), sv.zone_label(F.col("name"), F.col("zone_id"))),
            }
        )
    )
    cols = [*SLICE, "origin_id", "zone_id", "label", "borough", "avg", "fare", "max_trips", "drive_minutes", "efficiency", "demand_score"]
    best = Window.partitionBy("origin_id", *SLICE).orderBy(
        F.col("efficiency").desc(), F.col("demand_score").desc(), "zone_id"
    )
    return (
        moves.select(cols)
        .unionByName(stays.select(cols))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= n)
        .select(
            *SLICE,
            F.col("origin_id").cast("bigint").alias("origin_id"),
            F.col("rank").cast("bigint").alias("rank"),
            F.col("zone_id").cast("bigint").alias("zone_id"),
            F.col("label").alias("name"),
            F.coalesce("borough", F.lit("")).alias("borough"),
            F.bround("avg", 1).alias("trips"),
            "demand_score",
            "drive_minutes",
            F.col("fare").cast("bigint").alias("est_yield_min"),
            (F.col("max_trips") * F.col("fare")).cast("bigint").alias("est_yield_max"),
            F.round("efficiency", 6).alias("efficiency_score"),
        )
    )
