"""Holiday dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .literals import literal_table

# Holidays by month and day.
MONTH_DAY_HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (1, 20, "MLK Day"),
    (2, 17, "Presidents Day"),
    (3, 17, "St. Patrick's Day"),
    (5, 26, "Memorial Day"),
    (7, 4, "Independence Day"),
    (9, 1, "Labor Day"),
    (10, 13, "Columbus Day"),
    (10, 31, "Halloween"),
    (11, 11, "Veterans Day"),
    (11, 27, "Thanksgiving"),
    (12, 24, "Christmas Eve"),
    (12, 25, "Christmas"),
    (12, 31, "New Year's Eve"),
]

# Federal holidays. Fixed-date ones are (month, day, name); the others fall on the
# n-th weekday of a month (Monday is 0, n = -1 is the last one).
FEDERAL_FIXED = [
    (1, 1, "New Year's Day"),
    (6, 19, "Juneteenth"),
    (7, 4, "Independence Day"),
    (11, 11, "Veterans Day"),
    (12, 25, "Christmas Day"),
]
FEDERAL_FLOATING = [
    (1, 0, 3, "MLK Day"),
    (2, 0, 3, "Presidents Day"),
    (5, 0, -1, "Memorial Day"),
    (9, 0, 1, "Labor Day"),
    (10, 0, 2, "Columbus Day"),
    (11, 3, 4, "Thanksgiving"),
]
FEDERAL_OBSERVED = [(dt.date(2026, 7, 3), "Independence Day (observed)")]

REGULAR = "regular"


def _nth_weekday(year: int, month: int, weekday: int, n: int) -> dt.date:
    if n < 0:
        last = dt.date(year, month, 28) + dt.timedelta(days=4)
        last -= dt.timedelta(days=last.day)
        return last - dt.timedelta(days=(last.weekday() - weekday) % 7)
    first = dt.date(year, month, 1)
    return first + dt.timedelta(days=(weekday - first.weekday()) % 7 + 7 * (n - 1))


def federal_holidays(years: Iterable[int]) -> list[tuple[dt.date, str]]:
    """Dates of the federal calendar in the given years, in order."""
    years = set(years)
    days = [(dt.date(y, m, d), name) for y in years for m, d, name in FEDERAL_FIXED]
    days += [(_nth_weekday(y, m, wd, n), name) for y in years for m, wd, n, name in FEDERAL_FLOATING]
    days += [(d, name) for d, name in FEDERAL_OBSERVED if d.year in years]
    return sorted(days)


def month_day_calendar(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MONTH_DAY_HOLIDAYS, "month int, day int, holiday_name string")


def federal_calendar(spark: SparkSession, *years: int) -> DataFrame:
    """The dates of the given years as a table."""
    return literal_table(spark, federal_holidays(years), "holiday_date date, holiday_name string")


def federal_name(date: Column) -> Column:
    """The federal holiday on a date of any year, NULL on other days: the calendar as a rule instead of a table."""
    month, day, weekday = F.month(date), F.dayofmonth(date), F.weekday(date)
    name = F.coalesce(*[F.when(date == F.lit(d), F.lit(n)) for d, n in FEDERAL_OBSERVED])
    for m, wd, n, text in FEDERAL_FLOATING:
        nth = day > F.dayofmonth(F.last_day(date)) - 7 if n < 0 else F.ceil(day / 7) == n
        name = F.coalesce(name, F.when((month == m) & (weekday == wd) & nth, F.lit(text)))
    for m, d, text in FEDERAL_FIXED:
        name = F.coalesce(name, F.when((month == m) & (day == d), F.lit(text)))
    return name


def with_month_day_holiday(df: DataFrame, date_col: str, requested: str | None = None) -> DataFrame:
    """Adds ``holiday``: the name for the date's month and day, else ``requested``, else 'regular'.

    The calendar is a literal table of 14 rows, so Spark broadcasts it by its known size.
    """
    cal = month_day_calendar(df.sparkSession).select(
        F.col("month").alias("_m"), F.col("day").alias("_d"), F.col("holiday_name").alias("_name")
    )
    d = F.col(date_col)
    fallback = F.col(requested) if requested else F.lit(REGULAR)
    return (
        df.join(cal, (F.month(d) == F.col("_m")) & (F.dayofmonth(d) == F.col("_d")), "left")
        .withColumn("holiday", F.coalesce("_name", fallback))
        .drop("_m", "_d", "_name")
    )


def with_federal_holiday(df: DataFrame, date: Column, name: str = "federal_name") -> DataFrame:
    """Adds the federal holiday of a date; ``name`` is null on other days."""
    return df.withColumn(name, federal_name(date))
