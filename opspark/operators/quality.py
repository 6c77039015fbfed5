"""Validation, cleaning and exploration of an incoming demand batch.

Issue frames have the columns check, severity, description, details (map) and affected_rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..plans.ranks import exact_quantiles
from ..session import cut_lineage
from ..sources.calendars import federal_calendar, federal_name

# Fixed values of the validation rules.
SENTINELS = (-5, -1, 9999, 99999)
NEGATIVE_FLOOR = 0
MAX_HISTORICAL = 465
MAX_DROP_RATE = 0.05

KEY = ["zone_id", "time_bucket"]
ISSUE_SCHEMA = "check string, severity string, description string, details map<string,string>, affected_rows bigint"


class DropRateExceeded(Exception):
    """Cleaning would drop more rows than allowed."""


def value_class(trips: Column) -> Column:
    """'sentinel', 'negative', 'over_max' or 'ok'; the classes are disjoint and NULL is 'ok'."""
    return (
        F.when(trips.isin(*SENTINELS), "sentinel")
        .when(trips < NEGATIVE_FLOOR, "negative")
        .when(trips > MAX_HISTORICAL, "over_max")
        .otherwise("ok")
    )


def missing_columns(df: DataFrame, check: str, needed: list[str]) -> DataFrame | None:
    """One critical issue for the first required column that is absent, or None."""
    for column in needed:
        if column not in df.columns:
            return df.sparkSession.sql(
                f"SELECT '{check}' AS check, 'critical' AS severity, 'column {column} is missing' AS description, "
                "CAST(map() AS map<string,string>) AS details, 0L AS affected_rows"
            )
    return None


def _first_zones(zone: str, k: int) -> Column:
    return F.array_join(F.array_sort(F.collect_list(F.when(F.col("_rn") <= k, F.col(zone)))), ",")


def _details(**parts: Column) -> Column:
    pairs = [x for name, c in parts.items() for x in (F.lit(name), c.cast("string"))]
    return F.create_map(*pairs)


def value_range_findings(df: DataFrame) -> DataFrame:
    """Per class (and per sentinel value): rows, extremes and the first 20 zones.

    Rows collapse to one per (class, value, zone) before anything is grouped or ranked.
    """
    t = F.col("trip_count")
    per_zone = (
        df.withColumn("class", value_class(t))
        .where(F.col("class") != "ok")
        .groupBy("class", F.when(F.col("class") == "sentinel", t.cast("bigint")).alias("value"), "zone_id")
        .agg(F.count("*").alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"))
    )
    order = Window.partitionBy("class", "value").orderBy("zone_id")
    return (
        per_zone.withColumn("_rn", F.row_number().over(order))
        .groupBy("class", "value")
        .agg(
            F.sum("n").alias("affected_rows"),
            F.min("lo").cast("double").alias("min"),
            F.max("hi").cast("double").alias("max"),
            _first_zones("zone_id", 20).alias("zones"),
        )
    )


def check_value_ranges(df: DataFrame) -> DataFrame:
    absent = missing_columns(df, "value_ranges", ["trip_count"])
    if absent is not None:
        return absent
    kind, value = F.col("class"), F.col("value").cast("string")
    text = (
        F.when(kind == "sentinel", F.concat(F.lit("trip_count sentinel value "), value, F.lit(" detected")))
        .when(kind == "negative", F.lit("trip_count negative values outside sentinel set"))
        .otherwise(F.lit(f"trip_count > historical max ({MAX_HISTORICAL})"))
    )
    count = F.col("affected_rows")
    details = (
        F.when(kind == "sentinel", _details(value=value, count=count, zones=F.col("zones")))
        .when(kind == "negative", _details(count=count, min=F.col("min")))
        .otherwise(_details(count=count, max_observed=F.col("max"), historical_max=F.lit(MAX_HISTORICAL)))
    )
    return value_range_findings(df).select(
        F.lit("value_ranges").alias("check"),
        F.lit("critical").alias("severity"),
        text.alias("description"),
        details.alias("details"),
        "affected_rows",
    )


def false_holidays(df: DataFrame) -> DataFrame:
    """Rows flagged as holiday on a date off the federal calendar, counted by date."""
    flagged = df.where(F.col("is_holiday") == 1).groupBy(F.to_date("time_bucket").alias("date")).agg(F.count("*").alias("n"))
    return flagged.where(federal_name(F.col("date")).isNull())


def check_holiday_labels(df: DataFrame) -> DataFrame:
    absent = missing_columns(df, "holiday_labels", ["is_holiday", "time_bucket"])
    if absent is not None:
        return absent
    found = false_holidays(df).agg(
        F.sum("n").alias("n"),
        F.array_join(F.array_sort(F.collect_list(F.col("date").cast("string"))), ",").alias("dates"),
        F.count("date").alias("date_count"),
    )
    return found.where(F.col("n") > 0).select(
        F.lit("holiday_labels").alias("check"),
        F.lit("critical").alias("severity"),
        F.lit("is_holiday=1 on dates that are not real US Federal holidays").alias("description"),
        _details(affected_dates=F.col("dates"), date_count=F.col("date_count"), affected_rows=F.col("n")).alias("details"),
        F.col("n").alias("affected_rows"),
    )


def duplicate_keys(df: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*KEY).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def duplicate_findings(df: DataFrame) -> DataFrame:
    """Duplicate keys rolled up over zones to one row."""
    by_zone = duplicate_keys(df).groupBy("zone_id").agg(
        F.count("*").alias("keys"),
        F.sum(F.col("n") - 1).alias("extra"),
        F.min("time_bucket").alias("first"),
        F.max("time_bucket").alias("last"),
    )
    # One row per affected zone reaches this window: the size of the zone dimension at most.
    ranked = by_zone.withColumn("_rn", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("zone_id")))
    return ranked.agg(
        F.coalesce(F.sum("keys"), F.lit(0)).alias("duplicate_key_count"),
        F.coalesce(F.sum("extra"), F.lit(0)).alias("extra_rows"),
        F.count("zone_id").alias("affected_zone_count"),
        _first_zones("zone_id", 25).alias("affected_zones"),
        F.min("first").alias("first_time"),
        F.max("last").alias("last_time"),
    )


def check_duplicates(df: DataFrame) -> DataFrame:
    absent = missing_columns(df, "duplicates", KEY)
    if absent is not None:
        return absent
    return duplicate_findings(df).where(F.col("extra_rows") > 0).select(
        F.lit("duplicates").alias("check"),
        F.lit("critical").alias("severity"),
        F.lit("duplicate (zone, time_bucket) keys detected").alias("description"),
        _details(
            duplicate_key_count=F.col("duplicate_key_count"),
            extra_rows_beyond_first=F.col("extra_rows"),
            affected_zone_count=F.col("affected_zone_count"),
            affected_zones=F.col("affected_zones"),
            first_time=F.col("first_time"),
            last_time=F.col("last_time"),
        ).alias("details"),
        F.col("extra_rows").alias("affected_rows"),
    )


def validate(df: DataFrame) -> DataFrame:
    """All issues of a batch; the batch passes when none is critical."""
    return reduce(DataFrame.unionByName, [check_value_ranges(df), check_holiday_labels(df), check_duplicates(df)])


def passed(issues: DataFrame) -> DataFrame:
    """One row: whether the batch passed, and how many issues it has."""
    critical = F.count_if(F.col("severity") == "critical")
    return issues.agg((critical == 0).alias("passed"), F.count("*").alias("issues"))


def summary(issues: DataFrame) -> DataFrame:
    return issues.groupBy("check").agg(F.count("*").alias("issues"), F.sum("affected_rows").alias("rows"))


def _valid(df: DataFrame) -> DataFrame:
    return df.where(value_class(F.col("trip_count")) == "ok") if "trip_count" in df.columns else df


def clean(df: DataFrame, order: str) -> DataFrame:
    """Valid rows, first row per key by ``order``, false holiday flags set to 0.

    The first-row filter is a window group limit: every task keeps one row per key before the shuffle,
    so a key with very many copies costs no more than any other.
    """
    out = _valid(df)
    if set(KEY) <= set(out.columns):
        first = Window.partitionBy(*KEY).orderBy(order)
        out = out.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")
    if {"is_holiday", "time_bucket"} <= set(out.columns):
        out = _fix_flags(out)
    return out


def _false_flag(df: DataFrame) -> DataFrame:
    wrong = (F.col("is_holiday") == 1) & federal_name(F.to_date("time_bucket")).isNull()
    return df.withColumn("_wrong", F.coalesce(wrong, F.lit(False)))


def _fix_flags(df: DataFrame) -> DataFrame:
    fixed = F.when(F.col("_wrong"), F.lit(0)).otherwise(F.col("is_holiday")).cast(df.schema["is_holiday"].dataType)
    return _false_flag(df).withColumn("is_holiday", fixed).drop("_wrong")


def quarantine(df: DataFrame, order: str) -> DataFrame:
    """The rows ``clean`` drops, with the reason.

    Copies are found by a join to the first row of their key. That table is written first: both join sides are
    then plain shuffles, so AQE can split the partition of a key with very many copies.
    """
    kind = value_class(F.col("trip_count"))
    invalid = df.where(kind != "ok").withColumn("reason", kind)
    valid = _valid(df)
    first = cut_lineage(
        valid.groupBy(*[F.col(k).alias(f"_{k}") for k in KEY])
        .agg(F.min(order).alias("_first"), F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
    )
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY])
    copies = (
        valid.join(first, on)
        .where(F.col(order) > F.col("_first"))
        .select(*valid.columns)
        .withColumn("reason", F.lit("duplicate"))
    )
    return invalid.unionByName(copies)


def clean_report(df: DataFrame, order: str) -> DataFrame:
    """Counts of what ``clean`` does, in one pass: rows are combined per key before the totals."""
    kind = value_class(F.col("trip_count"))
    ok = kind == "ok"
    per_key = (
        df.groupBy(*KEY)
        .agg(
            F.count("*").alias("rows"),
            F.count_if(~ok).alias("invalid"),
            F.count_if(ok).alias("valid"),
            F.min_by(F.when(ok, F.col("is_holiday")), F.when(ok, F.col(order))).alias("is_holiday"),
        )
    )
    wrong = F.col("_wrong") & (F.col("valid") > 0)
    totals = _false_flag(per_key).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("original_rows"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("dropped_invalid"),
        F.coalesce(F.sum(F.greatest(F.col("valid") - 1, F.lit(0))), F.lit(0)).alias("dropped_duplicates"),
        F.count_if(wrong).alias("rows_modified"),
    )
    dropped = F.col("dropped_invalid") + F.col("dropped_duplicates")
    return totals.select(
        "*",
        dropped.alias("rows_dropped"),
        (F.col("original_rows") - dropped).alias("final_rows"),
        F.round(dropped / F.greatest(F.col("original_rows"), F.lit(1)), 6).alias("drop_rate"),
    )


def clean_guarded(df: DataFrame, order: str, max_drop_rate: float = MAX_DROP_RATE) -> tuple[DataFrame, Row]:
    """Cleaned frame and its report row; raises when the drop rate is over the limit."""
    report = clean_report(df, order).first()
    if report.rows_dropped / max(report.original_rows, 1) > max_drop_rate:
        raise DropRateExceeded(
            f"dropped {report.rows_dropped} of {report.original_rows} rows, limit {max_drop_rate:.2%}"
        )
    return clean(df, order), report


# Exploration


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null rate per column in both windows and the change; one pass, then one row is unpivoted."""
    present = [c for c in columns if c in df.columns]
    new = F.col("is_new")
    aggs = [F.count_if(~new).alias("_nb"), F.count_if(new).alias("_nn")]
    for c in present:
        aggs.append(F.count_if(~new & F.col(c).isNull()).alias(f"b_{c}"))
        aggs.append(F.count_if(new & F.col(c).isNull()).alias(f"n_{c}"))
    base_n = F.when(F.col("_nb") > 0, F.col("_nb"))
    new_n = F.when(F.col("_nn") > 0, F.col("_nn"))
    rows = [
        F.struct(
            F.lit(c).alias("column"), (F.col(f"b_{c}") / base_n).alias("base_rate"), (F.col(f"n_{c}") / new_n).alias("new_rate")
        )
        for c in present
    ]
    return (
        df.agg(*aggs)
        .select(F.explode(F.array(*rows)).alias("r"))
        .select("r.*", (F.col("r.new_rate") - F.col("r.base_rate")).alias("delta"))
    )


def describe_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """min, max, mean, std, p95 and p99 per column and window. Quantiles are exact and distributed."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns if c in df.columns]
    )
    long = df.select("is_new", F.explode(pairs).alias("p")).select("is_new", "p.column", "p.value").where(F.col("value").isNotNull())
    by = ["column", "is_new"]
    basics = long.groupBy(*by).agg(
        F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
    return basics.join(exact_quantiles(long, by, "value", {"p95": 0.95, "p99": 0.99}), by)


def lag_correlation(df: DataFrame, lag: str = "lag_1week", min_rows: int = 50) -> DataFrame:
    """Pearson correlation of a lag with the series per zone, NULL without spread; information only, never an issue."""
    x, y = F.col(lag).cast("double"), F.col("trip_count").cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return (
        df.groupBy("zone_id")
        .agg(F.covar_pop(x, y).alias("_cov"), spread.alias("_spread"), F.count("*").alias("n"))
        .where(F.col("n") >= min_rows)
        .select("zone_id", (F.col("_cov") / F.when(F.col("_spread") > 0, F.col("_spread"))).alias("corr"), "n")
    )


def holiday_flag_rates(df: DataFrame) -> DataFrame:
    """Share of flagged rows per date and whether the date is a real holiday."""
    rates = df.groupBy(F.to_date("time_bucket").alias("date")).agg(
        F.avg("is_holiday").alias("rate"), F.count("*").alias("rows"), F.count_if(F.col("is_holiday") == 1).alias("flagged")
    )
    return rates.withColumn("holiday_name", federal_name(F.col("date")))


def holiday_flag_audit(df: DataFrame, year: int) -> DataFrame:
    """Every calendar date of a year with the state of its flags in the data."""
    rates = df.groupBy(F.to_date("time_bucket").alias("holiday_date")).agg(F.avg("is_holiday").alias("rate"))
    state = (
        F.when(F.col("rate").isNull(), "no data")
        .when(F.col("rate") >= 0.99, "FLAGGED")
        .when(F.col("rate") > 0, "partial")
        .otherwise("MISSING")
    )
    return federal_calendar(df.sparkSession, year).join(rates, "holiday_date", "left").withColumn("status", state)


def invalid_drilldown(df: DataFrame, k: int = 10) -> DataFrame:
    """Invalid rows by zone, by date and by value; the ``k`` largest groups of each."""
    cells = (
        df.where(value_class(F.col("trip_count")) != "ok")
        .groupBy("zone_id", F.to_date("time_bucket").alias("date"), F.col("trip_count").cast("bigint").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    sets = [[F.col("zone_id")], [F.col("date")], [F.col("value")]]
    rolled = cells.groupingSets(sets, F.col("zone_id"), F.col("date"), F.col("value")).agg(
        F.grouping("zone_id").alias("_z"), F.grouping("date").alias("_d"), F.sum("n").alias("rows")
    )
    grouping = F.when(F.col("_z") == 0, "zone").when(F.col("_d") == 0, "date").otherwise("value")
    item = F.coalesce(F.col("zone_id").cast("string"), F.col("date").cast("string"), F.col("value").cast("string"))
    best = Window.partitionBy("grouping").orderBy(F.col("rows").desc(), "item")
    return (
        rolled.select(grouping.alias("grouping"), item.alias("item"), "rows")
        .withColumn("rank", F.row_number().over(best).cast("bigint"))
        .where(F.col("rank") <= k)
    )
