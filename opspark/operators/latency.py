"""Quantiles of latencies by component, from stored sketches of single days that merge into any period.

A sketch counts values in buckets whose limits grow by a constant factor, so each estimate is within ``error`` of the exact
quantile, relative to it. Counts add up: a day is sketched once, and a period is the sum of its days' buckets.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ERROR = 0.01
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
SKETCH = "component string, bucket bigint, n bigint, day date"

#: Values at or below are counted as this.
SMALLEST = 1e-6


def growth(error: float) -> float:
    return (1 + error) / (1 - error)


def sketch(rows: DataFrame, component: str, value: str, ts: str, error: float = ERROR) -> DataFrame:
    """(day, component, bucket, n): map-side combined, at most some thousand buckets for each component and day."""
    v = F.greatest(F.col(value), F.lit(SMALLEST))
    bucket = F.ceil(F.ln(v) / F.lit(math.log(growth(error))))
    kept = rows.where(F.col(value).isNotNull() & ~F.isnan(value))
    return kept.groupBy(F.to_date(ts).alias("day"), F.col(component).alias("component"), bucket.cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def store_days(sketches: DataFrame, path: str) -> None:
    """Adds days to a store, each a folder; a day that is written again replaces itself."""
    spark = sketches.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, "static")
    spark.conf.set(mode, "dynamic")
    try:
        sketches.select("component", "bucket", "n", "day").write.mode("overwrite").partitionBy("day").parquet(path)
    finally:
        spark.conf.set(mode, before)


def stored(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """The sketches of a period, both days included; only their folders are read."""
    days = spark.read.schema(SKETCH).parquet(path)
    return days.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def quantiles(sketches: DataFrame, wanted: dict[str, float] | None = None, error: float = ERROR) -> DataFrame:
    """n and the estimated quantiles of each component: the value at rank q * (n - 1), counted from 0, without interpolation."""
    wanted = wanted or QUANTILES
    merged = sketches.groupBy("component", "bucket").agg(F.sum("n").alias("n"))
    # The buckets of a component are bounded by the range of a double, whatever the number of rows.
    order = Window.partitionBy("component").orderBy("bucket")
    ranked = merged.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy("component"))})
    g = growth(error)
    middle = F.pow(F.lit(g), F.col("bucket").cast("double")) * F.lit(2.0 / (g + 1.0))
    picks = [F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("total") - 1)), middle)).alias(name) for name, q in wanted.items()]
    return ranked.groupBy("component").agg(F.max("total").alias("n"), *picks)
