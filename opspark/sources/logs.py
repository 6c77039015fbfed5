"""Append-only logs and report sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append_log(rows: DataFrame, path: str, ts: str = "timestamp", batch: str | None = None) -> None:
    """Appends records to a Parquet log partitioned by day.

    Rows of a day are spread over a few files per task instead of one task per day, so a busy day stays parallel.
    With the name of a ``batch`` the append can be repeated: what the batch wrote before is replaced, not doubled. All appends to one log
    should then be named.
    """
    dated = rows.withColumn("log_date", F.to_date(ts))
    if batch is None:
        dated.write.mode("append").partitionBy("log_date").parquet(path)
        return
    # A folder for each batch, with its days in it: only this one is written anew.
    dated.write.mode("overwrite").partitionBy("log_date").parquet(f"{path}/batch={batch}")


def scan_log(spark: SparkSession, path: str, condition: Column | None = None, schema=None) -> DataFrame:
    """Records of a log that meet a condition; conditions on ``log_date`` prune partitions, others reach Parquet."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    log = reader.parquet(path)
    return log if condition is None else log.where(condition)


def _by(name: str):
    """Order of structs by one field; maps cannot be compared."""

    def order(a: Column, b: Column) -> Column:
        return F.when(a[name] < b[name], -1).when(a[name] > b[name], 1).otherwise(0)

    return order


def report_rows(metrics: DataFrame) -> DataFrame:
    """Nested form of a long metrics table: one row per metric with grouping -> segment -> field -> value.

    The maps hold one entry per segment, not per data row, in ascending order, so that the JSON text is always the same.
    """
    fields = metrics.where(F.col("value").isNotNull()).groupBy("metric", "grouping", "segment").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "value")))).alias("fields")
    )
    segments = fields.groupBy("metric", "grouping").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("segment", "fields")), _by("segment"))).alias("segments")
    )
    return segments.groupBy("metric").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("grouping", "segments")), _by("grouping"))).alias("report")
    )


def write_report(metrics: DataFrame, alerts: DataFrame, decision: DataFrame, path: str) -> None:
    """Report of a monitoring run: metrics, alerts and decision as JSON lines next to each other."""
    for name, rows in (("metrics", report_rows(metrics)), ("alerts", alerts), ("decision", decision)):
        rows.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")
