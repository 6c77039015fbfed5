"""When to retrain: a state machine over the alert history of each model.

A model is due on the day of an alert if, with it, at least ``k`` of the last ``n`` days had one. After that it is cooling down for ``cooldown`` days: alerts
are noted but it is not due again; those up to the day it was due no longer count. A model's history is one small row a day, folded in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def triggers(history: DataFrame, model: str, day: str, alerted: str, k: int, n: int, cooldown: int) -> DataFrame:
    """(model, day) of every due date. Several rows of a day are one, alerted if any is; days without a row have no alert."""
    daily = history.where(F.col(day).isNotNull()).groupBy(F.col(model).alias("model"), F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).alias("d")).agg(F.max(F.coalesce(F.col(alerted), F.lit(False)).cast("int")).alias("a"))
    alerts = daily.where("a = 1").groupBy("model").agg(F.array_sort(F.collect_list("d")).alias("days"))
    empty = F.array().cast("array<int>")
    start = F.struct(empty.alias("due"), empty.alias("open"), F.lit(-(10**6)).alias("last"))

    def step(state: Column, today: Column) -> Column:
        """An alert that comes after the last due date joins those of the last ``n`` days."""
        open_ = F.filter(F.concat(state["open"], F.array(today)), lambda x: x > today - n)
        due = (today > state["last"] + cooldown) & (F.size(open_) >= k)
        return F.struct(
            F.when(due, F.concat(state["due"], F.array(today))).otherwise(state["due"]).alias("due"),
            F.when(due, empty).otherwise(open_).alias("open"),
            F.when(due, today).otherwise(state["last"]).alias("last"),
        )

    folded = alerts.select("model", F.aggregate("days", start, step, lambda s: s["due"]).alias("due"))
    return folded.select("model", F.explode("due").alias("d")).select("model", F.date_add(F.lit("1970-01-01").cast("date"), F.col("d")).alias("day"))
