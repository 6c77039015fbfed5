"""Business records behind the service: expenses by filters, project totals, and salary bands that show no single person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ranks import exact_quantiles

#: Groups with fewer people are not shown.
LEAST_PEOPLE = 5


def find_expenses(
    expenses: DataFrame, employee_id: int | None = None, status: str | None = None, category: str | None = None, first: str | None = None, last: str | None = None
) -> DataFrame:
    """Expenses that meet all filters given; dates include both ends. All filters are plain comparisons, which reach the scan."""
    found = expenses
    for column, wanted in (("employee_id", employee_id), ("status", status), ("category", category)):
        if wanted is not None:
            found = found.where(F.col(column) == F.lit(wanted))
    if first is not None:
        found = found.where(F.col("date") >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        found = found.where(F.col("date") < F.lit(last).cast("timestamp_ntz") + F.expr("INTERVAL '1' DAY"))
    return found


def project_totals(expenses: DataFrame) -> DataFrame:
    """Amount, rows and people of each project, and its share of approved money. Money is added in cents."""
    cents = F.round(F.col("amount") * 100).cast("bigint")
    approved = F.when(F.col("status") == "approved", cents).otherwise(F.lit(0))
    # People are made distinct before they are counted, so a project of many rows is no single large set.
    per = expenses.groupBy("project_id", "employee_id").agg(F.sum(cents).alias("c"), F.sum(approved).alias("a"), F.count(F.lit(1)).alias("n"))
    total = per.groupBy("project_id").agg(F.sum("c").alias("c"), F.sum("a").alias("a"), F.sum("n").alias("rows"), F.count("employee_id").alias("people"))
    return total.select("project_id", (F.col("c") / 100).alias("amount"), (F.col("a") / F.when(F.col("c") != 0, F.col("c"))).alias("approved_share"), "rows", "people")


def salary_bands(people: DataFrame, level: str = "department", least: int = LEAST_PEOPLE) -> DataFrame:
    """Number of people and the quartiles of salaries of each level, exact; levels of few people are left out."""
    bands = exact_quantiles(people.withColumn("salary", F.col("salary").cast("double")), [level], "salary", {"p25": 0.25, "median": 0.5, "p75": 0.75})
    return bands.where(F.col("n") >= least).withColumnRenamed("n", "people")
