"""Expectation rules: a table of rules compiled into one aggregation over the data.

A rule names a column and what its values have to be. All rules are counted in one scan, whatever their number, and those that fail
come out as issue rows (check, severity, description, details, affected_rows). The rule table is configuration and is read by the
driver; it should have hundreds of rows, not millions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.literals import literal_table
from .quality import ISSUE_SCHEMA

RULES = "kind string, column string, low double, high double, allowed array<string>, pattern string, mostly double, severity string"
KINDS = ("not_null", "in_set", "between", "regex", "columns_match")


class Rule(NamedTuple):
    """``kind`` is one of KINDS. ``mostly`` is the share of tested rows that has to comply; NULLs are tested by ``not_null`` only.

    ``in_set`` compares with ``allowed`` as text, ``between`` includes both ends (a missing end is open), ``regex`` has to be found in the
    value, ``columns_match`` compares the table's column names with ``allowed``, in any order.
    """

    kind: str
    column: str | None = None
    low: float | None = None
    high: float | None = None
    allowed: list[str] | None = None
    pattern: str | None = None
    mostly: float = 1.0
    severity: str = "critical"

    def broken(self) -> Column:
        """True for a row that does not comply, false for one that does, NULL for one that is not tested."""
        c = F.col(f"`{self.column}`")
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "in_set":
            return F.when(c.isNotNull(), ~c.cast("string").isin(*(self.allowed or [])) if self.allowed else F.lit(True))
        if self.kind == "between":
            ok = F.lit(True)
            if self.low is not None:
                ok = ok & (c >= F.lit(self.low))
            if self.high is not None:
                ok = ok & (c <= F.lit(self.high))
            return F.when(c.isNotNull(), ~ok)
        if self.kind == "regex":
            return F.when(c.isNotNull(), ~c.cast("string").rlike(self.pattern))
        raise ValueError(f"unknown kind of rule: {self.kind}")

    def text(self) -> str:
        what = {
            "not_null": "not null",
            "in_set": f"in {{{', '.join(self.allowed or [])}}}",
            "between": f"between {self.low} and {self.high}",
            "regex": f"like /{self.pattern}/",
            "columns_match": f"columns {{{', '.join(sorted(self.allowed or []))}}}",
        }[self.kind]
        return what if self.kind == "columns_match" else f"{self.column} {what}"


def rule_table(rows: DataFrame) -> list[Rule]:
    """Rules from a table with the columns of RULES, in the order of their text."""
    found = [Rule(**{k: v for k, v in r.asDict().items() if v is not None}) for r in rows.collect()]
    for rule in found:
        if rule.kind not in KINDS:
            raise ValueError(f"unknown kind of rule: {rule.kind}")
    return sorted(found, key=Rule.text)


def check(df: DataFrame, rules: list[Rule], name: str = "expectations") -> DataFrame:
    """The issue rows of all rules that fail, from one pass over the columns that the rules name.

    A rule on a column that the table lacks fails with 0 affected rows. An empty table fails no value rule.
    """
    present = {c.lower() for c in df.columns}
    issues: list[tuple] = []
    tested: list[Rule] = []
    for rule in rules:
        if rule.kind == "columns_match":
            wanted = {c.lower() for c in rule.allowed or []}
            lacking, extra = sorted(wanted - present), sorted(present - wanted)
            if lacking or extra:
                issues.append((name, rule.severity, f"{rule.text()} expected", {"missing": ",".join(lacking), "unexpected": ",".join(extra)}, 0))
        elif (rule.column or "").lower() not in present:
            issues.append((name, rule.severity, f"column {rule.column} is missing", {}, 0))
        else:
            tested.append(rule)
    fixed = literal_table(df.sparkSession, issues, ISSUE_SCHEMA)
    if not tested:
        return fixed
    counts = []
    for i, rule in enumerate(tested):
        counts += [F.count_if(rule.broken()).alias(f"b{i}"), F.count(rule.broken()).alias(f"n{i}")]
    rows = [
        F.struct(
            F.lit(name).alias("check"),
            F.lit(r.severity).alias("severity"),
            F.lit(f"{r.text()} expected").alias("description"),
            F.create_map(F.lit("tested"), F.col(f"n{i}").cast("string"), F.lit("mostly"), F.lit(str(float(r.mostly)))).alias("details"),
            F.col(f"b{i}").alias("affected_rows"),
            (F.col(f"n{i}") - F.col(f"b{i}") < F.lit(float(r.mostly)) * F.col(f"n{i}")).alias("_failed"),
        )
        for i, r in enumerate(tested)
    ]
    found = df.agg(*counts).select(F.inline(F.array(*rows))).where("_failed").drop("_failed")
    return found.unionByName(fixed)
