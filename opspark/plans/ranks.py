"""Exact ranks, cumulative distributions and quantiles without a global sort or one-task windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PIECES = 256
GROUP = 16


def value_counts(rows: DataFrame, groups: list[str], value: str, sums: dict) -> DataFrame:
    """One row per (groups, value) with the summed weights; map-side combined, so a frequent value is cheap."""
    v = F.col(value).cast("double")
    return (
        rows.where(v.isNotNull() & ~F.isnan(v))
        .groupBy(*groups, v.alias(value))
        .agg(*[F.sum(w).cast("bigint").alias(name) for name, w in sums.items()])
    )


def cumulative_counts(
    counts: DataFrame, groups: list[str], value: str, sums: list[str], pieces: int = PIECES, following: str | None = None
) -> DataFrame:
    """Adds ``cum_<s>`` (inclusive running total by value) and ``all_<s>`` (group total) to value counts.

    The value axis is cut at approximate quantiles of all distinct values, so a (group, piece) cell holds
    about 1/pieces of the rows at most, also when one group has most of them. Running totals are taken
    inside the cells and shifted by the totals of the cells before; those are ``pieces`` rows per group.
    ``counts`` is read three times, so pass a materialised frame (``cut_lineage``). ``following`` names one more column, the next
    larger value of the group: inside a cell it is the next row's, at the end of a cell the first one of the next cell.
    """
    if pieces % GROUP:
        raise ValueError(f"pieces must be a multiple of {GROUP}")
    probs = [i / pieces for i in range(1, pieces)]
    cuts = counts.agg(F.percentile_approx(value, probs, 10 * pieces)).scalar()

    v = F.col(value)

    def passed(indexes: list) -> Column:
        """How many of these cuts lie below the value; plain comparisons, so the stage stays compiled."""
        return reduce(Column.__add__, [F.coalesce((F.get("_cuts", i) < v).cast("int"), F.lit(0)) for i in indexes])

    # Two steps: the group of cuts by the last cut of each, then the place inside the group.
    ends = [F.lit(GROUP * i - 1) for i in range(1, pieces // GROUP)]
    placed = (
        counts.withColumn("_cuts", cuts)
        .withColumn("_at", passed(ends))
        .withColumn("_piece", F.col("_at") * GROUP + passed([F.col("_at") * GROUP + j for j in range(GROUP - 1)]))
        .drop("_cuts", "_at")
    )
    cell = [*groups, "_piece"]
    totals = placed.groupBy(*cell).agg(F.min(value).alias("_first"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    by_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    before = by_group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *cell,
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_o_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(by_group).alias(f"all_{s}") for s in sums],
        *([F.lead("_first").over(by_group.orderBy("_piece")).alias("_after")] if following else []),
    )
    inside = Window.partitionBy(*cell).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns({f"_c_{s}": F.sum(s).over(inside) for s in sums})
    if following:
        local = local.withColumn(following, F.lead(value).over(Window.partitionBy(*cell).orderBy(value)))
    joined = local.join(offsets, cell)
    if following:
        joined = joined.withColumn(following, F.coalesce(following, "_after")).drop("_after")
    return joined.withColumns({f"cum_{s}": F.col(f"_c_{s}") + F.col(f"_o_{s}") for s in sums}).drop(
        "_piece", *[f"_{k}_{s}" for k in "co" for s in sums]
    )


def exact_quantiles(
    rows: DataFrame, groups: list[str], value: str, quantiles: dict[str, float], weight=None
) -> DataFrame:
    """Linearly interpolated quantiles per group, exact, one output row per group."""
    weight = F.lit(1) if weight is None else weight
    counts = cut_lineage(value_counts(rows, groups, value, {"n": weight}).where(F.col("n") > 0))
    ranked = cumulative_counts(counts, groups, value, ["n"])
    picks = []
    for name, q in quantiles.items():
        pos = F.lit(float(q)) * (F.col("all_n") - 1)
        for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            picks.append(F.min(F.when(F.col("cum_n") > rank, F.col(value))).alias(f"_{side}_{name}"))
    found = ranked.groupBy(*groups).agg(F.max("all_n").alias("n"), *picks)
    out = []
    for name, q in quantiles.items():
        pos = F.lit(float(q)) * (F.col("n") - 1)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    return found.select(*groups, "n", *out)


def running_sums(rows: DataFrame, keys: list[str], cut: str, order: list, sums: dict[str, str]) -> DataFrame:
    """Running totals (inclusive, by ``order``) within the keys: {new column: summed column}.

    ``cut`` is a column that ascends with the order and splits a key's rows into bounded parts, such as a slice of time. Totals are taken inside
    the parts and shifted by those of the parts before, so no task holds a key's whole history. ``rows`` is read twice.
    """
    cell = [*keys, cut]
    totals = rows.groupBy(*cell).agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*cell, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    inside = Window.partitionBy(*cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"_c_{n}": F.sum(c).over(inside) for n, c in sums.items()})
    joined = local.join(offsets, cell)
    return joined.withColumns({n: F.col(f"_c_{n}") + F.col(f"_o_{n}") for n in sums}).drop(*[f"_{k}_{n}" for k in "co" for n in sums])
