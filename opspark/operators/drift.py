"""Distribution drift between a baseline and a new window: PSI, KS, Jensen-Shannon, mean shifts.

Inputs carry a boolean ``is_new`` column, so both windows are read in one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scores import chi_square_pvalue, ks_pvalue
from ..session import cut_lineage
from ..plans.ranks import cumulative_counts, value_counts

PSI_BINS = 10
JS_BINS = 20
SHARE_FLOOR = 1e-6
TOP_EDGE = 1e-9


def side_weights(is_new: str = "is_new") -> dict[str, Column]:
    flag = F.col(is_new)
    return {"n_base": (~flag).cast("int"), "n_new": flag.cast("int")}


def windows(df: DataFrame, base_end: str, new_start: str, new_end: str | None = None, ts: str = "time_bucket") -> DataFrame:
    """Labels rows before ``base_end`` as baseline and those in [new_start, new_end) as new; drops the rest.

    The bounds are plain comparisons on the time column, so they reach the Parquet scan.
    """
    t = F.col(ts)

    def at(x: str) -> Column:
        return F.lit(x).cast("timestamp_ntz")

    new = t >= at(new_start)
    if new_end is not None:
        new = new & (t < at(new_end))
    return df.where((t < at(base_end)) | new).withColumn("is_new", new)


def unpivot(df: DataFrame, columns: list[str], keep: list[str]) -> DataFrame:
    """(keep..., feature, value); absent columns are left out, and values that are no numbers become NULL."""
    present = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).try_cast("double").alias("value")) for c in present])
    return df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.feature", "_p.value")


def feature_counts(df: DataFrame, columns: list[str], segments: list[str] | None = None) -> DataFrame:
    """Value counts of both windows for every feature (and segment): the one shuffle all tests share."""
    segments = segments or []
    long = unpivot(df, columns, [*segments, "is_new"])
    return value_counts(long, [*segments, "feature"], "value", side_weights())


def group_ranges(counts: DataFrame, groups: list[str], value: str = "value") -> DataFrame:
    """Joint range, row totals and means of both windows: one row per group."""
    v = F.col(value)
    totals = counts.groupBy(*groups).agg(
        F.min(v).alias("_lo"),
        (F.max(v) + TOP_EDGE).alias("_top"),
        F.sum("n_base").alias("all_base"),
        F.sum("n_new").alias("all_new"),
        F.sum(v * F.col("n_base")).alias("_sb"),
        F.sum(v * F.col("n_new")).alias("_sn"),
    )
    return totals.select(
        *groups,
        "_lo",
        "_top",
        "all_base",
        "all_new",
        (F.col("_sb") / F.when(F.col("all_base") > 0, F.col("all_base"))).alias("base_mean"),
        (F.col("_sn") / F.when(F.col("all_new") > 0, F.col("all_new"))).alias("new_mean"),
    )


def histogram(
    counts: DataFrame, groups: list[str], bins: int, value: str = "value", ranges: DataFrame | None = None
) -> DataFrame:
    """Counts of both windows in equal-width bins over their joint range.

    Bins are right-open; the top edge is the maximum plus 1e-9.
    """
    if ranges is None:
        ranges = group_ranges(counts, groups, value)
    x, lo = F.col(value), F.col("_lo")
    step = (F.col("_top") - lo) / F.lit(float(bins))
    guess = F.when(step > 0, F.floor((x - lo) / F.when(step > 0, step))).otherwise(F.lit(0))
    # A division can land one bin off an edge; compare with the edges themselves.
    guess = F.when(x < lo + guess * step, guess - 1).when(x >= lo + (guess + 1) * step, guess + 1).otherwise(guess)
    bin_no = F.least(F.lit(bins - 1), F.greatest(F.lit(0), guess)).cast("int")
    return (
        counts.join(ranges.drop("base_mean", "new_mean"), groups)
        .groupBy(*groups, "all_base", "all_new", bin_no.alias("bin"))
        .agg(F.sum("n_base").alias("n_base"), F.sum("n_new").alias("n_new"))
    )


def _shares() -> tuple[Column, Column]:
    e = F.col("n_base") / F.when(F.col("all_base") > 0, F.col("all_base"))
    a = F.col("n_new") / F.when(F.col("all_new") > 0, F.col("all_new"))
    return e, a


def merged_bins(bins: DataFrame, groups: list[str], by: int) -> DataFrame:
    """A histogram with ``by`` neighbouring bins made one; the edges that remain are exactly the coarser ones."""
    return bins.groupBy(*groups, "all_base", "all_new", F.floor(F.col("bin") / by).cast("int").alias("bin")).agg(
        F.sum("n_base").alias("n_base"), F.sum("n_new").alias("n_new")
    )


def psi(
    counts: DataFrame, groups: list[str], bins: int = PSI_BINS, ranges: DataFrame | None = None, table: DataFrame | None = None
) -> DataFrame:
    """Population stability index per group; NULL when a window is empty. ``table``: its histogram, if known."""
    e, a = _shares()
    e, a = F.greatest(e, F.lit(SHARE_FLOOR)), F.greatest(a, F.lit(SHARE_FLOOR))
    both = (F.col("all_base") > 0) & (F.col("all_new") > 0)
    term = F.when(both, (a - e) * F.ln(a / e))
    table = histogram(counts, groups, bins, ranges=ranges) if table is None else table
    return table.groupBy(*groups).agg(F.sum(term).alias("psi"))


def psi_label(value: Column) -> Column:
    return F.when(value.isNull(), "skip").when(value < 0.1, "stable").when(value < 0.25, "moderate").otherwise("significant")


def js_distance(
    counts: DataFrame, groups: list[str], bins: int = JS_BINS, ranges: DataFrame | None = None, table: DataFrame | None = None
) -> DataFrame:
    """Jensen-Shannon distance (base 2) between the two histograms of each group. ``table``: the histogram, if known."""
    p, q = _shares()
    mid = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / F.when(mid > 0, mid))).otherwise(F.lit(0.0))

    both = (F.col("all_base") > 0) & (F.col("all_new") > 0)
    total = F.sum(F.when(both, part(p) + part(q)))
    js = F.sqrt(F.greatest(total, F.lit(0.0)) / 2).alias("js")
    table = histogram(counts, groups, bins, ranges=ranges) if table is None else table
    return table.groupBy(*groups).agg(js)


def ks(counts: DataFrame, groups: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic (exact) and asymptotic p-value per group."""
    ranked = cumulative_counts(counts, groups, "value", ["n_base", "n_new"])
    gap = F.abs(F.col("cum_n_base") / F.col("all_n_base") - F.col("cum_n_new") / F.col("all_n_new"))
    usable = ranked.where((F.col("all_n_base") > 0) & (F.col("all_n_new") > 0))
    return (
        usable.groupBy(*groups)
        .agg(F.max(gap).alias("ks"), F.max("all_n_base").alias("n_base"), F.max("all_n_new").alias("n_new"))
        .withColumn("pvalue", ks_pvalue(F.col("ks"), F.col("n_base"), F.col("n_new")))
    )


def wasserstein(counts: DataFrame, groups: list[str]) -> DataFrame:
    """First Wasserstein distance of the two windows per group: the area between their cumulative distributions, exact.

    Each value's gap between the distributions holds up to the next value, so the sum needs one pass over the ranked values.
    """
    ranked = cumulative_counts(counts, groups, "value", ["n_base", "n_new"], following="_next")
    gap = F.abs(F.col("cum_n_base") / F.col("all_n_base") - F.col("cum_n_new") / F.col("all_n_new"))
    area = gap * (F.coalesce("_next", "value") - F.col("value"))
    usable = ranked.where((F.col("all_n_base") > 0) & (F.col("all_n_new") > 0))
    return usable.groupBy(*groups).agg(F.sum(area).alias("wasserstein"), F.max("all_n_base").alias("n_base"), F.max("all_n_new").alias("n_new"))


def chi_square(df: DataFrame, groups: list[str], category: str) -> DataFrame:
    """Chi-square test, without correction, of one category's shares in the two windows, per group.

    Rows first collapse to counts by (group, category). NULL is a category of its own. With one category, or an empty window, there is nothing to test:
    the statistic and the p-value are NULL.
    """
    sums = {name: F.sum(w).cast("bigint").alias(name) for name, w in side_weights().items()}
    cells = cut_lineage(df.groupBy(*groups, category).agg(*sums.values()))
    totals = cells.groupBy(*groups).agg(F.sum("n_base").alias("all_base"), F.sum("n_new").alias("all_new"), F.count(F.lit(1)).alias("categories"))
    on = F.lit(True)
    for g in groups:
        on = on & F.col(f"cells.{g}").eqNullSafe(F.col(f"totals.{g}"))
    joined = cells.alias("cells").join(totals.alias("totals"), on).select("cells.*", "all_base", "all_new", "categories") if groups else None
    if joined is None:
        one = totals.agg(F.struct(*[F.max(c).alias(c) for c in ("all_base", "all_new", "categories")])).scalar()
        joined = cells.withColumns({c: one[c] for c in ("all_base", "all_new", "categories")})
    both = F.col("n_base") + F.col("n_new")
    everything = F.col("all_base") + F.col("all_new")
    term = F.lit(0.0)
    for n, total in (("n_base", "all_base"), ("n_new", "all_new")):
        expected = F.try_divide(both * F.col(total), everything)
        term = term + F.try_divide((F.col(n) - expected) * (F.col(n) - expected), expected)
    per = joined.groupBy(*groups).agg(
        F.sum(term).alias("_x"), F.max("categories").alias("categories"), F.max("all_base").alias("n_base"), F.max("all_new").alias("n_new")
    )
    tested = (F.col("n_base") > 0) & (F.col("n_new") > 0) & (F.col("categories") > 1)
    dof = (F.col("categories") - 1).cast("int")
    return per.select(
        *groups, "n_base", "n_new", F.when(tested, dof).alias("dof"), F.when(tested, F.col("_x")).alias("chi2"), F.when(tested, chi_square_pvalue(F.col("_x"), dof)).alias("pvalue")
    )


def moments(counts: DataFrame, groups: list[str], ranges: DataFrame | None = None) -> DataFrame:
    """Mean and sample standard deviation of both windows from value counts, centred on the group's mean."""
    if ranges is None:
        ranges = group_ranges(counts, groups)

    def std(side: str) -> Column:
        d = F.col("value") - F.col(f"{side}_mean")
        n = F.max(F.col(f"all_{side}"))
        return F.sqrt(F.sum(d * d * F.col(f"n_{side}")) / F.when(n > 1, n - 1)).alias(f"{side}_std")

    keys = [*groups, "all_base", "all_new", "base_mean", "new_mean"]
    spread = counts.join(ranges.drop("_lo", "_top"), groups).groupBy(*groups).agg(
        *[F.max(k).alias(k) for k in keys if k not in groups], std("base"), std("new")
    )
    return spread.withColumnsRenamed({"all_base": "rows_base", "all_new": "rows_new"})


def feature_drift(df: DataFrame, columns: list[str], min_rows: int = 50) -> DataFrame:
    """Means, deviations, KS, PSI and JS of every feature with at least ``min_rows`` values in both windows, ranked by PSI.

    The value counts, and the ranges and histogram made of them (a few rows for each feature), are written once. The
    JS bins are the PSI bins halved, so one histogram serves both.
    """
    counts = cut_lineage(feature_counts(df, columns))
    by = ["feature"]
    ranges = cut_lineage(group_ranges(counts, by))
    fine = cut_lineage(histogram(counts, by, JS_BINS, ranges=ranges))
    # One row for each feature.
    order = Window.orderBy(F.round("psi", 9).desc_nulls_last(), "feature")
    enough = (F.col("rows_base") >= min_rows) & (F.col("rows_new") >= min_rows)
    return (
        moments(counts, by, ranges)
        .where(enough)
        .join(ks(counts, by).select("feature", "ks", "pvalue"), by)
        .join(psi(counts, by, table=merged_bins(fine, by, JS_BINS // PSI_BINS)), by)
        .join(js_distance(counts, by, table=fine), by)
        .withColumn("interpretation", psi_label(F.col("psi")))
        .withColumn("psi_rank", F.row_number().over(order).cast("bigint"))
    )


MEAN_DRIFT_SETS = [["zone_id"], ["borough_id"], ["hour"], ["dayofweek"], ["borough_id", "is_weekend"]]
MEAN_DRIFT_MARK = {"hour": 20.0, "dayofweek": 15.0, "borough_id,is_weekend": 20.0}


def mean_drift(df: DataFrame, value: str = "trip_count", min_rows: int = 30) -> DataFrame:
    """Mean of both windows by zone, borough, hour, weekday and borough x weekend, with delta and percent.

    Rows are first summed to the finest cell; the grouping sets then expand only those cells.
    """
    cells = ["zone_id", "borough_id", "hour", "dayofweek", "is_weekend"]
    v = F.col(value).cast("double")
    new = F.col("is_new")
    fine = (
        df.where(v.isNotNull())
        .groupBy(*cells)
        .agg(
            F.sum(F.when(~new, v)).alias("sb"),
            F.sum(F.when(new, v)).alias("sn"),
            F.count_if(~new).alias("nb"),
            F.count_if(new).alias("nn"),
        )
    )
    grouped = fine.groupingSets(
        [[F.col(c) for c in s] for s in MEAN_DRIFT_SETS], *[F.col(c) for c in cells]
    ).agg(
        *[F.grouping(c).alias(f"_g_{c}") for c in cells],
        F.sum("sb").alias("sb"),
        F.sum("sn").alias("sn"),
        F.sum("nb").alias("base_rows"),
        F.sum("nn").alias("new_rows"),
    )

    def used(c: str) -> Column:
        return F.col(f"_g_{c}") == 0

    grouping = F.concat_ws(",", *[F.when(used(c), F.lit(c)) for c in cells])
    segment = F.concat_ws("/", *[F.when(used(c), F.coalesce(F.col(c).cast("string"), F.lit("?"))) for c in cells])
    no_null_key = ~F.coalesce(*[F.when(used(c) & F.col(c).isNull(), F.lit(True)) for c in cells], F.lit(False))
    base, fresh = F.col("base_mean"), F.col("new_mean")
    pct = F.when(base > 0, (fresh - base) / base * 100)
    limit = F.coalesce(*[F.when(F.col("grouping") == k, F.lit(x)) for k, x in MEAN_DRIFT_MARK.items()])
    return (
        grouped.where(no_null_key)
        .withColumns({"grouping": grouping, "segment": segment})
        .where((F.col("base_rows") > 0) & (F.col("new_rows") > 0))
        .where((F.col("grouping") != "borough_id,is_weekend") | (F.least("base_rows", "new_rows") >= min_rows))
        .withColumns({"base_mean": F.col("sb") / F.col("base_rows"), "new_mean": F.col("sn") / F.col("new_rows")})
        .select(
            "grouping",
            "segment",
            "base_rows",
            "new_rows",
            "base_mean",
            "new_mean",
            (fresh - base).alias("delta"),
            pct.alias("pct_change"),
            F.coalesce(F.abs(pct) > limit, F.lit(False)).alias("marked"),
        )
    )


def worst(df: DataFrame, by: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest value of ``by``, NULLs last: a bounded heap per task, no full sort."""
    return df.orderBy(F.col(by).desc_nulls_last()).limit(k)


def row_count_delta(df: DataFrame, key: str = "zone_id") -> DataFrame:
    """Rows per key in both windows, 0 where a key is absent: the full outer alignment in one shuffle."""
    sums = {name: F.sum(w).cast("bigint").alias(name) for name, w in side_weights().items()}
    return (
        df.groupBy(key).agg(*sums.values()).withColumn("delta", F.col("n_new") - F.col("n_base"))
    )
