"""Error terms of forecasts and the asymptotic Kolmogorov p-value."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PREDICTION_FLOOR = 1e-9


def deviance_term(y: Column, p: Column) -> Column:
    """One row's half of the Poisson deviance; the log part is 0 at y = 0."""
    q = F.greatest(p, F.lit(PREDICTION_FLOOR))
    return F.when(y > 0, y * F.ln(y / q)).otherwise(F.lit(0.0)) - (y - q)


def relative_error(y: Column, p: Column) -> Column:
    """|y - p| / y where y > 0, else NULL."""
    return F.when(y > 0, F.abs(y - p) / y)


def error_sums(y: Column, p: Column, weight: Column | None = None) -> dict[str, Column]:
    """Per-row quantities whose sums give every accuracy measure of any union of groups."""
    y, p = y.cast("double"), p.cast("double")
    both = y.isNotNull() & p.isNotNull()
    parts = {
        "n": F.lit(1.0),
        "s_dev": deviance_term(y, p),
        "s_sq": (y - p) * (y - p),
        "s_abs": F.abs(y - p),
        "s_ape": F.coalesce(relative_error(y, p), F.lit(0.0)),
        "n_pos": (y > 0).cast("double"),
        "s_y": y,
        "s_p": p,
    }
    keep = both if weight is None else both & weight
    return {k: F.when(keep, v) for k, v in parts.items()}


def measures(prefix: str = "") -> dict[str, Column]:
    """Accuracy measures from summed error terms named ``<prefix><term>``; NULL for an empty group."""

    def s(term: str) -> Column:
        return F.col(prefix + term)

    n = F.when(s("n") > 0, s("n"))
    return {
        "n": F.coalesce(s("n"), F.lit(0.0)).cast("bigint"),
        "poisson_deviance": F.lit(2.0) * s("s_dev") / n,
        "rmse": F.sqrt(s("s_sq") / n),
        "mae": s("s_abs") / n,
        "mape": s("s_ape") / F.when(s("n_pos") > 0, s("n_pos")),
        "actual_mean": s("s_y") / n,
        "pred_mean": s("s_p") / n,
    }


def relative_delta(new: Column, base: Column) -> Column:
    return (new - base) / F.when(base != 0, base)


def ks_pvalue(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value: 2 * sum of (-1)^(k-1) exp(-2 k^2 t^2), t = D sqrt(nm / (n + m))."""
    t = d * F.sqrt(n.cast("double") * m / (n + m))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0)) * F.exp(F.lit(-2.0) * k * k * t * t),
    )
    return F.when(t < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(2.0) * series)))


def log_gamma_half(n: Column) -> Column:
    """ln Gamma(n / 2) of a positive whole number: a product of whole or half numbers down to 1 or the root of pi."""
    odd = n % 2 == 1
    steps = F.floor((n - 1) / 2).cast("int")
    factor = F.when(odd, F.lit(-0.5)).otherwise(F.lit(0.0))
    product = F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), F.lit(0.0), lambda acc, k: acc + F.ln(k + factor)
    )
    return product + F.when(odd, F.lit(0.5 * math.log(math.pi))).otherwise(F.lit(0.0))


def chi_square_pvalue(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution: the regularised incomplete gamma function Q(dof / 2, x / 2).

    Below the mean by the power series of its complement, above by the continued fraction (Lentz). The number of terms
    grows with the root of the degrees of freedom, which is where both converge.
    """
    a, z = dof / F.lit(2.0), x / F.lit(2.0)
    safe = F.greatest(z, F.lit(1e-300))
    terms = F.sequence(F.lit(1), (F.lit(60) + F.lit(14) * F.sqrt(a)).cast("int"))
    front = F.exp(-safe + a * F.ln(safe) - log_gamma_half(dof))
    start = F.struct((F.lit(1.0) / a).alias("term"), (F.lit(1.0) / a).alias("sum"))
    series = F.aggregate(
        terms,
        start,
        lambda acc, k: F.struct((acc["term"] * safe / (a + k)).alias("term"), (acc["sum"] + acc["term"] * safe / (a + k)).alias("sum")),
        lambda acc: acc["sum"],
    )
    b = safe + 1.0 - a
    first = F.struct(b.alias("b"), F.lit(1e300).alias("c"), (F.lit(1.0) / b).alias("d"), (F.lit(1.0) / b).alias("h"))

    def fraction(acc: Column, k: Column) -> Column:
        an = -k * (k - a)
        b = acc["b"] + 2.0
        d = F.lit(1.0) / (an * acc["d"] + b)
        c = b + an / acc["c"]
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    upper = front * F.aggregate(terms, first, fraction, lambda acc: acc["h"])
    tail = F.when(z <= 0, F.lit(1.0)).when(z < a + 1, F.lit(1.0) - front * series).otherwise(upper)
    return F.when((dof > 0) & x.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))
