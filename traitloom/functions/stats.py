"""Column expressions for statistics that Spark has no single function for. All stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Coefficients of the published rational approximation of the inverse normal distribution function
# (relative error below 1.15e-9), for the central region and for the tails.
CENTRE_TOP = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
CENTRE_BOTTOM = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
TAIL_TOP = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
TAIL_BOTTOM = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)
TAIL = 0.02425


def finite(x: Column) -> Column:
    """x, or null where it is null, NaN or infinite."""
    return F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), x)


def _horner(x: Column, coefficients, last: float | None = None) -> Column:
    value = F.lit(coefficients[0])
    for c in (*coefficients[1:], *(() if last is None else (last,))):
        value = value * x + F.lit(c)
    return value


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution; null outside (0, 1)."""
    q, r = p - 0.5, (p - 0.5) * (p - 0.5)
    centre = _horner(r, CENTRE_TOP) * q / _horner(r, CENTRE_BOTTOM, 1.0)
    low, high = F.sqrt(F.lit(-2.0) * F.ln(p)), F.sqrt(F.lit(-2.0) * F.ln(1.0 - p))
    return (
        F.when((p <= 0) | (p >= 1), None)
        .when(p < TAIL, _horner(low, TAIL_TOP) / _horner(low, TAIL_BOTTOM, 1.0))
        .when(p > 1 - TAIL, -_horner(high, TAIL_TOP) / _horner(high, TAIL_BOTTOM, 1.0))
        .otherwise(centre)
    )


def inverse_normal_sql(p: str) -> str:
    """The same expression as SQL text."""

    def horner(x: str, coefficients, last: float | None = None) -> str:
        text = repr(coefficients[0])
        for c in (*coefficients[1:], *(() if last is None else (last,))):
            text = f"({text} * {x} + {c!r})"
        return text

    r, low, high = f"(({p}) - 0.5e0) * (({p}) - 0.5e0)", f"sqrt(-2e0 * ln({p}))", f"sqrt(-2e0 * ln(1e0 - ({p})))"
    r = f"({r})"
    return (
        f"CASE WHEN ({p}) <= 0 OR ({p}) >= 1 THEN NULL WHEN ({p}) < {TAIL} THEN {horner(low, TAIL_TOP)} / {horner(low, TAIL_BOTTOM, 1.0)} "
        f"WHEN ({p}) > {1 - TAIL} THEN -{horner(high, TAIL_TOP)} / {horner(high, TAIL_BOTTOM, 1.0)} "
        f"ELSE {horner(r, CENTRE_TOP)} * (({p}) - 0.5e0) / {horner(r, CENTRE_BOTTOM, 1.0)} END"
    )


def average_rank(value: str, *within: str) -> Column:
    """Rank of value among the non-null values of the same `within`, ties averaged; null for null."""
    order = Window.partitionBy(*within, F.col(value).isNull()).orderBy(value)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*within, value))
    return F.when(F.col(value).isNotNull(), F.rank().over(order) + (ties - 1) / 2.0)


def normal_scores(value: str, *within: str, offset: float = 0.5) -> Column:
    """Rank-based inverse-normal scores within a feature: ranks less offset over n + 1 - 2 offset."""
    n = F.count(value).over(Window.partitionBy(*within))
    return inverse_normal((average_rank(value, *within) - offset) / (n + (1 - 2 * offset)))


def centred(value: Column, within: WindowSpec) -> Column:
    """Value less its mean, over its sample deviation; null where the deviation is zero or undefined."""
    return F.try_divide(value - F.avg(value).over(within), F.when(F.stddev_samp(value).over(within) > 0, F.stddev_samp(value).over(within)))


def number_text(x: Column) -> Column:
    """A double as text of the tables: NA for null and not-a-number, Inf and -Inf for the infinite."""
    inf = float("inf")
    return F.when(x.isNull() | F.isnan(x), "NA").when(x == inf, "Inf").when(x == -inf, "-Inf").otherwise(x.cast("string"))
