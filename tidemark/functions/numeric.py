"""Null-safe arithmetic: NaN never reaches a comparison, a missing operand gives null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: Column | str) -> Column:
    """NaN and infinities as null."""
    x = col(x)
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def safe_div(num: Column | str, den: Column | str) -> Column:
    """Null where an operand is missing or the denominator is zero."""
    num, den = col(num), col(den)
    return F.when(den != 0, num / den)


def winsorize(x: Column | str, low: float, high: float | None = None) -> Column:
    """Clip to [low, high], or to plus and minus ``low``; null stays null (least and greatest skip nulls)."""
    x = col(x)
    low, high = (low, high) if high is not None else (-low, low)
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def mean_of(xs: Sequence[Column | str], least: int = 2) -> Column:
    """Mean of the non-null ones where at least ``least`` are there."""
    cs = [col(x) for x in xs]
    n = sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int"))
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs[1:]), F.coalesce(cs[0], F.lit(0.0)))
    return F.when(n >= least, total / n)


def wilson(k: Column | str, n: Column | str, z: float = 1.96) -> tuple[Column, Column]:
    """Lower and upper bound of the Wilson interval of k successes in n; null for n = 0."""
    k, n = col(k).cast("double"), col(n).cast("double")
    n = F.when(n > 0, n)
    p = k / n
    mid, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (mid - half) / (1 + z * z / n), (mid + half) / (1 + z * z / n)


def plausible(x: Column | str, low: float | None, high: float | None) -> Column:
    """Strictly inside the band; a missing border is no border."""
    x = col(x)
    ok = x.isNotNull()
    if low is not None:
        ok = ok & (x > low)
    if high is not None:
        ok = ok & (x < high)
    return ok


def admit(x: Column | str, low: float | None, high: float | None) -> Column:
    """The value where plausible, else null: the row itself stays."""
    return F.when(plausible(x, low, high), col(x))


def near_reference(x: Column | str, ref: Column | str, low: float = 0.01, high: float = 50.0) -> Column:
    """Whether the size of x against the reference lies in [low, high]; true where there is nothing to compare."""
    x, ref = col(x), col(ref)
    ratio = safe_div(F.abs(x), F.abs(ref))
    return F.coalesce((ratio >= low) & (ratio <= high), F.lit(True))


def kelly(p: Column | str, payoff: Column | str, share: float = 0.5, cap: float = 1.0) -> Column:
    """Fraction to stake at win rate p and payoff ratio: fractional, never negative, capped."""
    p, b = col(p), col(payoff)
    return F.when(b > 0, F.least(F.lit(cap), F.greatest(F.lit(0.0), share * (p - (1 - p) / b))))


def logistic(x: Column | str, intercept: float, slope: float) -> Column:
    return 1 / (1 + F.exp(-(intercept + slope * col(x))))
