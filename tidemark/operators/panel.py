"""Quarterly panels: calendar self-joins, row windows, yearly aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import col, safe_div


def pivot_metrics(long: DataFrame, keys: Sequence[str], metric: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per metric; the caller names them, so the schema is fixed, and dedupes first."""
    return long.groupBy(*keys).pivot(metric, list(names)).agg(F.first(value))


def calendar_lag(df: DataFrame, keys: Sequence[str], index: str, value: str, steps: int, alias: str) -> DataFrame:
    """The value ``steps`` periods earlier by the calendar (a gap gives null, unlike ``lag``), by a self-join."""
    past = df.select(*keys, (F.col(index) + steps).alias(index), F.col(value).alias(alias))
    return df.join(past, [*keys, index], "left")


def row_lag(value: str, keys: Sequence[str], order: str, steps: int) -> Column:
    return F.lag(value, steps).over(Window.partitionBy(*keys).orderBy(order))


def trailing(fn: Column, keys: Sequence[str], order: str, first: int, last: int, count_of: str, least: int) -> Column:
    """``fn`` over rows first..last of the group, null with fewer than ``least`` values."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(first, last)
    return F.when(F.count(count_of).over(w) >= least, fn.over(w))


def expanding_mean(value: str, keys: Sequence[str], order: str, least: int = 2) -> Column:
    """Mean of all earlier rows of the group."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.when(F.count(value).over(w) >= least, F.avg(value).over(w))


def floored_growth(value: str, prior: str, keys: Sequence[str], order: str, share: float = 0.05) -> Column:
    """Growth over the prior-year value, the denominator at least ``share`` of the mean size of the last four rows."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-4, -1)
    floor = share * F.avg(F.abs(F.col(value))).over(w)
    den = F.when(F.col(prior).isNotNull(), F.greatest(F.abs(F.col(prior)), F.coalesce(floor, F.lit(0.0))))
    return safe_div(F.col(value) - F.col(prior), den)


def fiscal_year(df: DataFrame, keys: Sequence[str], index: str, flows: Sequence[str], stocks: Sequence[str], ratios: Sequence[str] = ()) -> DataFrame:
    """Per year: a flow's sum if all four quarters are there, a stock's latest non-zero value, a ratio's mean."""
    year = df.withColumn("fy", F.floor(F.col(index) / 4).cast("int"))
    aggs = [F.when(F.count(c) == 4, F.sum(c)).alias(c) for c in flows]
    aggs += [F.max_by(F.nullif(F.col(c), F.lit(0)), F.when(F.col(c) != 0, F.col(index))).alias(c) for c in stocks]
    aggs += [F.avg(c).alias(c) for c in ratios]
    return year.groupBy(*keys, "fy").agg(*aggs, F.count("*").alias("quarters"))


def cagr(df: DataFrame, keys: Sequence[str], year: str, value: str, span: int, alias: str = "cagr") -> DataFrame:
    """Yearly growth between the ends of the last ``span`` years; both ends must be positive."""
    last = Window.partitionBy(*keys)
    inside = df.where(F.col(value).isNotNull()).withColumn("_last", F.max(year).over(last)).where(F.col(year) >= F.col("_last") - span)
    ends = inside.groupBy(*keys).agg(F.min(year).alias("y0"), F.max(year).alias("y1"), F.min_by(value, year).alias("v0"), F.max_by(value, year).alias("v1"))
    ok = (F.col("v0") > 0) & (F.col("v1") > 0) & (F.col("y1") > F.col("y0"))
    return ends.select(*keys, "y0", "y1", F.when(ok, F.pow(safe_div("v1", "v0"), 1 / (F.col("y1") - F.col("y0"))) - 1).alias(alias))


def band(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Mean, one population deviation either side, percentile and z of the latest value among all of its group."""
    known = df.where(F.col(value).isNotNull())
    stats = known.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.max_by(value, order).alias("current"), F.count("*").alias("n"))
    below = known.join(stats.select(*keys, "current"), list(keys)).where(F.col(value) < F.col("current")).groupBy(*keys).agg(F.count("*").alias("below"))
    out = stats.join(below, list(keys), "left")
    rank = F.when(F.col("n") > 1, 100.0 * F.coalesce("below", F.lit(0)) / (F.col("n") - 1))
    return out.select(*keys, "mean", (F.col("mean") - F.col("sd")).alias("low"), (F.col("mean") + F.col("sd")).alias("high"), rank.alias("pct"), safe_div(F.col("current") - F.col("mean"), F.col("sd")).alias("z"))


def combine_first(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Full outer join where the left cell wins and the right one fills."""
    r = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in values])
    return left.select(*keys, *values).join(r, list(keys), "full").select(*keys, *[F.coalesce(c, f"_r_{c}").alias(c) for c in values])


def append_fresh(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose key it lacks."""
    return old.unionByName(new.join(old.select(*keys).distinct(), list(keys), "left_anti"))


def many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that raises at run time, on the executors, where the right side repeats a key."""
    once = right.groupBy(*keys).agg(*[F.any_value(c).alias(c) for c in right.columns if c not in keys], F.count("*").alias("_n"))
    checked = once.withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.lit("the right side repeats a key"))).otherwise(F.col("_n")))
    return left.join(checked, list(keys), "left").withColumn("_n", F.coalesce("_n", F.lit(1))).where("_n = 1").drop("_n")


def signed(x: Column | str) -> Column:
    return F.signum(col(x))
