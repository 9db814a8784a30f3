"""Earnings surprises: standardised change, cross-sectional scores and buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div, winsorize


def trailing_sue(dx: str, keys: Sequence[str], order: str, history: int = 8, least: int = 4) -> Column:
    """dx over the sample deviation of the ``history`` rows before it, with ``least`` values among them.

    A row whose dx is null still takes a place in the window.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-history, -1)
    sd = F.when(F.count(dx).over(w) >= least, F.stddev_samp(dx).over(w))
    return safe_div(F.col(dx), F.when(sd > 0, sd))


def masked_sue(dx: str, filed: str, keys: Sequence[str], order: str, history: int = 8, least: int = 4) -> Column:
    """``trailing_sue`` that uses an earlier row only if it was available strictly before the current one."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-history, -1)
    past = F.collect_list(F.struct(F.col(dx).alias("dx"), F.col(filed).alias("filed"))).over(w)
    now = F.col(filed)
    usable = F.transform(F.filter(past, lambda p: p["dx"].isNotNull() & (p["filed"] < now)), lambda p: p["dx"])
    n = F.size(usable)
    mean = safe_div(F.aggregate(usable, F.lit(0.0), lambda a, x: a + x), n)
    square = F.aggregate(usable, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    sd = F.when(n >= least, F.sqrt(safe_div(square, n - 1)))
    return safe_div(F.col(dx), F.when(sd > 0, sd))


def cross_z(value: str, period: str, pool: int = 5, limit: float = 3.0) -> Column:
    """z within the period, clipped; null for pools under ``pool`` or without spread."""
    w = Window.partitionBy(period)
    sd = F.stddev_samp(value).over(w)
    z = safe_div(F.col(value) - F.avg(value).over(w), F.when(sd > 0, sd))
    return winsorize(F.when(F.count(value).over(w) >= pool, z), limit)


def quantile_buckets(value: str, period: str, tie: str, buckets: int = 3, pool: int = 6, up: bool = True) -> Column:
    """Bucket 1..k of a value in its period by interpolated edges on ranks (not ``ntile``).

    The rank breaks ties by ``tie``. With r ranks from 1 and n values, bucket j+1 starts where k(r-1) reaches
    j(n-1); ``up`` says whether a rank exactly on an edge belongs above it.
    """
    w = Window.partitionBy(period).orderBy(F.col(value).asc_nulls_last(), tie)
    r, n = F.row_number().over(w), F.count(value).over(Window.partitionBy(period))
    out = F.lit(1)
    for j in range(1, buckets):
        reached = buckets * (r - 1) >= j * (n - 1) if up else buckets * (r - 1) > j * (n - 1)
        out = out + reached.cast("int")
    return F.when(F.col(value).isNotNull() & (n >= pool), out)


def percentile_rank(value: str, period: str) -> Column:
    """Average-tie rank over the number of non-null values."""
    w = Window.partitionBy(period)
    below = F.rank().over(w.orderBy(F.col(value).asc_nulls_last()))
    ties = F.count("*").over(Window.partitionBy(period, value))
    return F.when(F.col(value).isNotNull(), (below + (ties - 1) / 2) / F.count(value).over(w))


def rank_composite(df: DataFrame, values: Sequence[str], period: str, alias: str = "composite") -> DataFrame:
    """Mean of the percentile ranks, scaled to -1..1; null where any is missing."""
    for i, v in enumerate(values):
        df = df.withColumn(f"_p{i}", percentile_rank(v, period))
    total = sum((F.col(f"_p{i}") for i in range(1, len(values))), F.col("_p0"))
    return df.withColumn(alias, (total / len(values) - 0.5) * 2).drop(*[f"_p{i}" for i in range(len(values))])


def sign_agreement(a: str, b: str) -> Column:
    """The shared sign of two scores, 0 where they disagree."""
    return F.when(F.signum(a) == F.signum(b), F.signum(a)).when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.lit(0.0))
