"""Event-study statistics as aggregations; p-values by special functions in vectorised UDFs."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import col, safe_div


def mean_t(x: Column | str) -> list[Column]:
    """Aggregates n, mean and t (sample deviation, at least two values)."""
    x = col(x)
    n = F.count(x)
    sd = F.stddev_samp(x)
    return [n.alias("n"), F.avg(x).alias("mean"), F.when((n >= 2) & (sd > 0), F.avg(x) / (sd / F.sqrt(n))).alias("t")]


def fama_macbeth(df: DataFrame, group: str, value: str) -> DataFrame:
    """mean_t over the groups' means."""
    return df.groupBy(group).agg(F.avg(value).alias("m")).agg(*mean_t("m"))


def bucket_table(df: DataFrame, bucket: str, measure: str) -> DataFrame:
    return df.where(F.col(bucket).isNotNull() & F.col(measure).isNotNull()).groupBy(F.col(bucket).alias("bucket")).agg(*mean_t(measure))


def spread_by_period(df: DataFrame, bucket: str, measure: str, period: str, top: int, bottom: int = 1) -> DataFrame:
    """Top less bottom bucket mean of each period that has both."""
    leg = lambda b: F.avg(F.when(F.col(bucket) == b, F.col(measure)))
    return df.groupBy(period).agg((leg(top) - leg(bottom)).alias("spread")).where("spread is not null")


def ols_fe_clustered(df: DataFrame, y: str, x: str, group: str, least: int = 10) -> DataFrame:
    """Slope of y on x within groups, its cluster-robust error (G/(G-1) corrected) and t; one row."""
    w = Window.partitionBy(group)
    used = df.where(F.col(y).isNotNull() & F.col(x).isNotNull())
    d = used.select(F.col(group).alias("g"), (F.col(x) - F.avg(x).over(w)).alias("xd"), (F.col(y) - F.avg(y).over(w)).alias("yd"))
    sums = d.groupBy("g").agg(F.sum(F.col("xd") * F.col("xd")).alias("xx"), F.sum(F.col("xd") * F.col("yd")).alias("xy"), F.count("*").alias("m"))
    total = sums.agg(F.sum("xx").alias("sxx"), F.sum("xy").alias("sxy"), F.sum("m").alias("n"), F.count("*").alias("groups"))
    total = total.withColumn("slope", F.when(F.col("n") >= least, safe_div("sxy", "sxx")))
    # the score of a group is sum(x * (y - slope * x)), which its two sums give; total is one row
    meat = sums.crossJoin(F.broadcast(total.select("slope"))).agg(F.sum(F.pow(F.col("xy") - F.col("slope") * F.col("xx"), 2)).alias("meat"))
    out = total.crossJoin(F.broadcast(meat))
    se = F.sqrt(F.when(F.col("groups") > 1, F.col("meat") * F.col("groups") / (F.col("groups") - 1))) / F.when(F.col("sxx") > 0, F.col("sxx"))
    return out.select("n", "groups", "slope", se.alias("se"), safe_div(F.col("slope"), se).alias("t"))


def ols_fe_multi(df: DataFrame, y: str, xs: Sequence[str], group: str) -> dict[str, tuple[float, float]]:
    """Slope and cluster-robust error of each regressor within groups.

    Per-group Gram matrices are aggregates; only their k x k sums and the sandwich's reach the driver.
    """
    import numpy as np

    w, names = Window.partitionBy(group), [*xs, y]
    used = df.dropna(subset=[*names, group])
    d = used.select(F.col(group).alias("g"), *[(F.col(c) - F.avg(c).over(w)).alias(f"d{i}") for i, c in enumerate(names)])
    k = len(xs)
    terms = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    sums = d.groupBy("g").agg(*[F.sum(F.col(f"d{i}") * F.col(f"d{j}")).alias(f"s{i}_{j}") for i, j in terms])
    total = sums.agg(*[F.sum(f"s{i}_{j}").alias(f"s{i}_{j}") for i, j in terms], F.count("*").alias("n")).first()
    s = lambda row, i, j: row[f"s{min(i, j)}_{max(i, j)}"]
    inverse = np.linalg.inv(np.array([[s(total, i, j) for j in range(k)] for i in range(k)]))
    beta = inverse @ np.array([s(total, i, k) for i in range(k)])
    score = [F.col(f"s{i}_{k}") - sum(float(beta[j]) * F.col(f"s{min(i, j)}_{max(i, j)}") for j in range(k)) for i in range(k)]
    meat = sums.select(*[c.alias(f"u{i}") for i, c in enumerate(score)]).agg(*[F.sum(F.col(f"u{i}") * F.col(f"u{j}")).alias(f"m{i}_{j}") for i in range(k) for j in range(k)]).first()
    n = total["n"]
    cov = inverse @ np.array([[meat[f"m{i}_{j}"] for j in range(k)] for i in range(k)]) @ inverse * (n / max(1, n - 1))
    return {x: (float(beta[i]), float(math.sqrt(cov[i, i]))) for i, x in enumerate(xs)}


def average_rank(value: str, *part: str) -> Column:
    """Rank with ties averaged within the partition."""
    return F.rank().over(Window.partitionBy(*part).orderBy(value)) + (F.count("*").over(Window.partitionBy(*part, value)) - 1) / 2


def spearman(df: DataFrame, signal: str, outcome: str, *part: str, least: int = 5) -> DataFrame:
    """Rank correlation and ic * sqrt(n) of each part."""
    used = df.where(F.col(signal).isNotNull() & F.col(outcome).isNotNull())
    ranked = used.withColumns({"_a": average_rank(signal, *part), "_b": average_rank(outcome, *part)})
    out = ranked.groupBy(*part).agg(F.count("*").alias("n"), F.corr("_a", "_b").alias("ic")).where(F.col("n") >= least)
    return out.withColumn("t", F.col("ic") * F.sqrt("n"))


def hit_rate(signal: str, outcome: str) -> list[Column]:
    """Aggregates n, hits and rate over rows where neither is zero or null."""
    used = (F.signum(signal) != 0) & (F.signum(outcome) != 0)
    hit = used & (F.signum(signal) == F.signum(outcome))
    n, k = F.sum(F.coalesce(used, F.lit(False)).cast("long")), F.sum(F.coalesce(hit, F.lit(False)).cast("long"))
    return [n.alias("n"), k.alias("hits"), safe_div(k, n).alias("rate")]


def confusion(df: DataFrame, gold: str, guess: str, classes: Sequence) -> DataFrame:
    """(gold, guess, n, macro_f1): the confusion table, with the mean F1 of ``classes`` in every row."""
    cells = df.groupBy(gold, guess).agg(F.count("*").alias("n"))
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    g, p = F.col(gold), F.col(guess)
    f1 = [safe_div(2.0 * n((g == c) & (p == c)), n(g == c) + n(p == c)) for c in classes]
    macro = cells.agg(F.array_compact(F.array(*f1)).alias("_f")).select((F.aggregate("_f", F.lit(0.0), lambda a, x: a + x) / F.size("_f")).alias("macro_f1"))
    return cells.crossJoin(F.broadcast(macro))  # one row


def dual_sharpe(daily: DataFrame, ret: str, calendar_days: int, year: int = 252) -> DataFrame:
    """Sharpe ratio over days with trades, and over all calendar days (others at zero) in closed form."""
    r = F.col(ret)
    s = daily.agg(F.count(r).alias("n"), F.sum(r).alias("s1"), F.sum(r * r).alias("s2"), F.avg(r).alias("m"), F.stddev_samp(r).alias("sd"))
    mean = F.col("s1") / calendar_days
    var = (F.col("s2") - calendar_days * mean * mean) / (calendar_days - 1)
    return s.select("n", (safe_div("m", "sd") * math.sqrt(year)).alias("sharpe_trades"), (safe_div(mean, F.sqrt(var)) * math.sqrt(year)).alias("sharpe_calendar"))


def bh_qvalues(df: DataFrame, p: str, alias: str = "q") -> DataFrame:
    """Benjamini-Hochberg q-values of a report's p-values (few rows: one window over all)."""
    n = F.count(p).over(Window.partitionBy())
    df = df.withColumn("_raw", F.least(F.lit(1.0), F.col(p) * n / F.row_number().over(Window.orderBy(p))))
    return df.withColumn(alias, F.min("_raw").over(Window.orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, 0))).drop("_raw")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, c = 1e-300, 1.0
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        for k in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + k * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + k / (c if abs(c) > tiny else tiny)
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


@F.pandas_udf(T.DoubleType())
def t_pvalue(t, n):
    """Two-sided p of t with n - 1 degrees of freedom."""
    import pandas as pd

    ok = lambda a, m: a == a and a is not None and m and m > 1
    return pd.Series([incomplete_beta((m - 1) / 2, 0.5, (m - 1) / (m - 1 + a * a)) if ok(a, m) else None for a, m in zip(t, n)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def binomial_pvalue(k, n):
    """One-sided p of at least k hits in n fair draws."""
    import pandas as pd

    return pd.Series([1.0 if n_ and k_ <= 0 else incomplete_beta(k_, n_ - k_ + 1, 0.5) if n_ else None for k_, n_ in zip(k, n)], dtype="float64")
