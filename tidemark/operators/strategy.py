"""Portfolio days, sizing, curves and walk-forward fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import Stored
from ..functions.numeric import kelly, safe_div
from .events import drawdown


def compounded(r: Column) -> Column:
    """Aggregate: product of 1 + r, less 1."""
    return F.exp(F.sum(F.log1p(r))) - 1


def day_means(trades: DataFrame, day: str, ret: str, cost_bps: float, sign: int = 1) -> DataFrame:
    """Equal-weight return of each day with trades, after costs."""
    return trades.groupBy(day).agg((F.avg(F.col(ret) * sign) - cost_bps / 1e4).alias("r"), F.count("*").alias("trades"))


def inverse_vol(vol: str, cap: float = 3.0) -> Column:
    """1 / vol, at most ``cap`` times its median over all rows with one (a per-study constant, joined by the caller)."""
    return F.least(1 / F.col(vol), cap * F.col("median_weight"))


def weighted_days(trades: DataFrame, day: str, ret: str, weight: str) -> DataFrame:
    return trades.groupBy(day).agg(safe_div(F.sum(F.col(weight) * F.col(ret)), F.sum(weight)).alias("r"))


def kelly_days(trades: DataFrame, day: str, ret: str, weight: str) -> DataFrame:
    """Day return with stakes summing to at most 1; a missing stake is the day's median stake."""
    w = Window.partitionBy(day)
    stake = F.coalesce(F.col(weight), F.median(weight).over(w), F.lit(0.0))
    staked = trades.withColumn("_w", stake).withColumn("_g", F.sum("_w").over(w))
    scaled = F.col("_w") / F.when(F.col("_g") > 1, F.col("_g")).otherwise(1.0)
    return staked.groupBy(day).agg(F.sum(scaled * F.col(ret)).alias("r"))


def curve_stats(daily: DataFrame, part: str, day: str, ret: str, year: int = 252) -> DataFrame:
    """Total and yearly growth, volatility, Sharpe ratio and deepest drawdown of each part's daily returns."""
    w = Window.partitionBy(part).orderBy(day)
    curve = daily.withColumn("equity", F.exp(F.sum(F.log1p(F.col(ret))).over(w)))
    curve = curve.withColumn("dd", drawdown("equity", day, part))
    n = F.count("*")
    total = compounded(F.col(ret))
    sd = F.stddev_samp(ret)
    return curve.groupBy(part).agg(n.alias("days"), total.alias("total"), (F.pow(1 + total, year / n) - 1).alias("cagr"), (sd * year**0.5).alias("vol"), (safe_div(F.avg(ret), sd) * year**0.5).alias("sharpe"), F.min("dd").alias("max_drawdown"))


def top_per_day(trades: DataFrame, day: str, signal: str, tie: str, k: int = 3) -> DataFrame:
    """The k strongest signals of each day by size; ties by key."""
    w = Window.partitionBy(day).orderBy(F.desc(F.abs(signal)), tie)
    return trades.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def trailing_kelly(trades: DataFrame, tier: str, period: str, win: str, span: int, least: int, share: float = 0.5, cap: float = 0.25) -> DataFrame:
    """Stake of each tier and period from the wins of the ``span`` periods strictly before it."""
    now = trades.select(tier, period).distinct()
    past = trades.select(tier, F.explode(F.sequence(F.col(period) + 1, F.col(period) + span)).alias(period), F.col(win).alias("_x"))
    up, down = F.avg(F.when(F.col("_x") > 0, F.col("_x"))), F.avg(F.when(F.col("_x") <= 0, -F.col("_x")))
    fit = past.groupBy(tier, period).agg(F.count("_x").alias("n"), F.avg((F.col("_x") > 0).cast("double")).alias("p"), safe_div(up, down).alias("payoff"))
    out = now.join(fit, [tier, period], "left")
    return out.withColumn("stake", F.when(F.col("n") >= least, kelly("p", "payoff", share, cap)))


def trailing_median(df: DataFrame, period: str, value: str, span: int, least: int) -> DataFrame:
    """Median of a value over the ``span`` periods before each, the median over all where those hold too few."""
    past = df.select(F.explode(F.sequence(F.col(period) + 1, F.col(period) + span)).alias(period), F.col(value).alias("_x"))
    fit = past.groupBy(period).agg(F.count("_x").alias("n"), F.median("_x").alias("m"))
    whole = df.agg(F.median(value).alias("_all"))  # one row
    return df.select(period).distinct().join(fit, period, "left").crossJoin(F.broadcast(whole)).select(period, F.when(F.col("n") >= least, F.col("m")).otherwise(F.col("_all")).alias("median"))


def classify(score: str, good: float, bad: float) -> Column:
    return F.when(F.col(score) > good, "good").when(F.col(score) < bad, "bad").when(F.col(score).isNotNull(), "neutral")


def decide(score: str, analyst: str, risk: str, median: str) -> Column:
    """Tier of a call: both agree, score alone, analyst alone, vetoed by risk, none."""
    agree = F.signum(score) == F.signum(analyst)
    return (
        F.when(F.col(risk) > 3 * F.col(median), "vetoed")
        .when(agree & (F.abs(score) >= 1), "T1")
        .when(agree & (F.signum(score) != 0), "T1b")
        .when((F.abs(score) >= 1) & F.col(analyst).isNull(), "T2")
        .when(F.signum(analyst) != 0, "T3")
        .otherwise("T4")
    )


def logistic_fit(df: DataFrame, period: str, x: str, y: str, span: int | None, least: int = 20, rounds: int = 25) -> DataFrame:
    """Logistic intercept and slope per period from the ``span`` periods strictly before it, by reweighted least squares.

    Without a span a period learns from all other periods, so that each is left out once.

    Each round is one aggregation of five sums per period; the driver holds two numbers a
    period, never rows. Null where the past has under ``least`` rows or one outcome only.
    """
    import numpy as np

    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(period).cast("int").alias("own"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    wanted = df.select(F.col(period).cast("int").alias("p")).where("p is not null").distinct()
    if span is None:
        others = F.array(*[F.lit(r["p"]) for r in wanted.collect()])  # one entry a period
        past = known.select(F.explode(F.filter(others.cast("array<int>"), lambda p: p != F.col("own"))).alias("p"), "x", "y")
    else:
        past = known.select(F.explode(F.sequence(F.col("own") + 1, F.col("own") + span)).alias("p"), "x", "y").join(wanted, "p", "left_semi")
    spark = df.sparkSession
    stored = Stored(past, "fits")  # every round reads it
    past = stored.df
    sizes = {r["p"]: r for r in past.groupBy("p").agg(F.count("*").alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi")).collect()}
    b = {k: np.zeros(2) for k, r in sizes.items() if r["n"] >= least and r["lo"] < r["hi"]}
    moving = set(b)
    for _ in range(rounds):
        if not moving:
            break
        now = spark.createDataFrame([(k, float(b[k][0]), float(b[k][1])) for k in sorted(moving)], "p int, b0 double, b1 double")
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("b0") + F.col("b1") * F.col("x")))
        q = past.join(F.broadcast(now), "p").withColumn("q", 1 / (1 + F.exp(-z)))  # a row a period
        w, r = F.col("q") * (1 - F.col("q")), F.col("y") - F.col("q")
        sums = q.groupBy("p").agg(F.sum(w), F.sum(w * F.col("x")), F.sum(w * F.col("x") * F.col("x")), F.sum(r), F.sum(r * F.col("x")))
        moving = set()
        for k, a, c, d, g, h in sums.collect():
            step = np.linalg.solve(np.array([[a, c], [c, d]]) + 1e-6 * np.eye(2), np.array([g, h]) - 1e-6 * b[k])
            b[k] = b[k] + step
            if np.abs(step).max() >= 1e-10:
                moving.add(k)
    stored.drop()
    rows = [(k, r["n"], *(map(float, b[k]) if k in b else (None, None))) for k, r in sorted(sizes.items())]
    return spark.createDataFrame(rows, "p int, n long, intercept double, slope double").withColumnRenamed("p", period)


#: Rows of a group whose draws are made side by side in one task; larger groups are dealt out by draw.
GROUP_ROWS = 1 << 18


def permutation_p(df: DataFrame, keys: Sequence[str], group: str, signal: str, outcome: str, draws: int, seed: int = 1) -> DataFrame:
    """Share of within-group shuffles whose mean signal * outcome reaches the real one: (k + 1) / (draws + 1).

    A shuffle pairs the signal's order with a hash order of the same group, so draws are reproducible anywhere. Rows are
    shuffled once, by group; every draw is then a sort of the group's array where it lies. A group of over ``GROUP_ROWS``
    rows has its draws dealt out over tasks instead.
    """
    used = df.where(F.col(signal).isNotNull() & F.col(outcome).isNotNull()).select(F.struct(*keys).alias("_k"), F.col(group).alias("_g"), F.col(signal).cast("double").alias("_s"), F.col(outcome).cast("double").alias("_o"))
    real = used.agg(F.avg(F.col("_s") * F.col("_o")).alias("real"), F.count("*").alias("n"))
    sizes = used.groupBy("_g").agg(F.count("*").alias("_n"))
    large = [r["_g"] for r in sizes.where(F.col("_n") > GROUP_ROWS).select("_g").collect()]  # at most rows / GROUP_ROWS
    hot = F.coalesce(F.col("_g").isin(large), F.lit(False)) if large else F.lit(False)
    mixed = lambda k: F.xxhash64(F.lit(seed), "draw", *[k[c] for c in keys])
    number = F.sequence(F.lit(1), F.lit(draws))

    lists = used.where(~hot).groupBy("_g").agg(F.array_sort(F.collect_list(F.struct("_k", "_o", "_s"))).alias("_rows")).withColumn("draw", F.explode(number))
    order = F.array_sort(F.transform("_rows", lambda r: F.struct(mixed(r["_k"]).alias("h"), r["_k"].alias("k"), r["_s"].alias("s"))))
    dot = F.aggregate(F.zip_with("_rows", order, lambda a, b: a["_o"] * b["s"]), F.lit(0.0), lambda acc, x: acc + x)
    sums = lists.select("draw", dot.alias("m"))
    if large:
        many = used.where(hot).withColumn("draw", F.explode(number))
        w = Window.partitionBy("draw", "_g")
        left = many.withColumn("_r", F.row_number().over(w.orderBy("_k"))).select("draw", "_g", "_r", "_o")
        right = many.withColumn("_r", F.row_number().over(w.orderBy(mixed(F.col("_k")), "_k"))).select("draw", "_g", "_r", "_s")
        sums = sums.unionByName(left.join(right, ["draw", "_g", "_r"]).groupBy("draw").agg(F.sum(F.col("_s") * F.col("_o")).alias("m")))
    shuffled = sums.groupBy("draw").agg(F.sum("m").alias("m")).crossJoin(F.broadcast(real))  # one row
    # sums of another order differ in their last digits
    reached = F.col("m") / F.col("n") >= F.col("real") - 1e-12 * F.abs("real")
    return shuffled.agg(F.any_value("real").alias("real"), ((F.sum(reached.cast("int")) + 1) / (draws + 1)).alias("p"))
