"""Event alignment to trading sessions and event-window measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div

def calendar(days: DataFrame, day: str, *part: str) -> DataFrame:
    """Days with their position from 0 (a calendar is small: one window over its distinct days)."""
    w = Window.partitionBy(*part).orderBy(day)
    return days.select(*part, day).distinct().withColumn("pos", F.row_number().over(w) - 1)


def align(events: DataFrame, ts: str, sessions: DataFrame, open_ts: str, close_ts: str | None = None) -> DataFrame:
    """Position (t0) of the first session that opens strictly after each event; null off the end.

    An event exactly at an open reacts in the next session. With ``close_ts``, in_session says whether the event
    lies in a session, both ends included. Events join the calendar on their day: a day's row has the number of
    sessions that opened before it and its own sessions, so no event looks through more than those. The calendar
    has one row a day, which one window can sort however long it is.
    """
    rows = sessions.select(F.col(open_ts).alias("o"), (F.col(close_ts) if close_ts else F.lit(None).cast("timestamp")).alias("c"))
    by_day = rows.groupBy(F.to_date("o").alias("_d")).agg(F.sort_array(F.collect_list(F.struct("o", "c"))).alias("_s"))  # a day's sessions
    ends = by_day.agg(F.min("_d").alias("_a"), F.max("_d").alias("_z"), F.sum(F.size("_s")).alias("_n"))  # one row
    days = ends.where("_a is not null").select(F.explode(F.sequence("_a", "_z")).alias("_d")).join(by_day, "_d", "left")
    before = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    opened, closed = F.coalesce(F.sum(F.size("_s")).over(before), F.lit(0)), F.max(F.array_max(F.col("_s.c"))).over(before)
    days = days.withColumn("_s", F.coalesce("_s", F.array().cast("array<struct<o:timestamp,c:timestamp>>"))).withColumns({"_before": opened, "_closed": closed})
    out = events.withColumn("_d", F.to_date(ts)).join(days, "_d", "left").crossJoin(F.broadcast(ends))
    count = F.when(F.col("_d") < F.col("_a"), 0).when(F.col("_d") > F.col("_z"), F.col("_n")).otherwise(F.col("_before") + F.size(F.filter("_s", lambda s: s["o"] <= F.col(ts))))
    out = out.withColumn("t0", F.when(count < F.col("_n"), count).cast("int"))
    if close_ts:
        now = F.exists("_s", lambda s: (s["o"] <= F.col(ts)) & (F.col(ts) <= s["c"]))
        earlier = F.col(ts) <= F.col("_closed")  # a session that opened on an earlier day
        out = out.withColumn("in_session", F.coalesce(now | F.coalesce(earlier, F.lit(False)), F.lit(False)))
    return out.drop("_d", "_s", "_before", "_closed", "_a", "_z", "_n")


def daily_returns(bars: DataFrame, symbol: str, pos: str, price: str) -> DataFrame:
    """Simple return on the previous calendar position; a missing bar leaves both days null."""
    past = bars.select(symbol, (F.col(pos) + 1).alias(pos), F.col(price).alias("_past"))
    return bars.join(past, [symbol, pos], "left").withColumn("ret", safe_div(F.col(price), F.col("_past")) - 1).drop("_past")


def abnormal(returns: DataFrame, index: DataFrame, pos: str) -> DataFrame:
    """Return less the index return of the same position."""
    return returns.join(index.select(pos, F.col("ret").alias("_i")), pos, "left").withColumn("ar", F.col("ret") - F.col("_i")).drop("_i")


def window_sums(events: DataFrame, key: Sequence[str], symbol: str, t0: str, bars: DataFrame, pos: str, value: str, first: int, last: int) -> DataFrame:
    """count, sum, mean, sample deviation and median of a value over positions t0+first..t0+last.

    Offsets are exploded and joined on (symbol, position): an equi-join whose size is events times offsets.
    """
    wide = events.select(*key, symbol, F.explode(F.sequence(F.col(t0) + first, F.col(t0) + last)).alias(pos))
    got = wide.join(bars.select(symbol, pos, value), [symbol, pos], "left")
    return got.groupBy(*key).agg(F.count(value).alias("n"), F.sum(value).alias("s"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.median(value).alias("median"))


def car(events: DataFrame, key: Sequence[str], symbol: str, t0: str, bars: DataFrame, pos: str, ar: str, first: int, last: int, coverage: float = 0.8) -> DataFrame:
    """Cumulative abnormal return over the window, null with under ``coverage`` of its days."""
    days = last - first + 1
    sums = window_sums(events, key, symbol, t0, bars, pos, ar, first, last)
    return sums.select(*key, F.when(F.col("n") >= coverage * days, F.col("s")).alias("car"), "n")


def beta(events: DataFrame, key: Sequence[str], symbol: str, t0: str, bars: DataFrame, pos: str, ret: str, market: str, first: int, last: int, least: int) -> DataFrame:
    """Sample covariance with the market over its sample variance, with ``least`` joint days."""
    wide = events.select(*key, symbol, F.explode(F.sequence(F.col(t0) + first, F.col(t0) + last)).alias(pos))
    got = wide.join(bars.where(F.col(ret).isNotNull() & F.col(market).isNotNull()), [symbol, pos])
    return got.groupBy(*key).agg(F.when(F.count("*") >= least, safe_div(F.covar_samp(ret, market), F.var_samp(market))).alias("beta"))


def equal_weight_index(returns: DataFrame, pos: str) -> DataFrame:
    """Mean return of each position and its running compounded level (one row a day, so one window can sort them)."""
    mean = returns.groupBy(pos).agg(F.avg("ret").alias("ret"))
    level = F.exp(F.sum(F.log1p(F.coalesce("ret", F.lit(0.0)))).over(Window.orderBy(pos)))
    return mean.withColumn("level", level)


def drawdown(level: str, order: str, *part: str) -> Column:
    w = Window.partitionBy(*part).orderBy(order)
    return F.col(level) / F.max(level).over(w) - 1
