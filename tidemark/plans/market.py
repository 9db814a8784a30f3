"""Queries of event alignment, window measures, strategies and series quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numeric, periods
from ..operators import events as ev
from ..operators import quality, stats, strategy
from .base import Q_SQL, SUE_SQL, quarterly, query, table
from .study import scored

#: Daily bars: mean value of each event type on each day; sessions open at 08:30 and close at 15:00.
BARS_SQL = """bars AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS day, avg(value) + 100 AS price FROM events GROUP BY 1, 2),
cal AS (SELECT day, CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS pos FROM (SELECT DISTINCT day FROM bars)),
px AS (SELECT symbol, pos, price FROM bars JOIN cal USING (day)),
rt AS (SELECT a.symbol, a.pos, a.price, a.price / b.price - 1 AS ret FROM px a LEFT JOIN px b ON a.symbol = b.symbol AND a.pos = b.pos + 1),
ix AS (SELECT pos, avg(ret) AS mret FROM rt GROUP BY pos), ab AS (SELECT rt.*, mret, ret - mret AS ar FROM rt LEFT JOIN ix USING (pos)),
al AS (SELECT e.event_id, e.event_type AS symbol, (SELECT count(*) FROM cal) AS n, (SELECT count(*) FROM cal c WHERE c.day + INTERVAL 510 MINUTE <= e.ts) AS t FROM events e),
ev AS (SELECT event_id, symbol, CASE WHEN t < n THEN CAST(t AS INTEGER) END AS t0 FROM al)"""


def _market(spark, d):
    """(events with t0 and in_session, returns with market and abnormal return, sessions)."""
    e = table(spark, d, "events").select("event_id", "ts", F.col("event_type").alias("symbol"), "value")
    bars = e.groupBy("symbol", F.to_date("ts").alias("day")).agg((F.avg("value") + 100).alias("price"))
    cal = ev.calendar(bars, "day")
    at = lambda clock: F.to_timestamp_ntz(F.concat(F.col("day").cast("string"), F.lit(f" {clock}")))
    sessions = cal.select("pos", "day", at("08:30:00").alias("o"), at("15:00:00").alias("c"))
    returns = ev.daily_returns(bars.join(cal, "day").select("symbol", "pos", "price"), "symbol", "pos", "price")
    index = ev.equal_weight_index(returns, "pos")
    full = ev.abnormal(returns, index, "pos").join(index.select("pos", F.col("ret").alias("mret"), "level"), "pos")
    return ev.align(e, "ts", sessions, "o", "c"), full, sessions


@query(
    "event_alignment",
    f"WITH {BARS_SQL} SELECT event_id, t0, (SELECT count(*) > 0 FROM cal c WHERE c.day + INTERVAL 510 MINUTE <= e.ts AND e.ts <= c.day + INTERVAL 900 MINUTE) AS in_session FROM events e JOIN ev USING (event_id)",
)
def event_alignment(spark, d):
    return _market(spark, d)[0].select("event_id", "t0", "in_session")


@query(
    "event_window_car",
    f"""WITH {BARS_SQL} SELECT event_id, count(ar) AS n, round(CASE WHEN count(ar) >= 4 THEN sum(ar) END, 8) AS car
 FROM ev LEFT JOIN ab ON ev.symbol = ab.symbol AND ab.pos BETWEEN t0 + 1 AND t0 + 5 WHERE t0 IS NOT NULL GROUP BY event_id""",
)
def event_window_car(spark, d):
    e, bars, _ = _market(spark, d)
    out = ev.car(e.where("t0 is not null"), ["event_id"], "symbol", "t0", bars, "pos", "ar", 1, 5)
    return out.select("event_id", "n", F.round("car", 8).alias("car"))


@query(
    "event_measures",
    f"""WITH {BARS_SQL}, k AS (SELECT * FROM ev WHERE t0 IS NOT NULL AND event_id % 4 >= 0),
a AS (SELECT event_id, count(ab.ar) AS n_pre, stddev_samp(ab.ar) AS sigma, median(ab.price) AS liquidity FROM k LEFT JOIN ab ON k.symbol = ab.symbol AND ab.pos BETWEEN t0 - 12 AND t0 - 3 GROUP BY 1),
b AS (SELECT event_id, CASE WHEN count(*) >= 8 THEN covar_samp(ret, mret) / nullif(var_samp(mret), 0) END AS beta FROM k JOIN ab ON k.symbol = ab.symbol AND ab.pos BETWEEN t0 - 15 AND t0 - 3 WHERE ret IS NOT NULL AND mret IS NOT NULL GROUP BY 1)
SELECT k.event_id, n_pre, round(CASE WHEN n_pre >= 5 THEN sigma END, 8) AS sigma, round(CASE WHEN n_pre >= 5 THEN liquidity END, 6) AS liquidity, round(beta, 6) AS beta,
 round(r.ar, 8) AS ar_react, round(r.ar / nullif(CASE WHEN n_pre >= 5 THEN sigma END, 0), 6) AS sar FROM k LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id) LEFT JOIN ab r ON r.symbol = k.symbol AND r.pos = k.t0""",
)
def event_measures(spark, d):
    e, bars, _ = _market(spark, d)
    k = e.where("t0 is not null")
    pre = ev.window_sums(k, ["event_id"], "symbol", "t0", bars, "pos", "ar", -12, -3).select("event_id", F.col("n").alias("n_pre"), "sd")
    liq = ev.window_sums(k, ["event_id"], "symbol", "t0", bars, "pos", "price", -12, -3).select("event_id", F.col("median").alias("liq"))
    b = ev.beta(k, ["event_id"], "symbol", "t0", bars, "pos", "ret", "mret", -15, -3, 8)
    react = k.join(bars.select("symbol", F.col("pos").alias("t0"), F.col("ar").alias("ar_react")), ["symbol", "t0"], "left")
    out = react.join(pre, "event_id", "left").join(liq, "event_id", "left").join(b, "event_id", "left")
    sigma = F.when(F.col("n_pre") >= 5, F.col("sd"))
    return out.select("event_id", "n_pre", F.round(sigma, 8).alias("sigma"), F.round(F.when(F.col("n_pre") >= 5, F.col("liq")), 6).alias("liquidity"), F.round("beta", 6).alias("beta"), F.round("ar_react", 8).alias("ar_react"), F.round(numeric.safe_div(F.col("ar_react"), sigma), 6).alias("sar"))


@query(
    "event_profile",
    f"""WITH {BARS_SQL}, o AS (SELECT unnest(range(-2, 4)) AS day) SELECT symbol, day, count(ar) AS n, round(avg(ar) * 10000, 4) AS bps, round(sum(avg(ar)) OVER (PARTITION BY symbol ORDER BY day) * 10000, 4) AS cumulative
 FROM (SELECT ev.symbol, day, ar FROM ev CROSS JOIN o LEFT JOIN ab ON ab.symbol = ev.symbol AND ab.pos = t0 + day WHERE t0 IS NOT NULL) GROUP BY symbol, day""",
)
def event_profile(spark, d):
    e, bars, _ = _market(spark, d)
    days = F.explode(F.array(*[F.lit(i) for i in range(-2, 4)]))
    got = e.where("t0 is not null").select("symbol", "t0", days.alias("day")).join(bars.select("symbol", (F.col("pos")).alias("_p"), "ar").withColumnRenamed("symbol", "_s"), (F.col("symbol") == F.col("_s")) & (F.col("_p") == F.col("t0") + F.col("day")), "left")
    means = got.groupBy("symbol", "day").agg(F.count("ar").alias("n"), F.avg("ar").alias("m"))
    run = F.sum("m").over(Window.partitionBy("symbol").orderBy("day"))
    return means.select("symbol", "day", "n", F.round(F.col("m") * 1e4, 4).alias("bps"), F.round(run * 1e4, 4).alias("cumulative"))


@query(
    "proxy_index",
    f"WITH {BARS_SQL} SELECT pos, round(mret, 8) AS ret, round(exp(sum(ln(1 + coalesce(mret, 0))) OVER (ORDER BY pos)), 8) AS level FROM ix",
)
def proxy_index(spark, d):
    _, bars, _ = _market(spark, d)
    return bars.groupBy("pos").agg(F.round(F.any_value("mret"), 8).alias("ret"), F.round(F.any_value("level"), 8).alias("level"))


DAYS_SQL = """dd AS (SELECT c_mktsegment AS seg, CAST(o_orderdate AS DATE) AS day, avg(o_totalprice) AS v FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
d0 AS (SELECT seg, day, (v - lag(v) OVER (PARTITION BY seg ORDER BY day)) / nullif(v * 50, 0) AS r FROM dd), dr AS (SELECT seg, day, CASE WHEN r IS NOT NULL THEN greatest(-0.1, least(0.1, r)) END AS r FROM d0)"""


def _segment_days(spark, d):
    """Bounded daily returns of each market segment."""
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    days = joined.groupBy(F.col("c_mktsegment").alias("seg"), F.to_date("o_orderdate").alias("day")).agg(F.avg("o_totalprice").alias("v"))
    past = F.lag("v").over(Window.partitionBy("seg").orderBy("day"))
    return days.select("seg", "day", numeric.winsorize(numeric.safe_div(F.col("v") - past, F.col("v") * 50), 0.1).alias("r"))


@query(
    "max_drawdown",
    f"""WITH {DAYS_SQL}, u AS (SELECT *, exp(sum(ln(1 + r)) OVER (PARTITION BY seg ORDER BY day)) AS equity FROM dr WHERE r IS NOT NULL),
m AS (SELECT *, equity / max(equity) OVER (PARTITION BY seg ORDER BY day) - 1 AS down FROM u)
SELECT seg, count(*) AS days, round(exp(sum(ln(1 + r))) - 1, 8) AS total, round(pow(exp(sum(ln(1 + r))), 252.0 / count(*)) - 1, 8) AS cagr, round(stddev_samp(r) * sqrt(252), 8) AS vol,
 round(avg(r) / stddev_samp(r) * sqrt(252), 6) AS sharpe, round(min(down), 8) AS max_drawdown FROM m GROUP BY seg""",
)
def max_drawdown(spark, d):
    out = strategy.curve_stats(_segment_days(spark, d).where("r is not null"), "seg", "day", "r")
    return out.select("seg", "days", *[F.round(c, 6 if c == "sharpe" else 8).alias(c) for c in ("total", "cagr", "vol", "sharpe", "max_drawdown")])


@query(
    "dual_sharpe",
    f"""WITH {DAYS_SQL}, p AS (SELECT day, avg(r) AS r FROM dr WHERE r IS NOT NULL GROUP BY day), s AS (SELECT count(r) AS n, sum(r) AS s1, sum(r * r) AS s2, avg(r) AS m, stddev_samp(r) AS sd FROM p)
SELECT n, round(m / sd * sqrt(252), 6) AS sharpe_trades, round(s1 / 3000 / sqrt((s2 - 3000 * (s1 / 3000) * (s1 / 3000)) / 2999) * sqrt(252), 6) AS sharpe_calendar FROM s""",
)
def dual_sharpe(spark, d):
    days = strategy.day_means(_segment_days(spark, d).where("r is not null"), "day", "r", 0.0)
    return stats.dual_sharpe(days, "r", 3000).select("n", F.round("sharpe_trades", 6).alias("sharpe_trades"), F.round("sharpe_calendar", 6).alias("sharpe_calendar"))


@query(
    "winsorized_weights",
    """WITH i AS (SELECT CAST(l_shipdate AS DATE) AS day, l_tax, l_linenumber, (l_discount - 0.05) AS r, 1 / (l_tax + 0.01) AS w FROM lineitem), m AS (SELECT median(w) AS mw FROM i), c AS (SELECT i.*, least(w, 3 * mw) AS cw FROM i, m),
k AS (SELECT *, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_tax * 2 END AS stake FROM c), g AS (SELECT day, r, cw, coalesce(stake, median(stake) OVER (PARTITION BY day), 0) AS s FROM k),
h AS (SELECT *, sum(s) OVER (PARTITION BY day) AS total FROM g)
SELECT CAST(day AS VARCHAR) AS day, round(sum(cw * r) / sum(cw), 8) AS weighted, round(sum(s / CASE WHEN total > 1 THEN total ELSE 1 END * r), 8) AS kelly FROM h GROUP BY day""",
)
def winsorized_weights(spark, d):
    i = table(spark, d, "lineitem").select(F.to_date("l_shipdate").alias("day"), (F.col("l_discount") - 0.05).alias("r"), (F.col("l_tax") + 0.01).alias("vol"), F.when(F.col("l_linenumber") != 7, F.col("l_tax") * 2).alias("stake"))
    med = i.agg(F.median(1 / F.col("vol")).alias("median_weight"))
    i = i.crossJoin(F.broadcast(med)).withColumn("w", strategy.inverse_vol("vol"))
    a = strategy.weighted_days(i, "day", "r", "w").select("day", F.round("r", 8).alias("weighted"))
    return a.join(strategy.kelly_days(i, "day", "r", "stake").select("day", F.round("r", 8).alias("kelly")), "day").withColumn("day", F.col("day").cast("string"))


@query(
    "top_per_day",
    f"WITH {SUE_SQL} SELECT slug, qi, round(z, 6) AS z FROM (SELECT *, row_number() OVER (PARTITION BY qi ORDER BY abs(z) DESC, slug) AS r FROM t WHERE z IS NOT NULL) WHERE r <= 3",
)
def top_per_day(spark, d):
    return strategy.top_per_day(scored(spark, d).where("z is not null"), "qi", "z", "slug").select("slug", "qi", F.round("z", 6).alias("z"))


@query(
    "trailing_kelly",
    f"""WITH {SUE_SQL}, u AS (SELECT coalesce(tercile, 0) AS tier, qi, z * fwd AS x FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL), n AS (SELECT DISTINCT tier, qi FROM u),
f AS (SELECT n.tier, n.qi, count(x) AS n, avg(CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE x IS NOT NULL) AS p, avg(CASE WHEN x > 0 THEN x END) / nullif(avg(CASE WHEN x <= 0 THEN -x END), 0) AS b FROM n LEFT JOIN u ON u.tier = n.tier AND u.qi BETWEEN n.qi - 8 AND n.qi - 1 GROUP BY 1, 2)
SELECT tier, qi, CASE WHEN n = 0 THEN NULL ELSE n END AS n, round(p, 8) AS p, round(CASE WHEN n >= 10 AND b > 0 THEN least(0.25, greatest(0.0, 0.5 * (p - (1 - p) / b))) END, 8) AS stake FROM f""",
)
def trailing_kelly(spark, d):
    u = scored(spark, d).where("z is not null and fwd is not null").select(F.coalesce("tercile", F.lit(0)).alias("tier"), "qi", (F.col("z") * F.col("fwd")).alias("x"))
    return strategy.trailing_kelly(u, "tier", "qi", "x", 8, 10).select("tier", "qi", "n", F.round("p", 8).alias("p"), F.round("stake", 8).alias("stake"))


@query(
    "pit_median_decisions",
    f"""WITH {SUE_SQL}, n AS (SELECT DISTINCT qi FROM t), m AS (SELECT n.qi, count(units) AS c, median(units) AS m FROM n LEFT JOIN t ON t.qi BETWEEN n.qi - 8 AND n.qi - 1 GROUP BY n.qi),
k AS (SELECT qi, CASE WHEN c >= 40 THEN m ELSE (SELECT median(units) FROM t) END AS med FROM m)
SELECT slug, t.qi, round(med, 4) AS med, CASE WHEN units > 3 * med THEN 'vetoed' WHEN sign(z) = sign(dx) AND abs(z) >= 1 THEN 'T1' WHEN sign(z) = sign(dx) AND sign(z) <> 0 THEN 'T1b' WHEN abs(z) >= 1 AND dx IS NULL THEN 'T2' WHEN sign(dx) <> 0 THEN 'T3' ELSE 'T4' END AS tier,
 CASE WHEN z > 0.5 THEN 'good' WHEN z < -0.5 THEN 'bad' WHEN z IS NOT NULL THEN 'neutral' END AS call FROM t JOIN k ON t.qi = k.qi""",
)
def pit_median_decisions(spark, d):
    s = scored(spark, d)
    med = strategy.trailing_median(s, "qi", "units", 8, 40)
    out = s.join(med, "qi")
    return out.select("slug", "qi", F.round("median", 4).alias("med"), strategy.decide("z", "dx", "units", "median").alias("tier"), strategy.classify("z", 0.5, -0.5).alias("call"))


@query("conviction_model")
def conviction_model(spark, d):
    """Intercept and slope per quarter of winning against the size of z, from the eight quarters before."""
    u = scored(spark, d).where("z is not null and fwd is not null").select(F.col("qi").cast("int").alias("qi"), F.abs("z").alias("x"), (F.signum("z") == F.signum("fwd")).cast("int").alias("y"))
    return strategy.logistic_fit(u, "qi", "x", "y", 8)


@query("permutation_test")
def permutation_test(spark, d):
    """Mean z * fwd against 200 within-quarter shuffles."""
    return strategy.permutation_p(scored(spark, d), ["slug"], "qi", "z", "fwd", 200)


@query(
    "cost_grid",
    f"""WITH {SUE_SQL}, c AS (SELECT unnest([0, 10, 25]) AS bps), p AS (SELECT bps, tercile AS leg, qi, avg(fwd * CASE WHEN tercile = 1 THEN -1 ELSE 1 END) - bps / 10000.0 AS r FROM t CROSS JOIN c WHERE tercile IN (1, 3) AND fwd IS NOT NULL GROUP BY 1, 2, 3)
SELECT bps, leg, count(*) AS periods, round(avg(r), 8) AS mean, round(avg(r) / (stddev_samp(r) / sqrt(count(*))), 6) AS t FROM p GROUP BY 1, 2""",
)
def cost_grid(spark, d):
    used = scored(spark, d).where("tercile in (1, 3) and fwd is not null").withColumn("bps", F.explode(F.array(F.lit(0), F.lit(10), F.lit(25))))
    sign = F.when(F.col("tercile") == 1, -1).otherwise(1)
    days = used.groupBy("bps", F.col("tercile").alias("leg"), "qi").agg((F.avg(F.col("fwd") * sign) - F.any_value("bps") / 1e4).alias("r"))
    out = days.groupBy("bps", "leg").agg(*stats.mean_t("r"))
    return out.select("bps", "leg", F.col("n").alias("periods"), F.round("mean", 8).alias("mean"), F.round("t", 6).alias("t"))


SERIES_SQL = Q_SQL + """, v AS (SELECT slug, qi, CASE WHEN (qi * 7 + length(slug)) % 11 = 0 THEN revenue * 1000 WHEN qi % 13 = 0 THEN 0 ELSE revenue END AS value FROM q)"""


def _series(spark, d):
    """Quarterly revenue with planted unit slips and zeros."""
    v = F.when((F.col("qi") * 7 + F.length("slug")) % 11 == 0, F.col("revenue") * 1000).when(F.col("qi") % 13 == 0, 0.0).otherwise(F.col("revenue"))
    return quarterly(spark, d).select("slug", "qi", v.alias("value"))


@query(
    "magnitude_breaks",
    f"""WITH {SERIES_SQL}, w AS (SELECT *, CASE WHEN value <> 0 THEN abs(value) END AS a FROM v),
n AS (SELECT *, list_concat(list(a) FILTER (WHERE a IS NOT NULL) OVER before, list(a) FILTER (WHERE a IS NOT NULL) OVER after) AS near, median(a) OVER (PARTITION BY slug) AS sm, count(a) OVER (PARTITION BY slug) AS c FROM w
 WINDOW before AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), after AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING)),
r AS (SELECT *, CASE WHEN len(near) >= 3 THEN list_median(near) ELSE sm END AS ref FROM n)
SELECT slug, qi, round(ref, 2) AS reference, coalesce(c >= 5 AND value <> 0 AND (abs(value) / ref > 4 OR abs(value) / ref < 0.25), false) AS suspect FROM r""",
)
def magnitude_breaks(spark, d):
    out = quality.magnitude_breaks(_series(spark, d), ["slug"], "qi", "value")
    return out.select("slug", "qi", F.round("reference", 2).alias("reference"), "suspect")


@query(
    "series_quarantine",
    "WITH m AS (SELECT l_returnflag AS metric, median(abs(l_quantity)) AS m FROM lineitem WHERE l_quantity <> 0 GROUP BY 1), x AS (SELECT l_returnflag AS metric, l_orderkey, l_linenumber, CASE WHEN l_orderkey % 97 = 0 THEN l_quantity * 1000 ELSE l_quantity END AS v FROM lineitem), m2 AS (SELECT metric, median(abs(v)) AS m FROM x WHERE v <> 0 GROUP BY 1) SELECT metric, count(*) AS n, count(*) FILTER (WHERE abs(v) > 300 * m AND l_linenumber <> 1) AS quarantined FROM x JOIN m2 USING (metric) GROUP BY metric",
)
def series_quarantine(spark, d):
    x = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("metric"), "l_linenumber", F.when(F.col("l_orderkey") % 97 == 0, F.col("l_quantity") * 1000).otherwise(F.col("l_quantity")).alias("v")).withColumn("keep", F.col("l_linenumber") == 1)
    out = quality.quarantine(x, "metric", "v", 300.0, "keep")
    return out.groupBy("metric").agg(F.count("*").alias("n"), F.sum(F.col("quarantined").cast("long")).alias("quarantined"))


@query(
    "clean_cascade",
    f"""WITH {SERIES_SQL}, b AS (SELECT *, CASE WHEN value IS NULL THEN 'R0' WHEN abs(value) > 1e10 THEN 'R1' END AS r1 FROM v), l AS (SELECT *, CASE WHEN r1 IS NULL AND value <> 0 THEN log10(abs(value)) END AS l FROM b),
m AS (SELECT *, abs(l - median(l) OVER (PARTITION BY slug)) AS dist FROM l),
h AS (SELECT *, (abs(l - lag(l) OVER o) > 2 AND dist > lag(dist) OVER o) OR (abs(l - lead(l) OVER o) > 2 AND dist > lead(dist) OVER o) AS hit FROM m WINDOW o AS (PARTITION BY slug ORDER BY qi)),
k AS (SELECT *, coalesce(r1, CASE WHEN hit THEN 'R2' END) AS r2 FROM h), c AS (SELECT *, CASE WHEN r2 IS NULL THEN l END AS ok FROM k),
n AS (SELECT *, list_concat(list(ok) FILTER (WHERE ok IS NOT NULL) OVER before, list(ok) FILTER (WHERE ok IS NOT NULL) OVER after) AS near FROM c
 WINDOW before AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), after AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING))
SELECT slug, qi, coalesce(r2, CASE WHEN len(near) >= 2 AND abs(ok - list_median(near)) > 2 THEN 'R3' END) AS rule FROM n""",
)
def clean_cascade(spark, d):
    return quality.clean_cascade(_series(spark, d), ["slug"], "qi", "value", bound=1e10).select("slug", "qi", "rule")


@query(
    "scale_snap",
    f"""WITH {SERIES_SQL}, j AS (SELECT v.slug, v.value AS a, q.revenue / 1000 * CASE WHEN v.slug < 'F' THEN 1 ELSE 3 END AS b FROM v JOIN q USING (slug, qi)), r AS (SELECT slug, median(abs(a / b)) AS ratio, count(*) AS n FROM j WHERE a <> 0 AND b <> 0 GROUP BY slug)
SELECT slug, n, round(ratio, 6) AS ratio, CASE WHEN abs(log10(ratio) - round(log10(ratio))) <= 0.1 AND abs(round(log10(ratio))) <= 9 THEN pow(10.0, round(log10(ratio))) END AS scale FROM r""",
)
def scale_snap(spark, d):
    q = quarterly(spark, d).select("slug", "qi", (F.col("revenue") / 1000 * F.when(F.col("slug") < "F", 1).otherwise(3)).alias("b"))
    j = _series(spark, d).withColumnRenamed("value", "a").join(q, ["slug", "qi"])
    return quality.snap_scale(j, ["slug"], "a", "b").select("slug", "n", F.round("ratio", 6).alias("ratio"), "scale")


@query(
    "price_quality",
    """WITH b AS (SELECT l_suppkey AS symbol, l_tax - l_discount / 4 AS f FROM lineitem), g AS (SELECT symbol, count(*) AS n FROM b WHERE f > 0 AND f <= 0.06 GROUP BY 1), s AS (SELECT DISTINCT symbol FROM b),
thin AS (SELECT s.symbol, coalesce(n, 0) AS n FROM s LEFT JOIN g USING (symbol) WHERE coalesce(n, 0) < 300)
SELECT 'kept' AS reason, CAST(sum(n) AS BIGINT) AS n FROM g WHERE symbol NOT IN (SELECT symbol FROM thin) UNION ALL SELECT 'factor', count(*) FROM b WHERE NOT (f > 0 AND f <= 0.06) UNION ALL SELECT 'too few bars', coalesce(CAST(sum(n) AS BIGINT), 0) FROM thin""",
)
def price_quality(spark, d):
    bars = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), (F.col("l_tax") - F.col("l_discount") / 4).alias("f"))
    kept, log = quality.price_quality(bars, "symbol", "f", 0.0, 0.06, 300)
    names = spark.createDataFrame([("factor",), ("too few bars",)], "reason string")
    logged = names.join(log.groupBy("reason").agg(F.sum("n").alias("n")), "reason", "left").select("reason", F.coalesce("n", F.lit(0)).alias("n"))
    return kept.agg(F.lit("kept").alias("reason"), F.count("*").alias("n")).unionByName(logged)


@query(
    "validation_rules",
    """WITH f AS (SELECT o_orderkey, sum(l_extendedprice) AS revenue, sum(l_extendedprice * l_discount) AS costs, sum(l_extendedprice * (1 - l_discount)) AS gross, sum(l_extendedprice * l_tax) AS dep, max(o_totalprice) AS total, max(CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 1 END) AS known FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
r AS (SELECT 'gross_profit' AS rule, abs(gross - (revenue - costs)) <= 0.02 * greatest(abs(gross), abs(revenue - costs), 1) AS ok FROM f UNION ALL SELECT 'revenue_positive', revenue > 0 FROM f UNION ALL SELECT 'costs_not_negative', costs >= 0 FROM f
UNION ALL SELECT 'balance_sheet', abs(total * known - (revenue + dep)) <= 0.02 * greatest(abs(total * known), abs(revenue + dep), 1) FROM f WHERE known IS NOT NULL UNION ALL SELECT 'margin_order', gross - dep <= gross FROM f UNION ALL SELECT 'ebitda', true FROM f)
SELECT rule, count(*) AS n, count(*) FILTER (WHERE ok) AS passed FROM r GROUP BY rule""",
)
def validation_rules(spark, d):
    items, orders = table(spark, d, "lineitem"), table(spark, d, "orders")
    p = F.col("l_extendedprice")
    f = items.groupBy("l_orderkey").agg(F.sum(p).alias("revenue"), F.sum(p * F.col("l_discount")).alias("costs"), F.sum(p * (1 - F.col("l_discount"))).alias("gross_profit"), F.sum(p * F.col("l_tax")).alias("depreciation"))
    f = f.join(orders.select("o_orderkey", "o_totalprice"), F.col("l_orderkey") == F.col("o_orderkey"))
    f = f.withColumns({"operating_income": F.col("gross_profit") - F.col("depreciation"), "ebitda": F.col("gross_profit"), "assets": F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice")), "liabilities": F.col("revenue"), "equity": F.col("depreciation"), **{c: F.lit(None).cast("double") for c in ("debt", "cash", "net_debt")}})
    return quality.validations(f).groupBy("rule").agg(F.count("*").alias("n"), F.sum(F.col("ok").cast("long")).alias("passed"))


del periods
