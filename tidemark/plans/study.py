"""Queries of the event study: surprises, buckets, statistics, panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numeric, periods
from ..operators import panel, stats, surprise
from .base import Q_SQL, SUE_SQL, quarterly, query, table


def scored(spark: SparkSession, d: str) -> DataFrame:
    """The quarterly panel with dx, sue, z, tercile, quintile and the next quarter's growth."""
    df = panel.calendar_lag(quarterly(spark, d), ["slug"], "qi", "revenue", 4, "prior").withColumn("dx", F.col("revenue") - F.col("prior"))
    df = df.withColumn("sue", surprise.trailing_sue("dx", ["slug"], "qi")).withColumn("z", surprise.cross_z("sue", "qi"))
    nxt = F.lead("revenue").over(Window.partitionBy("slug").orderBy("qi"))
    return df.withColumns({"tercile": surprise.quantile_buckets("z", "qi", "slug"), "quintile": surprise.quantile_buckets("z", "qi", "slug", 5, 25, up=False), "fwd": numeric.safe_div(nxt, "revenue") - 1})


@query("quarterly_surprise", f"WITH {SUE_SQL} SELECT slug, qi, round(revenue, 2) AS revenue, round(dx, 2) AS dx, round(sue, 6) AS sue, round(z, 6) AS z FROM z")
def quarterly_surprise(spark, d):
    return scored(spark, d).select("slug", "qi", F.round("revenue", 2).alias("revenue"), F.round("dx", 2).alias("dx"), F.round("sue", 6).alias("sue"), F.round("z", 6).alias("z"))


@query("surprise_terciles", f"WITH {SUE_SQL} SELECT slug, qi, tercile, quintile FROM t")
def surprise_terciles(spark, d):
    return scored(spark, d).select("slug", "qi", "tercile", "quintile")


@query(
    "masked_surprise",
    f"""WITH {Q_SQL}, y AS (SELECT a.slug, a.qi, a.revenue - b.revenue AS dx,
 date_add(CAST(last_day(make_date(a.qi // 4, (a.qi % 4) * 3 + 3, 1)) AS DATE), CAST(CASE WHEN a.qi % 5 = 0 THEN 200 ELSE 40 END AS INTEGER)) AS filed FROM q a LEFT JOIN q b ON a.slug = b.slug AND a.qi = b.qi + 4),
r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY qi) AS i FROM y),
p AS (SELECT a.slug, a.qi, a.dx, count(b.dx) AS n, stddev_samp(b.dx) AS sd FROM r a LEFT JOIN r b ON a.slug = b.slug AND b.i BETWEEN a.i - 8 AND a.i - 1 AND b.filed < a.filed GROUP BY ALL)
SELECT slug, qi, round(CASE WHEN n >= 4 AND sd > 0 THEN dx / sd END, 6) AS sue FROM p""",
)
def masked_surprise(spark, d):
    df = panel.calendar_lag(quarterly(spark, d), ["slug"], "qi", "revenue", 4, "prior").withColumn("dx", F.col("revenue") - F.col("prior"))
    late = F.when(F.col("qi") % 5 == 0, 200).otherwise(40)
    df = df.withColumn("filed", F.date_add(periods.quarter_end("qi"), late))
    return df.select("slug", "qi", F.round(surprise.masked_sue("dx", "filed", ["slug"], "qi"), 6).alias("sue"))


@query(
    "bucket_spread_fm",
    f"""WITH {SUE_SQL}, u AS (SELECT * FROM t WHERE tercile IS NOT NULL AND fwd IS NOT NULL),
b1 AS (SELECT CAST(tercile AS VARCHAR) AS bucket, count(fwd) AS n, avg(fwd) AS mean, avg(fwd) / (stddev_samp(fwd) / sqrt(count(fwd))) AS t FROM u GROUP BY tercile),
sp AS (SELECT avg(CASE WHEN tercile = 3 THEN fwd END) - avg(CASE WHEN tercile = 1 THEN fwd END) AS s FROM u GROUP BY qi),
b2 AS (SELECT 'spread' AS bucket, count(s) AS n, avg(s) AS mean, avg(s) / (stddev_samp(s) / sqrt(count(s))) AS t FROM sp WHERE s IS NOT NULL),
pm AS (SELECT avg(fwd) AS m FROM u GROUP BY qi), b3 AS (SELECT 'periods' AS bucket, count(m) AS n, avg(m) AS mean, avg(m) / (stddev_samp(m) / sqrt(count(m))) AS t FROM pm)
SELECT bucket, n, round(mean, 8) AS mean, round(t, 6) AS t FROM (SELECT * FROM b1 UNION ALL SELECT * FROM b2 UNION ALL SELECT * FROM b3)""",
)
def bucket_spread_fm(spark, d):
    used = scored(spark, d).where("tercile is not null and fwd is not null")
    pooled = stats.bucket_table(used, "tercile", "fwd").withColumn("bucket", F.col("bucket").cast("string"))
    spread = stats.spread_by_period(used, "tercile", "fwd", "qi", 3).agg(*stats.mean_t("spread")).select(F.lit("spread").alias("bucket"), "n", "mean", "t")
    fm = stats.fama_macbeth(used, "qi", "fwd").select(F.lit("periods").alias("bucket"), "n", "mean", "t")
    return pooled.unionByName(spread).unionByName(fm).select("bucket", "n", F.round("mean", 8).alias("mean"), F.round("t", 6).alias("t"))


@query(
    "sign_buckets",
    f"""WITH {SUE_SQL}, u AS (SELECT CASE WHEN z > 0.5 THEN 'up' WHEN z < -0.5 THEN 'down' ELSE 'flat' END AS bucket, qi, fwd FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL)
SELECT bucket, count(*) AS n, round(avg(fwd), 8) AS mean, round(avg(fwd) / (stddev_samp(fwd) / sqrt(count(*))), 6) AS t FROM u GROUP BY bucket""",
)
def sign_buckets(spark, d):
    used = scored(spark, d).where("z is not null and fwd is not null")
    used = used.withColumn("side", F.when(F.col("z") > 0.5, "up").when(F.col("z") < -0.5, "down").otherwise("flat"))
    return stats.bucket_table(used, "side", "fwd").select("bucket", "n", F.round("mean", 8).alias("mean"), F.round("t", 6).alias("t"))


@query(
    "fe_ols_clustered",
    f"""WITH {SUE_SQL}, u AS (SELECT qi, fwd - avg(fwd) OVER w AS yd, z - avg(z) OVER w AS xd FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL WINDOW w AS (PARTITION BY qi)),
g AS (SELECT qi, sum(xd * xd) AS xx, sum(xd * yd) AS xy, count(*) AS m FROM u GROUP BY qi), f AS (SELECT sum(xx) AS sxx, sum(xy) AS sxy, sum(m) AS n, count(*) AS groups FROM g),
k AS (SELECT sum(pow(xy - sxy / sxx * xx, 2)) AS meat FROM g, f)
SELECT CAST(n AS BIGINT) AS n, groups, round(sxy / sxx, 8) AS slope, round(sqrt(meat * groups / (groups - 1)) / sxx, 8) AS se, round(sxy / sqrt(meat * groups / (groups - 1)), 6) AS t FROM f, k""",
)
def fe_ols_clustered(spark, d):
    out = stats.ols_fe_clustered(scored(spark, d), "fwd", "z", "qi")
    return out.select("n", "groups", *[F.round(c, p).alias(c) for c, p in (("slope", 8), ("se", 8), ("t", 6))])


@query(
    "rank_ic",
    f"""WITH {SUE_SQL}, u AS (SELECT qi, z, fwd FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL),
r AS (SELECT qi, rank() OVER (PARTITION BY qi ORDER BY z) + (count(*) OVER (PARTITION BY qi, z) - 1) / 2.0 AS a, rank() OVER (PARTITION BY qi ORDER BY fwd) + (count(*) OVER (PARTITION BY qi, fwd) - 1) / 2.0 AS b FROM u)
SELECT qi, count(*) AS n, round(corr(a, b), 8) AS ic, round(corr(a, b) * sqrt(count(*)), 6) AS t FROM r GROUP BY qi HAVING count(*) >= 5""",
)
def rank_ic(spark, d):
    return stats.spearman(scored(spark, d), "z", "fwd", "qi").select("qi", "n", F.round("ic", 8).alias("ic"), F.round("t", 6).alias("t"))


@query(
    "hit_rate_wilson",
    f"""WITH {SUE_SQL}, h AS (SELECT slug, count(*) FILTER (WHERE sign(z) <> 0 AND sign(fwd) <> 0) AS n, count(*) FILTER (WHERE sign(z) <> 0 AND sign(z) = sign(fwd)) AS hits FROM t GROUP BY slug),
p AS (SELECT *, CAST(hits AS DOUBLE) / nullif(n, 0) AS rate, 1.96 * 1.96 AS zz FROM h)
SELECT slug, n, hits, round(rate, 8) AS rate, round((rate + zz / (2 * n) - 1.96 * sqrt(rate * (1 - rate) / n + zz / (4.0 * n * n))) / (1 + zz / n), 8) AS low,
 round((rate + zz / (2 * n) + 1.96 * sqrt(rate * (1 - rate) / n + zz / (4.0 * n * n))) / (1 + zz / n), 8) AS high FROM p""",
)
def hit_rate_wilson(spark, d):
    out = scored(spark, d).groupBy("slug").agg(*stats.hit_rate("z", "fwd"))
    low, high = numeric.wilson("hits", "n")
    return out.select("slug", "n", "hits", F.round("rate", 8).alias("rate"), F.round(low, 8).alias("low"), F.round(high, 8).alias("high"))


@query("hit_rate_pvalues")
def hit_rate_pvalues(spark, d):
    """Exact one-sided binomial p and two-sided t p of each slug, with Benjamini-Hochberg q-values of the former."""
    out = scored(spark, d).groupBy("slug").agg(*stats.hit_rate("z", "fwd"), *[c.alias(f"fwd_{i}") for i, c in enumerate(stats.mean_t("fwd"))])
    out = out.withColumns({"p_hits": stats.binomial_pvalue("hits", "n"), "p_mean": stats.t_pvalue("fwd_2", "fwd_0")})
    return stats.bh_qvalues(out.select("slug", "n", "hits", "p_hits", "p_mean"), "p_hits")


@query(
    "bh_fdr",
    f"""WITH {SUE_SQL}, h AS (SELECT slug, 1.0 / (1 + count(*) FILTER (WHERE z > 0)) + row_number() OVER (ORDER BY slug) * 1e-6 AS p FROM t GROUP BY slug),
r AS (SELECT slug, p, least(1.0, p * count(*) OVER () / row_number() OVER (ORDER BY p)) AS raw FROM h)
SELECT slug, round(p, 8) AS p, round(min(raw) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING), 8) AS q FROM r""",
)
def bh_fdr(spark, d):
    ups = scored(spark, d).groupBy("slug").agg((1.0 / (1 + F.count(F.when(F.col("z") > 0, 1)))).alias("p"))
    ups = ups.withColumn("p", F.col("p") + F.row_number().over(Window.orderBy("slug")) * 1e-6)
    return stats.bh_qvalues(ups, "p").select("slug", F.round("p", 8).alias("p"), F.round("q", 8).alias("q"))


@query(
    "ttm_and_yoy_panel",
    f"""WITH {Q_SQL}, l AS (SELECT a.*, b.revenue AS prior FROM q a LEFT JOIN q b ON a.slug = b.slug AND a.qi = b.qi + 4)
SELECT slug, qi, round(CASE WHEN count(revenue) OVER w4 >= 4 THEN sum(revenue) OVER w4 END, 2) AS ttm, round(lag(revenue, 4) OVER o, 2) AS lag4, round(revenue - lag(revenue) OVER o, 2) AS d1,
 round(CASE WHEN count(revenue) OVER p8 >= 4 THEN avg(revenue) OVER p8 END, 2) AS mean8, round(CASE WHEN count(revenue) OVER same >= 2 THEN avg(revenue) OVER same END, 2) AS same_quarter,
 round(CASE WHEN prior IS NOT NULL THEN (revenue - prior) / nullif(greatest(abs(prior), coalesce(0.05 * avg(abs(revenue)) OVER p4, 0)), 0) END, 8) AS yoy FROM l
WINDOW o AS (PARTITION BY slug ORDER BY qi), w4 AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), p8 AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING),
 p4 AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), same AS (PARTITION BY slug, qi % 4 ORDER BY qi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def ttm_and_yoy_panel(spark, d):
    k = ["slug"]
    df = panel.calendar_lag(quarterly(spark, d), k, "qi", "revenue", 4, "prior").withColumn("fq", F.col("qi") % 4)
    cols = {
        "ttm": panel.trailing(F.sum("revenue"), k, "qi", -3, 0, "revenue", 4),
        "lag4": panel.row_lag("revenue", k, "qi", 4),
        "d1": F.col("revenue") - panel.row_lag("revenue", k, "qi", 1),
        "mean8": panel.trailing(F.avg("revenue"), k, "qi", -8, -1, "revenue", 4),
        "same_quarter": panel.expanding_mean("revenue", ["slug", "fq"], "qi"),
    }
    return df.select("slug", "qi", *[F.round(c, 2).alias(n) for n, c in cols.items()], F.round(panel.floored_growth("revenue", "prior", k, "qi"), 8).alias("yoy"))


@query(
    "seasonal_double_diff",
    f"""WITH {Q_SQL} SELECT a.slug, a.qi, round((a.revenue - b.revenue) - (c.revenue - e.revenue), 2) AS dd FROM q a LEFT JOIN q b ON a.slug = b.slug AND b.qi = a.qi - 1
 LEFT JOIN q c ON a.slug = c.slug AND c.qi = a.qi - 4 LEFT JOIN q e ON a.slug = e.slug AND e.qi = a.qi - 5""",
)
def seasonal_double_diff(spark, d):
    df = quarterly(spark, d)
    base = df
    for k in (1, 4, 5):
        df = panel.calendar_lag(df, ["slug"], "qi", "revenue", k, f"r{k}") if k == 1 else df.join(base.select("slug", (F.col("qi") + k).alias("qi"), F.col("revenue").alias(f"r{k}")), ["slug", "qi"], "left")
    return df.select("slug", "qi", F.round((F.col("revenue") - F.col("r1")) - (F.col("r4") - F.col("r5")), 2).alias("dd"))


@query(
    "fy_rollup",
    f"""WITH {Q_SQL} SELECT slug, qi // 4 AS fy, round(CASE WHEN count(revenue) = 4 THEN sum(revenue) END, 2) AS revenue, max_by(units, qi) FILTER (WHERE units <> 0) AS units,
 round(avg(filings), 6) AS filings, count(*) AS quarters FROM q GROUP BY 1, 2""",
)
def fy_rollup(spark, d):
    out = panel.fiscal_year(quarterly(spark, d), ["slug"], "qi", ["revenue"], ["units"], ["filings"])
    return out.select("slug", "fy", F.round("revenue", 2).alias("revenue"), "units", F.round("filings", 6).alias("filings"), "quarters")


@query(
    "cagr_bands",
    f"""WITH {Q_SQL}, y AS (SELECT slug, qi // 4 AS fy, CASE WHEN count(*) = 4 THEN sum(revenue) END AS v FROM q GROUP BY 1, 2), k AS (SELECT * FROM y WHERE v IS NOT NULL),
i AS (SELECT *, max(fy) OVER (PARTITION BY slug) AS last FROM k), e AS (SELECT slug, min(fy) AS y0, max(fy) AS y1, arg_min(v, fy) AS v0, arg_max(v, fy) AS v1 FROM i WHERE fy >= last - 3 GROUP BY slug),
b AS (SELECT slug, avg(v) AS mean, stddev_pop(v) AS sd, arg_max(v, fy) AS cur, count(*) AS n FROM k GROUP BY slug), p AS (SELECT k.slug, count(*) AS below FROM k JOIN b ON k.slug = b.slug WHERE v < cur GROUP BY 1)
SELECT slug, round(CASE WHEN v0 > 0 AND v1 > 0 AND y1 > y0 THEN pow(v1 / v0, 1.0 / (y1 - y0)) - 1 END, 8) AS cagr, round(mean, 2) AS mean, round(mean - sd, 2) AS low, round(mean + sd, 2) AS high,
 round(CASE WHEN n > 1 THEN 100.0 * coalesce(below, 0) / (n - 1) END, 6) AS pct, round((cur - mean) / nullif(sd, 0), 6) AS z FROM e JOIN b USING (slug) LEFT JOIN p USING (slug)""",
)
def cagr_bands(spark, d):
    years = panel.fiscal_year(quarterly(spark, d), ["slug"], "qi", ["revenue"], [])
    growth = panel.cagr(years, ["slug"], "fy", "revenue", 3).select("slug", F.round("cagr", 8).alias("cagr"))
    bands = panel.band(years, ["slug"], "fy", "revenue")
    digits = {"mean": 2, "low": 2, "high": 2, "pct": 6, "z": 6}
    return growth.join(bands.select("slug", *[F.round(c, p).alias(c) for c, p in digits.items()]), "slug")


@query(
    "rank_composite",
    f"""WITH {SUE_SQL}, r AS (SELECT slug, qi, sue, dx,
 CASE WHEN sue IS NOT NULL THEN (rank() OVER (PARTITION BY qi ORDER BY sue NULLS LAST) + (count(*) OVER (PARTITION BY qi, sue) - 1) / 2.0) / count(sue) OVER (PARTITION BY qi) END AS a,
 CASE WHEN dx IS NOT NULL THEN (rank() OVER (PARTITION BY qi ORDER BY dx NULLS LAST) + (count(*) OVER (PARTITION BY qi, dx) - 1) / 2.0) / count(dx) OVER (PARTITION BY qi) END AS b FROM t)
SELECT slug, qi, round(((a + b) / 2 - 0.5) * 2, 8) AS composite, CASE WHEN sign(sue) = sign(dx) THEN CAST(sign(sue) AS DOUBLE) WHEN sue IS NOT NULL AND dx IS NOT NULL THEN 0.0 END AS agree FROM r""",
)
def rank_composite(spark, d):
    out = surprise.rank_composite(scored(spark, d), ["sue", "dx"], "qi")
    return out.select("slug", "qi", F.round("composite", 8).alias("composite"), surprise.sign_agreement("sue", "dx").alias("agree"))


@query(
    "combine_and_append",
    f"""WITH {Q_SQL}, a AS (SELECT slug, qi, CASE WHEN qi % 3 <> 0 THEN revenue END AS revenue FROM q WHERE qi % 7 <> 0), b AS (SELECT slug, qi, revenue * 2 AS revenue FROM q WHERE qi % 2 = 0),
m AS (SELECT coalesce(a.slug, b.slug) AS slug, coalesce(a.qi, b.qi) AS qi, coalesce(a.revenue, b.revenue) AS revenue FROM a FULL JOIN b ON a.slug = b.slug AND a.qi = b.qi)
SELECT slug, qi, round(revenue, 2) AS revenue FROM (SELECT * FROM m UNION ALL SELECT slug, qi, revenue FROM q WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.slug = q.slug AND m.qi = q.qi))""",
)
def combine_and_append(spark, d):
    q = quarterly(spark, d).select("slug", "qi", "revenue")
    left = q.where("qi % 7 <> 0").withColumn("revenue", F.when(F.col("qi") % 3 != 0, F.col("revenue")))
    right = q.where("qi % 2 = 0").withColumn("revenue", F.col("revenue") * 2)
    merged = panel.combine_first(left, right, ["slug", "qi"], ["revenue"])
    return panel.append_fresh(merged, q, ["slug", "qi"]).withColumn("revenue", F.round("revenue", 2))


@query(
    "sample_filters",
    f"""WITH {SUE_SQL} SELECT slug, qi, CASE WHEN qi < 1998 * 4 THEN 'early' ELSE 'late' END AS era, CASE WHEN units >= 3000 THEN 'high' WHEN units >= 1500 THEN 'mid' WHEN units >= 0 THEN 'low' END AS liquidity FROM t
 WHERE z IS NOT NULL AND units >= 500 AND qi BETWEEN 1996 * 4 AND 2000 * 4 + 3""",
)
def sample_filters(spark, d):
    used = scored(spark, d).where(F.col("z").isNotNull() & (F.col("units") >= 500) & periods.in_window("qi", 1996 * 4, 2000 * 4 + 3))
    era = F.when(F.col("qi") < 1998 * 4, "early").otherwise("late")
    ladder = F.when(F.col("units") >= 3000, "high").when(F.col("units") >= 1500, "mid").when(F.col("units") >= 0, "low")
    return used.select("slug", "qi", era.alias("era"), ladder.alias("liquidity"))


@query("pivot_metrics", """SELECT c_mktsegment AS slug, CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE NULL END) AS BIGINT) AS urgent, CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE NULL END) AS BIGINT) AS low
 FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def pivot_metrics(spark, d):
    joined = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    long = joined.groupBy(F.col("c_mktsegment").alias("slug"), F.col("o_orderpriority").alias("metric")).agg(F.count("*").alias("v"))
    wide = panel.pivot_metrics(long, ["slug"], "metric", "v", ["1-URGENT", "5-LOW"])
    return wide.select("slug", F.col("1-URGENT").alias("urgent"), F.col("5-LOW").alias("low"))
