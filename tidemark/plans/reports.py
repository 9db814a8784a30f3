"""Queries of scorecards, gates, candidates and study reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numeric, periods
from ..functions import text as tx
from ..operators import catalog, panel, reports, stats, strategy, surprise
from .base import Q_SQL, SUE_SQL, quarterly, query, table
from .market import BARS_SQL, _market
from .study import scored


@query("hit_partition", "SELECT CASE WHEN quality = 1 THEN 'exact' ELSE 'related' END AS part, count(*) AS n FROM labels GROUP BY 1")
def hit_partition(spark, d):
    hits = table(spark, d, "labels").select(F.when(F.col("quality") == 1, "literal").otherwise("semantic").alias("kind"))
    return reports.partition_hits(hits, "kind", True).groupBy("part").agg(F.count("*").alias("n"))


@query("donor_map", f"""WITH {Q_SQL}, o AS (SELECT slug, qi, slug || '@' || CAST(qi AS VARCHAR) AS k, md5('3:' || slug) AS h FROM q)
SELECT slug, qi, CASE WHEN don <> k THEN don END AS donor FROM (SELECT *, coalesce(lead(k) OVER w, first_value(k) OVER w) AS don FROM o WINDOW w AS (PARTITION BY qi ORDER BY h, slug))""")
def donor_map(spark, d):
    k = quarterly(spark, d).withColumn("k", F.concat("slug", F.lit("@"), F.col("qi").cast("string")))
    return reports.donors(k, "k", "slug", "qi", 3).select("slug", "qi", "donor")


@query("alias_mentions", r"SELECT doc_id AS id, c AS company, n FROM (SELECT doc_id, 'free' AS c, CAST(len(regexp_extract_all(lower(text), '\b(?:mit|gpl|apache)\b')) AS INTEGER) AS n FROM documents UNION ALL SELECT doc_id, 'rights', CAST(len(regexp_extract_all(lower(text), '\b(?:rights|copyright)\b')) AS INTEGER) FROM documents) WHERE n > 0")
def alias_mentions(spark, d):
    return reports.alias_mentions(table(spark, d, "documents"), "doc_id", "text", {"free": ("mit", "gpl", "apache"), "rights": ("rights", "copyright")})


@query("roster_reconciliation", "WITH f AS (SELECT c_nationkey AS key FROM customer WHERE c_acctbal < -900), s AS (SELECT s_nationkey AS key FROM supplier WHERE s_acctbal > 0), n AS (SELECT n_nationkey AS key FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE')), k AS (SELECT key FROM f UNION SELECT key FROM s UNION SELECT key FROM n) SELECT key, key IN (SELECT key FROM f) AS filings, key IN (SELECT key FROM s) AS roster, key IN (SELECT key FROM n) AS covered FROM k")
def roster_reconciliation(spark, d):
    a = table(spark, d, "customer").where("c_acctbal < -900").select(F.col("c_nationkey").alias("key"))
    b = table(spark, d, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("key"))
    regions = table(spark, d, "region").where(F.col("r_name").isin("ASIA", "EUROPE"))
    c = table(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("key"))
    return reports.reconcile_rosters(filings=a, roster=b, covered=c)


ACC_SQL = """x AS (SELECT l_suppkey % 10 AS company, l_returnflag AS tier, CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 11 = 0 THEN l_extendedprice * 1.05 ELSE l_extendedprice * 1.001 END AS got, CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS want FROM lineitem),
y AS (SELECT *, CASE WHEN want IS NULL THEN 'excluded' WHEN got IS NULL THEN 'miss' WHEN abs(got - want) <= 0.01 * greatest(abs(want), 1e-9) THEN 'correct' ELSE 'fail' END AS outcome FROM x)"""


def _extracted(spark, d):
    o, p = F.col("l_orderkey"), F.col("l_extendedprice")
    got = F.when(o % 7 == 0, None).when(o % 11 == 0, p * 1.05).otherwise(p * 1.001)
    x = table(spark, d, "lineitem").select((F.col("l_suppkey") % 10).alias("company"), F.col("l_returnflag").alias("tier"), got.alias("got"), F.when(o % 13 != 0, p).alias("want"))
    return reports.extraction_accuracy(x, "got", "want")


@query("extraction_scorecard", f"WITH {ACC_SQL} SELECT company, count(*) AS total, count(*) FILTER (WHERE outcome = 'correct') AS correct, count(*) FILTER (WHERE outcome = 'fail') AS fail, count(*) FILTER (WHERE outcome = 'miss') AS miss, count(*) FILTER (WHERE outcome = 'excluded') AS excluded FROM y GROUP BY 1")
def extraction_scorecard(spark, d):
    return reports.scorecard(_extracted(spark, d), "company")


@query("tier_accuracy", f"WITH {ACC_SQL} SELECT tier, count(*) FILTER (WHERE outcome <> 'excluded') AS judged, round(avg(CASE WHEN outcome = 'correct' THEN 1.0 ELSE 0.0 END) FILTER (WHERE outcome <> 'excluded'), 8) AS accuracy FROM y GROUP BY 1")
def tier_accuracy(spark, d):
    x = _extracted(spark, d).where("outcome <> 'excluded'")
    return x.groupBy("tier").agg(F.count("*").alias("judged"), F.round(F.avg((F.col("outcome") == "correct").cast("double")), 8).alias("accuracy"))


@query("trust_grades", f"""WITH {ACC_SQL}, s AS (SELECT company, avg(CASE WHEN outcome = 'correct' THEN 1.0 ELSE 0.0 END) FILTER (WHERE outcome IN ('correct', 'fail')) AS c, count(*) FILTER (WHERE outcome = 'miss') < 0.145 * count(*) AS complete FROM y GROUP BY 1)
SELECT company, CASE WHEN company = 3 THEN 'D' WHEN c >= 0.99 AND complete THEN 'A' WHEN c >= 0.9 THEN 'B' WHEN c IS NOT NULL THEN 'C' ELSE 'D' END AS grade FROM s""")
def trust_grades(spark, d):
    x = _extracted(spark, d)
    s = x.groupBy("company").agg(F.avg(F.when(F.col("outcome").isin("correct", "fail"), (F.col("outcome") == "correct").cast("double"))).alias("c"), (F.count(F.when(F.col("outcome") == "miss", 1)) < 0.145 * F.count("*")).alias("complete"))
    status = F.when(F.col("company") == 3, "blocked").otherwise("open")
    return s.select("company", reports.grade(status, F.col("c"), F.col("complete")).alias("grade"))


@query("best_candidates", "SELECT l_orderkey, l_partkey, c AS confidence, alternatives FROM (SELECT l_orderkey, l_partkey, l_discount * 10 AS c, count(*) OVER (PARTITION BY l_orderkey) - 1 AS alternatives, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_discount DESC, l_partkey) AS r FROM (SELECT DISTINCT l_orderkey, l_partkey, l_discount FROM lineitem)) WHERE r = 1 AND c >= 0.5")
def best_candidates(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_discount").distinct().withColumn("confidence", F.col("l_discount") * 10)
    return reports.best_candidate(x, ["l_orderkey"], "confidence", "l_partkey", 0.5).select("l_orderkey", "l_partkey", "confidence", "alternatives")


@query("paired_callers", f"""WITH {SUE_SQL}, u AS (SELECT sign(z) = sign(fwd) AS a, sign(dx) = sign(fwd) AS b FROM t WHERE z IS NOT NULL AND dx IS NOT NULL AND fwd IS NOT NULL), c AS (SELECT count(*) AS n, count(*) FILTER (WHERE a AND NOT b) AS only_a, count(*) FILTER (WHERE b AND NOT a) AS only_b FROM u)
SELECT n, only_a, only_b, round(pow(greatest(abs(only_a - only_b) - 1, 0), 2) / nullif(only_a + only_b, 0), 8) AS chi2 FROM c""")
def paired_callers(spark, d):
    return reports.paired_test(scored(spark, d), "z", "dx", "fwd").withColumn("chi2", F.round("chi2", 8))


@query("signal_auc", f"""WITH {SUE_SQL}, u AS (SELECT qi, z, CASE WHEN fwd > 0 THEN 1 ELSE 0 END AS y FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL), r AS (SELECT *, rank() OVER (PARTITION BY qi ORDER BY z) + (count(*) OVER (PARTITION BY qi, z) - 1) / 2.0 AS r FROM u),
g AS (SELECT qi, sum(CASE WHEN y = 1 THEN r END) AS s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM r GROUP BY 1) SELECT qi, pos, neg, round((s - pos * (pos + 1) / 2.0) / nullif(pos * neg, 0), 8) AS auc FROM g""")
def signal_auc(spark, d):
    u = scored(spark, d).where("z is not null and fwd is not null").withColumn("y", (F.col("fwd") > 0).cast("int"))
    return reports.rank_auc(u, "z", "y", "qi").withColumn("auc", F.round("auc", 8))


@query("walk_forward_auc")
def walk_forward_auc(spark, d):
    """AUC of scores from logistic fits on the eight quarters before each row's quarter."""
    u = scored(spark, d).where("z is not null and fwd is not null").select(F.col("qi").cast("int").alias("qi"), "z", (F.col("fwd") > 0).cast("int").alias("y"))
    s = reports.walk_forward_scores(u, "qi", "z", "y", 8).where("p is not null").withColumn("_all", F.lit(1))
    return reports.rank_auc(s, "p", "y", "_all").drop("_all")


@query("left_out_auc")
def left_out_auc(spark, d):
    """AUC of scores from logistic fits that leave each row's quarter out, its permutation p within quarters, and the gate on both."""
    u = scored(spark, d).where("z is not null and fwd is not null").select("slug", F.col("qi").cast("int").alias("qi"), "z", (F.col("fwd") > 0).cast("int").alias("y"))
    s = reports.walk_forward_scores(u, "qi", "z", "y", None).where("p is not null").withColumn("_all", F.lit(1))
    auc = reports.rank_auc(s, "p", "y", "_all").drop("_all")
    chance = strategy.permutation_p(s, ["slug"], "qi", "p", "y", 100).select(F.col("p").alias("chance"))
    return reports.gate(auc.crossJoin(F.broadcast(chance)), "auc", "chance")  # one row


@query("multi_regression")
def multi_regression(spark, d):
    """Fixed-effect slopes of two regressors with cluster-robust errors."""
    fit = stats.ols_fe_multi(scored(spark, d).withColumn("scaled", F.col("dx") / F.col("revenue")), "fwd", ["z", "scaled"], "qi")
    return spark.createDataFrame([(k, b, se) for k, (b, se) in fit.items()], "name string, slope double, se double")


@query("ic_weights", f"""WITH {SUE_SQL}, u AS (SELECT 'z' AS name, qi, z AS s, fwd FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL UNION ALL SELECT 'dx', qi, dx, fwd FROM t WHERE dx IS NOT NULL AND fwd IS NOT NULL),
r AS (SELECT name, qi, rank() OVER (PARTITION BY name, qi ORDER BY s) + (count(*) OVER (PARTITION BY name, qi, s) - 1) / 2.0 AS a, rank() OVER (PARTITION BY name, qi ORDER BY fwd) + (count(*) OVER (PARTITION BY name, qi, fwd) - 1) / 2.0 AS b FROM u),
i AS (SELECT name, qi, count(*) AS n, corr(a, b) AS ic FROM r GROUP BY 1, 2 HAVING count(*) >= 5), p AS (SELECT name, qi + k AS qi, ic, n FROM i, range(1, 9) t(k)), f AS (SELECT name, qi, avg(ic) AS m, sum(n) AS o FROM p GROUP BY 1, 2), w AS (SELECT name, qi, CASE WHEN o >= 60 THEN greatest(m, 0) END AS w FROM f)
SELECT name, CAST(qi AS INTEGER) AS qi, round(w / nullif(sum(w) OVER (PARTITION BY qi), 0), 8) AS weight FROM w""")
def ic_weights(spark, d):
    s = scored(spark, d).where("fwd is not null")
    long = s.where("z is not null").select(F.lit("z").alias("name"), "qi", F.col("z").alias("s"), "fwd").unionByName(s.where("dx is not null").select(F.lit("dx").alias("name"), "qi", F.col("dx").alias("s"), "fwd"))
    ics = stats.spearman(long, "s", "fwd", "name", "qi")
    return reports.trailing_ic_weights(ics, "name", "qi", 8, 60).select("name", "qi", F.round("weight", 8).alias("weight"))


@query("tradability", f"""WITH {SUE_SQL}, u AS (SELECT tercile, fwd, dx / revenue AS rel FROM t WHERE tercile IS NOT NULL), l AS (SELECT tercile, 'fwd' AS measure, fwd AS v FROM u UNION ALL SELECT tercile, 'rel', rel FROM u)
SELECT tercile, measure, count(v) AS n, round(avg(v), 8) AS mean FROM l GROUP BY 1, 2""")
def tradability(spark, d):
    u = scored(spark, d).where("tercile is not null").select("tercile", "fwd", (F.col("dx") / F.col("revenue")).alias("rel"))
    long = u.unpivot(["tercile"], ["fwd", "rel"], "measure", "v")
    return long.groupBy("tercile", "measure").agg(F.count("v").alias("n"), F.round(F.avg("v"), 8).alias("mean"))


@query("size_modes", f"""WITH {SUE_SQL}, u AS (SELECT qi, fwd, abs(z) AS m, least(1.0, abs(z) / 2) AS k FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL) SELECT qi, round(avg(fwd), 8) AS equal, round(sum(m * fwd) / nullif(sum(m), 0), 8) AS model, round(sum(k * fwd) / nullif(sum(k), 0), 8) AS capped FROM u GROUP BY qi""")
def size_modes(spark, d):
    u = scored(spark, d).where("z is not null and fwd is not null").withColumns({"m": F.abs("z"), "k": F.least(F.lit(1.0), F.abs("z") / 2)})
    model = strategy.weighted_days(u, "qi", "fwd", "m").select("qi", F.round("r", 8).alias("model"))
    capped = strategy.weighted_days(u, "qi", "fwd", "k").select("qi", F.round("r", 8).alias("capped"))
    return u.groupBy("qi").agg(F.round(F.avg("fwd"), 8).alias("equal")).join(model, "qi").join(capped, "qi")


@query("growth_acceleration", f"""WITH {Q_SQL}, g AS (SELECT a.slug, a.qi, a.revenue / nullif(b.revenue, 0) - 1 AS yoy FROM q a LEFT JOIN q b ON a.slug = b.slug AND a.qi = b.qi + 4)
SELECT slug, qi, round(yoy - CASE WHEN count(yoy) OVER w >= 4 THEN avg(yoy) OVER w END, 8) AS accel FROM g WINDOW w AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING)""")
def growth_acceleration(spark, d):
    g = panel.calendar_lag(quarterly(spark, d), ["slug"], "qi", "revenue", 4, "prior").withColumn("yoy", numeric.safe_div("revenue", "prior") - 1)
    return g.select("slug", "qi", F.round(F.col("yoy") - panel.trailing(F.avg("yoy"), ["slug"], "qi", -4, -1, "yoy", 4), 8).alias("accel"))


@query("margin_surprise", f"""WITH {Q_SQL}, m AS (SELECT slug, qi, units / revenue AS margin FROM q), x AS (SELECT *, margin - lag(margin, 4) OVER (PARTITION BY slug ORDER BY qi) AS dm FROM m), s AS (SELECT *, CASE WHEN count(dm) OVER w >= 4 THEN stddev_samp(dm) OVER w END AS sd FROM x WINDOW w AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))
SELECT slug, qi, round(CASE WHEN sd > 0 THEN dm / sd END, 6) AS sue_margin FROM s""")
def margin_surprise(spark, d):
    m = quarterly(spark, d).withColumn("margin", F.col("units") / F.col("revenue"))
    m = m.withColumn("dm", F.col("margin") - panel.row_lag("margin", ["slug"], "qi", 4))
    return m.select("slug", "qi", F.round(surprise.trailing_sue("dm", ["slug"], "qi"), 6).alias("sue_margin"))


@query("stale_share", f"""WITH {BARS_SQL}, z AS (SELECT symbol, pos, CASE WHEN abs(ret) < 0.002 THEN 1.0 ELSE 0.0 END AS still FROM ab WHERE ret IS NOT NULL) SELECT event_id, count(still) AS n, round(avg(still), 8) AS share FROM ev LEFT JOIN z ON z.symbol = ev.symbol AND z.pos BETWEEN t0 - 10 AND t0 - 1 WHERE t0 IS NOT NULL GROUP BY 1""")
def stale_share(spark, d):
    from ..operators import events as ev

    e, bars, _ = _market(spark, d)
    still = bars.where("ret is not null").withColumn("still", F.when(F.abs("ret") < 0.002, 1.0).otherwise(0.0))
    out = ev.window_sums(e.where("t0 is not null"), ["event_id"], "symbol", "t0", still, "pos", "still", -10, -1)
    return out.select("event_id", "n", F.round("mean", 8).alias("share"))


@query("alignment_invariants", f"WITH {BARS_SQL} SELECT count(*) AS events, count(*) FILTER (WHERE t0 IS NOT NULL AND (SELECT c.day + INTERVAL 510 MINUTE FROM cal c WHERE c.pos = t0) <= e.ts) AS violations FROM events e JOIN ev USING (event_id)")
def alignment_invariants(spark, d):
    """The open of an event's session lies strictly after the event; the count of violations must be 0."""
    e, _, sessions = _market(spark, d)
    j = e.join(sessions.select(F.col("pos").alias("t0"), "o"), "t0", "left")
    return j.agg(F.count("*").alias("events"), F.count(F.when(F.col("o") <= F.col("ts"), 1)).alias("violations"))


@query("placebo_shift", f"""WITH {BARS_SQL} SELECT symbol, count(ar) AS n, round(avg(ar), 8) AS mean FROM (SELECT ev.symbol, ab.ar FROM ev LEFT JOIN ab ON ab.symbol = ev.symbol AND ab.pos = t0 - 5 WHERE t0 IS NOT NULL) GROUP BY 1""")
def placebo_shift(spark, d):
    """Reactions five sessions before the events: nothing should be there."""
    e, bars, _ = _market(spark, d)
    j = e.where("t0 is not null").select("symbol", (F.col("t0") - 5).alias("pos")).join(bars.select("symbol", "pos", "ar"), ["symbol", "pos"], "left")
    return j.groupBy("symbol").agg(F.count("ar").alias("n"), F.round(F.avg("ar"), 8).alias("mean"))


@query("match_ranges", r"WITH m AS (SELECT doc_id, source, CAST(len(regexp_extract_all(lower(text), '\bthe\b')) AS BIGINT) AS n FROM documents), s AS (SELECT source, doc_id, n, CAST(sum(n) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS last FROM m WHERE n > 0) SELECT source, doc_id, last - n + 1 AS first, last FROM s")
def match_ranges(spark, d):
    m = table(spark, d, "documents").select("doc_id", "source", tx.count_matches("text", ("the",)).cast("long").alias("n")).where("n > 0")
    return reports.match_ranges(m, "source", "doc_id", "n").select("source", "doc_id", "first", "last")


@query("report_calendar", """WITH k AS (SELECT DISTINCT o_custkey AS n, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS qi FROM orders), e AS (SELECT c_custkey AS n, CAST(qi AS INTEGER) AS qi FROM customer, range(2000 * 4, 2002 * 4) r(qi))
SELECT e.n, e.qi, CASE WHEN k.n IS NOT NULL THEN 'received' WHEN CAST(last_day(make_date(e.qi // 4, (e.qi % 4) * 3 + 3, 1)) AS DATE) + 60 <= DATE '2001-10-01' THEN 'missing' ELSE 'expected' END AS state FROM e LEFT JOIN k ON k.n = e.n AND k.qi = e.qi""")
def report_calendar(spark, d):
    known = table(spark, d, "orders").select(F.col("o_custkey").alias("n"), periods.quarter_index("o_orderdate").alias("qi"))
    expected = table(spark, d, "customer").select(F.col("c_custkey").alias("n"), F.explode(F.sequence(F.lit(8000), F.lit(8007))).alias("qi"))
    return reports.report_calendar(known, expected, ["n", "qi"], periods.due("qi", F.lit("2001-10-01").cast("date"), 60))


@query("reembed_plan", "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 OR doc_id % 5 = 1")
def reembed_plan(spark, d):
    """The remainder of the id plants which rows an index holds, under which model; every row takes part."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    done = docs.where("doc_id % 5 > 0").select("doc_id", F.sha2(F.concat_ws("|", F.when(F.col("doc_id") % 5 == 1, "old").otherwise("new"), F.coalesce("text", F.lit(""))), 256).alias("signature"))
    return reports.reembed_plan(docs, done, "doc_id", "text", "new").select("doc_id")


@query("nearest_header", "WITH h AS (SELECT l_returnflag AS page, l_linestatus || CAST(l_linenumber AS VARCHAR) AS name, l_linenumber * 7.0 AS pos FROM lineitem GROUP BY ALL), t AS (SELECT DISTINCT l_returnflag AS page, l_quantity AS x FROM lineitem) SELECT page, x, min_by(name, struct_pack(g := abs(x - pos), n := name)) AS column FROM t JOIN h USING (page) WHERE abs(x - pos) <= 3 GROUP BY 1, 2".replace("AS column", 'AS "column"'))
def nearest_header(spark, d):
    i = table(spark, d, "lineitem")
    h = i.select(F.col("l_returnflag").alias("page"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("name"), (F.col("l_linenumber") * 7.0).cast("double").alias("pos")).distinct()
    t = i.select(F.col("l_returnflag").alias("page"), F.col("l_quantity").alias("x")).distinct()
    return reports.nearest_column(t, h, "page", "x", 3.0)


@query("metric_strength", """WITH x AS (SELECT p_brand AS metric, p_retailprice AS v, p_size FROM part), s AS (SELECT metric, count(*) AS n, avg(CASE WHEN p_size > 5 THEN 1.0 ELSE 0.0 END) AS coverage, count(*) FILTER (WHERE v > 2000) AS suspects FROM x GROUP BY 1)
SELECT metric, round(coverage, 8) AS coverage, suspects, coverage >= 0.85 AND suspects = 0 AS strong FROM s""")
def metric_strength(spark, d):
    s = table(spark, d, "part").groupBy(F.col("p_brand").alias("metric")).agg(F.avg((F.col("p_size") > 5).cast("double")).alias("coverage"), F.count(F.when(F.col("p_retailprice") > 2000, 1)).alias("suspects"))
    return s.select("metric", F.round("coverage", 8).alias("coverage"), "suspects", ((F.col("coverage") >= 0.85) & (F.col("suspects") == 0)).alias("strong"))


@query("confidence_scores", "SELECT o_orderkey, round(((CASE WHEN o_totalprice > 100000 THEN 2.0 ELSE 0 END) + (CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END) + (CASE WHEN o_orderkey % 4 <> 0 AND o_custkey % 2 = 0 THEN 1.0 ELSE 0 END)) / (3.0 + CASE WHEN o_orderkey % 4 <> 0 THEN 1.0 ELSE 0 END), 8) AS confidence FROM orders")
def confidence_scores(spark, d):
    checks = {"size": (F.col("o_totalprice") > 100000, 2.0), "status": (F.col("o_orderstatus") == "F", 1.0), "client": (F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey") % 2 == 0), 1.0)}
    return table(spark, d, "orders").select("o_orderkey", F.round(reports.confidence(checks), 8).alias("confidence"))


@query("verdict_texts", f"""WITH {SUE_SQL} SELECT slug, qi, concat_ws(', ', CASE WHEN dx > 0 THEN 'revenue up' WHEN dx < 0 THEN 'revenue down' END, CASE WHEN z > 1 THEN 'strong surprise' WHEN z < -1 THEN 'weak surprise' END, CASE WHEN units > 3000 THEN 'high volume' END) AS verdict FROM t""")
def verdict_texts(spark, d):
    parts = [F.when(F.col("dx") > 0, "revenue up").when(F.col("dx") < 0, "revenue down"), F.when(F.col("z") > 1, "strong surprise").when(F.col("z") < -1, "weak surprise"), F.when(F.col("units") > 3000, "high volume")]
    return scored(spark, d).select("slug", "qi", F.concat_ws(", ", *parts).alias("verdict"))


@query("residual_segments", "WITH p AS (SELECT l_orderkey, sum(l_extendedprice) FILTER (WHERE l_returnflag <> 'N') AS parts FROM lineitem GROUP BY 1) SELECT o_orderkey, round(o_totalprice - coalesce(parts, 0), 2) AS residual FROM orders JOIN p ON l_orderkey = o_orderkey")
def residual_segments(spark, d):
    p = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice"))).alias("parts"))
    return table(spark, d, "orders").join(p, F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", F.round(F.col("o_totalprice") - F.coalesce("parts", F.lit(0.0)), 2).alias("residual"))


@query("readiness_matrix", """WITH c AS (SELECT c_mktsegment AS company, count(DISTINCT c_nationkey) AS sources, count(*) FILTER (WHERE c_acctbal > 0) AS active, count(*) AS n FROM customer GROUP BY 1) SELECT company, sources, active, n, concat_ws(';', CASE WHEN sources < 25 THEN 'sources' END, CASE WHEN active < 0.9 * n THEN 'inactive' END) AS gaps FROM c""")
def readiness_matrix(spark, d):
    c = table(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("company")).agg(F.count_distinct("c_nationkey").alias("sources"), F.count(F.when(F.col("c_acctbal") > 0, 1)).alias("active"), F.count("*").alias("n"))
    gaps = F.concat_ws(";", F.when(F.col("sources") < 25, "sources"), F.when(F.col("active") < 0.9 * F.col("n"), "inactive"))
    return c.withColumn("gaps", gaps)


@query("question_parts", r"SELECT conv_id, turn, len(list_filter(list_transform(regexp_split_to_array(lower(text), '\?|;|\b(?:and|as well as|y|und|et)\b'), lambda p: trim(p)), lambda p: length(p) >= 8)) AS parts FROM conversations WHERE text IS NOT NULL AND role = 'user'")
def question_parts(spark, d):
    t = table(spark, d, "conversations").where("text is not null and role = 'user'")
    return t.select("conv_id", "turn", F.size(reports.decompose(F.col("text"))).cast("long").alias("parts"))


@query("figure_signal", r"SELECT doc_id, round(least(1.0, len(regexp_extract_all(text, '\d+(?:[.,]\d+)*\s*%?')) / nullif(len(string_split(nullif(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ''), ' ')), 0)), 8) AS signal FROM documents")
def figure_signal(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(reports.figure_signal(F.col("text")), 8).alias("signal"))


@query("validated_overlay", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def validated_overlay(spark, d):
    """A left join that fails if the right side repeats a key."""
    right = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return panel.many_to_one(table(spark, d, "orders").select("o_orderkey", "o_custkey"), right, ["o_custkey"]).select("o_orderkey", "c_mktsegment")


@query("best_file_per_period", "SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS fy, min_by(o_orderkey, struct_pack(k := CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '3-MEDIUM' THEN 1 ELSE 2 END, o := o_orderkey)) AS o_orderkey FROM orders GROUP BY 1, 2")
def best_file_per_period(spark, d):
    x = table(spark, d, "orders").withColumn("fy", F.year("o_orderdate"))
    k = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "3-MEDIUM", 1).otherwise(2)
    return catalog.latest(x.withColumn("k", k), ["o_custkey", "fy"], F.col("k"), F.col("o_orderkey")).select("o_custkey", "fy", "o_orderkey")


@query("latest_periods", f"WITH {Q_SQL} SELECT slug, qi FROM q QUALIFY row_number() OVER (PARTITION BY slug ORDER BY qi DESC) <= 4")
def latest_periods(spark, d):
    return catalog.latest_k(quarterly(spark, d).select("slug", "qi"), ["slug"], 4, F.desc("qi"))
