"""Queries of filters, composites, audits and orderings that complete the other plans."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numeric, periods
from ..operators import catalog, panel, stats, strategy
from ..operators.filters import Filter, flagged, listed
from .base import Q_SQL, SUE_SQL, quarterly, query, table
from .study import scored


@query("composed_filter", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice >= 50000 AND o_totalprice <= 300000 AND regexp_matches(lower(o_orderstatus), 'f|p') AND o_orderdate IS NOT NULL")
def composed_filter(spark, d):
    """A filter object built from two and applied as one predicate of the scan."""
    f = Filter(values={"o_orderpriority": ["1-URGENT", "2-HIGH", "5-LOW"]}, least={"o_totalprice": 50_000}) & Filter(values={"o_orderpriority": ["2-HIGH", "1-URGENT"]}, most={"o_totalprice": 300_000}, patterns={"o_orderstatus": "f|p"}, present=["o_orderdate"])
    return f.apply(table(spark, d, "orders")).select("o_orderkey")


@query("universe_flags", """WITH u AS (SELECT c_custkey AS k, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS has_facts, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) AS has_prices, c_acctbal > 0 AS in_universe FROM customer)
SELECT in_universe, has_facts, has_prices, count(*) AS n, count(*) FILTER (WHERE in_universe AND has_facts AND has_prices) AS used FROM u GROUP BY ALL""")
def universe_flags(spark, d):
    """Companies by what is there about them; a study uses those with all three."""
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    u = flagged(table(spark, d, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_acctbal") > 0).alias("in_universe")), "k", has_facts=o.where("o_orderstatus = 'F'"), has_prices=o.where("o_totalprice > 400000"))
    return u.groupBy("in_universe", "has_facts", "has_prices").agg(F.count("*").alias("n"), F.count_if(F.expr("in_universe and has_facts and has_prices")).alias("used"))


@query("listing_windows", """WITH l AS (SELECT o_custkey, min(year(o_orderdate)) AS a, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE max(year(o_orderdate)) END AS z FROM orders GROUP BY 1) SELECT c_custkey, CAST(y AS INTEGER) AS fy FROM customer LEFT JOIN l ON o_custkey = c_custkey, range(1995, 2003) t(y) WHERE coalesce(y >= a, true) AND coalesce(y <= z, true)""")
def listing_windows(spark, d):
    """Years for which a report is due from each company: those of its listing, open-ended for some."""
    span = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("z"))
    c = table(spark, d, "customer").select("c_custkey").join(span, "c_custkey", "left").withColumn("z", F.when(F.col("c_custkey") % 3 != 0, F.col("z")))
    return c.withColumn("fy", F.explode(F.sequence(F.lit(1995), F.lit(2002)))).where(listed(F.col("fy"), F.col("a"), F.col("z"))).select("c_custkey", "fy")


@query("study_join", f"""WITH {SUE_SQL}, e AS (SELECT n_name AS slug, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS qi, min(o_orderdate) AS first, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 490000 GROUP BY 1, 2)
SELECT e.slug, e.qi, e.n, round(t.z, 6) AS z, t.tercile FROM e LEFT JOIN t ON t.slug = e.slug AND t.qi = e.qi""")
def study_join(spark, d):
    """Events with the surprise of their company and period, where there is one."""
    o = table(spark, d, "orders").where("o_totalprice > 490000").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    e = o.groupBy(F.col("n_name").alias("slug"), periods.quarter_index("o_orderdate").alias("qi")).agg(F.count("*").alias("n"))
    return e.join(scored(spark, d).select("slug", "qi", F.round("z", 6).alias("z"), "tercile"), ["slug", "qi"], "left").select("slug", "qi", "n", "z", "tercile")


@query("availability_times", "SELECT o_orderkey, strftime(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 20 DAY ELSE CAST(last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS TIMESTAMP) + INTERVAL 90 DAY + INTERVAL 1439 MINUTE END, '%Y-%m-%d %H:%M:%S') AS known FROM orders")
def availability_times(spark, d):
    """When figures could be known: the filing, else the quarter's end and ninety days."""
    filed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("INTERVAL 20 DAYS"))
    return table(spark, d, "orders").select("o_orderkey", F.date_format(periods.availability(filed, periods.quarter_index("o_orderdate")), "yyyy-MM-dd HH:mm:ss").alias("known"))


@query("winsorized_values", f"WITH {SUE_SQL} SELECT slug, qi, round(CASE WHEN sue IS NOT NULL THEN greatest(-2.0, least(2.0, sue)) END, 8) AS sue, round(CASE WHEN dx IS NOT NULL THEN greatest(-0.5, least(0.25, dx / revenue)) END, 8) AS rel FROM t")
def winsorized_values(spark, d):
    return scored(spark, d).select("slug", "qi", F.round(numeric.winsorize("sue", 2.0), 8).alias("sue"), F.round(numeric.winsorize(F.col("dx") / F.col("revenue"), -0.5, 0.25), 8).alias("rel"))


@query("seasonal_expectation", f"WITH {Q_SQL} SELECT slug, qi, round(CASE WHEN count(revenue) OVER w >= 2 THEN avg(revenue) OVER w END, 2) AS expected FROM q WINDOW w AS (PARTITION BY slug, qi % 4 ORDER BY qi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
def seasonal_expectation(spark, d):
    """Mean of the same fiscal quarter of all earlier years, from two on."""
    q = quarterly(spark, d).withColumn("fq", F.col("qi") % 4)
    return q.select("slug", "qi", F.round(panel.expanding_mean("revenue", ["slug", "fq"], "qi", 2), 2).alias("expected"))


@query("reaction_split", """WITH b AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS day, arg_min(value, struct_pack(ts, event_id)) AS o, arg_max(value, struct_pack(ts, event_id)) AS c FROM events GROUP BY 1, 2), r AS (SELECT symbol, day, o / nullif(lag(c) OVER w, 0) - 1 AS gap, c / nullif(o, 0) - 1 AS intraday, c / nullif(lag(c) OVER w, 0) - 1 AS close_to_close FROM b WINDOW w AS (PARTITION BY symbol ORDER BY day)),
l AS (SELECT CASE WHEN gap > 0 THEN 'up' ELSE 'down' END AS bucket, measure, v FROM (SELECT gap, 'gap' AS measure, gap AS v FROM r UNION ALL SELECT gap, 'intraday', intraday FROM r UNION ALL SELECT gap, 'close_to_close', close_to_close FROM r) WHERE gap IS NOT NULL)
SELECT bucket, measure, count(v) AS n, round(avg(v), 8) AS mean FROM l GROUP BY 1, 2""")
def reaction_split(spark, d):
    """What part of a reaction comes before the open, in the session and from close to close, by bucket."""
    key = F.struct("ts", "event_id")
    b = table(spark, d, "events").groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("day")).agg(F.min_by("value", key).alias("o"), F.max_by("value", key).alias("c"))
    past = F.lag("c").over(Window.partitionBy("symbol").orderBy("day"))
    r = b.withColumns({"gap": numeric.safe_div("o", past) - 1, "intraday": numeric.safe_div("c", "o") - 1, "close_to_close": numeric.safe_div("c", past) - 1}).where("gap is not null")
    long = r.withColumn("bucket", F.when(F.col("gap") > 0, "up").otherwise("down")).unpivot(["bucket"], ["gap", "intraday", "close_to_close"], "measure", "v")
    return long.groupBy("bucket", "measure").agg(F.count("v").alias("n"), F.round(F.avg("v"), 8).alias("mean"))


@query("agreement_composites", f"""WITH {SUE_SQL}, sg AS (SELECT slug, qi, sign(z) AS a, sign(dx) AS b, sign(fwd) AS c FROM t) SELECT slug, qi, CAST(CASE WHEN a = b AND a > 0 THEN 1 ELSE 0 END AS INTEGER) AS confirmed_beat, CAST(CASE WHEN a = b AND a < 0 THEN 1 ELSE 0 END AS INTEGER) AS confirmed_miss, CAST(CASE WHEN a * b < 0 THEN 1 ELSE 0 END AS INTEGER) AS contradiction, CAST(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS INTEGER) AS conviction FROM sg""")
def agreement_composites(spark, d):
    """Signs that agree, disagree, and their balance."""
    a, b, c = (F.signum(x) for x in ("z", "dx", "fwd"))
    one = lambda w: F.when(w, 1).otherwise(0)
    zero = F.lit(0.0)
    return scored(spark, d).select("slug", "qi", one((a == b) & (a > 0)).alias("confirmed_beat"), one((a == b) & (a < 0)).alias("confirmed_miss"), one(a * b < 0).alias("contradiction"), (F.coalesce(a, zero) + F.coalesce(b, zero) + F.coalesce(c, zero)).cast("int").alias("conviction"))


@query("kelly_day_returns", f"""WITH {SUE_SQL}, u AS (SELECT qi, fwd, CASE WHEN abs(z) > 0.3 THEN abs(z) / 20 END AS w FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL), m AS (SELECT *, coalesce(w, median(w) OVER (PARTITION BY qi), 0.0) AS s FROM u), g AS (SELECT *, sum(s) OVER (PARTITION BY qi) AS total FROM m)
SELECT qi, round(sum(s / CASE WHEN total > 1 THEN total ELSE 1 END * fwd), 8) AS r FROM g GROUP BY qi""")
def kelly_day_returns(spark, d):
    """Day returns with stakes that sum to one at most, missing stakes at the day's median."""
    u = scored(spark, d).where("z is not null and fwd is not null").withColumn("w", F.when(F.abs("z") > 0.3, F.abs("z") / 20))
    return strategy.kelly_days(u, "qi", "fwd", "w").select("qi", F.round("r", 8).alias("r"))


@query("class_size_modes", f"""WITH {SUE_SQL}, u AS (SELECT qi, fwd, abs(z) AS az, 1.0 / nullif(abs(dx / revenue), 0) AS iv FROM t WHERE z IS NOT NULL AND fwd IS NOT NULL AND dx IS NOT NULL), m AS (SELECT *, 3 * median(iv) OVER () AS cap FROM u)
SELECT qi, round(sum(least(iv, cap) * fwd) / nullif(sum(least(iv, cap)), 0), 8) AS vol, round(sum(CASE WHEN az >= 1 THEN 0.25 WHEN az >= 0.5 THEN 0.1 ELSE 0.05 END * fwd) / nullif(sum(CASE WHEN az >= 1 THEN 0.25 WHEN az >= 0.5 THEN 0.1 ELSE 0.05 END), 0), 8) AS kelly_class FROM m GROUP BY qi""")
def class_size_modes(spark, d):
    """Sizes by inverse volatility, capped at three times its median, and by a stake per class of conviction."""
    u = scored(spark, d).where("z is not null and fwd is not null and dx is not null").withColumn("vol", F.when(F.col("dx") != 0, F.abs(F.col("dx") / F.col("revenue"))))
    median = u.agg(F.median(1 / F.col("vol")).alias("median_weight"))  # one row
    u = u.crossJoin(F.broadcast(median)).withColumns({"iv": strategy.inverse_vol("vol"), "kc": F.when(F.abs("z") >= 1, 0.25).when(F.abs("z") >= 0.5, 0.1).otherwise(0.05)})
    a = strategy.weighted_days(u, "qi", "fwd", "iv").select("qi", F.round("r", 8).alias("vol"))
    return a.join(strategy.weighted_days(u, "qi", "fwd", "kc").select("qi", F.round("r", 8).alias("kelly_class")), "qi")


@query("confusion_table", """WITH j AS (SELECT quality AS gold, CASE WHEN length(text) > 800 THEN 1 ELSE 0 END AS guess FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL), c AS (SELECT gold, guess, count(*) AS n FROM j GROUP BY 1, 2),
f AS (SELECT k, 2.0 * sum(CASE WHEN gold = k AND guess = k THEN n ELSE 0 END) / nullif(sum(CASE WHEN gold = k THEN n ELSE 0 END) + sum(CASE WHEN guess = k THEN n ELSE 0 END), 0) AS f1 FROM c, (SELECT unnest([0, 1]) AS k) GROUP BY k)
SELECT gold, guess, n, round((SELECT avg(f1) FROM f), 8) AS macro_f1 FROM c""")
def confusion_table(spark, d):
    """Gold against guess, with the mean F1 of the classes."""
    j = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").where("quality is not null").select(F.col("quality").alias("gold"), F.when(F.length("text") > 800, 1).otherwise(0).alias("guess"))
    return stats.confusion(j, "gold", "guess", (0, 1)).withColumn("macro_f1", F.round("macro_f1", 8))


@query("consensus_surprise", f"""WITH {Q_SQL}, e AS (SELECT slug, qi, revenue, lag(revenue, 4) OVER (PARTITION BY slug ORDER BY qi) * 1.05 AS est FROM q), p AS (SELECT *, CASE WHEN est IS NOT NULL AND est <> 0 THEN greatest(-1.0, least(1.0, (revenue - est) / abs(est))) END AS pct FROM e)
SELECT slug, qi, round(pct, 8) AS pct, round(CASE WHEN count(pct) OVER w >= 20 AND stddev_samp(pct) OVER w > 0 THEN greatest(-3.0, least(3.0, (pct - avg(pct) OVER w) / stddev_samp(pct) OVER w)) END, 6) AS z FROM p WINDOW w AS (PARTITION BY qi)""")
def consensus_surprise(spark, d):
    """Surprise against an estimate in per cent, winsorized, standardised among a pool of twenty."""
    e = quarterly(spark, d).withColumn("est", F.lag("revenue", 4).over(Window.partitionBy("slug").orderBy("qi")) * 1.05)
    e = e.withColumn("pct", numeric.winsorize(numeric.safe_div(F.col("revenue") - F.col("est"), F.abs("est")), 1.0))
    w = Window.partitionBy("qi")
    sd = F.stddev_samp("pct").over(w)
    z = F.when((F.count("pct").over(w) >= 20) & (sd > 0), numeric.winsorize((F.col("pct") - F.avg("pct").over(w)) / sd, 3.0))
    return e.select("slug", "qi", F.round("pct", 8).alias("pct"), F.round(z, 6).alias("z"))


@query("strength_scores", """WITH s AS (SELECT p_brand AS metric, count(*) AS n, avg(CASE WHEN p_size > 5 THEN 1.0 ELSE 0.0 END) AS coverage, avg(CASE WHEN p_type = 'ECONOMY' THEN 0.9 ELSE 0.7 END) AS confidence, avg(CASE WHEN p_retailprice > 1700 THEN 1.0 ELSE 0.0 END) AS suspects FROM part GROUP BY 1)
SELECT metric, round(coverage, 8) AS coverage, round(confidence, 8) AS confidence, round(suspects, 8) AS suspects, round(0.5 * coverage + 0.3 * confidence + 0.2 * (1 - suspects), 8) AS score, coverage >= 0.8 AND confidence >= 0.7 AND suspects <= 0.2 AS strong FROM s""")
def strength_scores(spark, d):
    """How strong a metric is: cells filled, confidence of their sources, suspects among them."""
    share = lambda c: F.avg(c.cast("double"))
    s = table(spark, d, "part").groupBy(F.col("p_brand").alias("metric")).agg(share(F.col("p_size") > 5).alias("coverage"), F.avg(F.when(F.col("p_type") == "ECONOMY", 0.9).otherwise(0.7)).alias("confidence"), share(F.col("p_retailprice") > 1700).alias("suspects"))
    score = 0.5 * F.col("coverage") + 0.3 * F.col("confidence") + 0.2 * (1 - F.col("suspects"))
    return s.select("metric", *[F.round(c, 8).alias(c) for c in ("coverage", "confidence", "suspects")], F.round(score, 8).alias("score"), ((F.col("coverage") >= 0.8) & (F.col("confidence") >= 0.7) & (F.col("suspects") <= 0.2)).alias("strong"))


@query("universe_audit", """WITH k AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS qi FROM orders WHERE year(o_orderdate) BETWEEN 1998 AND 2000), c AS (SELECT c_custkey, count(qi) AS filled, round(count(qi) / 12.0, 8) AS ratio FROM customer LEFT JOIN k ON o_custkey = c_custkey GROUP BY 1)
SELECT c_custkey, filled, ratio, ratio >= 0.25 AS met, CASE WHEN ratio < 0.25 THEN row_number() OVER (ORDER BY ratio, c_custkey) END AS worst FROM c""")
def universe_audit(spark, d):
    """Quarters filled of twelve a company, those below the floor ranked worst first."""
    k = table(spark, d, "orders").where(F.year("o_orderdate").between(1998, 2000)).select(F.col("o_custkey").alias("c_custkey"), periods.quarter_index("o_orderdate").alias("qi")).distinct()
    c = table(spark, d, "customer").select("c_custkey").join(k, "c_custkey", "left").groupBy("c_custkey").agg(F.count("qi").alias("filled")).withColumn("ratio", F.round(F.col("filled") / 12, 8))
    return catalog.worst_first(c, "ratio", "c_custkey", 0.25)


@query("tier_precedence", "SELECT l_orderkey, min_by(l_returnflag, struct_pack(k := CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, f := l_returnflag)) AS tier FROM lineitem GROUP BY 1")
def tier_precedence(spark, d):
    x = table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("tier")).distinct()
    return catalog.precedence(x, ["l_orderkey"], "tier", {"R": 0, "A": 1}).select("l_orderkey", "tier")


@query("layout_provenance", """WITH x AS (SELECT l_partkey, CAST(year(l_shipdate) AS INTEGER) AS fy, l_linenumber AS layout, max(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3) SELECT l_partkey, fy, max_by(v, layout) AS value, max(layout) AS layout, string_agg(CAST(layout AS VARCHAR), ',' ORDER BY layout DESC) AS provenance FROM x GROUP BY 1, 2""")
def layout_provenance(spark, d):
    """Where several layouts report a period the newest wins; all that did are named."""
    x = table(spark, d, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("fy"), F.col("l_linenumber").alias("layout")).agg(F.max("l_quantity").alias("v"))
    return catalog.newest_layout(x, ["l_partkey", "fy"], "layout", "v")


@query("sequence_order", """WITH f AS (SELECT l_orderkey, list(l_returnflag ORDER BY l_linenumber, l_returnflag) AS f FROM (SELECT l_orderkey, l_returnflag, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY 1, 2) GROUP BY 1)
SELECT l_orderkey, array_to_string(list_filter(['A', 'N'], lambda x: NOT list_contains(f, x)), ',') AS missing, array_to_string(list_filter(f, lambda x: x NOT IN ('A', 'N')), ',') AS extra, list_filter(f, lambda x: x IN ('A', 'N')) = list_filter(['A', 'N'], lambda x: list_contains(f, x)) AS in_order FROM f""")
def sequence_order(spark, d):
    """Names in the order they appear against the expected ones: what is missing, extra, out of order."""
    f = table(spark, d, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.min("l_linenumber").alias("i")).groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "l_returnflag"))), lambda s: s["l_returnflag"]).alias("f"))
    r = catalog.sequence_difference(F.array(F.lit("A"), F.lit("N")), F.col("f"))
    return f.select("l_orderkey", r.alias("r")).select("l_orderkey", F.array_join("r.missing", ",").alias("missing"), F.array_join("r.extra", ",").alias("extra"), "r.in_order")


@query("spoken_periods", """WITH o AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) AS y, quarter(o_orderdate) AS q FROM orders) SELECT k, CASE WHEN k % 8 = 7 THEN y || '-FY' ELSE y || '-' || q || 'T' END AS label FROM o""")
def spoken_periods(spark, d):
    """Periods as reports speak of them, in two languages."""
    q, y = F.quarter("o_orderdate"), F.year("o_orderdate").cast("string")
    pick = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), q)
    n, end = q.cast("string"), pick("-03-31", "-06-30", "-09-30", "-12-31")
    forms = [F.concat(pick("1er", "2do", "3er", "4to"), F.lit(" trimestre de "), y), F.concat(F.lit("the "), pick("1st", "2nd", "3rd", "4th"), F.lit(" quarter of "), y), F.concat(n, F.lit("T"), F.substring(y, 3, 2)), F.concat(F.lit("Q"), n, F.lit(" "), y), F.concat(F.lit("Resultados "), pick("primer trimestre", "segundo trimestre", "tercer trimestre", "cuarto trimestre"), F.lit(" "), y), F.concat(F.lit("context ending "), y, end), F.concat(y, F.lit("-"), n, F.lit("T")), F.concat(F.lit("annual "), y)]
    spoken = F.element_at(F.array(*forms), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), periods.parse_period(spoken).alias("label"))


@query("fiscal_calendars", """WITH c AS (SELECT n_nationkey AS k, CAST(1 + n_nationkey % 12 AS INTEGER) AS m FROM nation), q AS (SELECT k, m, y, q, CAST(last_day(make_date(CAST(y AS INTEGER), m, 1)) - INTERVAL (3 * (4 - q)) MONTH AS DATE) AS d0 FROM c, range(1999, 2002) t(y), range(1, 5) s(q))
SELECT k, CAST(y AS INTEGER) AS fy, CAST(q AS INTEGER) AS q, CAST(last_day(d0) AS VARCHAR) AS ends, CAST(last_day(d0) + CASE q WHEN 4 THEN 120 ELSE 60 END AS VARCHAR) AS deadline FROM q""")
def fiscal_calendars(spark, d):
    """Each issuer's fiscal quarters by the month its year ends in, with deadlines; the last quarter has longer."""
    c = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), (1 + F.col("n_nationkey") % 12).cast("int").alias("m"))
    out = periods.fiscal_quarters(c, "m", 1999, 2001, 60, 120)
    return out.select("k", "fy", "q", F.col("ends").cast("string").alias("ends"), F.col("deadline").cast("string").alias("deadline"))


@query("logistic_scores", f"WITH {SUE_SQL} SELECT slug, qi, round(1 / (1 + exp(-(0.1 + 0.8 * z))), 8) AS p_win FROM t WHERE z IS NOT NULL")
def logistic_scores(spark, d):
    return scored(spark, d).where("z is not null").select("slug", "qi", F.round(numeric.logistic("z", 0.1, 0.8), 8).alias("p_win"))


@query("plausible_cells", "SELECT o_orderpriority AS metric, count(*) FILTER (WHERE o_totalprice > 20000 AND o_totalprice < 450000) AS inside, count(*) FILTER (WHERE NOT (o_totalprice > 20000 AND o_totalprice < 450000)) AS outside, count(nullif(o_totalprice - o_totalprice % 100000, 0)) AS not_zero FROM orders GROUP BY 1")
def plausible_cells(spark, d):
    """Cells inside a band, outside it, and artifact zeros taken as missing."""
    ok = numeric.plausible("o_totalprice", 20_000, 450_000)
    hundreds = F.col("o_totalprice") - F.col("o_totalprice") % 100_000
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("metric")).agg(F.count_if(ok).alias("inside"), F.count_if(~ok).alias("outside"), F.count(F.nullif(hundreds, F.lit(0.0))).alias("not_zero"))


@query("url_or_hash_merge", r"""WITH k AS (SELECT page_id, CASE WHEN url IS NOT NULL AND page_id % 4 <> 0 THEN 'u:' || regexp_replace(url, '[?#].*$', '') ELSE 'h:' || md5(html) || ':' || CAST(page_id % 7 AS VARCHAR) END AS key, length(html) AS n FROM pages) SELECT key, min(page_id) AS page_id, max(n) AS n, count(*) AS seen FROM k GROUP BY 1""")
def url_or_hash_merge(spark, d):
    """News rows by their link, those without one by content, publisher and day together."""
    link = F.when(F.col("page_id") % 4 != 0, F.concat(F.lit("u:"), F.regexp_replace("url", r"[?#].*$", "")))
    other = F.concat(F.lit("h:"), F.md5("html"), F.lit(":"), (F.col("page_id") % 7).cast("string"))
    p = table(spark, d, "pages").withColumn("n", F.length("html").cast("long"))
    return catalog.merge_natural(p, F.coalesce(link, other), ["page_id"], ["n"], "page_id")


@query("artifact_documents", "SELECT source, count(*) AS artifacts, count(DISTINCT doc_id) AS documents, count(*) FILTER (WHERE toxic = 1) AS flagged FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def artifact_documents(spark, d):
    """Artifacts with their documents' attributes, joined on the key's own name."""
    j = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    return j.groupBy("source").agg(F.count("*").alias("artifacts"), F.count_distinct("doc_id").alias("documents"), F.count_if(F.col("toxic") == 1).alias("flagged"))
