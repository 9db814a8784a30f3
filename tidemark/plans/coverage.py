"""Queries of valuation and coverage: companies are customers' nations and suppliers, figures come from orders and items."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import quality, valuation
from .base import query, table

#: One company per supplier with invented statement lines from its items.
CO_SQL = """i AS (SELECT l_suppkey, sum(l_extendedprice) AS revenue, sum(l_extendedprice * l_discount) AS costs, sum(l_extendedprice * l_tax) AS ebitda, count(*) AS n, sum(l_quantity) AS shares FROM lineitem GROUP BY 1),
co AS (SELECT s_suppkey AS company, s_nationkey % 5 AS sector, revenue, costs, CASE WHEN s_suppkey % 13 = 0 THEN NULL ELSE ebitda END AS ebitda, ebitda * 0.5 - costs * 0.2 AS net_income, revenue * 0.6 AS equity, revenue * 1.5 AS assets, costs AS debt, s_acctbal AS cash, CAST(NULL AS DOUBLE) AS minorities, shares, 10.0 + s_suppkey % 7 AS price,
 costs * 0.4 AS inventory, revenue * 0.1 AS receivables, costs * 0.3 AS payables, revenue * 0.3 AS current_assets, revenue * 0.2 AS current_liabilities, ebitda * 0.1 AS intangibles, ebitda * 0.2 AS depreciation, CAST(NULL AS DOUBLE) AS gains, ebitda * 0.8 AS noi, n FROM supplier JOIN i ON l_suppkey = s_suppkey),
mu AS (SELECT *, price * shares AS cap, price * shares + debt - cash AS ev FROM co)"""


def companies(spark, d):
    p = F.col("l_extendedprice")
    i = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.sum(p).alias("revenue"), F.sum(p * F.col("l_discount")).alias("costs"), F.sum(p * F.col("l_tax")).alias("_e"), F.count("*").alias("n"), F.sum("l_quantity").alias("shares"))
    c = table(spark, d, "supplier").join(i, F.col("s_suppkey") == F.col("l_suppkey"))
    null = F.lit(None).cast("double")
    return c.select(
        F.col("s_suppkey").alias("company"), (F.col("s_nationkey") % 5).alias("sector"), "revenue", "costs", F.when(F.col("s_suppkey") % 13 != 0, F.col("_e")).alias("ebitda"), (F.col("_e") * 0.5 - F.col("costs") * 0.2).alias("net_income"),
        (F.col("revenue") * 0.6).alias("equity"), (F.col("revenue") * 1.5).alias("assets"), F.col("costs").alias("debt"), F.col("s_acctbal").alias("cash"), null.alias("minorities"), "shares", (10.0 + F.col("s_suppkey") % 7).alias("price"),
        (F.col("costs") * 0.4).alias("inventory"), (F.col("revenue") * 0.1).alias("receivables"), (F.col("costs") * 0.3).alias("payables"), (F.col("revenue") * 0.3).alias("current_assets"), (F.col("revenue") * 0.2).alias("current_liabilities"),
        (F.col("_e") * 0.1).alias("intangibles"), (F.col("_e") * 0.2).alias("depreciation"), null.alias("gains"), (F.col("_e") * 0.8).alias("noi"), "n",
    )


def rounded(df, keys, names, digits=6):
    return df.select(*keys, *[F.round(n, digits).alias(n) for n in names])


@query("company_multiples", f"""WITH {CO_SQL} SELECT company, round(cap / nullif(net_income, 0), 6) AS pe, round(cap / nullif(equity, 0), 6) AS p_bv, round(net_income / nullif(equity, 0), 6) AS roe, round(ev / nullif(ebitda, 0), 6) AS ev_ebitda, round(ev / nullif(revenue, 0), 6) AS ev_sales, round((debt - cash) / nullif(ebitda, 0), 6) AS nd_ebitda FROM mu""")
def company_multiples(spark, d):
    m = valuation.multiples()
    return rounded(companies(spark, d).withColumns(m), ["company"], list(m))


@query("bank_and_trust_multiples", f"""WITH {CO_SQL} SELECT company, round(cap / nullif(equity - intangibles, 0), 6) AS p_tbv, round(net_income / nullif(equity - intangibles, 0), 6) AS rotce, round(cap / nullif(net_income + depreciation, 0), 6) AS p_ffo, round(ev / nullif(noi, 0), 6) AS ev_noi, round(debt / nullif(assets, 0), 6) AS ltv, round((net_income + depreciation) / nullif(cap, 0), 6) AS ffo_yield FROM mu""")
def bank_and_trust_multiples(spark, d):
    m = {k: v for k, v in (valuation.multiples("bank") | valuation.multiples("trust")).items() if k not in ("pe", "p_bv", "roe")}
    return rounded(companies(spark, d).withColumns(m), ["company"], list(m))


@query("peer_median_multiples", f"""WITH {CO_SQL}, r AS (SELECT company, sector, 'pe' AS name, cap / nullif(net_income, 0) AS v FROM mu UNION ALL SELECT company, sector, 'ev_ebitda', ev / nullif(ebitda, 0) FROM mu),
a AS (SELECT company, sector, name, CASE WHEN v > 0 AND v < CASE name WHEN 'pe' THEN 100 ELSE 60 END THEN v END AS v FROM r)
SELECT a.company, a.name, round(any_value(a.v), 6) AS value, round(median(b.v), 6) AS peer_median, round(any_value(a.v) / nullif(median(b.v), 0) - 1, 6) AS premium FROM a LEFT JOIN a b ON a.sector = b.sector AND a.name = b.name AND a.company <> b.company GROUP BY 1, 2""")
def peer_median_multiples(spark, d):
    m = valuation.multiples()
    names = ["pe", "ev_ebitda"]
    c = valuation.admitted(companies(spark, d).withColumns({k: m[k] for k in names}), names)
    out = valuation.peer_medians(c, "sector", "company", names)
    return rounded(out, ["company", "name"], ["value", "peer_median", "premium"])


@query("source_reconciliation", f"""WITH {CO_SQL}, x AS (SELECT company, CASE WHEN company % 4 = 0 THEN revenue * 1000 ELSE revenue END AS f, CASE WHEN company % 3 = 0 THEN NULL ELSE revenue * 1.02 END AS o, revenue AS ref FROM mu)
SELECT company, round(CASE WHEN f IS NOT NULL AND abs(f) / abs(ref) BETWEEN 0.01 AND 50 THEN f ELSE coalesce(o, f) END, 2) AS value, CASE WHEN f IS NOT NULL AND abs(f) / abs(ref) BETWEEN 0.01 AND 50 THEN 'filing' WHEN o IS NOT NULL THEN 'other' WHEN f IS NOT NULL THEN 'filing' END AS source FROM x""")
def source_reconciliation(spark, d):
    c = companies(spark, d).select("company", F.when(F.col("company") % 4 == 0, F.col("revenue") * 1000).otherwise(F.col("revenue")).alias("f"), F.when(F.col("company") % 3 != 0, F.col("revenue") * 1.02).alias("o"), F.col("revenue").alias("ref"))
    value, source = valuation.reconcile("f", "o", "ref")
    return c.select("company", F.round(value, 2).alias("value"), source.alias("source"))


@query("share_scale", f"""WITH {CO_SQL}, x AS (SELECT company, net_income, shares * CASE company % 3 WHEN 0 THEN 1000 WHEN 1 THEN 0.001 ELSE 1 END AS s, net_income / shares AS eps FROM mu) SELECT company, round(net_income / eps, 4) AS shares FROM x WHERE net_income <> 0""")
def share_scale(spark, d):
    factor = F.when(F.col("company") % 3 == 0, 1000.0).when(F.col("company") % 3 == 1, 0.001).otherwise(1.0)
    c = companies(spark, d).select("company", "net_income", (F.col("shares") * factor).alias("s"), (F.col("net_income") / F.col("shares")).alias("eps")).where("net_income <> 0")
    return c.select("company", F.round(valuation.share_scale("s", "net_income", "eps"), 4).alias("shares"))


@query("profitability", f"""WITH {CO_SQL} SELECT company, round(net_income / nullif(revenue, 0), 8) AS net_margin, round(revenue / nullif(assets, 0), 8) AS asset_turnover, round(assets / nullif(equity, 0), 8) AS leverage, round((net_income / nullif(revenue, 0)) * (revenue / nullif(assets, 0)) * (assets / nullif(equity, 0)), 8) AS roe,
 round(current_assets / nullif(current_liabilities, 0), 8) AS current_ratio, round((current_assets - inventory) / nullif(current_liabilities, 0), 8) AS quick_ratio, round(current_assets - current_liabilities, 2) AS working_capital,
 round(365 * (inventory / nullif(costs, 0)) + 365 * (receivables / nullif(revenue, 0)) - 365 * (payables / nullif(costs, 0)), 6) AS cash_cycle FROM mu""")
def profitability(spark, d):
    cols = valuation.dupont() | valuation.liquidity()
    digits = {"working_capital": 2, "cash_cycle": 6}
    return companies(spark, d).select("company", *[F.round(c, digits.get(n, 8)).alias(n) for n, c in cols.items()])


@query("impossible_cells", f"""WITH {CO_SQL}, m AS (SELECT company, sector = 2 AS reit, net_income / nullif(ebitda, 0) * 4 AS margin FROM mu) SELECT company, round(CASE WHEN abs(margin) <= CASE WHEN reit THEN 3 ELSE 1 END THEN margin END, 8) AS margin FROM m""")
def impossible_cells(spark, d):
    m = companies(spark, d).select("company", (F.col("sector") == 2).alias("reit"), (valuation.safe_div("net_income", "ebitda") * 4).alias("margin"))
    return m.select("company", F.round(valuation.poison("margin", F.col("reit")), 8).alias("margin"))


@query("sum_of_parts", f"""WITH {CO_SQL}, sg AS (SELECT l_suppkey AS company, l_returnflag AS seg, CASE WHEN l_returnflag = 'A' AND l_suppkey % 2 = 0 THEN NULL ELSE sum(l_extendedprice * l_tax) END AS e, CASE l_returnflag WHEN 'A' THEN 8.0 WHEN 'N' THEN 6.0 ELSE 5.0 END AS m FROM lineitem GROUP BY 1, 2),
s AS (SELECT company, sum(e * m) AS v, sum(e) AS se, count(*) FILTER (WHERE e IS NULL) AS missing, max(CASE WHEN e IS NULL THEN m END) AS mm FROM sg GROUP BY 1), j AS (SELECT s.*, ebitda, shares, debt - cash AS nd FROM s JOIN mu USING (company))
SELECT company, round(v + CASE WHEN missing = 1 THEN (ebitda - se) * mm ELSE 0 END - nd, 2) AS equity_value, round((v + CASE WHEN missing = 1 THEN (ebitda - se) * mm ELSE 0 END - nd) / nullif(shares, 0), 6) AS implied_price, round(se / nullif(ebitda, 0), 8) AS covered FROM j""")
def sum_of_parts(spark, d):
    seg = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("company"), "l_returnflag").agg(F.sum(F.col("l_extendedprice") * F.col("l_tax")).alias("e"))
    seg = seg.select("company", F.when(~((F.col("l_returnflag") == "A") & (F.col("company") % 2 == 0)), F.col("e")).alias("seg_ebitda"), F.when(F.col("l_returnflag") == "A", 8.0).when(F.col("l_returnflag") == "N", 6.0).otherwise(5.0).alias("m"))
    totals = companies(spark, d).select("company", "ebitda", (F.col("debt") - F.col("cash")).alias("net_debt"), "minorities", "shares")
    out = valuation.sum_of_parts(seg, "company", "seg_ebitda", "m", totals)
    return out.select("company", F.round("equity_value", 2).alias("equity_value"), F.round("implied_price", 6).alias("implied_price"), F.round("covered", 8).alias("covered"))


@query("derived_metrics", f"""WITH {CO_SQL} SELECT company, round(revenue - costs, 2) AS gross, round((revenue - costs) / nullif(revenue, 0), 8) AS gross_margin, round(coalesce(ebitda, noi / 0.8), 2) AS ebitda, round(-(debt - cash) / nullif(equity - equity, 0), 4) AS broken FROM mu""")
def derived_metrics(spark, d):
    rules = {"gross": "revenue - costs", "gross_margin": "gross / revenue", "ebitda": "noi / 0.8", "broken": "-(debt - cash) / (equity - equity)"}
    out = valuation.derived(companies(spark, d), rules)
    return out.select("company", *[F.round(c, p).alias(c) for c, p in (("gross", 2), ("gross_margin", 8), ("ebitda", 2), ("broken", 4))])


@query("coverage_matrix", f"""WITH {CO_SQL}, c AS (SELECT sector, CASE WHEN sector = 3 THEN 'na_template' WHEN ebitda IS NOT NULL THEN 'filled' WHEN company % 2 = 0 THEN 'na_source' ELSE 'gap' END AS state FROM mu)
SELECT sector, count(*) FILTER (WHERE state = 'filled') AS filled, count(*) FILTER (WHERE state IN ('filled', 'gap')) AS applicable, count(*) FILTER (WHERE state = 'gap') AS gap FROM c GROUP BY 1""")
def coverage_matrix(spark, d):
    c = companies(spark, d)
    state = valuation.cell_state(F.col("ebitda"), F.col("sector") != 3, F.col("company") % 2 != 0)
    n = lambda *xs: F.count(F.when(F.col("state").isin(*xs), 1))
    return c.withColumn("state", state).groupBy("sector").agg(n("filled").alias("filled"), n("filled", "gap").alias("applicable"), n("gap").alias("gap"))


@query("placeholder_check", "SELECT l_shipmode_ AS part, round(avg(CASE WHEN l_quantity % 5 = 0 THEN 1.0 ELSE 0.0 END), 8) AS share FROM (SELECT l_returnflag AS l_shipmode_, l_quantity FROM lineitem) GROUP BY 1")
def placeholder_check(spark, d):
    return table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("part")).agg(F.round(valuation.placeholder_share("l_quantity", 5.0), 8).alias("share"))


@query("cell_suspects", """WITH x AS (SELECT o_custkey AS k, o_orderkey AS o, 'total' AS metric, CASE WHEN o_orderkey % 101 = 0 THEN -o_totalprice WHEN o_orderkey % 103 = 0 THEN o_totalprice * 5000 ELSE o_totalprice END AS v FROM orders), m AS (SELECT median(abs(v)) AS m FROM x WHERE v <> 0)
SELECT count(*) FILTER (WHERE v < 0) AS sign, count(*) FILTER (WHERE v >= 0 AND abs(v) > 100 * m) AS range FROM x, m""")
def cell_suspects(spark, d):
    o = F.col("o_orderkey")
    v = F.when(o % 101 == 0, -F.col("o_totalprice")).when(o % 103 == 0, F.col("o_totalprice") * 5000).otherwise(F.col("o_totalprice"))
    x = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), o.alias("o"), F.lit("total").alias("metric"), v.alias("v"))
    out = quality.cell_suspects(x, "metric", "v", "o", ["k"], ["total"])
    n = lambda w: F.count(F.when(F.col("why") == w, 1))
    return out.agg(n("sign").alias("sign"), n("range").alias("range"))


@query("agreement_rate", f"""WITH {CO_SQL}, x AS (SELECT sector, revenue AS a, CASE WHEN company % 6 = 0 THEN NULL WHEN company % 5 = 0 THEN revenue * 1.2 ELSE revenue * 1.004 END AS b FROM mu)
SELECT sector, count(b) AS compared, round(avg(CASE WHEN abs(a - b) <= 0.01 * greatest(abs(a), abs(b)) THEN 1.0 ELSE 0.0 END) FILTER (WHERE b IS NOT NULL), 8) AS agreement FROM x GROUP BY 1""")
def agreement_rate(spark, d):
    """Share of values on which a second source agrees within 1 %."""
    b = F.when(F.col("company") % 6 == 0, None).when(F.col("company") % 5 == 0, F.col("revenue") * 1.2).otherwise(F.col("revenue") * 1.004)
    x = companies(spark, d).select("sector", F.col("revenue").alias("a"), b.alias("b"))
    ok = F.abs(F.col("a") - F.col("b")) <= 0.01 * F.greatest(F.abs("a"), F.abs("b"))
    return x.groupBy("sector").agg(F.count("b").alias("compared"), F.round(F.avg(F.when(F.col("b").isNotNull(), ok.cast("double"))), 8).alias("agreement"))


@query("trailing_dividends", """WITH x AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS day, l_tax AS div, l_extendedprice AS px FROM lineitem), t AS (SELECT symbol, max(day) AS last FROM x GROUP BY 1)
SELECT symbol, round(sum(div) FILTER (WHERE day > last - INTERVAL 365 DAY), 6) AS ttm, CAST(max(day) FILTER (WHERE day <= DATE '1997-12-31') AS VARCHAR) AS fy_day FROM x JOIN t USING (symbol) GROUP BY 1""")
def trailing_dividends(spark, d):
    """Dividends of the last 365 days and the last trading day on or before a year end."""
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day"), F.col("l_tax").alias("div"))
    last = F.max("day").over(Window.partitionBy("symbol"))
    x = x.withColumn("last", last)
    return x.groupBy("symbol").agg(F.round(F.sum(F.when(F.col("day") > F.date_sub("last", 365), F.col("div"))), 6).alias("ttm"), F.max(F.when(F.col("day") <= F.lit("1997-12-31").cast("date"), F.col("day"))).cast("string").alias("fy_day"))
