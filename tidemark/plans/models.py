"""Queries of valuation models and audit gates over the companies of the coverage plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from ..operators import audit, blocks, valuation
from .base import query, table
from .coverage import CO_SQL, companies

#: The companies with a template and the further lines that some blocks need; and their years.
CX_SQL = CO_SQL + """, cx AS (SELECT *, CASE sector WHEN 2 THEN 'trust' WHEN 3 THEN 'bank' ELSE 'industrial' END AS template, ebitda * 0.3 AS capex, net_income * 0.4 AS dividends, n * 100.0 AS area, n * 80.0 AS area_let, 12.5 AS unit_cost, costs * 0.05 AS provisions, 0.1 AS roe_supplied,
 CASE WHEN company % 2 = 0 THEN (net_income + depreciation) * CASE WHEN company % 3 = 0 THEN 1.5 ELSE 1.02 END END AS ffo_reported FROM mu),
fy AS (SELECT l_suppkey AS company, CAST(year(l_shipdate) AS INTEGER) AS fy, sum(l_extendedprice) AS revenue, sum(l_extendedprice * l_tax) AS ebitda, sum(l_extendedprice * l_tax) * 0.5 - sum(l_extendedprice * l_discount) * 0.2 AS net_income, sum(l_extendedprice) * 0.6 AS equity, max(l_quantity) AS px FROM lineitem GROUP BY 1, 2)"""


def model_companies(spark, d):
    n = F.col("n").cast("double")
    reported = (F.col("net_income") + F.col("depreciation")) * F.when(F.col("company") % 3 == 0, 1.5).otherwise(1.02)
    return companies(spark, d).withColumns({
        "template": F.when(F.col("sector") == 2, "trust").when(F.col("sector") == 3, "bank").otherwise("industrial"), "capex": F.col("ebitda") * 0.3, "dividends": F.col("net_income") * 0.4, "area": n * 100.0, "area_let": n * 80.0, "unit_cost": F.lit(12.5), "provisions": F.col("costs") * 0.05, "roe_supplied": F.lit(0.1),
        "ffo_reported": F.when(F.col("company") % 2 == 0, reported),
    })


def years(spark, d):
    p = F.col("l_extendedprice")
    y = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("company"), F.year("l_shipdate").alias("fy"))
    y = y.agg(F.sum(p).alias("revenue"), F.sum(p * F.col("l_tax")).alias("ebitda"), F.sum(p * F.col("l_discount")).alias("_c"), F.max("l_quantity").alias("px"))
    return y.select("company", "fy", "revenue", "ebitda", (F.col("ebitda") * 0.5 - F.col("_c") * 0.2).alias("net_income"), (F.col("revenue") * 0.6).alias("equity"), "px")


_D = lambda a, b: f"{a} / nullif({b}, 0)"
_MODEL = [
    (0, "snapshot", None, {"price": "price", "shares": "shares", "market_cap": "cap", "ev": "ev", "pe": _D("cap", "net_income"), "ev_ebitda": _D("ev", "ebitda"), "ev_sales": _D("ev", "revenue")}),
    (1, "margins", "industrial", {"gross_margin": _D("(revenue - costs)", "revenue"), "ebit_margin": _D("(ebitda - depreciation)", "revenue"), "ebitda_margin": _D("ebitda", "revenue"), "net_margin": _D("net_income", "revenue")}),
    (2, "cash", "industrial", {"fcf": "ebitda - capex", "fcf_yield": _D("(ebitda - capex)", "cap"), "fcf_conversion": _D("(ebitda - capex)", "ebitda"), "inventory_turns": _D("costs", "inventory"), "dividend_yield": _D("dividends", "cap"), "cash_to_debt": _D("cash", "debt")}),
    (3, "returns", None, {"roe": _D("net_income", "equity"), "roa": _D("net_income", "assets"), "roic": _D("((ebitda - depreciation) * 0.7)", "(equity + debt - cash)")}),
    (4, "replacement", "trust", {"replacement_value": "area * unit_cost / 1000", "ev_to_replacement": _D("ev", "(area * unit_cost / 1000)")}),
    (5, "bank", "bank", {"book_value": _D("equity", "shares"), "tangible_book": _D("(equity - intangibles)", "shares"), "pe": _D("cap", "net_income"), "p_bv": _D("cap", "equity"), "p_tbv": _D("cap", "(equity - coalesce(intangibles, 0))"), "roe": f"coalesce({_D('net_income', 'equity')}, roe_supplied)", "rotce": _D("net_income", "(equity - coalesce(intangibles, 0))"), "net_interest_margin": _D("(revenue - costs)", "assets"), "efficiency": _D("costs", "revenue"), "cost_of_risk": _D("provisions", "receivables")}),
    (6, "trust", "trust", {"ffo": "coalesce(ffo_reported, net_income + depreciation)", "p_ffo": _D("cap", "coalesce(ffo_reported, net_income + depreciation)"), "noi_margin": _D("noi", "revenue"), "occupancy": _D("area_let", "area"), "ev_sales": _D("ev", "revenue"), "ltv": _D("debt", "assets")}),
]
MODEL_SQL = CX_SQL + ", model AS (" + " UNION ALL ".join(f"SELECT company, {i} AS ordinal, '{b}' AS block, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM cx" + (f" WHERE template = '{t}'" if t else "") for i, b, t, ms in _MODEL for m, e in ms.items()) + ")"
SPEC = ("snapshot", "margins", "cash", "returns", "replacement", "bank", "trust")


@query("valuation_model", f"WITH {MODEL_SQL} SELECT company, ordinal, block, metric, round(value, 6) AS value FROM model")
def valuation_model(spark, d):
    return blocks.build_model(model_companies(spark, d), SPEC).withColumn("value", F.round("value", 6))


@query("historical_bands", f"""WITH {CX_SQL}, j AS (SELECT fy.company, fy.fy, fy.px * m.shares / nullif(fy.net_income, 0) AS pe, (fy.px * m.shares + m.debt - m.cash) / nullif(fy.ebitda, 0) AS ev_ebitda, (fy.px * m.shares + m.debt - m.cash) / nullif(fy.revenue, 0) AS ev_sales, fy.px * m.shares / nullif(fy.equity, 0) AS p_bv FROM fy JOIN mu m USING (company)),
l AS (SELECT company, fy, metric, CASE WHEN v > 0 AND v < 400 THEN v END AS v FROM (SELECT company, fy, 'pe' AS metric, pe AS v FROM j UNION ALL SELECT company, fy, 'ev_ebitda', ev_ebitda FROM j UNION ALL SELECT company, fy, 'ev_sales', ev_sales FROM j UNION ALL SELECT company, fy, 'p_bv', p_bv FROM j)),
n AS (SELECT *, last_value(v) OVER (PARTITION BY company, metric ORDER BY fy ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS now FROM l)
SELECT company, metric, count(v) AS years, round(avg(v), 5) AS mean, round(avg(v) - stddev_pop(v), 5) AS low, round(avg(v) + stddev_pop(v), 5) AS high, round(any_value(now), 5) AS current, round((any_value(now) - avg(v)) / nullif(stddev_pop(v), 0), 4) AS z, round(avg(CASE WHEN v IS NOT NULL AND now IS NOT NULL THEN CAST(v <= now AS INTEGER) END), 6) AS rank FROM n GROUP BY 1, 2""")
def historical_bands(spark, d):
    """Multiples of each year's price and results at current shares and net debt, banks and trusts included, and where the last stands."""
    now = model_companies(spark, d).select("company", "shares", (F.col("debt") - F.col("cash")).alias("nd"))
    j = years(spark, d).join(now, "company").withColumn("cap", F.col("px") * F.col("shares"))
    ev = F.col("cap") + F.col("nd")
    m = {"pe": safe_div("cap", "net_income"), "ev_ebitda": safe_div(ev, F.col("ebitda")), "ev_sales": safe_div(ev, F.col("revenue")), "p_bv": safe_div("cap", "equity")}
    out = blocks.historical_bands(j, "company", "fy", {k: (v, 0.0, 400.0) for k, v in m.items()})
    return out.select("company", "metric", "years", *[F.round(x, 5).alias(x) for x in ("mean", "low", "high", "current")], F.round("z", 4).alias("z"), F.round("rank", 6).alias("rank"))


@query("growth_block", f"""WITH {CX_SQL}, v AS (SELECT company, 'revenue' AS line, fy, revenue AS v FROM fy UNION ALL SELECT company, 'ebitda', fy, ebitda FROM fy UNION ALL SELECT company, 'net_income', fy, net_income FROM fy UNION ALL SELECT company, 'equity', fy, equity FROM fy),
y AS (SELECT a.*, a.v / nullif(b.v, 0) - 1 AS g, max(a.fy) OVER (PARTITION BY a.company, a.line) AS z FROM v a LEFT JOIN v b ON a.company = b.company AND a.line = b.line AND a.fy = b.fy + 1),
s AS (SELECT company, line, any_value(z) AS z, max_by(v, fy) AS last, max(CASE WHEN fy = z THEN g END) AS yoy, stddev_pop(g) AS sd, min(CASE WHEN fy >= z - 1 THEN fy END) AS f1, min(CASE WHEN fy >= z - 3 THEN fy END) AS f3, min(CASE WHEN fy >= z - 5 THEN fy END) AS f5,
 min_by(v, fy) FILTER (WHERE fy >= z - 1) AS v1, min_by(v, fy) FILTER (WHERE fy >= z - 3) AS v3, min_by(v, fy) FILTER (WHERE fy >= z - 5) AS v5 FROM y GROUP BY 1, 2)
SELECT company, line, round(last, 2) AS last, round(yoy, 6) AS yoy, round(CASE WHEN z > f1 AND last > 0 AND v1 > 0 THEN pow(last / v1, 1.0 / (z - f1)) - 1 END, 6) AS cagr_1, round(CASE WHEN z > f3 AND last > 0 AND v3 > 0 THEN pow(last / v3, 1.0 / (z - f3)) - 1 END, 6) AS cagr_3,
 round(CASE WHEN z > f5 AND last > 0 AND v5 > 0 THEN pow(last / v5, 1.0 / (z - f5)) - 1 END, 6) AS cagr_5, round(sd, 5) AS stability FROM s""")
def growth_block(spark, d):
    y, out = years(spark, d), None
    for line in ("revenue", "ebitda", "net_income", "equity"):
        g = blocks.growth(y, "company", "fy", line).withColumn("line", F.lit(line))
        out = g if out is None else out.unionByName(g)
    return out.select("company", "line", F.round("last", 2).alias("last"), *[F.round(x, 6).alias(x) for x in ("yoy", "cagr_1", "cagr_3", "cagr_5")], F.round("stability", 5).alias("stability"))


@query("financial_block", f"""WITH {CX_SQL}, p AS (SELECT company, sector, revenue / nullif(sum(revenue) OVER (PARTITION BY sector), 0) AS sales_share, ebitda / nullif(revenue, 0) AS ebitda_margin, net_income / nullif(equity, 0) AS roe, 365 * inventory / nullif(costs, 0) AS inventory_days, (debt - cash) / nullif(ebitda, 0) AS nd_ebitda, cap / nullif(equity, 0) AS p_bv FROM cx)
SELECT a.company, round(any_value(a.sales_share), 8) AS sales_share, round(any_value(a.ebitda_margin), 8) AS ebitda_margin, round(any_value(a.roe), 8) AS roe, round(any_value(a.inventory_days), 4) AS inventory_days, round(any_value(a.nd_ebitda), 6) AS nd_ebitda, round(any_value(a.p_bv), 6) AS p_bv, round(median(b.ebitda_margin), 8) AS peer_margin, round(median(b.roe), 8) AS peer_roe
FROM p a LEFT JOIN p b ON a.sector = b.sector AND a.company <> b.company GROUP BY a.company""")
def financial_block(spark, d):
    """A company among its peers: its share of their sales, its own ratios, and the medians of the others."""
    x = model_companies(spark, d)
    cap, _ = valuation.enterprise_value()
    total = x.groupBy("sector").agg(F.sum("revenue").alias("_t"))  # a row a sector
    x = x.join(total, "sector").withColumns({"sales_share": safe_div("revenue", "_t"), "ebitda_margin": safe_div("ebitda", "revenue"), "roe": safe_div("net_income", "equity"), "inventory_days": safe_div(365 * F.col("inventory"), F.col("costs")), "nd_ebitda": safe_div(F.col("debt") - F.col("cash"), F.col("ebitda")), "p_bv": safe_div(cap, F.col("equity"))})
    m = valuation.peer_medians(x, "sector", "company", ["ebitda_margin", "roe"]).groupBy("company").agg(*[F.max(F.when(F.col("name") == n, F.col("peer_median"))).alias(a) for n, a in (("ebitda_margin", "peer_margin"), ("roe", "peer_roe"))])
    digits = {"inventory_days": 4, "nd_ebitda": 6, "p_bv": 6}
    return x.join(m, "company").select("company", *[F.round(n, digits.get(n, 8)).alias(n) for n in ("sales_share", "ebitda_margin", "roe", "inventory_days", "nd_ebitda", "p_bv", "peer_margin", "peer_roe")])


@query("macro_values", "SELECT r_name AS series, CAST(year(o_orderdate) AS INTEGER) AS fy, round(avg(o_totalprice), 4) AS value, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def macro_values(spark, d):
    """Macro series by name and year, passed through to a model: written as JSON files a fetch would leave and scanned back."""
    from ..sources import readers
    from .delivery import shared_folder

    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    at = shared_folder(spark, "macro")
    o.groupBy(F.col("r_name").alias("series"), F.year("o_orderdate").alias("fy")).agg(F.avg("o_totalprice").alias("value"), F.count("*").alias("n")).write.json(at)
    return readers.macro_series(spark, at).select("series", "fy", F.round("value", 4).alias("value"), "n")


@query("ffo_corroboration", f"""WITH {CX_SQL}, o AS (SELECT company, ffo_reported AS r, net_income + depreciation AS f FROM cx), s AS (SELECT *, CASE WHEN r IS NULL AND f IS NULL THEN 'none' WHEN r IS NULL THEN 'reconstructed' WHEN f IS NULL THEN 'reported' WHEN abs(r - f) <= 0.1 * greatest(abs(r), abs(f)) THEN 'corroborated' ELSE 'disputed' END AS state FROM o)
SELECT company, state, round(CASE WHEN state IN ('corroborated', 'reported') THEN r ELSE f END, 4) AS ffo FROM s""")
def ffo_corroboration(spark, d):
    ffo, state = blocks.corroborated_ffo()
    return model_companies(spark, d).select("company", state.alias("state"), F.round(ffo, 4).alias("ffo"))


@query("native_derivations", f"WITH {CX_SQL} SELECT company, round(coalesce(ebitda, noi / 0.8), 4) AS ebitda, round(equity - intangibles, 4) AS tangible_book, round(coalesce(ebitda, noi / 0.8) - capex, 4) AS fcf, round(cap / nullif(price, 0), 4) AS shares_back, round(debt - cash, 4) AS net_debt, round(dividends / nullif(cap, 0), 8) AS dividend_yield FROM cx")
def native_derivations(spark, d):
    """Lines a filing leaves out, from those it has: ebitda, tangible book, free cash flow, shares, net debt."""
    cap, _ = valuation.enterprise_value()
    x = model_companies(spark, d).withColumn("cap", cap)
    out = valuation.derived(x, {"ebitda": "noi / 0.8", "tangible_book": "equity - intangibles", "fcf": "ebitda - capex", "shares_back": "cap / price", "net_debt": "debt - cash", "dividend_yield": "dividends / cap"})
    return out.select("company", *[F.round(n, 4).alias(n) for n in ("ebitda", "tangible_book", "fcf", "shares_back", "net_debt")], F.round("dividend_yield", 8).alias("dividend_yield"))


@query("prospectus_stubs", "WITH y AS (SELECT o_custkey AS k, year(o_orderdate) AS fy, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS revenue, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS ebitda FROM orders GROUP BY 1, 2) SELECT fy, count(*) AS filings, count(*) FILTER (WHERE coalesce(revenue, 0) = 0 AND coalesce(ebitda, 0) = 0) AS stubs FROM y GROUP BY 1")
def prospectus_stubs(spark, d):
    o = table(spark, d, "orders")
    some = lambda w: F.sum(F.when(w, F.col("o_totalprice")))
    y = o.groupBy(F.col("o_custkey").alias("k"), F.year("o_orderdate").cast("long").alias("fy")).agg(some(F.col("o_orderstatus") == "F").alias("revenue"), some(F.col("o_orderpriority") == "1-URGENT").alias("ebitda"))
    return blocks.stubs(y, ["revenue", "ebitda"]).groupBy("fy").agg(F.count("*").alias("filings"), F.count_if("stub").alias("stubs"))


@query("stale_filings", "SELECT year(o_orderdate) AS fy, count(*) AS n, count(*) FILTER (WHERE date_diff('day', o_orderdate, l.d) > 60) AS stale FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS d FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey GROUP BY 1")
def stale_filings(spark, d):
    """Filings later than 60 days after their period end."""
    filed = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("d"))
    j = table(spark, d, "orders").join(filed, F.col("l_orderkey") == F.col("o_orderkey"))
    lag = F.date_diff(F.to_date("d"), F.to_date("o_orderdate"))
    return j.groupBy(F.year("o_orderdate").cast("long").alias("fy")).agg(F.count("*").alias("n"), F.count_if(lag > 60).alias("stale"))


RULES_SQL = CX_SQL + """, f AS (SELECT company, revenue, costs, CASE WHEN company % 7 = 0 THEN NULL ELSE revenue - costs * CASE WHEN company % 5 = 0 THEN 2 ELSE 1 END END AS gross_profit, ebitda, depreciation, ebitda - depreciation AS operating_income, net_income, debt, cash, debt - cash * CASE WHEN company % 4 = 0 THEN 9 ELSE 1 END AS net_debt, assets, assets - equity AS liabilities, equity FROM cx)"""


def statement_lines(spark, d):
    k = F.col("company")
    x = model_companies(spark, d)
    return x.select("company", "revenue", "costs", F.when(k % 7 != 0, F.col("revenue") - F.col("costs") * F.when(k % 5 == 0, 2).otherwise(1)).alias("gross_profit"), "ebitda", "depreciation", (F.col("ebitda") - F.col("depreciation")).alias("operating_income"), "net_income", "debt", "cash", (F.col("debt") - F.col("cash") * F.when(k % 4 == 0, 9).otherwise(1)).alias("net_debt"), "assets", (F.col("assets") - F.col("equity")).alias("liabilities"), "equity")


_NEAR = lambda a, b, t: f"abs({a} - ({b})) <= {t} * greatest(abs({a}), abs({b}), 1.0)"
_THIRTEEN = {"balance_sheet": _NEAR("assets", "liabilities + equity", 0.02), "gross_profit": _NEAR("gross_profit", "revenue - costs", 0.02), "ebitda": _NEAR("ebitda", "operating_income + depreciation", 0.02), "net_income_below_revenue": "abs(net_income) <= abs(revenue)", "net_debt": _NEAR("net_debt", "debt - cash", 0.02), "revenue_positive": "revenue > 0", "costs_not_negative": "costs >= 0", "operating_below_gross": "operating_income <= gross_profit", "ebitda_above_operating": "ebitda >= operating_income", "cash_within_assets": "cash <= assets", "debt_within_liabilities": "debt <= liabilities * 1.02", "equity_within_assets": "equity <= assets", "net_margin_range": "abs(net_income / nullif(revenue, 0)) <= 1"}


@query("accounting_rules", f"WITH {RULES_SQL} SELECT rule, count(*) AS judged, count(*) FILTER (WHERE ok) AS passed FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS rule, {v} AS ok FROM f" for k, v in _THIRTEEN.items()) + ") WHERE ok IS NOT NULL GROUP BY 1")
def accounting_rules(spark, d):
    """The thirteen accounting rules over every company's statement."""
    return audit.judged(statement_lines(spark, d), audit.accounting_rules(), ["company"]).groupBy("rule").agg(F.count("*").alias("judged"), F.count_if("ok").alias("passed"))


@query("reconciliation_findings", f"""WITH {RULES_SQL}, g AS (SELECT *, CASE WHEN company % 3 = 0 THEN revenue * 1.01 ELSE revenue END AS approved, CASE WHEN company % 6 = 1 THEN ebitda * 1.2 WHEN company % 6 = 2 THEN NULL ELSE ebitda * 1.01 END AS other FROM f)
SELECT company, kind, "check", severity FROM (SELECT company, 'structural' AS kind, 'gross' AS "check", 'error' AS severity, NOT ({_NEAR("gross_profit", "revenue - costs", 0.02)}) AS hit FROM g UNION ALL SELECT company, 'structural', 'net_debt', 'error', NOT ({_NEAR("net_debt", "debt - cash", 0.02)}) FROM g
UNION ALL SELECT company, 'golden', 'revenue', 'error', NOT ({_NEAR("revenue", "approved", 0.001)}) FROM g UNION ALL SELECT company, 'oracle', 'ebitda', 'warning', NOT ({_NEAR("ebitda", "other", 0.05)}) FROM g) WHERE hit""")
def reconciliation_findings(spark, d):
    k, c = F.col("company"), F.col
    x = statement_lines(spark, d).withColumns({"approved": F.when(k % 3 == 0, c("revenue") * 1.01).otherwise(c("revenue")), "other": F.when(k % 6 == 1, c("ebitda") * 1.2).when(k % 6 != 2, c("ebitda") * 1.01)})
    rules = audit.accounting_rules()
    return audit.findings(x, "company", {"gross": rules["gross_profit"], "net_debt": rules["net_debt"]}, {"revenue": (c("revenue"), c("approved"))}, {"ebitda": (c("ebitda"), c("other"))})


@query("math_audit", f"""WITH {MODEL_SQL}, m AS (SELECT company, metric, CASE WHEN metric = 'roe' AND company % 10 = 0 THEN value * 1.01 ELSE value END AS a FROM model WHERE block = 'returns'),
r AS (SELECT company, metric, v AS b FROM (SELECT company, 'roe' AS metric, net_income / nullif(equity, 0) AS v FROM cx UNION ALL SELECT company, 'roa', net_income / nullif(assets, 0) FROM cx UNION ALL SELECT company, 'roic', (ebitda - depreciation) * 0.7 / nullif(equity + debt - cash, 0) FROM cx WHERE company % 9 <> 0)),
j AS (SELECT coalesce(m.metric, r.metric) AS metric, m.company IS NULL OR r.company IS NULL AS one, a IS NOT DISTINCT FROM b OR coalesce(abs(a - b) <= 1e-6 * greatest(abs(a), abs(b), 1.0), false) AS same FROM m FULL JOIN r ON m.company = r.company AND m.metric = r.metric)
SELECT metric, count(*) AS cells, count(*) FILTER (WHERE same AND NOT one) AS agree, count(*) FILTER (WHERE NOT same AND NOT one) AS differ, count(*) FILTER (WHERE one) AS one_sided, count(*) FILTER (WHERE NOT same AND NOT one) = 0 AND count(*) FILTER (WHERE one) = 0 AS open FROM j GROUP BY 1""")
def math_audit(spark, d):
    """The returns block, with planted slips, against a recomputation that leaves some cells out."""
    x, k = model_companies(spark, d), F.col("company")
    m = blocks.build_model(x, ["returns"]).withColumn("value", F.when((F.col("metric") == "roe") & (k % 10 == 0), F.col("value") * 1.01).otherwise(F.col("value")))
    again = {"roe": F.try_divide("net_income", "equity"), "roa": F.try_divide("net_income", "assets"), "roic": F.when(k % 9 != 0, F.struct(F.try_divide((F.col("ebitda") - F.col("depreciation")) * 0.7, F.col("equity") + F.col("debt") - F.col("cash")).alias("v")))}
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), (F.struct(v.alias("v")) if n != "roic" else v).alias("cell")) for n, v in again.items()])
    r = x.select("company", F.explode(cells).alias("_c")).where("_c.cell is not null").select("company", "_c.metric", F.col("_c.cell.v").alias("value"))
    return audit.math_audit(m, r, ["company", "metric"])


@query("reporting_units", """WITH f AS (SELECT l_suppkey AS company, CASE l_linenumber % 4 WHEN 0 THEN 'MXN thousands' WHEN 1 THEN 'mxn' WHEN 2 THEN 'USD millions' ELSE 'shares' END AS unit FROM lineitem), c AS (SELECT company, regexp_extract(upper(unit), '(MXN|USD)', 1) AS currency, count(*) AS n, max(CASE WHEN unit LIKE '%thousands' THEN 1000.0 WHEN unit LIKE '%millions' THEN 1000000.0 ELSE 1.0 END) AS scale FROM f GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY company ORDER BY n DESC, currency) AS r FROM c WHERE currency <> '') SELECT company, currency, n, round(1e6 / (scale * CASE currency WHEN 'MXN' THEN 1.0 ELSE 18.0 END), 8) AS divisor FROM b WHERE r = 1""")
def reporting_units(spark, d):
    k = F.col("l_linenumber") % 4
    f = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("company"), F.when(k == 0, "MXN thousands").when(k == 1, "mxn").when(k == 2, "USD millions").otherwise("shares").alias("unit"))
    return audit.reporting_units(f, "company", "unit", {"MXN": 1.0, "USD": 18.0}).withColumn("divisor", F.round("divisor", 8))


@query("sheet_formulas", """SELECT l_orderkey, l_linenumber, round(A + B + coalesce(C, 0), 6) AS total, round((A + B + coalesce(C, 0)) / (2 + CAST(C IS NOT NULL AS INTEGER)), 6) AS mean, round(CASE WHEN B > 0.05 THEN A / nullif(B - 0.06, 0) ELSE pow(A, 2) - 1 END, 4) AS choice, CASE WHEN C >= 0.04 THEN 1.0 WHEN C < 0.04 THEN 0.0 ELSE 0.0 END AS flag, greatest(A, B, C) AS top
FROM (SELECT l_orderkey, l_linenumber, l_quantity AS A, l_discount AS B, CASE WHEN l_tax > 0.02 THEN l_tax END AS C FROM lineitem)""")
def sheet_formulas(spark, d):
    """Formulas of a sheet, each a column over the cells of its row."""
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("A"), F.col("l_discount").alias("B"), F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("C"))
    f = audit.sheet_formula
    return x.select("l_orderkey", "l_linenumber", F.round(f("=SUM(A:C)"), 6).alias("total"), F.round(f("=AVERAGE(A:C)"), 6).alias("mean"), F.round(f("=IF(B>0.05,A/(B-0.06),A^2-1)"), 4).alias("choice"), f("=IF(C>=0.04,1,0)").alias("flag"), f("=MAX(A:C)").alias("top"))


@query("answer_checks", """WITH a AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'up' WHEN 1 THEN ' Down ' WHEN 2 THEN 'flat' WHEN 3 THEN 'sideways' END AS dir, CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value / 20, 4) END AS conv FROM events),
w AS (SELECT *, CASE WHEN dir IS NULL THEN 'not readable' WHEN dir = 'sideways' THEN 'unknown direction' WHEN conv IS NULL THEN 'no conviction' WHEN conv < 0 OR conv > 1 THEN 'conviction out of range' END AS why FROM a)
SELECT coalesce(why, 'ok') AS verdict, CASE WHEN why IS NULL THEN lower(trim(dir)) ELSE 'flat' END AS direction, count(*) AS n, round(sum(CASE WHEN why IS NULL THEN conv ELSE 0 END), 4) AS conviction FROM w GROUP BY 1, 2""")
def answer_checks(spark, d):
    """Answers of a language model as JSON, some broken, each neutral unless it holds."""
    k = F.col("event_id") % 5
    direction = F.when(k == 0, "up").when(k == 1, " Down ").when(k == 2, "flat").when(k == 3, "sideways")
    conviction = F.when(F.col("event_id") % 7 != 0, F.round(F.col("value") / 20, 4))
    js = F.when(k == 4, F.lit("I think it goes up")).otherwise(F.to_json(F.struct(direction.alias("direction"), conviction.alias("conviction"), F.lit("r").alias("reason"))))
    out = audit.answer_checks(table(spark, d, "events").select("event_id", js.alias("a")), "a")
    return out.groupBy(F.coalesce("why", F.lit("ok")).alias("verdict"), "direction").agg(F.count("*").alias("n"), F.round(F.sum("conviction"), 4).alias("conviction"))

