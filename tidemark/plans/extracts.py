"""Queries of extraction: statements and prose are written from orders and items, read back, and compared with the figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extraction as ex
from .base import query, table

FIG_SQL = """fg AS (SELECT l_orderkey AS k, round(sum(l_extendedprice), 2) AS sales, round(sum(l_quantity) * 10 - 600, 1) AS income, count(*) * 1000 AS assets, CASE WHEN l_orderkey % 2 = 0 THEN 1000.0 ELSE 1.0 END AS scale FROM lineitem GROUP BY l_orderkey)"""


def figures(spark, d):
    i = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"))
    return i.agg(F.round(F.sum("l_extendedprice"), 2).alias("sales"), F.round(F.sum("l_quantity") * 10 - 600, 1).alias("income"), (F.count("*") * 1000).alias("assets"))


def statements(spark, d):
    """A filing per order: scale line, two statements with header rows, negatives in brackets, other periods beside the target."""
    f = figures(spark, d)
    brackets = F.when(F.col("income") < 0, F.concat(F.lit("("), F.format_number(-F.col("income"), 1), F.lit(")"))).otherwise(F.format_number("income", 1))
    head = F.when(F.col("k") % 3 == 0, "Concept | FY2000 | 1T2001 | 2Q00").when(F.col("k") % 3 == 1, "Concept | Q1 2001 | 2000").otherwise("Concept | Dic 2000 | Mar-01")
    row = lambda label, cell: F.when(F.col("k") % 3 == 1, F.concat(F.lit(label + " | "), cell, F.lit(" | 7"))).otherwise(F.concat(F.lit(label + " | 9 | "), cell, F.when(F.col("k") % 3 == 0, " | 8").otherwise("")))
    text = F.concat_ws("\n", F.when(F.col("k") % 2 == 0, "Cifras en miles de pesos").otherwise("Figures in pesos"), F.lit("Income statement"), head, row("Net sales", F.format_number("sales", 2)), row("Utilidad de operación", brackets), F.lit("Balance sheet"), head, row("Total assets", F.col("assets").cast("string")), row("Net sales", F.lit("5")))
    return f.select("k", text.alias("text"))


METRICS = {"net_sales": r"net sales|ventas netas", "operating_income": r"operating income|utilidad de operacion", "total_assets": r"total assets|activo total"}


@query("table_metrics", f"""WITH {FIG_SQL} SELECT k, 'income' AS statement, 'net_sales' AS metric, round(sales * scale, 2) AS value FROM fg UNION ALL SELECT k, 'income', 'operating_income', round(income * scale, 2) FROM fg UNION ALL SELECT k, 'balance', 'total_assets', round(assets * scale, 2) FROM fg UNION ALL SELECT k, 'balance', 'net_sales', 5 * scale FROM fg""")
def table_metrics(spark, d):
    """Statements split into blocks, the target period's column chosen by the header, labels matched to metrics, scale applied."""
    s = statements(spark, d)
    blocks = ex.statement_blocks(ex.lines_of(s, "k", "text"), "k", {"income": "income statement|estado de resultados", "balance": "balance sheet|balance general"})
    out = ex.table_values(blocks, "k", F.lit("2001Q1"), METRICS)
    scale = s.select("k", ex.unit_scale(F.substring_index("text", "\n", 1)).alias("scale"))
    return out.join(scale, "k").select("k", "statement", "metric", F.round(F.col("value") * F.col("scale"), 2).alias("value"))


@query("statement_blocks", "WITH n AS (SELECT DISTINCT l_orderkey AS k FROM lineitem) SELECT k, 'income' AS statement, 3 AS lines FROM n UNION ALL SELECT k, 'balance', 3 FROM n")
def statement_blocks(spark, d):
    blocks = ex.statement_blocks(ex.lines_of(statements(spark, d), "k", "text"), "k", {"income": "income statement", "balance": "balance sheet"})
    return blocks.groupBy("k", "statement").agg(F.count("*").alias("lines"))


@query("header_periods", """WITH o AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS VARCHAR) AS y, quarter(o_orderdate) AS q FROM orders) SELECT k, CASE k % 6 WHEN 3 THEN y || 'FY' WHEN 5 THEN NULL ELSE y || 'Q' || q END AS period FROM o""")
def header_periods(spark, d):
    k, q, y = F.col("o_orderkey") % 6, F.quarter("o_orderdate").cast("string"), F.year("o_orderdate").cast("string")
    short = F.substring(y, 3, 2)
    month = F.element_at(F.array(F.lit("Marzo"), F.lit("Jun."), F.lit("September"), F.lit("Dic")), F.quarter("o_orderdate"))
    token = F.when(k == 0, F.concat(q, F.lit("T"), y)).when(k == 1, F.concat(F.lit("q"), q, F.lit(" "), y)).when(k == 2, F.concat(q, F.lit("Q'"), short)).when(k == 3, F.concat(F.lit("FY "), y)).when(k == 4, F.concat(month, F.lit(" "), y)).otherwise(F.concat(F.lit("Note "), y))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), ex.header_period(token).alias("period"))


@query("prose_metrics", """SELECT o_orderkey AS k, round(CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE round(o_totalprice, 2) * CASE o_orderkey % 4 WHEN 0 THEN 1000000.0 WHEN 1 THEN 1000.0 ELSE 1.0 END END, 2) AS sales, round((o_custkey % 400) / 10.0 / 100, 6) AS margin FROM orders""")
def prose_metrics(spark, d):
    """Figures and ratios found in running text by their labels."""
    k = F.col("o_orderkey") % 4
    unit = F.when(k == 0, " million").when(k == 1, " thousand pesos").otherwise(" pesos")
    said = F.when(k == 3, "Sales were in line with plans").otherwise(F.concat(F.lit("Consolidated net sales reached $"), F.format_number("o_totalprice", 2), unit))
    text = F.concat(said, F.lit("; the net interest margin stood at "), ((F.col("o_custkey") % 400) / 10.0).cast("decimal(6,1)").cast("string"), F.lit(" % in 2001."))
    x = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), text.alias("t"))
    return x.select("k", F.round(ex.prose_figure(F.col("t"), "net sales|ventas netas"), 2).alias("sales"), F.round(ex.prose_ratio(F.col("t"), "net interest margin|nim"), 6).alias("margin"))


@query("narrative_ratios", """SELECT s_suppkey AS k, CASE s_suppkey % 3 WHEN 0 THEN 'bank' WHEN 1 THEN 'trust' ELSE 'other' END AS kind, CASE WHEN s_suppkey % 3 = 0 THEN round((s_nationkey + 0.5) / 100, 6) END AS morosity, CASE WHEN s_suppkey % 3 = 0 THEN round((s_nationkey * 2 + 10) / 100.0, 6) END AS capital, CASE WHEN s_suppkey % 3 = 1 THEN round((90 + s_nationkey % 10) / 100.0, 6) END AS occupancy, CASE WHEN s_suppkey % 3 = 1 THEN round(s_acctbal, 2) * 1000000 END AS noi FROM supplier""")
def narrative_ratios(spark, d):
    """Ratios of banks and figures of property trusts from the narrative of a report."""
    k, n = F.col("s_suppkey") % 3, F.col("s_nationkey")
    bank = F.concat(F.lit("El índice de morosidad fue de "), (n + 0.5).cast("decimal(6,1)").cast("string"), F.lit("%; the capital ratio (ICAP) closed at "), (n * 2 + 10).cast("string"), F.lit(" %."))
    trust = F.concat(F.lit("Occupancy of the portfolio: "), (90 + n % 10).cast("string"), F.lit("%; NOI was "), F.format_string("%.2f", "s_acctbal"), F.lit(" millones."))
    x = table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.when(k == 0, "bank").when(k == 1, "trust").otherwise("other").alias("kind"), F.when(k == 0, bank).when(k == 1, trust).otherwise("Nothing to report.").alias("t"))
    t = F.col("t")
    return x.select("k", "kind", F.round(ex.prose_ratio(t, "morosidad|npl ratio"), 6).alias("morosity"), F.round(ex.prose_ratio(t, "capital ratio"), 6).alias("capital"), F.round(ex.prose_ratio(t, "occupancy|ocupación"), 6).alias("occupancy"), ex.prose_figure(t, "NOI").alias("noi"))


@query("company_rules", """SELECT c_nationkey AS company, c_custkey AS k, CASE c_nationkey % 3 WHEN 0 THEN 'volume' WHEN 1 THEN 'stores' ELSE 'tonnes' END AS metric, CASE c_nationkey % 3 WHEN 0 THEN (c_custkey % 900 + 100) * 1000.0 WHEN 1 THEN c_custkey % 900 + 100.0 ELSE round((c_custkey % 900 + 100) / 10.0, 1) END AS value FROM customer""")
def company_rules(spark, d):
    """Each company's own patterns, kept as rows of a table."""
    n, v = F.col("c_nationkey") % 3, F.col("c_custkey") % 900 + 100
    text = F.when(n == 0, F.concat(F.lit("Sales volume: "), v.cast("string"), F.lit(" thousand unit cases"))).when(n == 1, F.concat(F.lit("We closed with "), v.cast("string"), F.lit(" stores"))).otherwise(F.concat(F.lit("produced "), (v / 10.0).cast("decimal(8,1)").cast("string"), F.lit(" tonnes")))
    docs = table(spark, d, "customer").select(F.col("c_nationkey").alias("company"), F.col("c_custkey").alias("k"), text.alias("text"))
    m = F.col("n_nationkey") % 3
    rules = table(spark, d, "nation").select(F.col("n_nationkey").alias("company"), F.when(m == 0, "volume").when(m == 1, "stores").otherwise("tonnes").alias("metric"), F.when(m == 0, r"volume: (\d+) thousand").when(m == 1, r"with (\d+) stores").otherwise(r"produced ([\d.]+) tonnes").alias("pattern"), F.when(m == 0, 1000.0).otherwise(1.0).alias("scale"))
    return ex.company_rules(docs, "company", "text", rules)


@query("growth_orientation", """SELECT l_orderkey, l_linenumber, l_quantity AS current, round(l_quantity / (1 + 0.1 * (l_linenumber + 1)), 6) AS prior FROM lineitem""")
def growth_orientation(spark, d):
    """Two columns in unknown order, told apart by the growth stated beside them."""
    g = 0.1 * (F.col("l_linenumber") + 1)
    now, past = F.col("l_quantity"), F.col("l_quantity") / (1 + g)
    swap = F.col("l_orderkey") % 2 == 0
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(swap, past).otherwise(now).alias("a"), F.when(swap, now).otherwise(past).alias("b"), g.alias("g"))
    current, prior = ex.orient_by_growth("a", "b", "g")
    return x.select("l_orderkey", "l_linenumber", current.alias("current"), F.round(prior, 6).alias("prior"))


@query("summary_coverage", r"""WITH w AS (SELECT doc_id, string_split_regex(lower(text), '[^\p{L}\p{N}]+') AS ws, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[\p{L}\p{N}]')][1:5] AS facts, string_split_regex(lower(array_to_string(string_split(text, chr(10))[1:3], ' ')), '[^\p{L}\p{N}]+') AS sm FROM documents WHERE text IS NOT NULL),
c AS (SELECT doc_id, len(facts) AS facts, len(list_filter(facts, lambda f: len(list_filter(string_split_regex(lower(f), '[^\p{L}\p{N}]+'), lambda x: x <> '' AND NOT list_contains(sm, x))) = 0)) AS covered FROM w)
SELECT doc_id, facts, covered, round(covered / nullif(facts, 0), 8) AS coverage FROM c""")
def summary_coverage(spark, d):
    """A summary of the first lines against the first five lines as gold facts."""
    docs = table(spark, d, "documents").where("text is not null")
    lines = F.split("text", "\n", -1)
    x = docs.select("doc_id", F.array_join(F.slice(lines, 1, 3), " ").alias("summary"), F.filter(lines, lambda s: s.rlike(r"[\p{L}\p{N}]")).alias("facts"))
    return ex.coverage_of(x, "doc_id", "summary", "facts", 5).withColumn("coverage", F.round("coverage", 8))


@query("zero_shot_scorecard", """WITH x AS (SELECT l_suppkey AS company, l_returnflag AS metric, CASE WHEN l_linenumber % 6 = 0 THEN NULL ELSE l_quantity * CASE WHEN l_suppkey % 4 = 0 THEN 1.2 ELSE 1.001 END END AS got, CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_quantity END AS want FROM lineitem),
g AS (SELECT company, count(*) AS expected, count(got) AS filled, count(*) FILTER (WHERE got IS NOT NULL AND want IS NOT NULL) AS compared, count(*) FILTER (WHERE abs(got - want) <= 0.01 * greatest(abs(got), abs(want))) AS agreed FROM x WHERE metric IN ('A', 'R') GROUP BY 1)
SELECT company, expected, filled, compared, round(filled / expected, 8) AS coverage, round(agreed / nullif(compared, 0), 8) AS agreement, CASE WHEN compared = 0 THEN 'nothing compared' WHEN agreed / compared < 0.9 THEN 'disagrees' WHEN filled / expected < 0.8 THEN 'thin' ELSE 'ok' END AS flag FROM g""")
def zero_shot_scorecard(spark, d):
    q = F.col("l_quantity")
    got = F.when(F.col("l_linenumber") % 6 != 0, q * F.when(F.col("l_suppkey") % 4 == 0, 1.2).otherwise(1.001))
    x = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("company"), F.col("l_returnflag").alias("metric"), got.alias("got"), F.when(F.col("l_suppkey") % 9 != 0, q).alias("want"))
    out = ex.zero_shot_card(x, "company", "got", "want", ["A", "R"], "metric")
    return out.select("company", "expected", "filled", "compared", F.round("coverage", 8).alias("coverage"), F.round("agreement", 8).alias("agreement"), "flag")


