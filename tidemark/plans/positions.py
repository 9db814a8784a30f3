"""Queries of tables that are known only by where their words stand."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import wordtables
from .base import query, table

PAGE = ["segment", "nation"]


def _printed(spark, d):
    """One page a market segment and nation: order value by priority and year, in units or thousands, slanted, columns jittered."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    facts = o.groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), F.regexp_replace("o_orderpriority", "[0-9]-", "Class ").alias("label"), F.year("o_orderdate").alias("year"))
    facts = facts.agg(F.round(F.sum("o_totalprice")).cast("long").alias("total"))
    row = F.ascii(F.substring("label", 7, 1)) * 9
    column = F.col("year") - 1990
    jitter = lambda n: F.pmod(F.xxhash64("segment", "nation", "label", "year"), F.lit(n))
    thousands = F.col("nation") % 2 == 0
    shown = F.when(thousands, F.round(F.col("total") / 1000).cast("long")).otherwise(F.col("total")).cast("string")
    place = column * 70 + 150 + jitter(9) - 4
    word = lambda text, x, wide, top: F.struct(text.alias("text"), x.cast("double").alias("x0"), (x + wide).cast("double").alias("x1"), top.cast("double").alias("top"))
    figures = facts.where("total > 1000").select(*PAGE, word(shown, place, F.lit(30), row + column * 0.2).alias("w"))
    labels = facts.select(*PAGE, "label").distinct().select(*PAGE, F.explode(F.array(word(F.lit("Class"), F.lit(10), F.lit(25), row), word(F.substring_index("label", " ", -1), F.lit(38), F.lit(40), row))).alias("w"))
    years = facts.select(*PAGE, "year").distinct().select(*PAGE, "year", (column * 70 + 150).alias("x"))
    top = F.when(F.col("nation") % 3 == 0, F.lit(110)).otherwise(F.lit(100))
    heads = years.select(*PAGE, F.explode(F.array(word(F.lit("4Q"), F.col("x"), F.lit(12), F.lit(100)), word(F.col("year").cast("string"), F.col("x") + F.when(top > 100, 0).otherwise(16), F.lit(20), top))).alias("w"))
    return figures.unionByName(labels).unionByName(heads).select(*PAGE, "w.*"), facts


def _read(spark, d):
    words, facts = _printed(spark, d)
    lined = wordtables.lines(words, PAGE)
    head = wordtables.headers(wordtables.cells(lined, PAGE), PAGE)
    return wordtables.rows(lined, head, PAGE).withColumn("value", wordtables.value(F.col("figure"))), facts


FACTS_SQL = """f AS (SELECT c_mktsegment AS segment, c_nationkey AS nation, regexp_replace(o_orderpriority, '[0-9]-', 'Class ') AS label, year(o_orderdate) AS y, CAST(round(sum(o_totalprice)) AS BIGINT) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4),
p AS (SELECT segment, nation FROM f GROUP BY 1, 2 HAVING count(DISTINCT y) >= 2),
t AS (SELECT segment, nation, 'Class ' || split_part(label, ' ', -1) AS label, y || 'Q4' AS period, total, CASE WHEN nation % 2 = 0 THEN CAST(round(total / 1000.0) AS BIGINT) ELSE total END AS shown FROM f SEMI JOIN p USING (segment, nation) WHERE total > 1000)"""


@query("word_tables", f"WITH {FACTS_SQL} SELECT segment, nation, label, period, CAST(shown AS DOUBLE) AS value FROM t")
def word_tables(spark, d):
    """Rows, columns and figures recovered from word positions alone; headers of one line or of two."""
    return _read(spark, d)[0].where("period is not null").select(*PAGE, "label", "period", "value")


@query("word_table_scales", f"""WITH {FACTS_SQL} SELECT segment, nation, CASE WHEN nation % 2 = 0 AND count(*) >= 2 THEN 1000.0 ELSE 1.0 END AS scale, CASE WHEN nation % 2 = 0 AND count(*) < 2 THEN 0 ELSE count(*) END AS agreeing FROM t GROUP BY 1, 2""")
def word_table_scales(spark, d):
    """The unit each page was printed in, by a vote of its figures against the known values of the page's own segment and nation."""
    read, facts = _read(spark, d)
    own = lambda label: F.concat_ws("|", "segment", "nation", label)
    name = F.concat(F.lit("Class "), F.substring_index("label", " ", -1))
    known = facts.select(own(name).alias("label"), F.concat(F.col("year").cast("string"), F.lit("Q4")).alias("period"), F.col("total").cast("double").alias("value"))
    shown = read.where("period is not null").withColumn("label", own(F.col("label")))
    return wordtables.scales(shown, known, PAGE).select(*PAGE, "scale", "agreeing")
