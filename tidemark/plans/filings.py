"""Queries over XBRL instances of two layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import instances
from .base import query, table

#: Layout a names its taxonomy "mx", has dimensions in segments and contexts first; b has its own prefixes, typed dimensions in scenarios and contexts last.
_HEAD = 'xmlns:{i}="http://www.xbrl.org/2003/instance" xmlns:d="http://xbrl.org/2006/xbrldi" xmlns:{t}="http://taxonomy/{t}"'


def _instances(spark, d):
    """One instance a customer: total and per-priority order value a year, the total repeated in thousands."""
    o = table(spark, d, "orders")
    parts = o.groupBy("o_custkey", F.year("o_orderdate").alias("y"), F.substring("o_orderpriority", 1, 1).alias("p")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("v"))
    whole = parts.groupBy("o_custkey", "y").agg(F.sum("v").alias("v"))
    money = lambda c: F.format_string("%s.%02d", F.expr(f"{c} div 100"), F.expr(f"{c} % 100").cast("int"))
    odd = F.col("o_custkey") % 2 == 1
    i, t = F.when(odd, "x").otherwise("xbrli"), F.when(odd, "own").otherwise("mx")
    say = lambda pattern, *args: F.format_string(pattern, *args)
    period = say("<%s:period><%s:startDate>%s-01-01</%s:startDate><%s:endDate>%s-12-31</%s:endDate></%s:period>", i, i, F.col("y").cast("string"), i, i, F.col("y").cast("string"), i, i)
    entity = say("<%s:entity><%s:identifier scheme='s'>%s</%s:identifier>", i, i, F.col("o_custkey").cast("string"), i)
    typed = F.when(odd, say("<x:scenario><d:typedMember dimension='own:Priority'><own:p>P%s</own:p></d:typedMember></x:scenario>", F.col("p"))).otherwise("")
    explicit = F.when(~odd, say("<xbrli:segment><d:explicitMember dimension='mx:Priority'>mx:P%s</d:explicitMember></xbrli:segment>", F.col("p"))).otherwise("")
    ref = F.concat(F.lit("c"), F.col("y").cast("string"))
    context = lambda name, inner, after: say("<%s:context id='%s'>%s%s</%s:entity>%s%s</%s:context>", i, name, entity, inner, i, period, after, i)
    fact = lambda name, of, value, decimals: say("<%s:%s contextRef='%s' unitRef='u' decimals='%s'>%s</%s:%s>", t, F.lit(name), of, F.lit(decimals), value, t, F.lit(name))
    sub = F.concat(ref, F.lit("_"), F.col("p"))
    a = parts.select("o_custkey", context(sub, explicit, typed).alias("c"), fact("Revenue", sub, money("v"), "2").alias("f"))
    b = whole.select("o_custkey", context(ref, F.lit(""), F.lit("")).alias("c"), F.concat(fact("Revenue", ref, money("v"), "2"), fact("Revenue", ref, F.format_string("%d000", F.round(F.col("v") / 100000).cast("long")), "-3")).alias("f"))
    rows = a.unionByName(b).groupBy("o_custkey").agg(F.array_join(F.array_sort(F.collect_list("c")), "").alias("c"), F.array_join(F.array_sort(F.collect_list("f")), "").alias("f"))
    unit = say("<%s:unit id='u'><%s:measure>iso4217:MXN</%s:measure></%s:unit>", i, i, i, i)
    note = say("<%s:Discussion contextRef='none'>Orders of &lt;b&gt;customer&lt;/b&gt; %s &amp;amp; more</%s:Discussion>", t, F.col("o_custkey").cast("string"), t)
    head = F.when(odd, _HEAD.format(i="x", t="own")).otherwise(_HEAD.format(i="xbrli", t="mx"))
    body = F.when(odd, F.concat(unit, "f", note, "c")).otherwise(F.concat("c", unit, "f", note))
    return rows.select(F.col("o_custkey").alias("k"), say("<%s:xbrl %s>%s</%s:xbrl>", i, head, body, i).alias("xml"))


SQL = "p AS (SELECT o_custkey AS k, year(o_orderdate) AS y, substr(o_orderpriority, 1, 1) AS p, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS v FROM orders GROUP BY 1, 2, 3), w AS (SELECT k, y, CAST(sum(v) AS BIGINT) AS v FROM p GROUP BY 1, 2)"


@query("instance_facts", f"WITH {SQL}, u AS (SELECT k, y, 'P' || p AS priority, v / 100.0 AS value, 1 AS copies FROM p UNION ALL SELECT k, y, '', v / 100.0, 2 FROM w) SELECT k, 'Revenue' AS concept, 'MXN' AS unit, y || '-01-01' AS period_start, y || '-12-31' AS period_end, priority, round(value, 2) AS value, copies, false AS conflicting FROM u")
def instance_facts(spark, d):
    """Facts of both layouts, dimensions resolved; what is told twice, exactly and in thousands, is one fact."""
    found = instances.distinct_facts(instances.facts(instances.flat(_instances(spark, d), "xml", "k"), "k"), "k")
    dates = [F.col(c).cast("string").alias(c) for c in ("period_start", "period_end")]
    return found.select("k", "concept", "unit", *dates, F.coalesce(F.try_element_at("dimensions", F.lit("Priority")), F.lit("")).alias("priority"), F.round("value", 2).alias("value"), "copies", "conflicting")


@query("instance_totals", f"WITH {SQL} SELECT k, y || '-12-31' AS period_end, round(v / 100.0, 2) AS value FROM w")
def instance_totals(spark, d):
    """The consolidated fact of each concept and period: the one without dimensions."""
    found = instances.distinct_facts(instances.facts(instances.flat(_instances(spark, d), "xml", "k"), "k"), "k")
    return instances.consolidated(found, "k").select("k", F.col("period_end").cast("string").alias("period_end"), F.round("value", 2).alias("value"))


@query("instance_texts", "SELECT DISTINCT o_custkey AS k, 'Discussion' AS name, 'Orders of customer ' || o_custkey || ' & more' AS text FROM orders")
def instance_texts(spark, d):
    return instances.text_blocks(instances.flat(_instances(spark, d), "xml", "k"), ["Discussion"], "k")
