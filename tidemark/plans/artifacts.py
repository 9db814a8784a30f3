"""Queries of artifacts, links, citations, redaction and published versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import safe_div
from ..operators import catalog, search
from ..sources import bundles, readers
from .base import query, table
from .delivery import shared_folder
from .retrieval import W_SQL

ASKING = ("what", "which", "how", "the", "of", "and", "der", "die", "le", "la", "de", "que", "y", "el")
_IN = ", ".join(f"'{w}'" for w in ASKING)


@query("key_phrases", rf"""SELECT conv_id, turn, array_to_string(list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '' AND x NOT IN ({_IN}))[1:4], ' ') AS phrase FROM conversations WHERE role = 'user' AND text IS NOT NULL""")
def key_phrases(spark, d):
    """What a question is about in four words at most, in its own order."""
    kept = F.filter(tx.words("text"), lambda w: ~w.isin(list(ASKING)))
    return table(spark, d, "conversations").where("role = 'user' and text is not null").select("conv_id", "turn", F.array_join(F.slice(kept, 1, 4), " ").alias("phrase"))


@query("citation_segments", r"""WITH s AS (SELECT conv_id, turn, string_split_regex(replace(replace(text, '. ', ' [1] '), ', ', ' [22] '), '\[[0-9]+\]') AS p FROM conversations WHERE text IS NOT NULL) SELECT conv_id, turn, len(p) - 1 AS cited, len(list_filter(p, lambda x: trim(x, chr(10) || chr(9) || ' ') <> '')) AS segments, CAST(list_max(list_transform(p, lambda x: length(x))) AS BIGINT) AS longest FROM s""")
def citation_segments(spark, d):
    """An answer cut at its citation markers (written into the turns' texts here)."""
    marked = F.replace(F.replace("text", F.lit(". "), F.lit(" [1] ")), F.lit(", "), F.lit(" [22] "))
    t = table(spark, d, "conversations").where("text is not null").select("conv_id", "turn", F.split(marked, r"\[[0-9]+\]", -1).alias("p"))
    return t.select("conv_id", "turn", (F.size("p") - 1).cast("long").alias("cited"), F.size(F.filter("p", lambda x: F.trim(F.translate(x, "\n\t", "  ")) != "")).cast("long").alias("segments"), F.array_max(F.transform("p", F.length)).cast("long").alias("longest"))


@query("link_classes", r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\s+href="([^"]*)"', 1)) AS href FROM pages) SELECT page_id, CASE WHEN regexp_matches(lower(href), 'qu|trim') THEN 'quarterly' WHEN regexp_matches(lower(href), 'an|year') THEN 'annual' ELSE 'other' END AS kind, count(*) AS n FROM l GROUP BY 1, 2""")
def link_classes(spark, d):
    """Every link of a page by the kind of report it names."""
    links = table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<a\s+href="([^"]*)"'), F.lit(1))).alias("href"))
    return links.groupBy("page_id", tx.first_rule("href", {"quarterly": ("qu", "trim"), "annual": ("an", "year")}, "other").alias("kind")).agg(F.count("*").alias("n"))


@query("redacted_pages", r"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:nav|footer|script|style)\b.*?</(?:nav|footer|script|style)>', '', 'g'), '(?is)<div class="ad">.*?</div>', '', 'g'), '(?s)<[^>]*>', ' ', 'g')) AS redacted FROM pages""")
def redacted_pages(spark, d):
    """Pages of a provider without its menus, footers, scripts and adverts."""
    return table(spark, d, "pages").select("page_id", F.md5(tx.redact_html("html")).alias("redacted"))


@query("documents_without_boilerplate", f"""WITH {W_SQL}, r AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 7], ' ') AS s FROM w, range(1, 60000) t(i) WHERE i <= len(ws) - 7), c AS (SELECT s FROM r GROUP BY s HAVING count(*) >= 10),
b AS (SELECT doc_id FROM r LEFT JOIN c USING (s) GROUP BY doc_id HAVING count(c.s) >= 0.5 * count(*)) SELECT source, count(*) AS kept FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM b) GROUP BY 1""")
def documents_without_boilerplate(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", "source")
    bad = search.boilerplate(docs, "doc_id", "text").where("boilerplate").select(F.col("id").alias("doc_id"))
    return docs.join(bad, "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("kept"))


@query("fact_comparatives", """WITH f AS (SELECT o_custkey % 50 AS concept, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS e, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2) SELECT a.concept, CAST(a.e AS VARCHAR) AS e, round(a.value, 2) AS value, round(b.value, 2) AS prior, round(a.value / nullif(b.value, 0) - 1, 8) AS change FROM f a JOIN f b ON a.concept = b.concept AND b.e = CAST(a.e - INTERVAL 12 MONTH AS DATE)""")
def fact_comparatives(spark, d):
    """Facts with their own comparative of a year before, as observations of both periods would give."""
    f = table(spark, d, "orders").groupBy((F.col("o_custkey") % 50).alias("concept"), F.trunc("o_orderdate", "quarter").alias("e")).agg(F.sum("o_totalprice").alias("value")).withColumn("span", F.lit(90))
    out = catalog.prior_fact(f, f, ["concept"], "e", "span", tolerance=10)
    return out.select("concept", F.col("e").cast("string").alias("e"), F.round("value", 2).alias("value"), F.round("prior", 2).alias("prior"), F.round(safe_div("value", "prior") - 1, 8).alias("change"))


@query("report_rows", "SELECT n_nationkey, '<tr><td>' || n_name || ' &lt;&amp;&gt;</td><td>' || CAST(n_regionkey AS VARCHAR) || '</td><td></td></tr>' AS html FROM nation")
def report_rows(spark, d):
    """Rows of a report emitted as HTML."""
    n = table(spark, d, "nation").select("n_nationkey", F.concat("n_name", F.lit(" <&>")).alias("name"), "n_regionkey", F.lit(None).cast("string").alias("none"))
    return n.select("n_nationkey", bundles.html_row("name", "n_regionkey", "none").alias("html"))


@query("fact_files", """WITH f AS (SELECT c_mktsegment AS slug, CAST(year(o_orderdate) AS VARCHAR) AS period, CASE o_orderpriority WHEN '1-URGENT' THEN 'filed' WHEN '5-LOW' THEN 'archive' ELSE 'news' END AS source, o_totalprice AS v FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT (o_orderpriority = '1-URGENT' AND year(o_orderdate) > 1998)), g AS (SELECT slug, period, source, round(max(v), 2) AS v FROM f GROUP BY 1, 2, 3)
SELECT slug, period, min_by(source, CASE source WHEN 'filed' THEN 0 WHEN 'archive' THEN 1 ELSE 2 END) AS source, min_by(v, CASE source WHEN 'filed' THEN 0 WHEN 'archive' THEN 1 ELSE 2 END) AS value FROM g GROUP BY 1, 2""")
def fact_files(spark, d):
    """Fact files of several folders under a glob: for each company and period the folder with the best priority wins."""
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).where("not (o_orderpriority = '1-URGENT' and year(o_orderdate) > 1998)")
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "filed").when(F.col("o_orderpriority") == "5-LOW", "archive").otherwise("news")
    at = shared_folder(spark, "facts")
    g = j.groupBy(source.alias("source"), F.col("c_mktsegment").alias("slug"), F.year("o_orderdate").alias("period")).agg(F.round(F.max("o_totalprice"), 2).alias("v"))
    g.select("source", "slug", "period", F.col("v").cast("string").alias("value")).repartition("slug").write.partitionBy("source", "slug", "period").text(at)
    out = readers.json_facts(spark, f"{at}/*/*/*/*.txt", r"source=([^/]+)/slug=([^/]+)/period=([^/]+)/", {"filed": 0, "archive": 1, "news": 2})
    return out.select("slug", "period", "source", F.trim(F.translate("value", "\n", "")).cast("double").alias("value"))


@query("published_versions", "SELECT count(*) AS n, round(sum(s_acctbal) * 2, 2) AS total, 'v2' AS model FROM supplier")
def published_versions(spark, d):
    """A table published under one signature and migrated to another: readers of the pointer get the second whole."""
    at = shared_folder(spark, "published")
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    bundles.publish(s.withColumn("model", F.lit("v1")), at, "v1")
    bundles.publish(bundles.current(spark, at).withColumns({"s_acctbal": F.col("s_acctbal") * 2, "model": F.lit("v2")}), at, "v2")
    return bundles.current(spark, at).agg(F.count("*").alias("n"), F.round(F.sum("s_acctbal"), 2).alias("total"), F.max("model").alias("model"))


@query("xbrl_facts", "SELECT o_orderkey AS k, 'Revenue' AS concept, o_totalprice AS value, CAST(CAST(o_orderdate AS DATE) - 90 AS VARCHAR) AS period_start, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period_end, NULL AS instant FROM orders UNION ALL SELECT o_orderkey, 'Assets', o_totalprice * 2, NULL, NULL, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders")
def xbrl_facts(spark, d):
    """Facts of XBRL instances with the dates of the contexts they refer to."""
    facts, _ = bundles.xbrl(_instances(spark, d), "xml", "k")
    return facts.select("k", "concept", "value", *[F.col(c).cast("string").alias(c) for c in ("period_start", "period_end", "instant")])


@query("xbrl_notes", "SELECT o_orderkey AS k, 'ManagementDiscussion' AS name, 'Orders of customer ' || CAST(o_custkey AS VARCHAR) || ' & more.' AS text FROM orders")
def xbrl_notes(spark, d):
    return bundles.xbrl(_instances(spark, d), "xml", "k")[1]


def _instances(spark, d):
    o, day = table(spark, d, "orders"), F.to_date("o_orderdate")
    xml = F.format_string(
        '<xbrl><context id="a"><period><startDate>%s</startDate><endDate>%s</endDate></period></context><context id="b"><period><instant>%s</instant></period></context><fact name="Revenue" contextRef="a" unitRef="MXN">%s</fact><fact name="Assets" contextRef="b" unitRef="MXN">%s</fact><note name="ManagementDiscussion"> Orders of customer %s &amp; more. </note></xbrl>',
        F.date_sub(day, 90).cast("string"), day.cast("string"), day.cast("string"), F.col("o_totalprice").cast("string"), (F.col("o_totalprice") * 2).cast("string"), F.col("o_custkey").cast("string"),
    )
    return o.select(F.col("o_orderkey").alias("k"), xml.alias("xml"))


@query("section_metrics", r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL), s AS (SELECT *, sum(CAST(length(trim(line)) BETWEEN 3 AND 40 AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM l),
m AS (SELECT doc_id, section, i, CASE WHEN regexp_matches(line, '[0-9]{4,}') THEN 'long' WHEN regexp_matches(line, '[0-9]') THEN 'short' END AS metric FROM s) SELECT doc_id, CAST(section AS BIGINT) AS section, metric, min(i) - 1 AS line FROM m WHERE metric IS NOT NULL AND section <= 2 GROUP BY 1, 2, 3""")
def section_metrics(spark, d):
    """Patterns in their order, the first that matches a line wins, looked for in the first sections only; the first line of each counts."""
    from pyspark.sql import Window

    lines = table(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    w = Window.partitionBy("doc_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    s = lines.withColumn("section", F.sum(F.length(F.trim("line")).between(3, 40).cast("long")).over(w))
    m = s.withColumn("metric", F.when(F.col("line").rlike("[0-9]{4,}"), "long").when(F.col("line").rlike("[0-9]"), "short")).where("metric is not null and section <= 2")
    return m.groupBy("doc_id", "section", "metric").agg(F.min("i").cast("long").alias("line"))


@query("document_titles", r"""WITH l AS (SELECT doc_id, source, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS ls FROM documents WHERE text IS NOT NULL) SELECT doc_id, source AS company, substr(trim(coalesce(ls[1], '')), 1, 80) AS title, coalesce(nullif(regexp_extract(coalesce(array_to_string(ls, ' '), ''), '\b((?:19|20)[0-9]{2})\b', 1), ''), 'none') AS period FROM l""")
def document_titles(spark, d):
    """Title, company and period of a document from its first line, its source and the first year it names."""
    docs = table(spark, d, "documents").where("text is not null")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")
    year = F.regexp_extract(F.array_join(lines, " "), r"(?<![A-Za-z0-9_])((?:19|20)[0-9]{2})(?![A-Za-z0-9_])", 1)
    return docs.select("doc_id", F.col("source").alias("company"), F.substring(F.trim(F.coalesce(F.get(lines, F.lit(0)), F.lit(""))), 1, 80).alias("title"), F.coalesce(F.nullif(year, F.lit("")), F.lit("none")).alias("period"))


