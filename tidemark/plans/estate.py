"""Queries of catalogs, coverage, revisions and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import periods
from ..operators import catalog
from .base import Q_SQL, quarterly, query, table


def _t(name):
    return lambda spark, d: table(spark, d, name)


events, orders, documents = _t("events"), _t("orders"), _t("documents")


@query("latest_version", "SELECT user_id, event_type, max_by(event_id, struct_pack(ts, event_id)) AS event_id, count(*) AS versions FROM events GROUP BY 1, 2")
def latest_version(spark, d):
    e = events(spark, d)
    n = e.groupBy("user_id", "event_type").agg(F.count("*").alias("versions"))
    return catalog.latest(e, ["user_id", "event_type"], F.desc("ts"), F.desc("event_id")).select("user_id", "event_type", "event_id").join(n, ["user_id", "event_type"])


@query("coverage_gaps", """WITH k AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS qi FROM orders), b AS (SELECT min(qi) AS a, max(qi) AS z FROM k), x AS (SELECT c_custkey, unnest(range(a, z + 1)) AS qi FROM customer, b)
SELECT c_custkey, count(*) AS missing, min(qi) AS first_gap FROM x WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.o_custkey = x.c_custkey AND k.qi = x.qi) GROUP BY 1""")
def coverage_gaps(spark, d):
    known = orders(spark, d).select(F.col("o_custkey").alias("c_custkey"), periods.quarter_index("o_orderdate").alias("qi")).distinct()
    ends = known.agg(F.min("qi").alias("a"), F.max("qi").alias("z"))  # one row
    expected = table(spark, d, "customer").select("c_custkey").crossJoin(F.broadcast(ends)).select("c_custkey", F.explode(F.sequence("a", "z")).alias("qi"))
    return catalog.coverage_gaps(expected, known, ["c_custkey", "qi"]).groupBy("c_custkey").agg(F.count("*").alias("missing"), F.min("qi").alias("first_gap"))


@query("coverage_by_source", """WITH k AS (SELECT o_custkey, year(o_orderdate) AS fy, min(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END) AS rank FROM orders GROUP BY 1, 2)
SELECT c_custkey, CAST(r.fy AS INTEGER) AS fy, CASE rank WHEN 1 THEN 'urgent' WHEN 2 THEN 'high' WHEN 3 THEN 'other' ELSE 'none' END AS source FROM customer CROSS JOIN range(1995, 2002) r(fy) LEFT JOIN k ON o_custkey = c_custkey AND k.fy = r.fy""")
def coverage_by_source(spark, d):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    seen = orders(spark, d).groupBy(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("fy")).agg(F.min(rank).alias("rank"))
    wanted = table(spark, d, "customer").select("c_custkey", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("fy"))
    out = wanted.join(seen, ["c_custkey", "fy"], "left")
    return out.select("c_custkey", "fy", F.when(F.col("rank") == 1, "urgent").when(F.col("rank") == 2, "high").when(F.col("rank") == 3, "other").otherwise("none").alias("source"))


@query("duplicate_content", "SELECT sha256(coalesce(text, '')) AS sha256, count(*) AS copies, min(doc_id) AS canonical, (count(*) - 1) * max(length(text)) AS waste FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_content(spark, d):
    g = catalog.content_address(documents(spark, d), "text").groupBy("sha256")
    out = g.agg(F.count("*").alias("copies"), F.min("doc_id").alias("canonical"), F.max(F.length("text")).cast("long").alias("size")).where("copies > 1")
    return out.select("sha256", "copies", "canonical", ((F.col("copies") - 1) * F.col("size")).alias("waste"))


@query("physical_waste", "SELECT l_partkey, count(DISTINCT (l_orderkey, l_suppkey)) AS inodes, max(l_quantity) AS size, (count(DISTINCT (l_orderkey, l_suppkey)) - 1) * max(l_quantity) AS waste FROM lineitem GROUP BY 1 HAVING count(DISTINCT (l_orderkey, l_suppkey)) > 1")
def physical_waste(spark, d):
    return catalog.physical_waste(table(spark, d, "lineitem"), "l_partkey", ["l_orderkey", "l_suppkey"], "l_quantity")


@query("upsert_last_wins", """WITH c AS (SELECT user_id % 500 + 1 AS c_custkey, value AS c_acctbal FROM events WHERE event_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id % 500 ORDER BY event_id DESC) = 1)
SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c) UNION ALL SELECT * FROM c""")
def upsert_last_wins(spark, d):
    changes = events(spark, d).where("event_type is not null").select((F.col("user_id") % 500 + 1).alias("c_custkey"), F.col("value").alias("c_acctbal"), "event_id")
    return catalog.upsert(table(spark, d, "customer").select("c_custkey", "c_acctbal"), changes, ["c_custkey"], "event_id")


@query("natural_key_merge", r"""WITH k AS (SELECT *, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS bare FROM documents) SELECT md5(bare) AS key, min_by(doc_id, doc_id) AS doc_id, max(n_chars) AS n_chars, count(*) AS seen FROM k GROUP BY 1""")
def natural_key_merge(spark, d):
    return catalog.merge_natural(documents(spark, d), F.md5(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")), ["doc_id"], ["n_chars"], "doc_id")


@query("delta_sink", "SELECT sha256(coalesce(text, '')) AS sha256, min(doc_id) AS doc_id FROM documents WHERE doc_id % 3 = 1 AND sha256(coalesce(text, '')) NOT IN (SELECT sha256(coalesce(text, '')) FROM documents WHERE doc_id % 3 <> 1) GROUP BY 1")
def delta_sink(spark, d):
    """Content of one batch that the store lacks, once per address."""
    docs = documents(spark, d).select("doc_id", "text")
    stored = catalog.content_address(docs.where("doc_id % 3 <> 1"), "text").select("sha256")
    return catalog.store_new(stored, docs.where("doc_id % 3 = 1"), "text").select("sha256", "doc_id")


@query("manifest_checksum", "WITH h AS (SELECT CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS h FROM documents) SELECT count(*) AS rows, bit_xor(h) AS xor, CAST(sum(h % 2147483648) AS BIGINT) AS total FROM h")
def manifest_checksum(spark, d):
    return catalog.checksum(documents(spark, d), "doc_id", "text")


@query("facets", "SELECT source AS company, list_sort(list_distinct(list(lang))) AS langs, count(DISTINCT doc_id % 12) AS periods, count(*) AS n FROM documents GROUP BY 1".replace("list_sort(list_distinct(list(lang)))", "array_to_string(list_sort(list_distinct(list(lang))), ',')"))
def facets(spark, d):
    return documents(spark, d).groupBy(F.col("source").alias("company")).agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"), F.count_distinct(F.col("doc_id") % 12).alias("periods"), F.count("*").alias("n"))


@query("company_profile", """WITH s AS (SELECT source, count(*) AS documents, count(*) FILTER (WHERE lang = 'en') AS english, count(*) FILTER (WHERE n_chars > 5000) AS long, max(doc_id) AS newest FROM documents GROUP BY 1)
SELECT source, documents, english, long, newest, round(english / documents, 8) AS ratio, english >= 0.6 * documents AS met FROM s""")
def company_profile(spark, d):
    n = lambda c: F.count(F.when(c, 1))
    s = documents(spark, d).groupBy("source").agg(F.count("*").alias("documents"), n(F.col("lang") == "en").alias("english"), n(F.col("n_chars") > 5000).alias("long"), F.max("doc_id").alias("newest"))
    return s.withColumns({"ratio": F.round(F.col("english") / F.col("documents"), 8), "met": F.col("english") >= 0.6 * F.col("documents")})


@query("memberships", "SELECT c_mktsegment AS company, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS nations FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def memberships(spark, d):
    j = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy(F.col("c_mktsegment").alias("company")).agg(F.array_join(F.array_sort(F.collect_set("n_name")), ",").alias("nations"))


@query("filtered_search", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31' AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')")
def filtered_search(spark, d):
    o = orders(spark, d).where(F.col("o_orderstatus").isin("F", "O") & F.col("o_orderdate").between(F.lit("1996-01-01").cast("timestamp_ntz"), F.lit("1996-12-31").cast("timestamp_ntz")))
    return o.join(table(spark, d, "customer").where("c_mktsegment = 'BUILDING'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")


@query("missing_embeddings", "SELECT doc_id FROM documents LEFT JOIN embeddings ON doc_id = vec_id WHERE vec_id IS NULL")
def missing_embeddings(spark, d):
    return documents(spark, d).join(table(spark, d, "embeddings"), F.col("doc_id") == F.col("vec_id"), "left_anti").select("doc_id")


@query("freshness", "SELECT event_type, max(ts) AS last, max(ts) >= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS fresh FROM events GROUP BY 1".replace("max(ts) AS last", "strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last"))
def freshness(spark, d):
    e = events(spark, d)
    now = e.agg(F.max("ts").alias("now"))  # one row
    out = e.groupBy("event_type").agg(F.max("ts").alias("last")).crossJoin(F.broadcast(now))
    return out.select("event_type", F.date_format("last", "yyyy-MM-dd HH:mm:ss").alias("last"), (F.col("last") >= F.col("now") - F.expr("INTERVAL 1 HOUR")).alias("fresh"))


@query("round_robin", "WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS turn FROM documents) SELECT source, doc_id, turn FROM r ORDER BY turn, source LIMIT 50")
def round_robin(spark, d):
    return catalog.round_robin(documents(spark, d).select("source", "doc_id"), "source", [F.desc("doc_id")], 50).withColumn("turn", F.col("turn").cast("long"))


@query("stratified_sample", "SELECT source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY md5('5:' || CAST(doc_id AS VARCHAR)), doc_id) <= 4")
def stratified_sample(spark, d):
    return catalog.stratified(documents(spark, d).select("source", "doc_id"), "source", "doc_id", 4, 5)


@query("precedence_merge", "SELECT o_custkey, min_by(o_orderkey, struct_pack(k := CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, p := o_orderpriority, o := o_orderkey)) AS o_orderkey FROM orders GROUP BY 1")
def precedence_merge(spark, d):
    o = orders(spark, d)
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    return catalog.latest(o.withColumn("k", rank), ["o_custkey"], F.col("k"), F.col("o_orderpriority"), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query("artifact_diff", """WITH a AS (SELECT p_partkey, p_size FROM part WHERE p_partkey % 7 <> 0), b AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_size + 1 ELSE p_size END AS p_size FROM part WHERE p_partkey % 11 <> 0)
SELECT CASE WHEN a.p_partkey IS NULL THEN 'added' WHEN b.p_partkey IS NULL THEN 'removed' WHEN a.p_size IS NOT DISTINCT FROM b.p_size THEN 'same' ELSE 'changed' END AS status, count(*) AS n FROM a FULL JOIN b USING (p_partkey) GROUP BY 1""")
def artifact_diff(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_size")
    new = p.where("p_partkey % 11 <> 0").withColumn("p_size", F.when(F.col("p_partkey") % 5 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return catalog.compare(p.where("p_partkey % 7 <> 0"), new, ["p_partkey"], ["p_size"]).groupBy("status").agg(F.count("*").alias("n"))


@query("set_operations", "SELECT 'union' AS op, count(*) AS n FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'intersect', count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) UNION ALL SELECT 'except', count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT l_suppkey FROM lineitem)")
def set_operations(spark, d):
    c, s = table(spark, d, "customer").select("c_nationkey"), table(spark, d, "supplier").select("s_nationkey")
    one = lambda df, name: df.agg(F.lit(name).alias("op"), F.count("*").alias("n"))
    return one(c.union(s).distinct(), "union").union(one(c.intersect(s), "intersect")).union(one(orders(spark, d).select("o_custkey").subtract(table(spark, d, "lineitem").select("l_suppkey")), "except"))


@query("json_props_extract", "SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n, round(sum(value), 4) AS v FROM events GROUP BY 1, 2")
def json_props_extract(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    return events(spark, d).groupBy("event_type", k.alias("k")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("v"))


@query("first_and_revised", """WITH o AS (SELECT user_id % 50 AS series, CAST(ts AS DATE) AS period, ts, event_id, round(value) AS v FROM events), c AS (SELECT *, lag(v) OVER w AS p, row_number() OVER w AS r FROM o WINDOW w AS (PARTITION BY series, period ORDER BY ts, event_id))
SELECT series, CAST(period AS VARCHAR) AS period, arg_min(v, struct_pack(ts, event_id)) AS first, arg_max(v, struct_pack(ts, event_id)) AS current, CAST(sum(CASE WHEN r > 1 AND v IS DISTINCT FROM p THEN 1 ELSE 0 END) AS BIGINT) AS revisions FROM c GROUP BY 1, 2""")
def first_and_revised(spark, d):
    o = events(spark, d).select((F.col("user_id") % 50).alias("series"), F.to_date("ts").cast("string").alias("period"), "ts", "event_id", F.round("value").alias("v"))
    return catalog.reduce_observations(o, ["series"], "period", "ts", "event_id", "v")


@query("restated_priors", f"WITH {Q_SQL}, x AS (SELECT slug, qi, revenue, lag(revenue, 4) OVER (PARTITION BY slug ORDER BY qi) * 1.01 AS prior FROM q) SELECT a.slug, a.qi, round(coalesce(b.prior, a.revenue), 2) AS restated FROM x a LEFT JOIN x b ON a.slug = b.slug AND b.qi = a.qi + 4")
def restated_priors(spark, d):
    prior = F.lag("revenue", 4).over(Window.partitionBy("slug").orderBy("qi")) * 1.01
    x = quarterly(spark, d).select("slug", "qi", "revenue", prior.alias("prior"))
    return catalog.promote_comparatives(x, ["slug"], "qi", "revenue", "prior").select("slug", "qi", F.round("restated", 2).alias("restated"))


@query("pick_facts", "WITH f AS (SELECT l_partkey AS concept, CAST(l_shipdate AS DATE) AS e, CAST(l_shipdate AS DATE) - CAST(l_quantity * 3 AS INTEGER) AS s, l_linenumber AS dims, l_orderkey FROM lineitem) SELECT concept, min(struct_pack(dims, days := CAST(e - s AS INTEGER), s := s)).days AS days FROM f WHERE e - s <= 100 GROUP BY 1")
def pick_facts(spark, d):
    f = table(spark, d, "lineitem").select(F.col("l_partkey").alias("concept"), F.to_date("l_shipdate").alias("e"), F.col("l_linenumber").alias("dims"), (F.col("l_quantity") * 3).cast("int").alias("n"))
    f = f.withColumn("s", F.date_sub("e", F.col("n")))
    return catalog.pick_fact(f, ["concept"], "e", "s", "dims").select("concept", F.date_diff("e", "s").alias("days"))


@query("prior_year_facts", """WITH f AS (SELECT n_name AS slug, CAST(date_trunc('month', o_orderdate) AS DATE) AS e, sum(o_totalprice) AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
j AS (SELECT a.slug, a.e, a.value, b.value AS prior, abs(date_diff('day', CAST(a.e - INTERVAL 12 MONTH AS DATE), b.e)) AS gap, b.e AS pe FROM f a JOIN f b ON a.slug = b.slug WHERE abs(date_diff('day', CAST(a.e - INTERVAL 12 MONTH AS DATE), b.e)) <= 45)
SELECT slug, CAST(e AS VARCHAR) AS e, round(prior, 2) AS prior FROM j QUALIFY row_number() OVER (PARTITION BY slug, e ORDER BY gap, pe) = 1""")
def prior_year_facts(spark, d):
    j = orders(spark, d).join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    f = j.groupBy(F.col("n_name").alias("slug"), F.trunc("o_orderdate", "month").alias("e")).agg(F.sum("o_totalprice").alias("value")).withColumn("span", F.lit(30))
    return catalog.prior_fact(f, f, ["slug"], "e", "span").select("slug", F.col("e").cast("string").alias("e"), F.round("prior", 2).alias("prior"))


@query("sequence_compare", "SELECT count(*) AS orders, count(*) FILTER (WHERE len(list_filter(['A','N','R'], lambda x: NOT list_contains(f, x))) > 0) AS incomplete FROM (SELECT l_orderkey, list(DISTINCT l_returnflag) AS f FROM lineitem GROUP BY 1)")
def sequence_compare(spark, d):
    f = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("f"))
    r = f.select(catalog.sequence_difference(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.array_sort("f")).alias("r"))
    return r.agg(F.count("*").alias("orders"), F.count(F.when(F.size("r.missing") > 0, 1)).alias("incomplete"))


@query("multi_key_topn", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) <= 3")
def multi_key_topn(spark, d):
    return catalog.latest_k(orders(spark, d), ["o_custkey"], 3, F.col("o_orderpriority"), F.desc("o_totalprice"), F.col("o_orderkey")).select("o_custkey", "o_orderkey", "o_totalprice")


@query("percentiles", "SELECT event_type, round(quantile_cont(value, 0.5), 8) AS p50, round(quantile_cont(value, 0.9), 8) AS p90, round(quantile_disc(value, 0.9), 8) AS d90 FROM events GROUP BY 1")
def percentiles(spark, d):
    return events(spark, d).groupBy("event_type").agg(F.round(F.expr("percentile(value, 0.5)"), 8).alias("p50"), F.round(F.expr("percentile(value, 0.9)"), 8).alias("p90"), F.round(F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY value)"), 8).alias("d90"))


@query("period_labels", "SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) || '-' || CAST(quarter(o_orderdate) AS VARCHAR) || 'T' AS label, CAST(last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) AS VARCHAR) AS ends, CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(quarter(o_orderdate) AS VARCHAR) || 'T' AS prior, last_day(make_date(year(o_orderdate), quarter(o_orderdate) * 3, 1)) + 45 <= DATE '2000-01-01' AS due FROM orders")
def period_labels(spark, d):
    q = orders(spark, d).select(periods.quarter_index("o_orderdate").alias("qi")).distinct()
    label = periods.index_label("qi")
    return q.select(periods.parse_period(F.concat(F.lit("report "), F.substring(label, 6, 1), F.lit("T"), F.substring(label, 3, 2), F.lit(" final"))).alias("_p"), label.alias("label"), periods.quarter_end("qi").cast("string").alias("ends"), periods.shift_label(label, -1).alias("prior"), periods.due("qi", F.lit("2000-01-01").cast("date"), 45).alias("due")).drop("_p")
