"""Queries of batch claims, leases, projections, files, bundles and other sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import bundles, readers
from ..streaming import outbox
from .base import query, table
from .delivery import ATTEMPTS, _states, shared_folder

READY_SQL = "rd AS (SELECT event_id, event_type, user_id % 3 AS priority, user_id % 40 AS consumer_id, ts AS available_at FROM events)"


def _ready(spark, d):
    return table(spark, d, "events").select("event_id", "event_type", (F.col("user_id") % 3).alias("priority"), (F.col("user_id") % 40).alias("consumer_id"), F.col("ts").alias("available_at"))


@query("batch_claims", f"""WITH {READY_SQL}, f AS (SELECT consumer_id, event_id, event_type, priority FROM (SELECT *, row_number() OVER (PARTITION BY consumer_id ORDER BY priority DESC, available_at, event_id) AS r FROM rd) WHERE r = 1),
m AS (SELECT rd.consumer_id, rd.event_id, row_number() OVER (PARTITION BY rd.consumer_id ORDER BY available_at, rd.event_id) AS place FROM rd JOIN f ON rd.consumer_id = f.consumer_id AND rd.event_type = f.event_type AND rd.priority = f.priority AND rd.event_id <> f.event_id)
SELECT consumer_id, event_id, 0 AS place FROM f UNION ALL SELECT * FROM m WHERE place <= 5""")
def batch_claims(spark, d):
    """Each consumer's next delivery with up to five more like it."""
    from ..operators.catalog import latest

    ready = _ready(spark, d)
    first = latest(ready, ["consumer_id"], F.desc("priority"), F.col("available_at"), F.col("event_id"))
    return outbox.claim_batch(ready, first, 5).withColumn("place", F.col("place").cast("long"))


@query("dead_letter_requeue", f"WITH {ATTEMPTS} SELECT event_id, consumer_id, CASE WHEN status = 'dead' AND consumer_id = 'click' THEN 'pending' ELSE status END AS status, CASE WHEN status = 'dead' AND consumer_id = 'click' THEN 0 ELSE attempts END AS attempts, CASE WHEN status = 'dead' AND consumer_id = 'click' THEN 1 ELSE 0 END AS replay FROM s")
def dead_letter_requeue(spark, d):
    out = outbox.requeue(_states(spark, d).withColumn("replay", F.lit(0)), "click")
    return out.select("event_id", "consumer_id", "status", "attempts", "replay")


@query("lease_renewal", """SELECT user_id, owner, strftime(CASE WHEN owner = 'a' AND lu > TIMESTAMP '2024-01-20 00:00:00' THEN TIMESTAMP '2024-01-20 00:00:00' + INTERVAL 90 SECOND ELSE lu END, '%Y-%m-%d %H:%M:%S') AS lease_until FROM (SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS owner, max(ts) FILTER (WHERE event_id % 3 = 0) AS lu FROM events GROUP BY 1)""")
def lease_renewal(spark, d):
    x = table(spark, d, "events").groupBy("user_id").agg(F.max(F.when(F.col("event_id") % 3 == 0, F.col("ts"))).alias("lease_until")).withColumn("owner", F.when(F.col("user_id") % 2 == 0, "a").otherwise("b"))
    out = outbox.renewed(x, "a", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"), 90)
    return out.select("user_id", "owner", F.date_format("lease_until", "yyyy-MM-dd HH:mm:ss").alias("lease_until"))


@query("singleton_leases", """WITH RECURSIVE q AS (SELECT DISTINCT event_type AS lease, epoch_us(ts) AS t FROM events), g AS (SELECT lease, min(t) AS t FROM q GROUP BY 1 UNION ALL SELECT g.lease, (SELECT min(q.t) FROM q WHERE q.lease = g.lease AND q.t >= g.t + 7200000000) FROM g WHERE g.t IS NOT NULL)
SELECT event_type AS lease, count(*) AS requests, count(*) FILTER (WHERE g.t IS NOT NULL) AS granted FROM events e LEFT JOIN (SELECT * FROM g WHERE t IS NOT NULL) g ON g.lease = e.event_type AND g.t = epoch_us(e.ts) GROUP BY 1""")
def singleton_leases(spark, d):
    """Requests to run, two hours a lease, one run at a time."""
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("lease"), "ts")
    return outbox.singleton_runs(e, "lease", "ts", 7200).groupBy("lease").agg(F.count("*").alias("requests"), F.count_if("granted").alias("granted"))


PROJ_SQL = """src AS (SELECT user_id, max_by(value, event_id) AS value, count(*) AS events, max(event_id) AS version FROM events GROUP BY 1),
old AS (SELECT user_id, max_by(value, event_id) AS value, max(event_id) AS version FROM events WHERE event_id % 50 <> 0 AND user_id % 11 <> 0 GROUP BY 1)"""


def _projections(spark, d):
    e = table(spark, d, "events")
    return outbox.project(e, "user_id", "event_id", ["value"]), outbox.project(e.where("event_id % 50 <> 0 and user_id % 11 <> 0"), "user_id", "event_id", ["value"])


@query("projection_reconcile", f"WITH {PROJ_SQL} SELECT user_id, CASE WHEN old.version IS NULL THEN 'missing' ELSE 'behind' END AS state FROM src LEFT JOIN old USING (user_id) WHERE old.version IS NULL OR old.version < src.version")
def projection_reconcile(spark, d):
    """A projection that missed some events and users, against its source; the remainders plant what it missed."""
    source, old = _projections(spark, d)
    return outbox.reconcile(source, old, "user_id")


@query("projection_audit", f"WITH {PROJ_SQL} SELECT (SELECT count(*) FROM src) AS source_rows, (SELECT count(*) FROM old) AS projected_rows, (SELECT count(*) FROM src JOIN old USING (user_id) WHERE src.value IS DISTINCT FROM old.value) AS differ, (SELECT count(*) FROM src) = (SELECT count(*) FROM old) AND (SELECT count(*) FROM src JOIN old USING (user_id) WHERE src.value IS DISTINCT FROM old.value) = 0 AS equal")
def projection_audit(spark, d):
    source, old = _projections(spark, d)
    return outbox.audit(source, old, "user_id", ["value"])


@query("bundle_round_trip", "SELECT 'supplier' AS name, count(*) AS n, round(sum(s_acctbal), 2) AS total, 0 AS bad FROM supplier UNION ALL SELECT 'customer', count(*), round(sum(c_acctbal), 2), 0 FROM customer")
def bundle_round_trip(spark, d):
    """Tables exported as a bundle with a manifest, verified and read back; bad counts files whose checksum doesn't hold."""
    at = shared_folder(spark, "bundle")
    bundles.export_bundle({n: table(spark, d, n) for n in ("supplier", "customer")}, at)
    bad = bundles.verify(spark, f"{at}/data", f"{at}/manifest", "*.parquet").agg(F.count_if(F.col("state") != "same").cast("int").alias("bad"))
    read = lambda n, c: spark.read.parquet(f"{at}/data/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n"), F.round(F.sum(c), 2).alias("total"))
    return read("supplier", "s_acctbal").unionByName(read("customer", "c_acctbal")).crossJoin(bad)  # one row


@query("gzip_text_scan", "SELECT count(*) AS files, CAST(sum(length(r_name) + 1) AS BIGINT) AS chars FROM region")
def gzip_text_scan(spark, d):
    """Compressed text files read whole, by their name alone."""
    at = shared_folder(spark, "gzip")
    table(spark, d, "region").select(F.col("r_name").alias("value")).repartition(5, "value").write.option("compression", "gzip").option("maxRecordsPerFile", 1).text(at)
    return readers.raw_text(spark, at).agg(F.count("*").alias("files"), F.sum(F.length("value")).alias("chars"))


@query("csv_results", "SELECT n_regionkey AS region, count(*) AS n, min(n_name) AS first FROM nation GROUP BY 1")
def csv_results(spark, d):
    """A result table written as CSV with a header, read back by its names."""
    at = shared_folder(spark, "results")
    readers.write_csv(table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n"), F.min("n_name").alias("first")), at)
    return spark.read.schema("region long, n long, first string").option("header", True).csv(at)


@query("archive_tables", r"""SELECT o_orderkey AS k, count(*) AS rows, CAST(sum(l_linenumber) AS BIGINT) AS total FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def archive_tables(spark, d):
    """Tables of archived pages, cell by cell: pages written from items and parsed back."""
    row = F.concat(F.lit("<tr class=x><td>"), F.col("l_linenumber").cast("string"), F.lit("</td><th scope=row><b>"), F.col("l_quantity").cast("string"), F.lit("</b></th></tr>"))
    pages = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.concat(F.lit("<html><table>"), F.array_join(F.collect_list(row), "\n"), F.lit("</table></html>")).alias("html"))
    cells = readers.html_table_rows(pages, "html", "k")
    return cells.groupBy("k").agg(F.count("*").alias("rows"), F.sum(F.col("cells")[0].cast("long")).alias("total"))


@query("news_scan", r"""WITH a AS (SELECT regexp_replace(url, '[?#].*$', '') AS link, page_id FROM pages WHERE url IS NOT NULL) SELECT link, min(page_id) AS first_seen FROM a GROUP BY 1""")
def news_scan(spark, d):
    """A news list as a fetch leaves it, one row a link, the first seen wins."""
    at = shared_folder(spark, "news")
    stamp = F.date_format(F.timestamp_seconds(F.col("page_id") + 1_700_000_000), "yyyyMMdd'T'HHmmss'Z'")
    table(spark, d, "pages").select("url", F.col("page_id").cast("string").alias("title"), F.lit("d").alias("domain"), stamp.alias("seendate"), F.lit("en").alias("language")).write.json(at)
    return bundles.news(spark, at).select("link", F.col("title").cast("long").alias("first_seen"))


@query("feed_scan", "SELECT p_partkey AS k, p_name AS title FROM part WHERE p_size > 40")
def feed_scan(spark, d):
    """A feed written as items of XML and scanned."""
    at = shared_folder(spark, "feed")
    x = table(spark, d, "part").where("p_size > 40").select(F.col("p_name").alias("title"), F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string")).alias("link"), F.lit("2001-01-01").alias("pubDate"), F.lit("-").alias("description"))
    x.write.format("xml").option("rowTag", "item").option("rootTag", "channel").save(at)
    return readers.feed(spark, at).select(F.substring_index("link", "/", -1).cast("long").alias("k"), "title")


@query("text_tables", "SELECT l_orderkey AS k, l_linenumber AS line, l_quantity AS value FROM lineitem")
def text_tables(spark, d):
    """Rows of a text table by pattern, other lines aside."""
    row = F.concat(F.lit("  "), F.col("l_linenumber").cast("string"), F.lit(" ....... "), F.col("l_quantity").cast("string"))
    t = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.concat(F.lit("Title of 9 things\n"), F.array_join(F.collect_list(row), "\n"), F.lit("\nTotal: see note 3")).alias("t"))
    out = readers.text_table(t, "t", r"^\s+(\d+)\s\.+\s([\d.]+)$", ["line", "value"], "k")
    return out.select("k", F.col("line").cast("int").alias("line"), F.col("value").cast("double").alias("value"))


@query("markdown_scan", "SELECT o_orderkey AS k, kind, count(*) AS n FROM orders, (SELECT unnest(['heading', 'paragraph', 'item', 'item', 'quote', 'row']) AS kind) GROUP BY 1, 2")
def markdown_scan(spark, d):
    """Blocks of Markdown notes by kind."""
    o = table(spark, d, "orders")
    text = F.concat_ws("\n", F.concat(F.lit("## Order "), F.col("o_orderkey").cast("string")), F.lit(""), F.lit("A **plain** paragraph."), F.lit("- one"), F.lit("2. two"), F.lit("> quoted"), F.lit("| a | b |"))
    b = bundles.markdown_blocks(o.select(F.col("o_orderkey").alias("k"), text.alias("t")), "k", "t")
    return b.groupBy("k", "kind").agg(F.count("*").alias("n"))


@query("stale_while_failing", "SELECT user_id, max(value) FILTER (WHERE event_id = last) AS value, CASE WHEN max(ts) >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 6 HOUR THEN 'cache' WHEN user_id % 3 = 0 THEN 'stale' ELSE 'fetched' END AS origin FROM (SELECT *, max_by(event_id, struct_pack(ts, event_id)) OVER (PARTITION BY user_id) AS last FROM events) GROUP BY user_id")
def stale_while_failing(spark, d):
    """A cache with a time to live: fresh rows serve at once, others are fetched, and where a fetch failed the stale row serves."""
    cache = table(spark, d, "events").select("user_id", F.col("ts").alias("fetched_at"), "event_id", "value")
    rows = readers.fresh_or_stale(cache, ["user_id"], F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), "6 HOURS")
    fetched = rows.where("user_id % 3 <> 0").select("user_id", F.col("value").alias("_new"))
    return readers.served(rows, fetched, "user_id", "value", "_new")
