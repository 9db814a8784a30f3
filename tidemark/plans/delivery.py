"""Queries of event delivery, streams and data formats."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.scratch import shared_folder  # noqa: F401  other plans take it from here
from ..sources import readers
from ..streaming import outbox
from .base import query, table


ATTEMPTS = """a AS (SELECT user_id % 400 AS event_id, event_type AS consumer_id, ts AS att, event_id AS attempt, CASE WHEN value < 12 THEN 'ok' WHEN value < 14 THEN 'skip' WHEN event_id % 7 = 0 THEN 'lease_expired' ELSE 'fail' END AS outcome FROM events),
d AS (SELECT event_id, consumer_id, count(*) AS attempts, CAST(count(*) FILTER (WHERE outcome IN ('fail', 'lease_expired')) AS INTEGER) AS failures, arg_max(outcome, struct_pack(att, attempt)) AS last FROM a GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN last = 'ok' THEN 'succeeded' WHEN last = 'skip' THEN 'skipped' WHEN failures >= 5 THEN 'dead' ELSE 'retryable' END AS status FROM d)"""


def _states(spark, d):
    e = table(spark, d, "events")
    outcome = F.when(F.col("value") < 12, "ok").when(F.col("value") < 14, "skip").when(F.col("event_id") % 7 == 0, "lease_expired").otherwise("fail")
    a = e.select((F.col("user_id") % 400).alias("event_id"), F.col("event_type").alias("consumer_id"), F.col("ts").alias("at"), F.col("event_id").alias("attempt"), outcome.alias("outcome"))
    return outbox.delivery_state(a)


@query("delivery_status", f"WITH {ATTEMPTS} SELECT event_id, consumer_id, attempts, failures, status, CASE WHEN status = 'retryable' THEN least(3600.0, 30.0 * pow(2, greatest(failures - 1, 0))) END AS retry_in FROM s")
def delivery_status(spark, d):
    return _states(spark, d).select("event_id", "consumer_id", "attempts", "failures", "status", "retry_in")


@query("event_publication", f"WITH {ATTEMPTS} SELECT event_id, count(*) AS deliveries, count(*) FILTER (WHERE status IN ('succeeded', 'skipped', 'dead')) AS terminal, bool_and(status IN ('succeeded', 'skipped', 'dead')) AS published FROM s GROUP BY 1")
def event_publication(spark, d):
    return outbox.event_state(_states(spark, d))


@query("delivery_health", f"WITH {ATTEMPTS} SELECT consumer_id, count(*) AS total, count(*) FILTER (WHERE status = 'succeeded') AS succeeded, count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) FILTER (WHERE status = 'retryable') AS retryable, count(*) FILTER (WHERE status = 'dead') AS dead FROM s GROUP BY 1")
def delivery_health(spark, d):
    return outbox.health(_states(spark, d))


@query("outbox_claim_rank", """WITH r AS (SELECT event_type AS consumer_id, max(ts) AS lease_until FROM events WHERE event_id % 3 = 0 GROUP BY 1), n AS (SELECT TIMESTAMP '2024-01-29 00:00:00' AS now)
SELECT event_id, consumer_id, turn FROM (SELECT event_id, event_type AS consumer_id, row_number() OVER (PARTITION BY event_type ORDER BY user_id % 5 DESC, ts, event_id) AS turn FROM events, n WHERE ts <= now AND NOT EXISTS (SELECT 1 FROM r WHERE r.consumer_id = event_type AND lease_until > now AND length(r.consumer_id) % 2 = 1)) WHERE turn <= 4""")
def outbox_claim_rank(spark, d):
    e = table(spark, d, "events")
    deliveries = e.select("event_id", F.col("event_type").alias("consumer_id"), F.lit("pending").alias("status"), F.col("ts").alias("available_at"), (F.col("user_id") % 5).alias("priority"))
    running = e.where("event_id % 3 = 0").groupBy(F.col("event_type").alias("consumer_id")).agg(F.max("ts").alias("lease_until")).where(F.length("consumer_id") % 2 == 1)
    out = outbox.claimable(deliveries, F.lit("2024-01-29 00:00:00").cast("timestamp_ntz"), running, 4)
    return out.select("event_id", "consumer_id", F.col("turn").cast("long").alias("turn"))


@query("outbox_unique_fanout", """WITH u AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events), s AS (SELECT * FROM (VALUES ('index', 1), ('mail', 2)) t(consumer_id, priority))
SELECT consumer_id, event_type, count(*) AS n FROM u, s WHERE r = 1 AND (consumer_id = 'index' OR length(event_type) > 5) GROUP BY 1, 2""")
def outbox_unique_fanout(spark, d):
    e = table(spark, d, "events").withColumns({"dedupe_key": F.concat_ws("|", "user_id", "event_type"), "created_at": F.struct("ts", "event_id")})
    types = e.select("event_type").distinct()
    subs = types.select(F.lit("index").alias("consumer_id"), "event_type", F.lit(1).alias("priority"), F.lit(True).alias("enabled")).unionByName(types.select(F.lit("mail").alias("consumer_id"), "event_type", F.lit(2).alias("priority"), (F.length("event_type") > 5).alias("enabled")))
    return outbox.fan_out(outbox.unique_events(e), subs).groupBy("consumer_id", "event_type").agg(F.count("*").alias("n"))


@query("fresh_derivatives", "SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 AND sha256(coalesce(text, '')) NOT IN (SELECT sha256(coalesce(text, '')) FROM documents WHERE doc_id % 4 = 0)")
def fresh_derivatives(spark, d):
    x = table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))
    key = F.sha2(F.concat_ws("|", F.col("sha256"), F.lit("summary"), F.lit("p"), F.lit("1")), 256)
    done = x.where("doc_id % 4 = 0").select(key.alias("derivative_key"))
    return outbox.fresh_derivatives(x.where("doc_id % 4 <> 0"), done, "summary", "p", "1").select("doc_id")


@query("stream_event_windows", "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_event_windows(spark, d):
    """A stream over the events table, drained: counts per hour of event time and type."""
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    at = shared_folder(spark, "windows")
    out = outbox.drain(spark, outbox.windowed_counts(stream, "ts", "event_type", "value"), f"{at}/out", f"{at}/state")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("json_facts", "SELECT 'c' || CAST(user_id % 20 AS VARCHAR) AS concept, count(*) AS n, count(*) FILTER (WHERE value > 15) AS filled, round(sum(value), 4) AS total FROM events GROUP BY 1")
def json_facts(spark, d):
    """Facts written as JSON maps and read back: census per concept."""
    e = table(spark, d, "events")
    fact = F.to_json(F.struct(F.round("value", 10).alias("value"), F.lit("MXN").alias("unit"), F.date_format("ts", "yyyy-MM-dd").alias("instant")))
    raw = e.select("event_id", F.concat(F.lit('{"c'), (F.col("user_id") % 20).cast("string"), F.lit('": ['), fact, F.lit("]}")).alias("j"))
    x = readers.explode_facts(raw, "j", "event_id")
    return x.groupBy("concept").agg(F.count("*").alias("n"), F.count(F.when(F.col("value") > 15, 1)).alias("filled"), F.round(F.sum("value"), 4).alias("total"))


@query("csv_round_trip", "SELECT CAST(count(*) AS BIGINT) AS n, round(sum(s_acctbal), 2) AS total FROM supplier")
def csv_round_trip(spark, d):
    at = shared_folder(spark, "csv")
    table(spark, d, "supplier").select("s_suppkey", "s_acctbal").write.csv(at)
    return readers.csv_grid(spark, at, 2).agg(F.count("*").alias("n"), F.round(F.sum(F.col("c1").cast("double")), 2).alias("total"))


@query("eav_pack", """SELECT c_mktsegment AS entity, CAST(year(o_orderdate) AS VARCHAR) AS period, max(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent, max(CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice END) AS low FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1, 2""")
def eav_pack(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    field = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").when(F.col("o_orderpriority") == "5-LOW", "low").otherwise("other")
    x = j.select(F.col("c_mktsegment").alias("entity"), F.lit("peer").alias("entity_kind"), field.alias("field"), F.year("o_orderdate").cast("string").alias("period"), F.col("o_totalprice").alias("value"))
    return readers.eav_pack(x, ["urgent", "low"])[0].select("entity", "period", "urgent", "low")


@query("series_bars", "SELECT event_type AS symbol, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n, round(avg(value), 6) AS close FROM events WHERE event_id % 11 <> 0 GROUP BY 1, 2")
def series_bars(spark, d):
    """Parallel arrays per symbol and day, of a thousand events at most, written as JSON and unpacked; rows without a close are dropped."""
    e = table(spark, d, "events").withColumn("sec", F.unix_timestamp(F.col("ts").cast("timestamp")))
    close = F.when(F.col("event_id") % 11 != 0, F.col("value"))
    packed = e.groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("_d"), F.floor(F.col("event_id") / 1000)).agg(F.collect_list(F.struct("sec", close.alias("c"))).alias("l"))
    arr = lambda n: F.transform("l", lambda x: x[n])
    blank = F.transform("l", lambda x: F.lit(None).cast("double"))
    js = F.to_json(F.struct(arr("sec").alias("timestamp"), blank.alias("open"), blank.alias("high"), blank.alias("low"), arr("c").alias("close"), blank.alias("volume"), arr("c").alias("adjclose")), {"ignoreNullFields": "false"})
    b = readers.bars(packed.select("symbol", js.alias("js")), "symbol", "js", "UTC")
    return b.groupBy("symbol", F.col("date").cast("string").alias("date")).agg(F.count("*").alias("n"), F.round(F.avg("close"), 6).alias("close"))


@query("cache_freshness", "SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS fetched, max(ts) >= TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 6 HOUR AS fresh FROM events GROUP BY 1")
def cache_freshness(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("ts").alias("fetched_at"))
    out = readers.fresh_or_stale(e, ["user_id"], F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), "6 HOURS")
    return out.select("user_id", F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched"), "fresh")


@query("page_lists", r"SELECT page_id, len(regexp_extract_all(html, '<li>', 0)) AS items FROM pages")
def page_lists(spark, d):
    """Items of the list markup of each page."""
    return table(spark, d, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("<li>"), F.lit(0))).cast("long").alias("items"))


@query("sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT user_id, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g) SELECT user_id, count(DISTINCT sid) AS sessions, count(*) AS events FROM s GROUP BY 1")
def sessions(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("ts") - F.lag("ts").over(w) <= F.expr("INTERVAL 6 HOURS")
    s = table(spark, d, "events").withColumn("brk", F.when(gap, 0).otherwise(1))
    return s.groupBy("user_id").agg(F.sum("brk").alias("sessions"), F.count("*").alias("events"))
