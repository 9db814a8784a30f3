"""Queries of deliveries driven by a stateful stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import delivery
from .base import query, table
from .delivery import shared_folder

KEYS = ["event", "consumer"]

_DELAY = "CAST(least(3600000, 30000 * pow(2, {f} - 1)) AS BIGINT)"
#: The machine by recursion over the messages of all deliveries at once, then what time alone does up to the watermark.
STATES_SQL = f"""RECURSIVE m AS (SELECT user_id % 400 AS event, event_type AS consumer, epoch_ms(ts) AS t, CASE WHEN event_id % 7 = 0 THEN 'claim' WHEN value < 6 THEN 'ok' WHEN value < 8 THEN 'skip' ELSE 'fail' END AS kind,
 row_number() OVER (PARTITION BY user_id % 400, event_type ORDER BY epoch_ms(ts), event_id) AS place FROM events),
s AS (SELECT DISTINCT event, consumer, CAST(0 AS BIGINT) AS place, 'pending' AS status, 0 AS attempts, 0 AS failures, CAST(NULL AS BIGINT) AS until FROM m
UNION ALL SELECT event, consumer, place, CASE WHEN NOT heard THEN st WHEN kind = 'claim' THEN 'running' WHEN kind = 'ok' THEN 'succeeded' WHEN kind = 'skip' THEN 'skipped' WHEN f + 1 >= 5 THEN 'dead' ELSE 'retryable' END,
 CASE WHEN heard AND st = 'pending' THEN a + 1 ELSE a END, CASE WHEN heard AND kind = 'fail' THEN f + 1 ELSE f END,
 CASE WHEN NOT heard THEN u WHEN kind = 'claim' THEN t + 900000 WHEN kind = 'fail' AND f + 1 < 5 THEN t + {_DELAY.format(f='(f + 1)')} END
FROM (SELECT *, NOT (st IN ('succeeded', 'skipped', 'dead', 'retryable') OR kind = 'claim' AND st = 'running') AS heard
FROM (SELECT event, consumer, place, t, kind, a, f, CASE WHEN st1 = 'retryable' AND u1 <= t THEN 'pending' ELSE st1 END AS st, CASE WHEN st1 = 'retryable' AND u1 <= t THEN NULL ELSE u1 END AS u
FROM (SELECT n.event, n.consumer, n.place, n.t, n.kind, s.attempts AS a, s.failures + CASE WHEN lapsed THEN 1 ELSE 0 END AS f, CASE WHEN NOT lapsed THEN s.status WHEN s.failures + 1 >= 5 THEN 'dead' ELSE 'retryable' END AS st1,
 CASE WHEN NOT lapsed THEN s.until WHEN s.failures + 1 < 5 THEN s.until + {_DELAY.format(f='(s.failures + 1)')} END AS u1
FROM s JOIN m n ON n.event = s.event AND n.consumer = s.consumer AND n.place = s.place + 1, LATERAL (SELECT s.status = 'running' AND s.until <= n.t AS lapsed) l)))),
w AS (SELECT max(t) - 600000 AS now FROM m), e AS (SELECT event, consumer, arg_max(struct_pack(status, attempts, failures, until), place) AS x FROM s GROUP BY 1, 2),
l AS (SELECT event, consumer, now, x.status AS status, x.attempts AS a, x.failures AS f, x.until AS u, coalesce(x.status = 'running' AND x.until <= now, false) AS lapsed FROM e, w),
l2 AS (SELECT event, consumer, now, a, f + CASE WHEN lapsed THEN 1 ELSE 0 END AS f, CASE WHEN NOT lapsed THEN status WHEN f + 1 >= 5 THEN 'dead' ELSE 'retryable' END AS st, CASE WHEN NOT lapsed THEN u WHEN f + 1 < 5 THEN u + {_DELAY.format(f='(f + 1)')} END AS u FROM l),
fin AS (SELECT event, consumer, CASE WHEN st = 'retryable' AND u <= now THEN 'pending' ELSE st END AS status, a AS attempts, f AS failures, CASE WHEN st = 'retryable' AND u <= now THEN NULL ELSE u END AS until FROM l2)"""


def _drained(spark, d):
    """All events as messages of deliveries, streamed until drained; the changes as they were written."""
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    kind = F.when(F.col("event_id") % 7 == 0, "claim").when(F.col("value") < 6, "ok").when(F.col("value") < 8, "skip").otherwise("fail")
    messages = stream.select((F.col("user_id") % 400).alias("event"), F.col("event_type").alias("consumer"), "ts", "event_id", kind.alias("kind"))
    at = shared_folder(spark, "deliveries")
    delivery.run(delivery.changes(messages, KEYS, "ts", "event_id", "kind"), f"{at}/changes", f"{at}/state")
    return spark.read.parquet(f"{at}/changes")


@query("stream_delivery_states", f"WITH {STATES_SQL} SELECT event, consumer, status, attempts, failures, until FROM fin WHERE attempts > 0")
def stream_delivery_states(spark, d):
    """Deliveries after their messages and timers: leases that ran out, back-off that ended, dead letters."""
    out = delivery.latest(_drained(spark, d), KEYS)
    return out.select(*KEYS, "status", "attempts", "failures", F.unix_millis("until").alias("until"))


@query("stream_delivery_health", f"WITH {STATES_SQL} SELECT consumer, status, count(*) AS deliveries, CAST(sum(attempts) AS BIGINT) AS attempts FROM fin WHERE attempts > 0 GROUP BY 1, 2")
def stream_delivery_health(spark, d):
    out = delivery.latest(_drained(spark, d), KEYS)
    return out.groupBy("consumer", "status").agg(F.count("*").alias("deliveries"), F.sum("attempts").alias("attempts"))
