"""Event delivery: an outbox with unique keys, fan-out to subscriptions, leases, retries and dead letters.

The rules are DataFrame functions over delivery and attempt tables, so that a micro-batch and a backfill share
them; ``run_outbox`` and ``windowed_counts`` drive them with Structured Streaming.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TERMINAL = ("succeeded", "skipped", "dead")


def unique_events(events: DataFrame, key: str = "dedupe_key", ts: str = "created_at", delay: str = "7 days") -> DataFrame:
    """The first event of each key; on a stream, keys are remembered for ``delay`` of event time."""
    if events.isStreaming:
        return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    w = Window.partitionBy(key).orderBy(ts)
    return events.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def fan_out(events: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """A pending delivery for each enabled subscription to the event's type (few rows, joined to the stream)."""
    on = subscriptions.where("enabled").select("consumer_id", "event_type", "priority")
    return events.join(on, "event_type").withColumns({"status": F.lit("pending"), "attempts": F.lit(0)})


def retry_delay(attempt: Column | str, base: float = 30.0, cap: float = 3600.0) -> Column:
    """Seconds before the next attempt: doubling, capped."""
    n = F.col(attempt) if isinstance(attempt, str) else attempt
    return F.least(F.lit(cap), base * F.pow(F.lit(2.0), F.greatest(n - 1, F.lit(0))))


def delivery_state(attempts: DataFrame, most: int = 5) -> DataFrame:
    """Status of each (event, consumer) from its attempts (outcome ok, skip, fail or lease_expired, in order of ``at``)."""
    last = F.max_by("outcome", F.struct("at", "attempt"))
    failed = F.sum(F.col("outcome").isin("fail", "lease_expired").cast("int"))
    g = attempts.groupBy("event_id", "consumer_id").agg(F.count("*").alias("attempts"), failed.alias("failures"), last.alias("last"), F.max("at").alias("last_at"))
    status = F.when(F.col("last") == "ok", "succeeded").when(F.col("last") == "skip", "skipped").when(F.col("failures") >= most, "dead").otherwise("retryable")
    out = g.withColumn("status", status)
    return out.withColumn("retry_in", F.when(F.col("status") == "retryable", retry_delay("failures")))


def event_state(deliveries: DataFrame) -> DataFrame:
    """An event is published once every delivery of it is terminal."""
    done = F.col("status").isin(*TERMINAL)
    return deliveries.groupBy("event_id").agg(F.count("*").alias("deliveries"), F.sum(done.cast("int")).cast("long").alias("terminal"), F.every(done).alias("published"))


def claimable(deliveries: DataFrame, now: Column, running: DataFrame, limit: int) -> DataFrame:
    """Deliveries to claim: available, their consumer without a live lease, consumers served in turn by priority.

    ``running`` has consumer_id and lease_until; an expired lease no longer blocks. The claim itself is a
    conditional write of the caller's table.
    """
    live = running.where(F.col("lease_until") > now).select("consumer_id").distinct()
    ready = deliveries.where(F.col("status").isin("pending", "retryable") & (F.col("available_at") <= now)).join(live, "consumer_id", "left_anti")
    turn = F.row_number().over(Window.partitionBy("consumer_id").orderBy(F.desc("priority"), "available_at", "event_id"))
    return ready.withColumn("turn", turn).where(F.col("turn") <= limit)


def requeue(deliveries: DataFrame, consumer: str) -> DataFrame:
    """Dead deliveries of a consumer pending again, with the next replay number."""
    hit = (F.col("status") == "dead") & (F.col("consumer_id") == consumer)
    return deliveries.withColumns({"replay": F.when(hit, F.col("replay") + 1).otherwise(F.col("replay")), "attempts": F.when(hit, 0).otherwise(F.col("attempts")), "status": F.when(hit, "pending").otherwise(F.col("status"))})


def health(deliveries: DataFrame) -> DataFrame:
    n = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(s)
    return deliveries.groupBy("consumer_id").agg(F.count("*").alias("total"), *[n(s) for s in ("succeeded", "skipped", "retryable", "dead")])


def renewed(leases: DataFrame, owner: str, now: Column, ttl_seconds: int) -> DataFrame:
    """Leases with the owner's live ones extended; others, and expired ones, as they were."""
    mine = (F.col("owner") == owner) & (F.col("lease_until") > now)
    return leases.withColumn("lease_until", F.when(mine, now + F.make_dt_interval(secs=F.lit(float(ttl_seconds)))).otherwise(F.col("lease_until")))


def fresh_derivatives(inputs: DataFrame, done: DataFrame, kind: str, processor: str, version: str) -> DataFrame:
    """Inputs that no derivative of this kind, processor and version exists for."""
    keyed = inputs.withColumn("derivative_key", F.sha2(F.concat_ws("|", F.col("sha256"), F.lit(kind), F.lit(processor), F.lit(version)), 256))
    return keyed.join(done.select("derivative_key").distinct(), "derivative_key", "left_anti")


def run_outbox(events: DataFrame, subscriptions: DataFrame, handlers: Mapping[str, Callable[[DataFrame, int], None]], checkpoint: str):
    """Streams unique events to each consumer's handler in micro-batches until none is left; handlers are idempotent by (event, batch)."""

    def batch(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        for consumer, handle in handlers.items():
            handle(rows.where(F.col("consumer_id") == consumer), epoch)
        rows.unpersist()

    stream = fan_out(unique_events(events), subscriptions)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, ts: str, key: str, value: str, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Count and sum per key and event-time window, late rows beyond ``delay`` aside."""
    w = F.window(F.col(ts).cast("timestamp"), size)
    rows = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay) if events.isStreaming else events
    return rows.groupBy(w.alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def drain(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there and returns its last state, written to ``out``."""

    def write(rows: DataFrame, epoch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    q = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    done = spark.read.parquet(out)
    last = done.agg(F.max("epoch").alias("e"))  # one row
    return done.join(F.broadcast(last), F.col("epoch") == F.col("e")).drop("epoch", "e")


def claim_batch(ready: DataFrame, first: DataFrame, limit: int) -> DataFrame:
    """The first claim of each consumer extended by up to ``limit`` further ready deliveries of the same kind and priority, oldest first.

    ``first`` has consumer_id, event_id, event_type and priority of what was claimed; a batch handler then gets one batch.
    """
    f = first.select("consumer_id", F.col("event_id").alias("_first"), F.col("event_type").alias("_kind"), F.col("priority").alias("_p"))
    same = ready.join(f, "consumer_id").where((F.col("event_type") == F.col("_kind")) & (F.col("priority") == F.col("_p")) & (F.col("event_id") != F.col("_first")))
    place = F.row_number().over(Window.partitionBy("consumer_id").orderBy("available_at", "event_id"))
    more = same.withColumn("place", place).where(F.col("place") <= limit).select("consumer_id", "event_id", "place")
    return f.select("consumer_id", F.col("_first").alias("event_id"), F.lit(0).alias("place")).unionByName(more)


def project(events: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """Current state of each key: the values of its last event, with how many events made it."""
    last = F.max_by(F.struct(*values), F.struct(order))
    return events.groupBy(key).agg(last.alias("_v"), F.count("*").alias("events"), F.max(order).alias("version")).select(key, "_v.*", "events", "version")


def reconcile(source: DataFrame, projection: DataFrame, key: str) -> DataFrame:
    """(key, state) of keys that a projection lacks (missing), holds at an older version (behind), or holds without a source (orphan)."""
    s, p = source.select(key, F.col("version").alias("_s")), projection.select(key, F.col("version").alias("_p"))
    state = F.when(F.col("_p").isNull(), "missing").when(F.col("_s").isNull(), "orphan").when(F.col("_p") < F.col("_s"), "behind")
    return s.join(p, key, "full").withColumn("state", state).where("state is not null").select(key, "state")


def audit(source: DataFrame, projection: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row: rows on both sides, rows whose values differ, and equal order-independent checksums or not."""
    mix = lambda df: df.agg(F.bit_xor(F.xxhash64(key, *values)).alias("sum"), F.count("*").alias("n"))
    a, b = mix(source).toDF("_a", "source_rows"), mix(projection).toDF("_b", "projected_rows")
    j = source.select(key, F.struct(*values).alias("_x")).join(projection.select(key, F.struct(*values).alias("_y")), key)
    differ = j.agg(F.count_if(~F.col("_x").eqNullSafe(F.col("_y"))).alias("differ"))
    return a.crossJoin(b).crossJoin(differ).select("source_rows", "projected_rows", "differ", F.col("_a").eqNullSafe(F.col("_b")).alias("equal"))  # one row each


def singleton_runs(requests: DataFrame, lease: str, at: str, ttl_seconds: int) -> DataFrame:
    """``requests`` with granted: a run starts only where no granted run's lease of the same name still lives.

    Requests stream through in order, and a task holds the last grant of one lease name only. Requests at the time of a
    grant are that grant; those without a time get none.
    """
    ttl = ttl_seconds * 1_000_000
    rows = requests.withColumn("_t", F.unix_micros(F.col(at).cast("timestamp"))).repartition(lease).sortWithinPartitions(lease, "_t")
    names = rows.columns
    name, time = names.index(lease), len(names) - 1

    def run(batches):
        import pyarrow as pa

        of, last = object(), None
        for b in batches:
            granted = []
            for who, t in zip(b.column(name).to_pylist(), b.column(time).to_pylist()):
                if who != of:
                    of, last = who, None
                yes = t is not None and (last is None or t == last or t >= last + ttl)
                granted.append(yes)
                last = t if yes else last
            yield pa.RecordBatch.from_arrays([*b.columns[:time], pa.array(granted)], [*names[:time], "granted"])

    from pyspark.sql.types import BooleanType, StructType

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:time]]).add("granted", BooleanType()))
