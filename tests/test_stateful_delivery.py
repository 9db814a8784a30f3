"""The stateful delivery stream against a plain loop, cut into batches in several ways and restarted from its checkpoint."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.streaming import delivery, outbox

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "event long, consumer string, ts timestamp, n long, kind string"


def messages():
    rng, out, at = random.Random(11), [], 0
    for i in range(600):
        at += rng.choice([0, 1, 20, 45, 300, 2000])
        out.append((rng.randrange(25), rng.choice(["index", "mail", None]), START + dt.timedelta(seconds=at, milliseconds=rng.choice([0, 250])), i, rng.choice(["claim", "claim", "fail", "fail", "fail", "ok", "skip"])))
    return out


def loop(rows, now):
    """The rules as a plain walk with explicit clocks."""
    ms = lambda t: int((t - START).total_seconds() * 1000)
    held = {}
    for event, consumer, ts, n, kind in sorted(rows, key=lambda r: (r[2], r[3])):
        d = held.setdefault((event, consumer), {"status": "pending", "attempts": 0, "failures": 0, "until": None})
        clock(d, ms(ts))
        if d["status"] == "pending":
            d["attempts"] += 1
        elif d["status"] != "running" or kind == "claim":
            continue
        if kind == "claim":
            d.update(status="running", until=ms(ts) + 900_000)
        elif kind == "fail":
            lose(d, ms(ts))
        else:
            d.update(status={"ok": "succeeded", "skip": "skipped"}[kind], until=None)
    for d in held.values():
        clock(d, now)
    return {k: tuple(d.values()) for k, d in held.items()}


def lose(d, at):
    d["failures"] += 1
    dead = d["failures"] == 5
    d.update(status="dead" if dead else "retryable", until=None if dead else at + min(3_600_000, 30_000 * 2 ** (d["failures"] - 1)))


def clock(d, now):
    if d["status"] == "running" and d["until"] <= now:
        lose(d, d["until"])
    if d["status"] == "retryable" and d["until"] <= now:
        d.update(status="pending", until=None)


def states(spark, folder):
    base = int(START.timestamp() * 1000)
    out = delivery.latest(spark.read.parquet(folder), ["event", "consumer"]).select("event", "consumer", "status", "attempts", "failures", F.unix_millis("until") - base)
    return {tuple(r[:2]): tuple(r[2:]) for r in out.collect()}


@pytest.mark.parametrize("files", [1, 6])
def test_drained_stream_equals_the_loop(spark, tmp_path, files):
    rows = messages()
    size = -(-len(rows) // files)
    source = str(tmp_path / "in")
    changes = lambda: delivery.changes(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), ["event", "consumer"], "ts", "n", "kind")
    # each run goes on where the last one stopped: a restart from the checkpoint after every file
    for i in range(files):
        spark.createDataFrame(rows[i * size : (i + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        delivery.run(changes(), str(tmp_path / "out"), str(tmp_path / "state"))
    now = max(int((r[2] - START).total_seconds() * 1000) for r in rows) - 600_000
    assert states(spark, str(tmp_path / "out")) == loop(rows, now)
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.groupBy("event", "consumer", "seq").count().where("count > 1").isEmpty()
    # a delivery that ended hears nothing more
    ended = {}
    for r in written.orderBy("seq").collect():
        assert (r["event"], r["consumer"]) not in ended
        if r["status"] in delivery.TERMINAL:
            ended[r["event"], r["consumer"]] = r["status"]
    assert set(ended.values()) == set(delivery.TERMINAL)


def test_singleton_runs_keep_one_grant(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), START + dt.timedelta(seconds=rng.randrange(4000)), i) for i in range(500)] + [("a", None, 900), ("c", None, 901)]
    got = {r["i"]: r["granted"] for r in outbox.singleton_runs(spark.createDataFrame(rows, "lease string, at timestamp, i int"), "lease", "at", 60).collect()}
    want, last = {}, {}
    for lease, at, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or START)):
        free = at is not None and (lease not in last or at == last[lease] or (at - last[lease]).total_seconds() >= 60)
        want[i] = free
        if free:
            last[lease] = at
    assert got == want
