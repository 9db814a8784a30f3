"""Delivery as a state machine on a stream: claims under a lease, outcomes, back-off, expiry and dead letters.

Messages of a delivery are claim, ok, skip and fail at an event time. Value state holds its status, attempts, failures
and the time the status lasts until; an event-time timer wakes it when a lease runs out or a back-off ends. Timers fire
as the watermark passes; a message that comes before its timer fired first lets happen what was due, so the states do
not depend on how the stream is cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

LEASE_MS, BASE_MS, CAP_MS, MOST = 900_000, 30_000, 3_600_000, 5
TERMINAL = ("succeeded", "skipped", "dead")
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: (status, attempts, failures, until): until in milliseconds, null but while a lease or back-off runs.
State = tuple[str, int, int, "int | None"]
NEW: State = ("pending", 0, 0, None)


def failed(state: State, at: int, most: int = MOST) -> State:
    """One more failure: a dead letter at the last one allowed, else retried after a doubling, capped delay."""
    _, attempts, failures, _ = state
    failures += 1
    if failures >= most:
        return "dead", attempts, failures, None
    return "retryable", attempts, failures, at + min(CAP_MS, BASE_MS << (failures - 1))


def due(state: State, now: int) -> Iterator[tuple[int, State]]:
    """(time, state) of what time alone does up to ``now``: a lease runs out, which is a failure; a back-off ends."""
    while state[3] is not None and state[3] <= now:
        at = state[3]
        state = failed(state, at) if state[0] == "running" else ("pending", *state[1:3], None)
        yield at, state


def heard(state: State, at: int, kind: str) -> State:
    """After a message: terminal deliveries and live leases are fenced, a delivery that waits takes none."""
    status, attempts, failures, _ = state
    if status in TERMINAL or status == "retryable" or kind == "claim" and status == "running":
        return state
    attempts += status == "pending"
    if kind == "claim":
        return "running", attempts, failures, at + LEASE_MS
    if kind == "fail":
        return failed((status, attempts, failures, None), at)
    return {"ok": "succeeded", "skip": "skipped"}[kind], attempts, failures, None


class Deliveries(StatefulProcessor):
    """One delivery a key; emits every change as (key, at, seq, status, attempts, failures, until)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("delivery", "status string, attempts int, failures int, until long, seq long")

    def _load(self) -> tuple[State, int]:
        if not self.state.exists():
            return NEW, 0
        v = self.state.get()
        return tuple(v[:4]), v[4]

    def _changes(self, key, changes: list[tuple[int, State]], before: State, seq: int, known: bool):
        """Keeps the last state, sets its timer in place of the old one, and hands on the changes."""
        import pandas as pd

        if not changes and known:
            return
        last = changes[-1][1] if changes else before
        if before[3] is not None and before[3] != last[3]:
            self.handle.deleteTimer(before[3])
        if last[3] is not None and last[3] != before[3]:
            self.handle.registerTimer(last[3])
        self.state.update((*last, seq + len(changes)))
        rows = [(*key, pd.Timestamp(at, unit="ms", tz="UTC"), seq + i, s[0], s[1], s[2], None if s[3] is None else pd.Timestamp(s[3], unit="ms", tz="UTC")) for i, (at, s) in enumerate(changes)]
        if rows:
            yield pd.DataFrame(rows, columns=self.columns(len(key)))

    @staticmethod
    def columns(n: int) -> list[str]:
        return [*[f"k{i}" for i in range(n)], "at", "seq", "status", "attempts", "failures", "until"]

    def handleInputRows(self, key, rows, timerValues):
        (state, seq), known = self._load(), self.state.exists()
        before, changes = state, []
        messages = sorted((int(at.value // 1_000_000), order, kind) for df in rows for at, order, kind in zip(df["at"], df["order"], df["kind"]))
        for at, _, kind in messages:
            for when, state in due(state, at):
                changes.append((when, state))
            after = heard(state, at, kind)
            if after != state:
                state = after
                changes.append((at, state))
        yield from self._changes(key, changes, before, seq, known)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        state, seq = self._load()
        # a back-off that follows an expired lease may have ended too: its timer would only fire with the next batch
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        yield from self._changes(key, list(due(state, now)), state, seq, True)

    def close(self) -> None:
        pass


def changes(messages: DataFrame, keys: Sequence[str], at: str, order: str, kind: str, delay: str = "10 minutes") -> DataFrame:
    """Stream of every change of every delivery: keys, at, seq, status, attempts, failures, until.

    ``messages`` is a stream of (keys, at, order, kind); messages of one batch are taken by ``at``, then ``order``. What
    comes more than ``delay`` late is dropped by the watermark. The session needs the RocksDB state store, which is set here.
    """
    messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    fields = {f.name: f.dataType.simpleString() for f in messages.schema}
    out = ", ".join(f"k{i} {fields[k]}" for i, k in enumerate(keys)) + ", at timestamp, seq long, status string, attempts int, failures int, until timestamp"
    rows = messages.select(*keys, F.col(at).cast("timestamp").alias("at"), F.col(order).alias("order"), F.col(kind).alias("kind")).withWatermark("at", delay)
    stream = rows.groupBy(*keys).transformWithStateInPandas(Deliveries(), out, "Append", "EventTime")
    return stream.toDF(*keys, "at", "seq", "status", "attempts", "failures", "until")


def latest(changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state each delivery ended in: its change with the highest number."""
    last = F.max_by(F.struct("at", "status", "attempts", "failures", "until"), "seq")
    return changed.groupBy(*keys).agg(last.alias("s")).select(*keys, "s.*")


def run(stream: DataFrame, out: str, checkpoint: str):
    """Writes the changes as Parquet, each once, until the stream is drained; goes on from the checkpoint."""
    q = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
