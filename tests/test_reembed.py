"""A re-embedding that is stopped half-way, resumed, and raced by its source."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.reembed import Migration
from tidemark.sources import bundles

ROWS = [(i, f"text {i}" if i % 9 else None) for i in range(200)] + [(7, "text 7"), (None, "no id")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id long, text string")


def size(c):
    return F.array(F.coalesce(F.length(c), F.lit(-1)).cast("double"))


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(f"{root}/work") for f in names if f.endswith(".parquet")}


def current(spark, root):
    return sorted(((r["id"], r["vector"][0]) for r in bundles.current(spark, root).collect()), key=str)


WANT = sorted(((i, float(len(t)) if t is not None else -1.0) for i, t in ROWS), key=str)


def test_resumed_equals_whole(spark, tmp_path):
    whole, cut = f"{tmp_path}/whole", f"{tmp_path}/cut"
    assert Migration(spark, whole, "v1", size, batches=8).run(frame(spark)) and current(spark, whole) == WANT
    # the derivation fails on one row, so the run dies in that row's batch
    last = frame(spark).where("text is not null").orderBy(F.desc(F.pmod(F.xxhash64("id"), F.lit(8)))).first()["text"]
    broken = Migration(spark, cut, "v1", lambda c: F.when(F.col(c) == last, F.raise_error(F.lit("killed")).cast("array<double>")).otherwise(size(c)), batches=8)
    with pytest.raises(Exception, match="killed"):
        broken.run(frame(spark))
    with pytest.raises(Exception):
        bundles.current(spark, cut)  # nothing was published
    healed = Migration(spark, cut, "v1", size, batches=8)
    finished, wanted = files(cut), healed.signatures(frame(spark))
    assert 0 < len(healed.missing(wanted)) < len(wanted)
    assert healed.run(frame(spark)) and current(spark, cut) == WANT
    after = files(cut)
    done = {f: t for f, t in finished.items() if f in after and "_temporary" not in f}
    assert done and all(after[f] == t for f, t in done.items())


def test_only_changed_batches_are_redone(spark, tmp_path):
    m = Migration(spark, str(tmp_path), "v1", size, batches=8)
    first = m.work(frame(spark))
    changed = [(i, "longer text" if i == 50 else t) for i, t in ROWS]
    assert not m.publish(frame(spark, changed), first)  # the source is not what was embedded
    assert len(m.missing(m.signatures(frame(spark, changed)))) == 1
    assert m.run(frame(spark, changed))
    assert (50, 11.0) in current(spark, str(tmp_path)) and len(current(spark, str(tmp_path))) == len(ROWS)


def test_signatures(spark, tmp_path):
    m = Migration(spark, str(tmp_path), "v1", size, batches=4)
    one = m.signatures(frame(spark).repartition(5))
    assert one == m.signatures(frame(spark)) and one != m.signatures(frame(spark, ROWS + [(7, "text 7")])) and one != m.signatures(frame(spark, ROWS[:-1] + [(None, None)]))
    assert m.signatures(frame(spark, [])) == {} and not m.run(frame(spark, []))
