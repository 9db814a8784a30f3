"""The revision fold against a plain loop on awkward observations."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import revisions

SCHEMA = "company string, metric string, id long, value double, role string, explicit boolean, trusted boolean, tier string, family string, version string, issued int"


def rows():
    rng = random.Random(9)
    out = [(c, m, i, rng.choice([1.0, 1.0 + 1e-13, 2.0, -0.0, 0.0, math.nan, None, 3.5]), rng.choice(["primary", "comparative", "restated", None]), rng.choice([None, False, False, True]), rng.choice([None, None, True, False]), rng.choice(["XBRL", " xbrl", "pdf", None]), rng.choice([None, "", "a", "b"]), rng.choice([None, "v2", "v10", "v9", "2", "10a", "x"]), rng.choice([1, 1, 2, 3, None])) for i, (c, m) in enumerate([("a", "x"), ("a", "y"), (None, "x"), ("b", None), ("c", "z")] * 60)]
    return out + [("single", "x", 999, 4.0, "primary", False, True, "pdf", None, None, 1)]


def loop(data, mode, tiers):
    series, steps, held = {}, [], {}
    for r in data:
        series.setdefault(r[:2], []).append(r)
    digits = lambda v: [(0, int(p), p) if p.isdigit() else (1, 0, p) for p in revisions._PARTS.findall(v or "")]
    for key, group in series.items():
        group.sort(key=lambda r: (r[10] is not None, r[10] or 0, r[9] is not None, digits(r[9]), r[2]))
        selected, n = group[0], {"superseded": 0, "conflicts": 0, "revised": 0}
        steps.append((*key, group[0][2], 0, "first", None))
        for place, new in enumerate(group[1:], 1):
            a, b = new[3], selected[3]
            same = a is b if a is None or b is None else a == b or abs(a - b) <= max(1e-12 * max(abs(a), abs(b)), 1e-9) or a != a and b != b
            trust = new[6] if new[6] is not None else (new[7] or "").strip().lower() in tiers
            signal = new[4] in ("comparative", "restated") or new[5] or new[8] and new[8] == selected[8] and digits(new[9]) > digits(selected[9])
            if mode == "force" or mode == "allow" and trust and (same or signal):
                steps.append((*key, new[2], place, "confirms" if same else "revises", selected[2]))
                n["superseded"] += 1
                n["revised"] += not same
                selected = new
            else:
                steps.append((*key, new[2], place, "repeats" if same else "conflicts", None))
                n["conflicts"] += not same
        reason = "unsafe conflicting observations retained" if n["conflicts"] else "later observation accepted by revision policy" if n["revised"] else "later observation confirms selected value" if len(group) > 1 else "single observation"
        held[key] = (selected[2], len(group), n["superseded"], n["conflicts"], reason)
    return steps, held


@pytest.mark.parametrize("mode", revisions.MODES)
def test_fold(spark, mode):
    data = rows()
    folded = revisions.steps(spark.createDataFrame(data, SCHEMA), ["company", "metric"], ["issued", revisions.natural(F.col("version"))], mode, ["xbrl"]).persist()
    steps, held = loop(data, mode, {"xbrl"})
    order = lambda x: tuple((v is not None, str(v)) for v in x)
    assert sorted((tuple(r) for r in folded.select("company", "metric", "id", "place", "step", "replaces").collect()), key=order) == sorted(steps, key=order)
    got = {(r["company"], r["metric"]): (r["selected"], r["candidates"], r["superseded"], r["conflicts"], r["reason"]) for r in revisions.decisions(folded, ["company", "metric"]).collect()}
    assert got == held


def test_empty_and_unknown(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert revisions.decisions(revisions.steps(none, ["company"], ["issued"]), ["company"]).collect() == []
    with pytest.raises(ValueError, match="unknown mode"):
        revisions.steps(none, ["company"], ["issued"], "maybe")


def test_extra_columns(spark):
    df = spark.createDataFrame(rows(), SCHEMA).withColumns({c: F.lit("x") for c in ("place", "step", "replaces", "selected")})
    assert revisions.steps(df, ["company", "metric"], ["issued"]).count() == len(rows())
