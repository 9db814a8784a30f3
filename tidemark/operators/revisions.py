"""Which observation of a series holds: a fold over its observations in order, whose state is the selected one.

Rows are dealt out by series and sorted, and stream through the fold: a task holds one selected observation at a time,
however long a series is. Every observation gets the step it caused, and decisions are sums over the steps.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MODES = ("off", "allow", "force")
#: Roles of an observation that announce a revision.
REVISING = frozenset(("comparative", "restated"))
#: What a fold reads of an observation.
FIELDS = ("id", "value", "role", "explicit", "trusted", "tier", "family", "version")

_PARTS = re.compile(r"\d+|\D+")


def natural(x: Column) -> Column:
    """Sort key of a label in which runs of digits count as numbers; null first."""
    parts = F.regexp_extract_all(x, F.lit(r"(\d+|\D+)"), 1)
    return F.transform(parts, lambda p: F.struct(~p.rlike("^[0-9]"), F.when(p.rlike("^[0-9]"), p.cast("decimal(38,0)")), p))


def natural_order(label: str | None) -> list[tuple]:
    """The same order for the fold."""
    return [(0, int(p), p) if p[0] in "0123456789" else (1, 0, p) for p in _PARTS.findall(label or "")]


def same_value(a: float | None, b: float | None) -> bool:
    if a is None or b is None:
        return a is b
    return math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)


class Fold:
    """The selected observation of one series."""

    def __init__(self, mode: str, tiers: frozenset[str]):
        self.mode, self.tiers, self.selected = mode, tiers, None

    def _allowed(self, new: dict, same: bool) -> bool:
        if self.mode != "allow":
            return self.mode == "force"
        known = new["trusted"] if new["trusted"] is not None else new["tier"] in self.tiers
        old = self.selected
        upgrade = bool(new["family"]) and new["family"] == old["family"] and natural_order(new["version"]) > natural_order(old["version"])
        return known and (same or new["role"] in REVISING or bool(new["explicit"]) or upgrade)

    def step(self, new: dict) -> tuple[str, object]:
        """(what the observation does, id of the one it replaces)."""
        old = self.selected
        if old is None:
            self.selected = new
            return "first", None
        same = same_value(new["value"], old["value"])
        if self._allowed(new, same):
            self.selected = new
            return ("confirms" if same else "revises"), old["id"]
        return ("repeats" if same else "conflicts"), None


def steps(observations: DataFrame, series: Sequence[str], order: Sequence[Column | str], mode: str = "allow", trusted_tiers: Sequence[str] = ()) -> DataFrame:
    """(series, id, value, place, step, replaces) of every observation: columns ``FIELDS`` beside the series'.

    off keeps the first assertion; force takes every later one; allow takes a later trusted one that repeats the selected
    value or announces a revision: by its role, explicitly, or as a higher version of the same family. What is trusted says
    the column, or where it is null the tier. Observations that differ and aren't taken are conflicts. Ties in the order
    are settled by id, series with null keys are series, a value may be null.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    series, tiers = list(series), frozenset(t.strip().lower() for t in trusted_tiers)
    rows = observations.withColumn("tier", F.lower(F.trim("tier"))).repartition(*series).sortWithinPartitions(*series, *order, "id")
    rows = rows.select(*series, *FIELDS)
    kind = rows.schema["id"].dataType
    schema = StructType([*rows.select(*series).schema.fields]).add("id", kind).add("value", "double").add("place", "long").add("step", "string").add("replaces", kind)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at, fold, place, n = None, None, 0, len(series)
        for b in batches:
            out = []
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if fold is None or row[:n] != at:
                    at, fold, place = row[:n], Fold(mode, tiers), 0
                new = dict(zip(FIELDS, row[n:]))
                out.append((*row[:n], new["id"], new["value"], place, *fold.step(new)))
                place += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return rows.withColumn("value", F.col("value").cast("double")).mapInArrow(run, schema)


def decisions(folded: DataFrame, series: Sequence[str]) -> DataFrame:
    """(series, selected, value, candidates, superseded, conflicts, reason) from ``steps``."""
    taken = F.col("step").isin("first", "confirms", "revises")
    n = lambda *names: F.count_if(F.col("step").isin(*names))
    last = lambda c: F.max_by(F.struct(c), F.when(taken, F.col("place")))[c].alias("selected" if c == "id" else c)
    out = folded.groupBy(*series).agg(last("id"), last("value"), F.count("*").alias("candidates"), n("confirms", "revises").alias("superseded"), n("conflicts").alias("conflicts"), n("revises").alias("_revised"))
    reason = F.when(F.col("conflicts") > 0, "unsafe conflicting observations retained").when(F.col("_revised") > 0, "later observation accepted by revision policy")
    reason = reason.when(F.col("candidates") > 1, "later observation confirms selected value").otherwise("single observation")
    return out.withColumn("reason", reason).drop("_revised")
