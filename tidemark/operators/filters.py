"""Filters built part by part, and predicates of universes and listings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Filter:
    """A search filter of optional parts; those that aren't set let everything pass. ``&`` joins two filters."""

    values: dict[str, Sequence] = field(default_factory=dict)
    least: dict[str, object] = field(default_factory=dict)
    most: dict[str, object] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    present: Sequence[str] = ()

    def __and__(self, other: Filter) -> Filter:
        both = lambda a, b: {k: sorted(set(a[k]) & set(b[k])) if k in a and k in b else (a | b)[k] for k in a | b}
        return Filter(both(self.values, other.values), self.least | other.least, self.most | other.most, self.patterns | other.patterns, [*self.present, *other.present])

    def condition(self) -> Column:
        parts = [F.col(c).isin(list(v)) for c, v in self.values.items()]
        parts += [F.col(c) >= v for c, v in self.least.items()] + [F.col(c) <= v for c, v in self.most.items()]
        parts += [F.lower(c).rlike(p) for c, p in self.patterns.items()] + [F.col(c).isNotNull() for c in self.present]
        out = F.lit(True)
        for p in parts:
            out = out & p
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.condition())


def flagged(df: DataFrame, key: str, **sets: DataFrame) -> DataFrame:
    """``df`` with a boolean per named set: whether the key is in it; the sets are reduced to distinct keys before they join."""
    for name, members in sets.items():
        df = df.join(members.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return df


def listed(period: Column, first: Column, last: Column) -> Column:
    """Whether a period lies in a listing that may be open at either end."""
    return F.coalesce(period >= first, F.lit(True)) & F.coalesce(period <= last, F.lit(True))
