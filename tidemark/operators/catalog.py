"""Document catalogs: versions, upserts, content addresses, coverage and delivery bookkeeping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, family: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each family in the given order."""
    w = Window.partitionBy(*family).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last change of each key wins over the target's row; other rows stay."""
    last = latest(changes, keys, F.desc(order))
    return target.join(last.select(*keys), list(keys), "left_anti").unionByName(last.select(*target.columns))


def merge_natural(df: DataFrame, key: Column, firsts: Sequence[str], highest: Sequence[str], order: str) -> DataFrame:
    """One row per natural key: the first non-null value of some columns, the greatest of others."""
    aggs = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in firsts] + [F.max(c).alias(c) for c in highest]
    return df.groupBy(key.alias("key")).agg(*aggs, F.count("*").alias("seen"))


def content_address(df: DataFrame, content: str) -> DataFrame:
    return df.withColumn("sha256", F.sha2(F.coalesce(F.col(content), F.lit("")), 256))


def store_new(existing: DataFrame, incoming: DataFrame, content: str) -> DataFrame:
    """Incoming content whose address is not stored yet, once."""
    fresh = content_address(incoming, content)
    return latest(fresh.join(existing.select("sha256").distinct(), "sha256", "left_anti"), ["sha256"], F.col(incoming.columns[0]))


def checksum(df: DataFrame, *cols: str) -> DataFrame:
    """One digest of a table whatever its row order: row count, xor and sum of the first 60 bits of each row's MD5."""
    h = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])), 1, 15), 16, 10).cast("long")
    return df.agg(F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum(F.pmod(h, F.lit(2**31))).alias("total"))


def coverage_gaps(expected: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.join(known.select(*keys).distinct(), list(keys), "left_anti")


def physical_waste(files: DataFrame, address: str, inode: Sequence[str], size: str) -> DataFrame:
    """(inodes - 1) * size of every content held more than once."""
    out = files.groupBy(address).agg(F.count_distinct(F.struct(*inode)).alias("inodes"), F.max(size).alias("size"))
    return out.where("inodes > 1").withColumn("waste", (F.col("inodes") - 1) * F.col("size"))


def round_robin(df: DataFrame, group: str, order: Sequence[Column], limit: int) -> DataFrame:
    """At most ``limit`` rows, taking the next of every group in turn (a report-sized limit)."""
    turn = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("turn", turn).where(F.col("turn") <= limit).orderBy("turn", group).limit(limit)


def stratified(df: DataFrame, stratum: str, key: str, each: int, seed: int) -> DataFrame:
    """``each`` rows of every stratum by a seeded hash: the same rows on every run."""
    return latest_k(df, [stratum], each, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key))


def latest_k(df: DataFrame, part: Sequence[str], k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def precedence(df: DataFrame, keys: Sequence[str], tier: str, ranks: Mapping[str, int]) -> DataFrame:
    """First tier by rank wins for each key; unknown tiers come last."""
    rank = F.lit(len(ranks))
    for name, r in ranks.items():
        rank = F.when(F.col(tier) == name, r).otherwise(rank)
    return latest(df.withColumn("_k", rank), keys, F.col("_k"), F.col(tier)).drop("_k")


def newest_layout(df: DataFrame, keys: Sequence[str], layout: str, value: str) -> DataFrame:
    """(keys, value, layout, provenance): of several layouts the newest's value, and all layouts, newest first."""
    g = df.groupBy(*keys).agg(F.max_by(value, layout).alias("value"), F.max(layout).alias("layout"), F.sort_array(F.collect_set(layout), asc=False).alias("_all"))
    return g.select(*keys, "value", "layout", F.array_join(F.transform("_all", lambda x: x.cast("string")), ",").alias("provenance"))


def worst_first(df: DataFrame, ratio: str, key: str, floor: float) -> DataFrame:
    """``df`` with met, and the place of those below ``floor`` on a worklist, worst first, ties by key (a worklist is a report: one window)."""
    met = F.col(ratio) >= floor
    work = df.where(~met).withColumn("worst", F.row_number().over(Window.orderBy(ratio, key)).cast("long"))
    return df.where(met).withColumn("worst", F.lit(None).cast("long")).unionByName(work).withColumn("met", met)


def compare(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """status (added, removed, changed, same) of each key; nulls equal each other."""
    a = old.select(*keys, F.struct(*values).alias("_a"))
    b = new.select(*keys, F.struct(*values).alias("_b"))
    j = a.join(b, list(keys), "full")
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a").eqNullSafe(F.col("_b")), "same").otherwise("changed")
    return j.select(*keys, status.alias("status"))


def sequence_difference(expected: Column, actual: Column) -> Column:
    """Struct (missing, extra, in_order) of two arrays of names."""
    common = F.array_intersect(expected, actual)
    in_order = F.filter(actual, lambda x: F.array_contains(common, x)) == common
    return F.struct(F.array_except(expected, actual).alias("missing"), F.array_except(actual, expected).alias("extra"), in_order.alias("in_order"))


def reduce_observations(obs: DataFrame, series: Sequence[str], period: str, issued: str, version: str, value: str) -> DataFrame:
    """First asserted and current value of each observation and how often it changed."""
    w = Window.partitionBy(*series, period).orderBy(issued, version)
    changed = obs.withColumn("_c", (~F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1)).cast("int"))
    key = F.struct(issued, version)
    return changed.groupBy(*series, period).agg(F.min_by(value, key).alias("first"), F.max_by(value, key).alias("current"), F.sum("_c").alias("revisions"))


def promote_comparatives(df: DataFrame, keys: Sequence[str], index: str, current: str, prior: str, step: int = 4) -> DataFrame:
    """``current`` restated by the comparative that the report ``step`` periods later gives for it."""
    later = df.select(*keys, (F.col(index) - step).alias(index), F.col(prior).alias("_restated"))
    return df.join(later, [*keys, index], "left").withColumn("restated", F.coalesce("_restated", current)).drop("_restated")


def pick_fact(facts: DataFrame, keys: Sequence[str], end: str, start: str, dims: str, most_days: int = 100) -> DataFrame:
    """Fact of each key: without dimensions first, instants, else the shortest duration of at most ``most_days``."""
    days = F.coalesce(F.date_diff(F.col(end), F.col(start)), F.lit(0))
    return latest(facts.withColumn("_d", days).where(F.col("_d") <= most_days), keys, F.col(dims), F.col("_d"), F.col(start)).drop("_d")


def prior_fact(now: DataFrame, past: DataFrame, keys: Sequence[str], end: str, span: str, tolerance: int = 45, span_tolerance: int = 20) -> DataFrame:
    """The value a year earlier: end within ``tolerance`` days of it, like span; the nearest wins. Joined on the month, so a long series meets only its neighbours."""
    # an end that fits lies in the month of the day a year earlier or at most two months off
    month = lambda c: F.year(c) * 12 + F.month(c)
    near = 1 + tolerance // 28
    p = past.select(*keys, F.col(end).alias("_end"), F.col(span).alias("_span"), F.col("value").alias("prior"), F.explode(F.sequence(month(end) - near, month(end) + near)).alias("_month"))
    j = now.withColumn("_month", month(end) - 12).join(p, [*keys, "_month"]).drop("_month")
    gap = F.abs(F.date_diff(F.add_months(F.col(end), -12), F.col("_end")))
    j = j.withColumn("_gap", gap).where((F.col("_gap") <= tolerance) & (F.abs(F.col(span) - F.col("_span")) <= span_tolerance))
    return latest(j, [*keys, end], F.col("_gap"), F.col("_end")).drop("_gap", "_span").withColumnRenamed("_end", "prior_end")
