"""Series checks and the cleaning cascade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div


def median_of(xs: Column) -> Column:
    """Exact median of an array of doubles; null if empty."""
    s = F.sort_array(xs)
    n = F.size(s)
    at = lambda i: F.get(s, i.cast("int"))
    return F.when(n > 0, (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2)


def magnitude_breaks(df: DataFrame, keys: Sequence[str], order: str, value: str, factor: float = 4.0, span: int = 4, points: int = 5) -> DataFrame:
    """``df`` with reference (median size of up to ``span`` non-zero neighbours each side, the series' where fewer than three) and suspect."""
    w = Window.partitionBy(*keys).orderBy(order)
    size = F.when(F.col(value) != 0, F.abs(value))
    near = F.concat(F.collect_list(size).over(w.rowsBetween(-span, -1)), F.collect_list(size).over(w.rowsBetween(1, span)))
    whole = Window.partitionBy(*keys)
    df = df.withColumns({"_near": near, "_series": F.median(size).over(whole), "_n": F.count(size).over(whole)})
    df = df.withColumn("reference", F.when(F.size("_near") >= 3, median_of(F.col("_near"))).otherwise(F.col("_series")))
    ratio = safe_div(F.abs(F.col(value)), F.col("reference"))
    suspect = (F.col("_n") >= points) & (F.col(value) != 0) & ((ratio > factor) | (ratio < 1 / factor))
    return df.withColumn("suspect", F.coalesce(suspect, F.lit(False))).drop("_near", "_series", "_n")


def quarantine(df: DataFrame, metric: str, value: str, factor: float = 300.0, exempt: str | None = None) -> DataFrame:
    """Marks values beyond ``factor`` times the metric's median size, exempt rows aside."""
    med = df.where(F.col(value) != 0).groupBy(metric).agg(F.median(F.abs(value)).alias("_m"))
    out = df.join(med, metric, "left")
    far = F.abs(F.col(value)) > factor * F.col("_m")
    if exempt:
        far = far & ~F.coalesce(F.col(exempt), F.lit(False))
    return out.withColumn("quarantined", F.coalesce(far, F.lit(False))).drop("_m")


def clean_cascade(df: DataFrame, keys: Sequence[str], order: str, value: str, bound: float = 1e15, jump: float = 2.0) -> DataFrame:
    """Rule (R0..R3 or null) that drops a value, each rule over what those before it left.

    R0 not finite; R1 beyond the bound; R2 of two neighbours apart by over ``jump`` decades, the one farther
    from the series' median; R3 apart by that from the median of its clean neighbours (four each side, at least
    two), flags of this rule itself not counted.
    """
    w, whole = Window.partitionBy(*keys).orderBy(order), Window.partitionBy(*keys)
    v = F.col(value)
    df = df.withColumn("rule", F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), "R0").when(F.abs(v) > bound, "R1"))
    size = F.when(F.col("rule").isNull() & (v != 0), F.log10(F.abs(v)))
    df = df.withColumn("_l", size).withColumn("_m", F.median("_l").over(whole))
    far = F.abs(F.col("_l") - F.col("_m"))
    df = df.withColumn("_d", far)
    for side in (F.lag, F.lead):
        other, odist = side("_l").over(w), side("_d").over(w)
        df = df.withColumn("_hit", F.when((F.abs(F.col("_l") - other) > jump) & (F.col("_d") > odist), True) if side is F.lag else F.coalesce(F.col("_hit"), F.when((F.abs(F.col("_l") - other) > jump) & (F.col("_d") > odist), True)))
    df = df.withColumn("rule", F.coalesce("rule", F.when(F.col("_hit"), "R2")))
    ok = F.when(F.col("rule").isNull(), F.col("_l"))
    near = F.concat(F.collect_list(ok).over(w.rowsBetween(-4, -1)), F.collect_list(ok).over(w.rowsBetween(1, 4)))
    df = df.withColumn("_near", near)
    off = (F.size("_near") >= 2) & (F.abs(ok - median_of(F.col("_near"))) > jump)
    return df.withColumn("rule", F.coalesce("rule", F.when(off, "R3"))).drop("_l", "_m", "_d", "_hit", "_near")


def snap_scale(df: DataFrame, keys: Sequence[str], a: str, b: str, tolerance: float = 0.1) -> DataFrame:
    """Power of ten (-9..9) nearest to the median ratio a / b of each group, null if off by over ``tolerance`` decades."""
    ratio = df.where((F.col(a) != 0) & (F.col(b) != 0)).groupBy(*keys).agg(F.median(F.abs(F.col(a) / F.col(b))).alias("ratio"), F.count("*").alias("n"))
    power = F.round(F.log10("ratio"))
    ok = (F.abs(F.log10("ratio") - power) <= tolerance) & (F.abs(power) <= 9)
    return ratio.withColumn("scale", F.when(ok, F.pow(F.lit(10.0), power)))


def cell_suspects(df: DataFrame, metric: str, value: str, order: str, keys: Sequence[str], positive: Sequence[str]) -> DataFrame:
    """Why a cell is suspect: sign, range (over 100 times the median size) or magnitude; null if it isn't."""
    checked = quarantine(magnitude_breaks(df, keys, order, value), metric, value, 100.0)
    why = F.when(F.col(metric).isin(list(positive)) & (F.col(value) < 0), "sign").when(F.col("quarantined"), "range").when(F.col("suspect"), "magnitude")
    return checked.withColumn("why", why)


def price_quality(bars: DataFrame, symbol: str, factor: str, low: float, high: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(bars of symbols with ``least`` sound ones, log of dropped bars and symbols by reason)."""
    good = bars.where((F.col(factor) > low) & (F.col(factor) <= high))
    counts = good.groupBy(symbol).agg(F.count("*").alias("_n"))
    thin = bars.select(symbol).distinct().join(counts, symbol, "left").where(F.coalesce("_n", F.lit(0)) < least).select(symbol)
    kept = good.join(thin, symbol, "left_anti")
    log = bars.join(good.select(symbol).distinct(), symbol, "left").where(~((F.col(factor) > low) & (F.col(factor) <= high))).groupBy(symbol).agg(F.count("*").alias("n")).withColumn("reason", F.lit("factor"))
    short = thin.join(counts, symbol, "left").select(symbol, F.coalesce("_n", F.lit(0)).alias("n"), F.lit("too few bars").alias("reason"))
    return kept, log.unionByName(short)


def validations(df: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """(row columns, rule, ok) for each rule whose operands are all there.

    Needs revenue, costs, gross_profit, ebitda, depreciation, operating_income, debt, cash, net_debt, assets,
    liabilities, equity.
    """
    c = F.col
    close = lambda a, b: F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
    rules = {
        "balance_sheet": close(c("assets"), c("liabilities") + c("equity")),
        "gross_profit": close(c("gross_profit"), c("revenue") - c("costs")),
        "ebitda": close(c("ebitda"), c("operating_income") + c("depreciation")),
        "net_debt": close(c("net_debt"), c("debt") - c("cash")),
        "revenue_positive": c("revenue") > 0,
        "costs_not_negative": c("costs") >= 0,
        "margin_order": c("operating_income") <= c("gross_profit"),
    }
    listed = F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("ok")) for k, v in rules.items()])
    return df.withColumn("_v", F.explode(listed)).select(*df.columns, "_v.rule", "_v.ok").where("ok is not null")
