"""Valuation blocks: named metrics of a company, per-year growth and bands, and the dispatcher that builds a model of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div
from .valuation import enterprise_value

Metrics = dict[str, Column]


def c(name: str) -> Column:
    return F.col(name)


def snapshot() -> Metrics:
    cap, ev = enterprise_value()
    return {"price": c("price"), "shares": c("shares"), "market_cap": cap, "ev": ev, "pe": safe_div(cap, "net_income"), "ev_ebitda": safe_div(ev, "ebitda"), "ev_sales": safe_div(ev, "revenue")}


def margins() -> Metrics:
    return {"gross_margin": safe_div(c("revenue") - c("costs"), "revenue"), "ebit_margin": safe_div(c("ebitda") - c("depreciation"), "revenue"), "ebitda_margin": safe_div("ebitda", "revenue"), "net_margin": safe_div("net_income", "revenue")}


def cash() -> Metrics:
    """Free cash flow, its yield on market value, and how much of ebitda becomes cash."""
    cap, _ = enterprise_value()
    fcf = c("ebitda") - c("capex")
    return {"fcf": fcf, "fcf_yield": safe_div(fcf, cap), "fcf_conversion": safe_div(fcf, "ebitda"), "inventory_turns": safe_div("costs", "inventory"), "dividend_yield": safe_div("dividends", cap), "cash_to_debt": safe_div("cash", "debt")}


def returns() -> Metrics:
    """Return on equity, assets and invested capital (after a flat tax rate on operating income)."""
    invested = c("equity") + c("debt") - c("cash")
    return {"roe": safe_div("net_income", "equity"), "roa": safe_div("net_income", "assets"), "roic": safe_div((c("ebitda") - c("depreciation")) * 0.7, invested)}


def replacement(scale: float = 1e3) -> Metrics:
    """Replacement value of the floor area, and what the market pays of it."""
    _, ev = enterprise_value()
    value = c("area") * c("unit_cost") / scale
    return {"replacement_value": value, "ev_to_replacement": safe_div(ev, value)}


def bank() -> Metrics:
    """Book values, multiples and returns of a bank; a return on equity that can't be computed is the supplied one."""
    cap, _ = enterprise_value()
    tangible = c("equity") - F.coalesce(c("intangibles"), F.lit(0.0))
    return {
        "book_value": safe_div("equity", "shares"),
        "tangible_book": safe_div(tangible, c("shares")),
        "pe": safe_div(cap, "net_income"),
        "p_bv": safe_div(cap, "equity"),
        "p_tbv": safe_div(cap, tangible),
        "roe": F.coalesce(safe_div("net_income", "equity"), c("roe_supplied")),
        "rotce": safe_div(c("net_income"), tangible),
        "net_interest_margin": safe_div(c("revenue") - c("costs"), c("assets")),
        "efficiency": safe_div("costs", "revenue"),
        "cost_of_risk": safe_div("provisions", "receivables"),
    }


def trust() -> Metrics:
    """Funds from operations (reconstructed where none is reported), income margin, occupancy and loan to value of a property trust."""
    cap, ev = enterprise_value()
    ffo = F.coalesce(c("ffo_reported"), c("net_income") + c("depreciation") - F.coalesce(c("gains"), F.lit(0.0)))
    return {"ffo": ffo, "p_ffo": safe_div(cap, ffo), "noi_margin": safe_div("noi", "revenue"), "occupancy": safe_div("area_let", "area"), "ev_sales": safe_div(ev, "revenue"), "ltv": safe_div("debt", "assets")}


#: Blocks of a model: which companies have them, and their metrics.
BLOCKS: dict[str, tuple[str | None, Callable[[], Metrics]]] = {"snapshot": (None, snapshot), "margins": ("industrial", margins), "cash": ("industrial", cash), "returns": (None, returns), "replacement": ("trust", replacement), "bank": ("bank", bank), "trust": ("trust", trust)}


def build_model(companies: DataFrame, spec: Sequence[str], key: str = "company", template: str = "template") -> DataFrame:
    """(company, ordinal, block, metric, value): the blocks of ``spec`` in order, each for the companies whose template has it."""
    out = None
    for i, name in enumerate(spec):
        kind, metrics = BLOCKS[name]
        rows = companies if kind is None else companies.where(F.col(template) == kind)
        cells = F.array(*[F.struct(F.lit(n).alias("metric"), v.cast("double").alias("value")) for n, v in metrics().items()])
        part = rows.select(key, F.lit(i).alias("ordinal"), F.lit(name).alias("block"), F.explode(cells).alias("_c")).select(key, "ordinal", "block", "_c.metric", "_c.value")
        out = part if out is None else out.unionByName(part)
    return out


def corroborated_ffo(tolerance: float = 0.1) -> tuple[Column, Column]:
    """(funds from operations, how it is known): the reported value where the reconstruction agrees, else the reconstruction, marked."""
    own = c("net_income") + c("depreciation") - F.coalesce(c("gains"), F.lit(0.0))
    reported = c("ffo_reported")
    agrees = F.abs(reported - own) <= tolerance * F.greatest(F.abs(reported), F.abs(own))
    state = F.when(reported.isNull() & own.isNull(), "none").when(reported.isNull(), "reconstructed").when(own.isNull(), "reported").when(agrees, "corroborated").otherwise("disputed")
    return F.when(state.isin("corroborated", "reported"), reported).otherwise(own), state


def growth(years: DataFrame, key: str, year: str, value: str, spans: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Per company: last value, its change on the year before, compound growth over each span, and stability.

    A span starts in the earliest year it covers and uses the years that really lie between; both ends must be
    positive. Stability is the population deviation of the yearly changes.
    """
    past = years.select(key, (F.col(year) + 1).alias(year), F.col(value).alias("_p"))
    w = Window.partitionBy(key)
    y = years.select(key, year, value).join(past, [key, year], "left").withColumns({"_g": safe_div(value, "_p") - 1, "_last": F.max(year).over(w)})
    first = lambda s: F.when(F.col(year) >= F.col("_last") - s, F.struct(F.col(year).alias("y"), F.col(value).alias("v")))
    g = y.groupBy(key).agg(F.max("_last").alias("_last"), F.max_by(value, year).alias("last"), F.max(F.when(F.col(year) == F.col("_last"), F.col("_g"))).alias("yoy"), F.stddev_pop("_g").alias("stability"), *[F.min(first(s)).alias(f"_f{s}") for s in spans])

    def cagr(s: int) -> Column:
        span = F.col("_last") - F.col(f"_f{s}.y")
        return F.when((span > 0) & (F.col("last") > 0) & (F.col(f"_f{s}.v") > 0), F.pow(F.col("last") / F.col(f"_f{s}.v"), 1 / span) - 1)

    return g.select(key, "last", "yoy", *[cagr(s).alias(f"cagr_{s}") for s in spans], "stability")


def historical_bands(years: DataFrame, key: str, year: str, multiples: Mapping[str, tuple[Column, float, float]]) -> DataFrame:
    """(company, metric, years, mean, low, high, current, z, rank) of each multiple over the years.

    Values outside their plausible borders count as missing. The band is one population deviation around the
    mean; current is the last year's value, rank the share of years not above it.
    """
    cells = F.array(*[F.struct(F.lit(n).alias("metric"), F.when((v > lo) & (v < hi), v).alias("v")) for n, (v, lo, hi) in multiples.items()])
    long = years.select(key, year, F.explode(cells).alias("_c")).select(key, year, "_c.metric", "_c.v")
    last = F.last("v").over(Window.partitionBy(key, "metric").orderBy(year).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    long = long.withColumn("_now", last)
    g = long.groupBy(key, "metric").agg(F.count("v").alias("years"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("_sd"), F.any_value("_now").alias("current"), F.avg(F.when(F.col("v").isNotNull() & F.col("_now").isNotNull(), (F.col("v") <= F.col("_now")).cast("double"))).alias("rank"))
    return g.select(key, "metric", "years", "mean", (F.col("mean") - F.col("_sd")).alias("low"), (F.col("mean") + F.col("_sd")).alias("high"), "current", safe_div(F.col("current") - F.col("mean"), F.col("_sd")).alias("z"), "rank")


def stubs(df: DataFrame, core: Sequence[str]) -> DataFrame:
    """Rows of a prospectus: every core metric is zero or missing."""
    empty = [F.coalesce(F.col(m), F.lit(0.0)) == 0 for m in core]
    out = empty[0]
    for e in empty[1:]:
        out = out & e
    return df.withColumn("stub", out)
