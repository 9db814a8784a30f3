"""Multiples, peers, bands, reconciliation and coverage states."""

from __future__ import annotations

import ast
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import admit, col, near_reference, safe_div

#: Strict plausibility bands of multiples; percentages have none.
BANDS: dict[str, tuple[float | None, float | None]] = {"pe": (0.0, 100.0), "ev_ebitda": (0.0, 60.0), "ev_sales": (0.0, 30.0), "p_bv": (0.0, 25.0), "p_ffo": (0.0, 60.0), "roe": (None, None), "div_yield": (None, None)}


def enterprise_value() -> tuple[Column, Column]:
    """Market capitalisation and enterprise value from price, shares, debt, cash and minorities."""
    cap = F.col("price") * F.col("shares")
    return cap, cap + F.col("debt") - F.col("cash") + F.coalesce("minorities", F.lit(0.0))


def multiples(kind: str = "industrial") -> dict[str, Column]:
    """Multiples by name for an industrial company, a bank or a property trust; null operands give null."""
    cap, ev = enterprise_value()
    common = {"pe": safe_div(cap, F.col("net_income")), "p_bv": safe_div(cap, F.col("equity")), "roe": safe_div(F.col("net_income"), F.col("equity"))}
    if kind == "industrial":
        return common | {"ev_ebitda": safe_div(ev, F.col("ebitda")), "ev_sales": safe_div(ev, F.col("revenue")), "nd_ebitda": safe_div(F.col("debt") - F.col("cash"), F.col("ebitda"))}
    if kind == "bank":
        tangible = F.col("equity") - F.coalesce("intangibles", F.lit(0.0))
        return common | {"p_tbv": safe_div(cap, tangible), "rotce": safe_div(F.col("net_income"), tangible)}
    ffo = F.col("net_income") + F.col("depreciation") - F.coalesce("gains", F.lit(0.0))
    return {"p_ffo": safe_div(cap, ffo), "ev_noi": safe_div(ev, F.col("noi")), "ltv": safe_div(F.col("debt"), F.col("assets")), "ffo_yield": safe_div(ffo, cap)}


def admitted(df: DataFrame, names: Sequence[str], subject: Column | None = None) -> DataFrame:
    """Implausible values as null, rows kept; the subject's own values are never blanked."""
    for n in names:
        kept = admit(n, *BANDS.get(n, (None, None)))
        df = df.withColumn(n, kept if subject is None else F.when(subject, F.col(n)).otherwise(kept))
    return df


def peer_medians(df: DataFrame, group: str, key: str, names: Sequence[str]) -> DataFrame:
    """Per company and multiple: value, exact median of its group without it, premium to that median.

    Values are ranked within their group; a median without one member lies among the few in the middle, which
    are one row a group, so no group is collected and no pairs are formed.
    """
    long = df.select(group, key, F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])).alias("m")).select(group, key, "m.name", "m.value")
    w = Window.partitionBy(group, "name")
    ranked = long.withColumn("_n", F.count("value").over(w)).withColumn("_r", F.when(F.col("value").isNotNull(), F.row_number().over(w.orderBy(F.asc_nulls_last("value"), key)) - 1))
    low, high = F.floor((F.col("_n") - 2) / 2), F.floor((F.col("_n") - 1) / 2)
    at = {"_c0": low, "_c1": low + 1, "_c2": high, "_c3": high + 1}
    middle = ranked.groupBy(group, "name").agg(*[F.max(F.when(F.col("_r") == i, F.col("value"))).alias(c) for c, i in at.items()])
    out = ranked.join(middle, [group, "name"])
    without = (F.when(low >= F.col("_r"), F.col("_c1")).otherwise(F.col("_c0")) + F.when(high >= F.col("_r"), F.col("_c3")).otherwise(F.col("_c2"))) / 2
    median = F.when(F.col("_r").isNull(), (F.col("_c2") + F.col("_c1")) / 2).when(F.col("_n") > 1, without)
    return out.select(group, key, "name", "value", median.alias("peer_median")).withColumn("premium", safe_div(F.col("value"), F.col("peer_median")) - 1)


def reconcile(filing: Column | str, other: Column | str, ref: Column | str) -> tuple[Column, Column]:
    """The filing's value where its size fits the reference, else the other source's; and the source taken."""
    a, b = col(filing), col(other)
    ok = a.isNotNull() & near_reference(a, ref)
    return F.when(ok, a).otherwise(F.coalesce(b, a)), F.when(ok, "filing").when(b.isNotNull(), "other").when(a.isNotNull(), "filing")


def share_scale(shares: str, income: str, eps: str) -> Column:
    """Shares at the power of a thousand whose earnings per share come nearest to the reported one."""
    options = [F.col(shares) * 10.0**p for p in (0, 3, -3, 6, -6)]
    gaps = [F.struct(F.abs(F.log10(F.abs(safe_div(safe_div(F.col(income), o), F.col(eps))))).alias("gap"), F.lit(i).alias("i"), o.alias("shares")) for i, o in enumerate(options)]
    return F.when(F.col(eps).isNotNull() & (F.col(income) != 0) & (F.col(shares) != 0), F.least(*gaps)["shares"]).otherwise(F.col(shares))


def dupont() -> dict[str, Column]:
    margin, turnover, leverage = safe_div("net_income", "revenue"), safe_div("revenue", "assets"), safe_div("assets", "equity")
    return {"net_margin": margin, "asset_turnover": turnover, "leverage": leverage, "roe": margin * turnover * leverage}


def liquidity() -> dict[str, Column]:
    """Current and quick ratio, working capital, and the cash conversion cycle in days."""
    dio, dso, dpo = 365 * safe_div("inventory", "costs"), 365 * safe_div("receivables", "revenue"), 365 * safe_div("payables", "costs")
    return {"current_ratio": safe_div("current_assets", "current_liabilities"), "quick_ratio": safe_div(F.col("current_assets") - F.col("inventory"), F.col("current_liabilities")), "working_capital": F.col("current_assets") - F.col("current_liabilities"), "cash_cycle": dio + dso - dpo}


def poison(name: str, reit: Column) -> Column:
    """A margin outside +-100 % (+-300 % for property trusts) as null."""
    limit = F.when(reit, 3.0).otherwise(1.0)
    return F.when(F.abs(F.col(name)) <= limit, F.col(name))


def sum_of_parts(segments: DataFrame, company: str, ebitda: str, multiple: str, totals: DataFrame) -> DataFrame:
    """Implied equity and price: segments at their multiples, one missing segment filled by the residual, less net debt.

    ``totals`` has a row per company: ebitda, net_debt, minorities, shares.
    """
    s = segments.groupBy(company).agg(F.sum(F.col(ebitda) * F.col(multiple)).alias("_v"), F.sum(ebitda).alias("_e"), F.count(F.when(F.col(ebitda).isNull(), 1)).alias("_missing"), F.max(F.when(F.col(ebitda).isNull(), F.col(multiple))).alias("_m"))
    j = s.join(totals, company)
    residual = F.when(F.col("_missing") == 1, (F.col("ebitda") - F.col("_e")) * F.col("_m")).otherwise(0.0)
    equity = F.col("_v") + residual - F.col("net_debt") - F.coalesce("minorities", F.lit(0.0))
    return j.select(company, equity.alias("equity_value"), safe_div(equity, F.col("shares")).alias("implied_price"), safe_div("_e", "ebitda").alias("covered"))


def cell_state(value: Column, template: Column, source: Column) -> Column:
    """na_template over filled over na_source over gap."""
    return F.when(~template, "na_template").when(value.isNotNull(), "filled").when(~source, "na_source").otherwise("gap")


def placeholder_share(value: str, step: float) -> Column:
    """Aggregate: share of values that are whole multiples of ``step``."""
    return F.avg((F.pmod(F.col(value), F.lit(step)) == 0).cast("double"))


def compile_metric(expression: str) -> Column:
    """Column of an arithmetic expression over metric names: + - * / and parentheses only; a missing operand or a zero divisor gives null."""

    def walk(node: ast.AST) -> Column:
        if isinstance(node, ast.Expression):
            return walk(node.body)
        if isinstance(node, ast.Name):
            return F.col(node.id)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)) and not isinstance(node.value, bool):
            return F.lit(float(node.value))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -walk(node.operand)
        if isinstance(node, ast.BinOp):
            a, b = walk(node.left), walk(node.right)
            for kind, f in ((ast.Add, lambda: a + b), (ast.Sub, lambda: a - b), (ast.Mult, lambda: a * b), (ast.Div, lambda: safe_div(a, b))):
                if isinstance(node.op, kind):
                    return f()
        raise ValueError(f"not allowed in a metric: {ast.dump(node)[:60]}")

    return walk(ast.parse(expression, mode="eval"))


def derived(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """``df`` with each rule's metric, in order; one that exists is filled where null."""
    for name, expression in rules.items():
        value = compile_metric(expression)
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


