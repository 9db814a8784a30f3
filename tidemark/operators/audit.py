"""Audit gates: accounting rules, reconciliation findings, independent recomputation, units, sheet formulas, answer checks."""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import safe_div


def close(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))


def accounting_rules(tolerance: float = 0.02) -> dict[str, Column]:
    """Thirteen rules by name; a missing operand gives null, which is no verdict."""
    c = F.col
    return {
        "balance_sheet": close(c("assets"), c("liabilities") + c("equity"), tolerance),
        "gross_profit": close(c("gross_profit"), c("revenue") - c("costs"), tolerance),
        "ebitda": close(c("ebitda"), c("operating_income") + c("depreciation"), tolerance),
        "net_income_below_revenue": F.abs(c("net_income")) <= F.abs(c("revenue")),
        "net_debt": close(c("net_debt"), c("debt") - c("cash"), tolerance),
        "revenue_positive": c("revenue") > 0,
        "costs_not_negative": c("costs") >= 0,
        "operating_below_gross": c("operating_income") <= c("gross_profit"),
        "ebitda_above_operating": c("ebitda") >= c("operating_income"),
        "cash_within_assets": c("cash") <= c("assets"),
        "debt_within_liabilities": c("debt") <= c("liabilities") * (1 + tolerance),
        "equity_within_assets": c("equity") <= c("assets"),
        "net_margin_range": F.abs(safe_div("net_income", "revenue")) <= 1,
    }


def judged(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """(keys, rule, ok) for each rule whose operands are there."""
    listed = F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("ok")) for k, v in rules.items()])
    return df.select(*keys, F.explode(listed).alias("_v")).select(*keys, "_v.rule", "_v.ok").where("ok is not null")


def findings(df: DataFrame, key: str, structural: Mapping[str, Column], golden: Mapping[str, tuple[Column, Column]], oracle: Mapping[str, tuple[Column, Column]], near: float = 0.001, far: float = 0.05) -> DataFrame:
    """(key, kind, check, severity) of every check that fails.

    ``structural`` are identities that must hold; ``golden`` are pairs of value and approved value, an error off by
    over ``near``; ``oracle`` are pairs of value and another source's, a warning off by over ``far``. A missing side
    is no finding.
    """
    off = lambda pair, by: ~close(pair[0], pair[1], by)
    checks = [("structural", n, "error", ~v) for n, v in structural.items()] + [("golden", n, "error", off(p, near)) for n, p in golden.items()] + [("oracle", n, "warning", off(p, far)) for n, p in oracle.items()]
    listed = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("check"), F.lit(s).alias("severity"), F.coalesce(v, F.lit(False)).alias("_hit")) for k, n, s, v in checks])
    return df.select(key, F.explode(F.filter(listed, lambda f: f["_hit"])).alias("_f")).select(key, "_f.kind", "_f.check", "_f.severity")


def math_audit(model: DataFrame, recomputed: DataFrame, keys: Sequence[str], value: str = "value", tolerance: float = 1e-6) -> DataFrame:
    """Per metric: cells, those that agree with an independent recomputation, differ, or stand on one side only; and the gate.

    The gate is open where no cell differs and none is missing.
    """
    a, b = model.select(*keys, F.col(value).alias("_a"), F.lit(1).alias("_in")), recomputed.select(*keys, F.col(value).alias("_b"), F.lit(1).alias("_re"))
    j = a.join(b, list(keys), "full")
    same = F.col("_a").eqNullSafe(F.col("_b")) | F.coalesce(close(F.col("_a"), F.col("_b"), tolerance), F.lit(False))
    one = F.col("_in").isNull() | F.col("_re").isNull()
    out = j.groupBy("metric").agg(F.count("*").alias("cells"), F.count_if(same & ~one).alias("agree"), F.count_if(~same & ~one).alias("differ"), F.count_if(one).alias("one_sided"))
    return out.withColumn("open", (F.col("differ") == 0) & (F.col("one_sided") == 0))


#: What words in a unit multiply a figure by.
SCALES = {"thousand": 1e3, "thousands": 1e3, "miles": 1e3, "million": 1e6, "millions": 1e6, "millones": 1e6}


def unit_scale(unit: Column) -> Column:
    """Multiplier named in a unit, 1 where none is."""
    out = F.lit(1.0)
    for word, by in SCALES.items():
        out = F.when(F.lower(unit).rlike(rf"(?<![a-z]){word}(?![a-z])"), by).otherwise(out)
    return out


def reporting_units(facts: DataFrame, company: str, unit: str, rates: Mapping[str, float]) -> DataFrame:
    """Per company the currency most of its facts name (ties by name), and the divisor that brings its facts to millions of the base currency."""
    found = F.regexp_extract(F.upper(unit), "(" + "|".join(sorted(rates)) + ")", 1)
    counts = facts.where(found != "").groupBy(company, found.alias("currency")).agg(F.count("*").alias("n"), F.max(unit_scale(F.col(unit))).alias("scale"))
    best = F.row_number().over(Window.partitionBy(company).orderBy(F.desc("n"), "currency"))
    rate = F.lit(None).cast("double")
    for name, r in rates.items():
        rate = F.when(F.col("currency") == name, r).otherwise(rate)
    return counts.withColumn("_r", best).where("_r = 1").select(company, "currency", "n", (1e6 / (F.col("scale") * rate)).alias("divisor"))


_RANGE = re.compile(r"\b([A-Z])(\d*):([A-Z])(\d*)\b")
_FUNCTIONS = {"SUM", "AVERAGE", "MIN", "MAX", "ABS", "ROUND", "IF", "COUNT"}


def sheet_formula(formula: str) -> Column:
    """Column of a sheet formula over columns A to Z of the same row: arithmetic, comparisons and a few functions.

    Ranges such as A:C list columns. Anything else is refused. A missing operand or a zero divisor gives null;
    SUM, AVERAGE, MIN, MAX and COUNT pass over missing cells, as sheets do.
    """
    body = _RANGE.sub(lambda m: ",".join(chr(x) for x in range(ord(m[1]), ord(m[3]) + 1)), formula.lstrip("="))
    body = re.sub(r"(?<![<>=!])=(?!=)", "==", body.replace("<>", "!=")).replace("^", "**")

    def call(name: str, xs: list[Column]) -> Column:
        if name == "ABS":
            return F.abs(xs[0])
        if name == "ROUND":
            return F.call_function("round", xs[0], F.lit(0) if len(xs) == 1 else xs[1].cast("int"))
        if name == "IF":
            return F.when(xs[0], xs[1]).otherwise(xs[2])
        n = sum((x.isNotNull().cast("int") for x in xs[1:]), xs[0].isNotNull().cast("int"))
        total = sum((F.coalesce(x, F.lit(0.0)) for x in xs[1:]), F.coalesce(xs[0], F.lit(0.0)))
        pick = {"MIN": F.array_min(F.array(*xs)), "MAX": F.array_max(F.array(*xs)), "COUNT": n.cast("double"), "SUM": total, "AVERAGE": safe_div(total, n)}
        return pick[name]

    def walk(e: ast.AST) -> Column:
        if isinstance(e, ast.Expression):
            return walk(e.body)
        if isinstance(e, ast.Constant) and type(e.value) in (int, float):
            return F.lit(float(e.value))
        if isinstance(e, ast.Name) and re.fullmatch("[A-Z]", e.id):
            return F.col(e.id)
        if isinstance(e, ast.UnaryOp) and isinstance(e.op, ast.USub):
            if isinstance(e.operand, ast.BinOp) and isinstance(e.operand.op, ast.Pow):  # sheets negate before they raise
                return F.pow(-walk(e.operand.left), walk(e.operand.right))
            return -walk(e.operand)
        if isinstance(e, ast.Call) and isinstance(e.func, ast.Name) and e.func.id in _FUNCTIONS and not e.keywords:
            return call(e.func.id, [walk(a) for a in e.args])
        if isinstance(e, ast.Compare) and len(e.ops) == 1:
            a, b = walk(e.left), walk(e.comparators[0])
            for kind, f in ((ast.Gt, a > b), (ast.GtE, a >= b), (ast.Lt, a < b), (ast.LtE, a <= b), (ast.Eq, a == b), (ast.NotEq, a != b)):
                if isinstance(e.ops[0], kind):
                    return f
        if isinstance(e, ast.BinOp):
            a, b = walk(e.left), walk(e.right)
            for kind, f in ((ast.Add, lambda: a + b), (ast.Sub, lambda: a - b), (ast.Mult, lambda: a * b), (ast.Div, lambda: safe_div(a, b)), (ast.Pow, lambda: F.pow(a, b))):
                if isinstance(e.op, kind):
                    return f()
        raise ValueError(f"not allowed in a sheet formula: {ast.dump(e)[:60]}")

    return walk(ast.parse(body, mode="eval"))


def answer_checks(df: DataFrame, answer: str, directions: Sequence[str] = ("up", "down", "flat")) -> DataFrame:
    """A model's JSON answers, checked: direction, conviction in 0..1, reason; a bad answer becomes neutral with why.

    Neutral is flat with conviction 0, so that a broken answer never moves a decision.
    """
    a = F.from_json(answer, "direction string, conviction double, reason string")
    direction = F.lower(F.trim(a["direction"]))
    why = F.when(a.isNull() | a["direction"].isNull(), "not readable").when(~direction.isin(list(directions)), "unknown direction").when(a["conviction"].isNull(), "no conviction").when((a["conviction"] < 0) | (a["conviction"] > 1), "conviction out of range")
    return df.withColumns({"why": why, "direction": F.when(why.isNull(), direction).otherwise("flat"), "conviction": F.when(why.isNull(), a["conviction"]).otherwise(0.0)})
