"""Metrics from statements and prose: blocks, header periods, rows, scale, company rules; all as column work on lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import safe_div
from .audit import unit_scale

#: A figure in either notation, with brackets for negatives.
FIGURE = r"\(?-?\d[\d.,]*\)?"


def header_period(token: Column) -> Column:
    """Period label of a table header: 1T2001, 2Q01, Q3 2001, 4Q-2001, FY2000, 2000 or a month and year; null for other text.

    Quarters give 2001Q1, years 2001FY; two-digit years are of this century below 70.
    """
    t = F.upper(F.trim(token))
    year = lambda y: F.when(F.length(y) == 4, y).when(y.cast("int") < 70, F.concat(F.lit("20"), y)).otherwise(F.concat(F.lit("19"), y))
    part = lambda p, i: F.regexp_extract(t, p, i)
    before, after, whole = r"^([1-4])\s*[TQ][\s\-']*(\d{4}|\d{2})$", r"^[TQ]([1-4])[\s\-']*(\d{4}|\d{2})$", r"^(?:FY|EJERCICIO|YEAR)?\s*(\d{4})$"
    month = r"^(MAR|JUN|SEP|DEC|DIC)[A-Z]*[\s\-/.]*(\d{4}|\d{2})$"
    quarter = F.when(part(month, 1) == "MAR", "1").when(part(month, 1) == "JUN", "2").when(part(month, 1) == "SEP", "3").otherwise("4")
    return (
        F.when(t.rlike(before), F.concat(year(part(before, 2)), F.lit("Q"), part(before, 1)))
        .when(t.rlike(after), F.concat(year(part(after, 2)), F.lit("Q"), part(after, 1)))
        .when(t.rlike(whole), F.concat(part(whole, 1), F.lit("FY")))
        .when(t.rlike(month), F.concat(year(part(month, 2)), F.lit("Q"), quarter))
    )


def lines_of(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(key, F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))


def statement_blocks(lines: DataFrame, key: str, headings: Mapping[str, str]) -> DataFrame:
    """``lines`` with statement: the last heading (a pattern by name) above each; heading lines and what stands before the first drop out."""
    name = F.lit(None).cast("string")
    for k, pattern in headings.items():
        name = F.when(F.lower("line").rlike(pattern), k).otherwise(name)
    w = Window.partitionBy(key).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    out = lines.withColumn("_h", name).withColumn("statement", F.last("_h", ignorenulls=True).over(w))
    return out.where("_h is null and statement is not null").drop("_h")


def table_values(lines: DataFrame, key: str, target: Column, metrics: Mapping[str, str], separator: str = r"\s*\|\s*") -> DataFrame:
    """(key, statement, metric, value): the target period's cell of the first row of each metric.

    A row with a period among its cells and no metric's label is a header for the rows below it in its statement;
    its column of the target period is read. A row's label takes the first metric whose pattern it matches.
    """
    cells = F.split(F.trim("line"), separator)
    x = lines.withColumn("_cells", cells).withColumn("_periods", F.transform("_cells", header_period))
    label = tx.normalize(tx.fold(F.col("_cells")[0]))
    name = F.lit(None).cast("string")
    for k, pattern in reversed(list(metrics.items())):
        name = F.when(label.rlike(pattern), k).otherwise(name)
    heads = F.exists("_periods", lambda p: p.isNotNull()) & name.isNull()
    w = Window.partitionBy(key, "statement").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_head", F.last(F.when(heads, F.col("_periods")), ignorenulls=True).over(w)).where(F.col("_head").isNotNull())
    place = F.array_position("_head", target).cast("int")
    value = F.when(place > 0, tx.parse_number(F.get("_cells", place - 1)))
    x = x.withColumns({"metric": name, "value": value}).where("metric is not null and value is not null")
    return x.groupBy(key, "statement", "metric").agg(F.min_by("value", "at").alias("value"))


def prose_figure(text: Column, label: str, gap: int = 40) -> Column:
    """The first figure within ``gap`` characters behind a label in prose, with the unit word behind it applied; null for none."""
    pattern = rf"(?i)(?:{label})[^\d\n;]{{0,{gap}}}?({FIGURE})\s*(millions?|millones|thousands?|miles)?"
    figure = F.regexp_extract(text, pattern, 1)
    clean = F.regexp_replace(figure, r"[.,]+$", "")
    return F.when(figure != "", tx.parse_number(clean) * unit_scale(F.regexp_extract(text, pattern, 2)))


def prose_ratio(text: Column, label: str, gap: int = 30) -> Column:
    """A percentage behind a label in prose, as a share; null for none."""
    figure = F.regexp_extract(text, rf"(?i)(?:{label})[^\d\n;]{{0,{gap}}}?(-?\d+(?:[.,]\d+)?)\s*%", 1)
    return F.when(figure != "", F.replace(figure, F.lit(","), F.lit(".")).cast("double") / 100)


def company_rules(docs: DataFrame, company: str, text: str, rules: DataFrame) -> DataFrame:
    """(company, metric, value) by each company's own rules: rows of company, metric, pattern (one group), scale.

    Rules are data: a new company is new rows. They join their company's documents; the first match counts.
    """
    j = docs.join(rules, company)
    found = F.expr(f"regexp_extract(`{text}`, pattern, 1)")
    return j.withColumn("_f", found).where("_f != ''").select(*[c for c in docs.columns if c != text], "metric", (tx.parse_number("_f") * F.col("scale")).alias("value"))


def orient_by_growth(a: str, b: str, growth: str, tolerance: float = 0.01) -> tuple[Column, Column]:
    """(current, prior) of two figures whose order a stated growth tells; as given where it tells nothing."""
    x, y, g = F.col(a), F.col(b), F.col(growth)
    straight, turned = F.abs(safe_div(x, y) - 1 - g), F.abs(safe_div(y, x) - 1 - g)
    swap = F.coalesce((turned < straight) & (turned <= tolerance), F.lit(False))
    return F.when(swap, y).otherwise(x), F.when(swap, x).otherwise(y)


def coverage_of(docs: DataFrame, key: str, summary: str, facts: str, n: int) -> DataFrame:
    """(key, facts, covered, coverage): of the first ``n`` gold facts (an array of texts) those whose words all stand in the summary."""
    words = tx.words(summary)
    some = F.slice(F.col(facts), 1, n)
    held = F.filter(some, lambda f: F.size(F.array_except(tx.words(f), words)) == 0)
    return docs.select(key, F.size(some).cast("long").alias("facts"), F.size(held).cast("long").alias("covered"), safe_div(F.size(held).cast("double"), F.size(some).cast("double")).alias("coverage"))


def zero_shot_card(df: DataFrame, group: str, got: str, want: str, expected: Sequence[str], metric: str, tolerance: float = 0.01) -> DataFrame:
    """Per company: cells expected, filled and compared, coverage, agreement, and a flag where either is low."""
    both = F.col(got).isNotNull() & F.col(want).isNotNull()
    near = F.abs(F.col(got) - F.col(want)) <= tolerance * F.greatest(F.abs(F.col(got)), F.abs(F.col(want)))
    g = df.where(F.col(metric).isin(list(expected))).groupBy(group).agg(F.count("*").alias("expected"), F.count(got).alias("filled"), F.count_if(both).alias("compared"), F.count_if(both & near).alias("agreed"))
    out = g.withColumns({"coverage": safe_div(F.col("filled").cast("double"), F.col("expected").cast("double")), "agreement": safe_div(F.col("agreed").cast("double"), F.col("compared").cast("double"))})
    flag = F.when(F.col("compared") == 0, "nothing compared").when(F.col("agreement") < 0.9, "disagrees").when(F.col("coverage") < 0.8, "thin").otherwise("ok")
    return out.withColumn("flag", flag)
