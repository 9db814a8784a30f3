"""Tables from the positions of words on pages: lines by height, columns by gaps, figures under the nearest header.

Everything is windows over one page's words and joins of a page's figures with its few header cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .extraction import FIGURE, header_period

#: Words whose tops differ by no more are on one line; words of one cell are no farther apart; a figure may stand so far beside its column.
LINE, GAP, REACH = 3.0, 8.0, 25.0


def lines(words: DataFrame, page: Sequence[str], tolerance: float = LINE) -> DataFrame:
    """``words`` (page, text, x0, x1, top) with line from 0: a word starts a new one when it is lower than the word above by more than the tolerance.

    So a line may slope, as scans do, while neighbouring words differ little. Words without text or position are left out.
    """
    kept = words.where("trim(text) != '' and x0 is not null and x1 is not null and top is not null")
    down = Window.partitionBy(*page).orderBy("top", "x0", "text")
    new = F.coalesce(F.col("top") - F.lag("top").over(down) > tolerance, F.lit(False)).cast("int")
    return kept.withColumn("_new", new).withColumn("line", F.sum("_new").over(down.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def cells(lined: DataFrame, page: Sequence[str], gap: float = GAP) -> DataFrame:
    """(page, line, cell, text, x0, x1): neighbouring words of a line, a new cell after a gap wider than ``gap``."""
    along = Window.partitionBy(*page, "line").orderBy("x0", "x1", "text")
    reach = F.max("x1").over(along.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("x0") - reach > gap, F.lit(False)).cast("int")
    placed = lined.withColumn("_new", new).withColumn("cell", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    ordered = F.array_sort(F.collect_list(F.struct("x0", "x1", F.col("text").alias("t"))))
    out = placed.groupBy(*page, "line", "cell").agg(F.array_join(F.transform(ordered, lambda w: w["t"]), " ").alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"))
    return out.select(*page, "line", "cell", "text", "x0", "x1")


def headers(celled: DataFrame, page: Sequence[str]) -> DataFrame:
    """(page, line, column, period, x0, x1): the first line of a page with two or more period cells.

    A header may be split over two lines, the quarter above its year: a cell that is no period alone is read together with
    the cell below it that overlaps it most.
    """
    below = celled.select(*page, (F.col("line") - 1).alias("line"), F.col("text").alias("_t"), F.col("x0").alias("_a"), F.col("x1").alias("_b"))
    over = F.least("x1", "_b") - F.greatest("x0", "_a")
    short = celled.where(F.length("text") <= 12)
    joined = short.join(below.where(F.length("_t") <= 12), [*page, "line"], "left").withColumn("_over", over)
    best = joined.groupBy(*page, "line", "cell", "text", "x0", "x1").agg(F.max_by("_t", F.when(F.col("_over") > 0, F.col("_over"))).alias("_t"))
    alone = header_period(F.col("text"))
    period = F.when(alone.isNotNull(), alone).otherwise(header_period(F.concat_ws(" ", "text", "_t")))
    named = best.withColumn("period", period).where("period is not null")
    first = named.groupBy(*page, "line").agg(F.count("*").alias("_n")).where("_n >= 2").groupBy(*page).agg(F.min("line").alias("line"))
    column = F.row_number().over(Window.partitionBy(*page).orderBy("x0", "cell")) - 1
    return named.join(first, [*page, "line"]).select(*page, "line", column.alias("column"), "period", "x0", "x1")


def is_figure(text: Column) -> Column:
    return text.rlike(rf"^\$?{FIGURE}%?$")


def rows(lined: DataFrame, head: DataFrame, page: Sequence[str], reach: float = REACH) -> DataFrame:
    """(page, line, label, place, figure, period): every figure behind a label, with the period of the nearest header column.

    The label is all words of the line before its first figure; lines without one, or above and on the header, are no rows.
    A figure takes the column whose centre is nearest its own, the right one of two as near, if it stands within ``reach``
    of that column's words; else its period is null. ``place`` counts the figures of a row from the left.
    """
    along = Window.partitionBy(*page, "line").orderBy("x0", "x1", "text")
    seen = F.max(is_figure(F.col("text"))).over(along.rowsBetween(Window.unboundedPreceding, 0))
    told = lined.withColumn("_seen", seen)
    labels = told.where(~F.col("_seen")).groupBy(*page, "line").agg(F.array_sort(F.collect_list(F.struct("x0", "x1", F.col("text").alias("t")))).alias("_w"))
    labels = labels.select(*page, "line", F.array_join(F.transform("_w", lambda w: w["t"]), " ").alias("label"))
    figures = told.where(is_figure(F.col("text"))).withColumn("place", F.row_number().over(along) - 1).join(labels, [*page, "line"])
    columns = head.select(*page, F.col("line").alias("_h"), "column", "period", F.col("x0").alias("_a"), F.col("x1").alias("_b"))
    centre = (F.col("x0") + F.col("x1")) / 2
    joined = figures.join(columns, list(page), "left").where(F.col("_h").isNull() | (F.col("line") > F.col("_h")))
    far = F.abs(centre - (F.col("_a") + F.col("_b")) / 2)
    held = centre.between(F.col("_a") - reach, F.col("_b") + reach) & (far <= reach)
    out = joined.groupBy(*page, "line", "label", "place", F.col("text").alias("figure")).agg(F.min_by("period", F.when(held, F.struct(far, -F.col("column")))).alias("period"))
    return out


def value(figure: Column) -> Column:
    return tx.parse_number(figure)


def scales(read: DataFrame, known: DataFrame, page: Sequence[str], candidates: Sequence[float] = (1e-3, 1.0, 1e3), votes: int = 2) -> DataFrame:
    """(page, scale, agreeing): what printed figures are to be multiplied with, by a vote of their ratios to known values.

    ``read`` has page, label, period and value, ``known`` label, period and value. A ratio votes for the candidate nearest
    in orders of magnitude; of equal votes the one nearer 1 wins, and one other than 1 needs ``votes`` of them. Figures of
    half a unit or less and zeros tell nothing. A page without a vote keeps 1.
    """
    both = read.where(F.abs("value") > 0.5).join(known.where("value != 0").select("label", "period", F.col("value").alias("_k")), ["label", "period"])
    ratio = F.log10(F.abs(F.col("_k")) / F.abs(F.col("value")))
    near = F.array_min(F.array(*[F.struct(F.abs(ratio - F.lit(_log10(c))).alias("d"), F.lit(abs(c - 1.0)), F.lit(float(c)).alias("scale")) for c in candidates]))["scale"]
    counted = both.withColumn("scale", near).groupBy(*page, "scale").agg(F.count("*").alias("n"))
    best = counted.groupBy(*page).agg(F.max_by(F.struct("scale", "n"), F.struct("n", -F.abs(F.col("scale") - 1))).alias("b"))
    sure = (F.col("b.scale") == 1) | (F.col("b.n") >= votes)
    out = read.select(*page).distinct().join(best, list(page), "left")
    return out.select(*page, F.when(sure, F.col("b.scale")).otherwise(F.lit(1.0)).alias("scale"), F.when(sure, F.col("b.n")).otherwise(F.lit(0)).alias("agreeing"))


def _log10(x: float) -> float:
    from math import log10

    return log10(x)
