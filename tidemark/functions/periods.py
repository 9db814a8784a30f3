"""Quarter and year labels (YYYY-NT, YYYY-FY) and quarter indices (4 * year + quarter - 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numeric import col

#: Words for quarters in Spanish and English reports.
QUARTER_WORDS = {
    1: ("primer trimestre", "first quarter"),
    2: ("segundo trimestre", "second quarter"),
    3: ("tercer trimestre", "third quarter"),
    4: ("cuarto trimestre", "fourth quarter"),
}


def quarter_index(ts: Column | str) -> Column:
    return F.year(col(ts)) * 4 + F.quarter(col(ts)) - 1


def index_label(i: Column | str) -> Column:
    i = col(i)
    return F.concat(F.floor(i / 4).cast("int").cast("string"), F.lit("-"), (F.pmod(i, F.lit(4)) + 1).cast("int").cast("string"), F.lit("T"))


def label_index(label: Column | str) -> Column:
    """Index of a quarter label; null for years and anything else."""
    label = col(label)
    year, q = F.regexp_extract(label, r"^(\d{4})-([1-4])T$", 1), F.regexp_extract(label, r"^(\d{4})-([1-4])T$", 2)
    return F.when(year != "", year.cast("int") * 4 + q.cast("int") - 1)


def parse_period(text: Column | str) -> Column:
    """Label found in free text, null if none.

    1Q24, 1T2024, 2024-1T, Q1 2024, quarter words and ordinals with a year, a quarter's last day, FY2024;
    two-digit years below 70 are of this century.
    """
    s = F.lower(col(text))
    for q, words in QUARTER_WORDS.items():
        for w in words:
            s = F.regexp_replace(s, w, f"q{q}")
    s = F.regexp_replace(s, r"\b([1-4])(?:er|do|to|st|nd|rd|th)?\.?\s+(?:trimestre|trim|quarter)\b", "q$1")
    # the end of a quarter as XBRL contexts write it
    for q, day in enumerate(("03-?31", "06-?30", "09-?30", "12-?31"), 1):
        s = F.regexp_replace(s, rf"\b((?:19|20)\d{{2}})-?{day}\b", f"$1 q{q}")
    year = lambda y: F.when(F.length(y) == 2, F.concat(F.when(y.cast("int") < 70, "20").otherwise("19"), y)).otherwise(y)
    out = F.lit(None).cast("string")
    forms = [(r"\b((?:19|20)\d{2})[-_ ]?([1-4])[qt]\b", 1, 2), (r"\b((?:19|20)\d{2})[-_ ]?[qt]([1-4])\b", 1, 2), (r"\b([1-4])[qt][-_ ]?((?:19|20)?\d{2})\b", 2, 1), (r"\b[qt]([1-4])(?:\s+(?:of|de|del))?[-_ ]?((?:19|20)?\d{2})\b", 2, 1)]
    for form, y, q in reversed(forms):
        found = F.regexp_extract(s, form, y)
        out = F.when(found != "", F.concat(year(found), F.lit("-"), F.regexp_extract(s, form, q), F.lit("T"))).otherwise(out)
    annual = F.regexp_extract(s, r"\b(?:fy|anual|annual|year)[-_ ]?((?:19|20)\d{2})\b|\b((?:19|20)\d{2})[-_ ]?fy\b", 0)
    year_of = F.regexp_extract(annual, r"((?:19|20)\d{2})", 1)
    return F.coalesce(out, F.when(year_of != "", F.concat(year_of, F.lit("-FY"))))


def sort_key(label: Column | str) -> Column:
    """(year, quarter or 5 for a full year, label); unknown labels sort last."""
    label = col(label)
    year = F.regexp_extract(label, r"^(\d{4})-", 1)
    q = F.regexp_extract(label, r"-([1-4])T$", 1)
    return F.struct(F.when(year != "", year.cast("int")).otherwise(9999).alias("year"), F.when(q != "", q.cast("int")).otherwise(5).alias("q"), label.alias("label"))


def quarter_end(i: Column | str) -> Column:
    """Last day of the quarter of an index."""
    i = col(i)
    first = F.make_date(F.floor(i / 4).cast("int"), (F.pmod(i, F.lit(4)) * 3 + 1).cast("int"), F.lit(1))
    return F.last_day(F.add_months(first, 2))


def shift_label(label: Column | str, years: int) -> Column:
    label = col(label)
    return F.concat((F.substring(label, 1, 4).cast("int") + years).cast("string"), F.substring(label, 5, 10))


def expected_quarters(spark: SparkSession, first: int, last: int) -> DataFrame:
    """One row for each quarter index from first to last."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("qi"))


def due(i: Column | str, as_of: Column, grace_days: int) -> Column:
    """Whether a quarter's report should be there: its end plus the grace lies before ``as_of``."""
    return F.date_add(quarter_end(i), grace_days) <= as_of


def fiscal_quarters(issuers: DataFrame, month: str, first: int, last: int, days: int, annual_days: int) -> DataFrame:
    """``issuers`` with fy, q, ends and deadline of each fiscal quarter; ``month`` is the month the fiscal year ends in."""
    rows = issuers.withColumn("fy", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("q", F.explode(F.array(*[F.lit(i) for i in range(1, 5)])))
    ends = F.last_day(F.add_months(F.make_date("fy", F.col(month), F.lit(1)), 3 * (F.col("q") - 4)))
    return rows.withColumn("ends", ends).withColumn("deadline", F.date_add("ends", F.when(F.col("q") == 4, annual_days).otherwise(days)))


def in_window(i: Column | str, first: int | None, last: int | None) -> Column:
    i = col(i)
    ok = F.lit(True)
    if first is not None:
        ok = ok & (i >= first)
    if last is not None:
        ok = ok & (i <= last)
    return ok


def availability(filed: Column | str, i: Column | str, days: int = 90) -> Column:
    """When a quarter's figures could be known: the filing time, else the end of the quarter and ``days`` at 23:59."""
    fallback = F.to_timestamp_ntz(F.concat(F.date_add(quarter_end(i), days).cast("string"), F.lit(" 23:59:00")))
    return F.coalesce(col(filed), fallback)
