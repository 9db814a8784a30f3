"""Scorecards, gates, candidates and other report computations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import safe_div
from .catalog import latest
from .strategy import logistic_fit


def partition_hits(hits: DataFrame, kind: str, semantic_ok: bool) -> DataFrame:
    """Hits with part: exact for literal and strong ones, related for weak and semantic ones (dropped unless wanted)."""
    part = F.when(F.col(kind).isin("literal", "strong"), "exact").otherwise("related")
    out = hits.withColumn("part", part)
    return out if semantic_ok else out.where("part = 'exact'")


def donors(df: DataFrame, key: str, slug: str, period: str, seed: int) -> DataFrame:
    """For every row another company's row of the same period, chosen by a seeded hash ring.

    Rows of a period are ordered by hash and each takes the next one; the last takes the first.
    """
    order = [F.md5(F.concat(F.lit(f"{seed}:"), F.col(slug).cast("string"))), F.col(slug)]
    w = Window.partitionBy(period).orderBy(*order)
    first = F.first(key).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = df.withColumn("donor", F.coalesce(F.lead(key).over(w), first))
    return out.withColumn("donor", F.when(F.col("donor") != F.col(key), F.col("donor")))


def alias_mentions(docs: DataFrame, id_col: str, text_col: str, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """(id, company, n): companies whose alias a text holds as whole words; the alias list is the caller's constant."""
    found = F.array(*[F.struct(F.lit(c).alias("company"), tx.count_matches(text_col, forms).alias("n")) for c, forms in aliases.items()])
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("_f")).select("id", "_f.company", "_f.n").where("n > 0")


def reconcile_rosters(**sets: DataFrame) -> DataFrame:
    """key and a boolean per named set of keys, over all keys of any set."""
    names = list(sets)
    parts = [df.select("key").distinct().select("key", *[F.lit(n == m).alias(m) for m in names]) for n, df in sets.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("key").agg(*[F.some(n).alias(n) for n in names])


def extraction_accuracy(df: DataFrame, got: str, want: str, tolerance: float = 0.01) -> DataFrame:
    """``df`` with outcome: correct, fail, miss (wanted, not found), excluded (nothing to compare with)."""
    near = F.abs(F.col(got) - F.col(want)) <= tolerance * F.greatest(F.abs(F.col(want)), F.lit(1e-9))
    out = F.when(F.col(want).isNull(), "excluded").when(F.col(got).isNull(), "miss").when(near, "correct").otherwise("fail")
    return df.withColumn("outcome", out)


def scorecard(df: DataFrame, group: str) -> DataFrame:
    n = lambda o: F.count(F.when(F.col("outcome") == o, 1)).alias(o)
    return df.groupBy(group).agg(F.count("*").alias("total"), *[n(o) for o in ("correct", "fail", "miss", "excluded")])


def best_candidate(df: DataFrame, keys: Sequence[str], confidence: str, tie: str, least: float) -> DataFrame:
    """The most confident candidate of each key if at or above ``least``, with how many others there were."""
    w = Window.partitionBy(*keys)
    out = latest(df.withColumn("alternatives", F.count("*").over(w) - 1), keys, F.desc(confidence), F.col(tie))
    return out.where(F.col(confidence) >= least)


def paired_test(df: DataFrame, a: str, b: str, truth: str) -> DataFrame:
    """Cases only one of two callers got right, and the continuity-corrected chi-square of their difference."""
    ra, rb = F.signum(a) == F.signum(truth), F.signum(b) == F.signum(truth)
    only = lambda x, y: F.count(F.when(x & ~y, 1))
    out = df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col(truth).isNotNull()).agg(F.count("*").alias("n"), only(ra, rb).alias("only_a"), only(rb, ra).alias("only_b"))
    both = F.col("only_a") + F.col("only_b")
    return out.withColumn("chi2", safe_div(F.pow(F.greatest(F.abs(F.col("only_a") - F.col("only_b")) - 1, F.lit(0)), 2), both))


def rank_auc(df: DataFrame, score: str, label: str, *part: str) -> DataFrame:
    """Area under the ROC curve by average-tie ranks."""
    r = F.rank().over(Window.partitionBy(*part).orderBy(score)) + (F.count("*").over(Window.partitionBy(*part, score)) - 1) / 2
    g = df.withColumn("_r", r).groupBy(*part).agg(F.sum(F.when(F.col(label) == 1, F.col("_r"))).alias("_s"), F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    return g.select(*part, "pos", "neg", safe_div(F.col("_s") - F.col("pos") * (F.col("pos") + 1) / 2, F.col("pos") * F.col("neg")).alias("auc"))


def walk_forward_scores(df: DataFrame, period: str, x: str, y: str, span: int | None) -> DataFrame:
    """``df`` with p: each period's rows scored by the logistic fit of the periods before it, without a span of all others."""
    fits = logistic_fit(df, period, x, y, span).select(period, "intercept", "slope")
    out = df.join(fits, period, "left")
    return out.withColumn("p", 1 / (1 + F.exp(-(F.col("intercept") + F.col("slope") * F.col(x))))).drop("intercept", "slope")


def trailing_ic_weights(ics: DataFrame, name: str, period: str, span: int, least: int) -> DataFrame:
    """Weight of each signal in each period: its mean rank correlation of the ``span`` periods before, negatives 0, scaled to sum 1."""
    past = ics.select(name, F.explode(F.sequence(F.col(period) + 1, F.col(period) + span)).alias(period), F.col("ic").alias("_i"), F.col("n").alias("_n"))
    fit = past.groupBy(name, period).agg(F.avg("_i").alias("_m"), F.sum("_n").alias("_o"))
    fit = fit.withColumn("_w", F.when(F.col("_o") >= least, F.greatest(F.col("_m"), F.lit(0.0))))
    return fit.withColumn("weight", safe_div(F.col("_w"), F.sum("_w").over(Window.partitionBy(period)))).select(name, period, "weight")


def gate(row: DataFrame, rate: str, p: str, least: float = 0.5, most: float = 0.05) -> DataFrame:
    """A study's one row with open: the hit rate is over ``least`` and the permutation p at most ``most``."""
    return row.withColumn("open", (F.col(rate) > least) & (F.col(p) <= most))


def confidence(checks: Mapping[str, tuple[Column, float]]) -> Column:
    """Weighted share of passed checks among those that could be made, 0..1."""
    total = sum((F.when(c.isNotNull(), w).otherwise(0.0) for c, w in checks.values()), F.lit(0.0))
    passed = sum((F.when(c, w).otherwise(0.0) for c, w in checks.values()), F.lit(0.0))
    return safe_div(passed, total)


def grade(status: Column, correct: Column, complete: Column) -> Column:
    return F.when(status == "blocked", "D").when((correct >= 0.99) & complete, "A").when(correct >= 0.9, "B").when(correct.isNotNull(), "C").otherwise("D")


def match_ranges(df: DataFrame, group: str, order: str, n: str) -> DataFrame:
    """1-based range of running match numbers that each document's matches take."""
    upto = F.sum(n).over(Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumns({"last": upto, "first": upto - F.col(n) + 1})


def report_calendar(known: DataFrame, expected: DataFrame, keys: Sequence[str], due: Column) -> DataFrame:
    """received, missing (due, not there) or expected for each key."""
    k = known.select(*keys).distinct().withColumn("_k", F.lit(True))
    return expected.join(k, list(keys), "left").withColumn("state", F.when(F.col("_k"), "received").when(due, "missing").otherwise("expected")).drop("_k")


def reembed_plan(source: DataFrame, index: DataFrame, key: str, text: str, model: str) -> DataFrame:
    """Rows of the source whose signature (text and model) the index lacks: what a resumed migration still has to embed."""
    signed = source.withColumn("signature", F.sha2(F.concat_ws("|", F.lit(model), F.coalesce(F.col(text), F.lit(""))), 256))
    return signed.join(index.select(key, "signature"), [key, "signature"], "left_anti")


def nearest_column(tokens: DataFrame, columns: DataFrame, page: str, x: str, tolerance: float) -> DataFrame:
    """Header column nearest to each token by position on its page, within ``tolerance`` (a page has few columns)."""
    j = tokens.join(columns.select(page, F.col("name"), F.col("pos").alias("_p")), page)
    gap = F.abs(F.col(x) - F.col("_p"))
    return j.withColumn("_g", gap).where(F.col("_g") <= tolerance).groupBy(*tokens.columns).agg(F.min_by("name", F.struct("_g", "name")).alias("column"))


def decompose(question: Column) -> Column:
    """All parts of a question: split at question marks, semicolons and joining words; short parts aside."""
    parts = F.transform(F.split(F.lower(question), r"\?|;|" + tx.whole_words(("and", "as well as", "y", "und", "et"))), lambda p: F.trim(p))
    return F.filter(parts, lambda p: F.length(p) >= 8)


def figure_signal(text: Column) -> Column:
    """How much a sentence is about figures: numbers and percentages per word, at most 1."""
    n = F.regexp_count(text, F.lit(r"\d+(?:[.,]\d+)*\s*%?"))
    return F.least(F.lit(1.0), safe_div(n.cast("double"), F.size(tx.words(text)).cast("double")))
