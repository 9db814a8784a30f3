"""Quality rules as a learned decision list: sequential covering over labelled statistics, JVM expressions throughout.

Texts are measured once. A rule for junk grows one threshold condition after another, each chosen by its gain in
information over the labelled rows that the rule still covers; it is cut back to the conditions that serve on rows it
didn't grow on, and stays if it is precise there. The rows it covers are set aside and the next rule grows on the
rest. The driver sees counts per feature and bin, never rows. The list becomes one ordered conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CLASS, Scratch, join_by_key, table, text_or_empty

MIN_WORDS = 50
#: Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Bins of a share: so many between 0 and 1; of a ratio or count: so many each doubling.
SHARE_BINS, LOG_BINS = 200, 8
MAX_RULES, MAX_CONDITIONS = 16, 4
#: A rule stays if so much of what it covers among the rows held back from its growth is junk, by the Laplace estimate.
PRECISION = 0.8
#: One labelled row in so many is held back from growing, to prune and judge.
PRUNE_EVERY = 3

#: name -> (expression over ``measures``, whether it is a share).
FEATURES = {
    "symbols_per_word": ("n_symbols / n_words", False),
    "chars_per_word": ("word_chars / n_words", False),
    "repeat_share": ("n_repeat_words / n_words", True),
    "distinct_share": ("n_distinct / n_words", True),
    "duplicate_line_share": ("n_dup_lines / n_lines", True),
    "capital_share": ("n_capitals / word_chars", True),
    "exclamations_per_word": ("n_exclamations / n_words", False),
    "stops_per_word": ("n_stops / n_words", False),
    "words_per_line": ("n_words / n_lines", False),
    "digit_share": ("n_digits / word_chars", True),
    "words": ("n_words", False),
}


def _repeats(words: str) -> tuple[Column, ...]:
    """Hashes of the windows of three words, those windows in order if any comes twice, the places of such ones, and the words under them."""
    w = F.col(words)
    gram = lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
    hashes = F.when(F.size(w) >= 3, F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), gram))
    # the words themselves settle equal hashes
    full = lambda h, i: F.struct(h.alias("h"), F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"), F.get(w, i + 2).alias("c"), i.alias("i"))
    some = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = F.when(some, F.sort_array(F.transform("_hashes", full)))

    def same(x, y):
        return F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    o = F.col("_ordered")
    twice = F.filter(o, lambda x, i: same(x, F.get(o, i + 1)) | same(x, F.get(o, i - 1)))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    p = F.col("_places")
    covered = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
    total = F.coalesce(F.aggregate(covered, F.lit(0), lambda acc, x: acc + x), F.lit(0)).cast("long")
    return hashes, ordered, places, total


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the counts behind ``FEATURES``.

    A null text has no words; nothing is cut from long ones. Repeated rows each give a row, other columns are left out.
    """
    out = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("_t"))
    t = F.col("_t")
    out = out.withColumn("_bits", F.split("_t", SPACE_CLASS, -1)).withColumn("_lines", F.split("_t", "\n", -1))
    # lines without a word hold nothing but the white space that trim takes
    filled = F.filter("_lines", lambda x: F.trim(x, F.lit(" \t\x0b\x0c\r")) != "")
    counted = lambda pattern: F.regexp_count("_t", F.lit(pattern)).cast("long")
    out = out.select(
        "id",
        F.array_remove("_bits", "").alias("_words"),
        (F.length(t) - F.size("_bits") + 1).cast("long").alias("word_chars"),
        filled.alias("_filled"),
        counted(SYMBOLS).alias("n_symbols"),
        counted(r"\p{Lu}").alias("n_capitals"),
        counted("!").alias("n_exclamations"),
        counted("[.?]").alias("n_stops"),
        counted("[0-9]").alias("n_digits"),
    )
    hashes, ordered, places, total = _repeats("_words")
    kept = ["word_chars", "n_symbols", "n_capitals", "n_exclamations", "n_stops", "n_digits"]
    n = lambda c: F.size(c).cast("long")
    out = out.select(
        "id", *kept, "_words", n("_words").alias("n_words"), n(F.array_distinct("_words")).alias("n_distinct"),
        n("_filled").alias("n_lines"), (n("_filled") - n(F.array_distinct("_filled"))).alias("n_dup_lines"), hashes.alias("_hashes"),
    )
    kept += ["n_words", "n_distinct", "n_lines", "n_dup_lines"]
    out = out.select("id", *kept, ordered.alias("_ordered"))
    out = out.select("id", *kept, places.alias("_places"))
    return out.select("id", *kept, total.alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _binned(name: str) -> Column:
    """Bin of a feature: on an even grid for shares, on one of equal ratios else; a feature that isn't defined is 0."""
    expr, share = FEATURES[name]
    x = F.coalesce(F.expr(f"try_divide({expr.replace(' / ', ', ')})") if " / " in expr else F.expr(f"double({expr})"), F.lit(0.0))
    scaled = x * SHARE_BINS if share else F.log2(x + F.lit(1 / 64)) * LOG_BINS
    return F.floor(scaled).cast("int")


def _value(name: str, edge: int) -> float:
    """The feature value at which the bin ``edge`` begins."""
    return edge / SHARE_BINS if FEATURES[name][1] else 2 ** (edge / LOG_BINS) - 1 / 64


@dataclass(frozen=True)
class Condition:
    """Feature at least (or under) the lower edge of a bin."""

    feature: str
    least: bool
    edge: int

    def holds(self, binned: bool = False) -> Column:
        bin_ = F.col(self.feature) if binned else _binned(self.feature)
        return bin_ >= self.edge if self.least else bin_ < self.edge

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.least else '<'} {_value(self.feature, self.edge):.4g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that tells junk, with its junk and clean rows among those held back."""

    conditions: tuple[Condition, ...]
    junk: int
    clean: int

    def holds(self, binned: bool = False) -> Column:
        out = self.conditions[0].holds(binned)
        for c in self.conditions[1:]:
            out = out & c.holds(binned)
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _histogram(rows: DataFrame) -> dict[str, dict[int, tuple[int, int, int, int]]]:
    """Feature -> bin -> (junk, clean) of the growing and of the held back rows: at most features times bins counts."""
    stacked = rows.select("_junk", "_held", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("b")) for f in FEATURES])).alias("x"))
    one = lambda held, junk: F.sum(F.expr(f"int({'' if held else 'not '}_held and {'' if junk else 'not '}_junk)"))
    counts = stacked.groupBy("x.f", "x.b").agg(one(0, 1), one(0, 0), one(1, 1), one(1, 0)).collect()
    out: dict[str, dict[int, tuple[int, int, int, int]]] = {f: {} for f in FEATURES}
    for f, b, *n in counts:
        out[f][b] = tuple(n)
    return out


def _cuts(counts: dict[str, dict[int, tuple[int, int, int, int]]]):
    """Each possible condition with the four counts of the rows it covers."""
    for feature, bins in counts.items():
        total = [sum(n[i] for n in bins.values()) for i in range(4)]
        below = [0, 0, 0, 0]
        edges = sorted(bins)
        for last, edge in zip(edges, edges[1:]):
            below = [a + b for a, b in zip(below, bins[last])]
            middle = (last + edge + 1) // 2  # no row lies between the two bins
            yield Condition(feature, False, middle), tuple(below)
            yield Condition(feature, True, middle), tuple(t - b for t, b in zip(total, below))


def _gain(junk: int, clean: int, junk0: int, clean0: int) -> float:
    return junk * (log2(junk / (junk + clean)) - log2(junk0 / (junk0 + clean0))) if junk else 0.0


def _grow(rows: DataFrame) -> Rule | None:
    """The next rule over ``rows``: grown by gain, pruned to the prefix that serves the held back rows best."""
    covered, prefix, steps = rows, [], []
    while len(prefix) < MAX_CONDITIONS:
        counts = _histogram(covered)
        junk0, clean0 = (sum(n[i] for n in counts["words"].values()) for i in (0, 1))
        if not junk0 or not clean0:
            break
        best = max(_cuts(counts), key=lambda c: (_gain(*c[1][:2], junk0, clean0), c[0].feature, c[0].least, c[0].edge), default=None)
        if best is None or _gain(*best[1][:2], junk0, clean0) <= 0:
            break
        prefix.append(best[0])
        steps.append(Rule(tuple(prefix), *best[1][2:]))
        covered = covered.where(best[0].holds(binned=True))
    # the shortest of equally good prefixes
    return max(steps, key=lambda r: ((r.junk - r.clean) / max(r.junk + r.clean, 1), -len(r.conditions)), default=None)


def learn(rows: DataFrame) -> list[Rule]:
    """Decision list from labelled ``measures`` with the boolean column junk; an empty table or one class gives no rule."""
    scratch = Scratch(rows.sparkSession, "rules")
    held = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(PRUNE_EVERY)) == 0
    binned = scratch.save(rows.select(F.col("junk").alias("_junk"), held.alias("_held"), *[_binned(f).alias(f) for f in FEATURES]), "binned")
    rules, left = [], binned
    while len(rules) < MAX_RULES:
        rule = _grow(left)
        if rule is None or (rule.junk + 1) / (rule.junk + rule.clean + 2) < PRECISION:
            break
        rules.append(rule)
        left = left.where(~rule.holds(binned=True))
    scratch.drop(binned)
    return rules


def first_rule(rules: list[Rule]) -> Column:
    """Text of the first rule of the list that holds, null where none does."""
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        out = F.when(rule.holds(), F.lit(str(rule))).otherwise(out)
    return out


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the measures, base_failed, the first learned rule that calls it junk (or null), kept.

    ``labels`` has (id_col, quality), 0 for junk; of an id labelled both ways no label counts, nor those of null ids. Rows
    that share an id share its label. Documents that fail the base rules are not learned from, as those decide them.
    """
    scratch = Scratch(spark, "quality")
    rows = scratch.save(measures(docs, id_col, text_col), "measures")
    known = labels.where(F.col(id_col).isNotNull() & F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id"))
    known = known.agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")).where("lo = hi").select("id", (F.col("lo") == 0).alias("junk"))
    taught = rows.where(~base_failed())
    sizes = taught.groupBy("id").agg(F.count("*").alias("_n")).join(known, "id")
    rules = learn(join_by_key(taught, sizes, ["id"], "_n", taught.count(), "inner"))
    out = rows.withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op12(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = judge(spark, docs, labels)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(F.col("id").alias("doc_id"), *base, "rule")
