"""Row labels matched to a dictionary's aliases by rules and by spelling, comparing only pairs that can reach the threshold.

Three equi-joins find the candidates: leading words of a label, the rarest word of an alias, and rare pairs of letters.
None loses a pair whose score is at least the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.spread import tasks

THRESHOLD = 0.85
#: Scores of the rules; a label that begins with an alias, or holds all its words in order and at most two others.
EXACT, PREFIX, HELD = 1.0, 0.98, 0.88
#: Longest labels that name a row.
MOST_CHARS, MOST_WORDS = 90, 12
Q = 2
#: Labels of a side that meet in one block of a join.
BLOCK = 1024


def normal(x: Column) -> Column:
    return tx.normalize(tx.fold(x))


def grams(x: Column) -> Column:
    """Runs of ``Q`` letters with their number where they repeat, so that they form a set."""
    runs = F.transform(F.sequence(F.lit(1), F.length(x) - Q + 1), lambda i: F.substring(x, i, F.lit(Q)))
    return F.when(F.length(x) >= Q, runs).otherwise(F.array().cast("array<string>"))


def spelling(a: Column, b: Column) -> Column:
    """1 less the share of letters to change, of the longer label."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def _marks(x: Column) -> list[Column]:
    """Two words of 64 bits, a bit for each letter of ``x`` and the time it comes: bits that another label lacks are letters that it lacks.

    They are never null, and said to be so, else Spark would compute them once more for every row that its filters see.
    """
    letter = lambda i: F.substring(x, i, F.lit(1))
    times = lambda i: i - F.length(F.replace(F.substring(x, F.lit(1), i), letter(i), F.lit("")))
    at = F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.pmod(F.xxhash64(letter(i), times(i)), F.lit(128)).cast("int"))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h % 64)
    word = lambda lo: F.aggregate(F.filter(at, lambda h: (h >= lo) & (h < lo + 64)), F.lit(0).cast("long"), lambda w, h: w.bitwiseOR(bit(h)))
    return [F.coalesce(word(lo), F.lit(0).cast("long")) for lo in (0, 64)]


def _meet(a: DataFrame, x: str, b: DataFrame, y: str, key: str) -> DataFrame:
    """Inner join on ``key`` where few bytes can be many pairs: in blocks of about ``BLOCK`` values of ``x`` and ``y``, so that a key that many share is dealt out."""
    n = tasks(a.sparkSession)
    dealt = [s.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(c)) for s, c in ((a, "_n"), (b, "_m"))]
    blocks = dealt[0].join(dealt[1], key)
    place = lambda v, c: F.pmod(F.xxhash64(v), F.col(c)).cast("int")
    every = lambda c: F.explode_outer(F.sequence(F.lit(0), F.col(c) - 1))
    a = a.join(blocks, key).withColumn("_i", place(x, "_n")).withColumn("_j", every("_m")).drop("_n", "_m")
    b = b.join(blocks, key).withColumn("_j", place(y, "_m")).withColumn("_i", every("_n")).drop("_n", "_m")
    # a number of its own, else small partitions become one
    a, b = (s.repartition(n, key, "_i", "_j") for s in (a, b))
    return a.join(b.hint("merge"), [key, "_i", "_j"]).drop("_i", "_j")


def near_pairs(left: DataFrame, right: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """(a, b): distinct labels of ``left`` and ``right`` (one column each) that are ``least`` alike by spelling.

    Labels within k changes of each other, k being the share 1 - ``least`` of the longer one, share all but k * Q of their
    pairs of letters. Sorted by rarity, the first k * Q + 1 of one and of the other must then meet: only those are joined,
    in blocks of at most ``BLOCK`` labels of either side, so that a pair of letters which many share is dealt out. What
    meets is compared inside the join, by the bits of its letters and then whole, and only pairs that are near leave it,
    once: at the first pair of letters that they share.
    Labels of under Q letters, and those that leave no change, are joined by equality.
    """
    sides = [df.toDF("x").where("x != ''").distinct() for df in (left, right)]
    # not posexplode(): for that, Spark would cut every label a second time, before its rows are made distinct
    runs = [s.select("x", F.posexplode_outer(grams(F.col("x"))).alias("i", "g")).where("g is not null") for s in sides]
    # a gram that comes twice in a label is another the second time
    nth = F.row_number().over(Window.partitionBy("x", "g").orderBy("i"))
    runs = [r.select("x", F.concat_ws("#", "g", nth.cast("string")).alias("g")) for r in runs]
    often = runs[0].unionByName(runs[1]).groupBy("g").agg(F.count("*").alias("df"))
    # the other label is at most length / least letters long
    changes = F.floor((1 - least) * F.floor(F.length("x") / least) + 1e-9)
    allowed = lambda n: F.floor((1 - least) * n + 1e-9).cast("int")
    first = F.slice(F.array_sort(F.collect_list(F.struct("df", "g"))), F.lit(1), (changes * Q + 1).cast("int"))

    n = tasks(left.sparkSession)

    def prefix(rows: DataFrame, side: str) -> DataFrame:
        own = rows.join(often, "g").repartition(n, "x").groupBy("x").agg(F.transform(first, lambda s: s["g"]).alias("p"))
        marks = [m.alias(f"{side}{i}") for i, m in enumerate(_marks(F.col("x")))]
        return own.select(F.col("x").alias(side), F.length("x").alias(f"{side}n"), *marks, F.col("p").alias(f"{side}p"), F.explode_outer("p").alias("g"))

    a, b = prefix(runs[0], "a"), prefix(runs[1], "b")
    most = allowed(F.greatest("an", "bn"))
    bits = lambda x, y: sum((F.bit_count(F.col(f"{x}{i}").bitwiseAND(F.bitwise_not(f"{y}{i}"))) for i in (0, 1)), F.lit(0))
    # each change takes at most one letter from either label; the cheap tests come first
    near = (F.abs(F.col("an") - F.col("bn")) <= most) & (bits("a", "b") <= most) & (bits("b", "a") <= most)
    near = near & (F.get(F.array_intersect("ap", "bp"), 0) == F.col("g")) & (F.call_function("levenshtein", F.col("a"), F.col("b"), most) >= 0)
    met = _meet(a, "a", b, "b", "g").where(near).select("a", "b")
    same = sides[0].join(sides[1], "x").select(F.col("x").alias("a"), F.col("x").alias("b"))
    # so short that one change is more than allowed, or that all pairs of letters may differ
    longer = F.greatest(F.length("a"), F.length("b"))
    few = allowed(longer) * Q + Q > longer
    size = F.abs(F.length("a") - F.length("b")) <= (1 - least) * longer + 1e-9
    tiny = [s.where((changes > 0) & (changes * Q + Q > F.length("x"))) for s in sides]
    close = tiny[0].toDF("a").join(tiny[1].toDF("b"), F.abs(F.length("a") - F.length("b")) <= 1).where(few & size)
    return met.unionByName(same).unionByName(close.select("a", "b")).distinct()


def _in_order(label: Column, alias: Column) -> Column:
    """Whether all words of the alias stand in the label in their order."""
    places = F.transform(F.split(alias, " "), lambda x: F.array_position(F.split(label, " "), x))
    return F.forall(places, lambda p: p > 0) & (places == F.array_sort(places))


def candidates(labels: DataFrame, aliases: DataFrame, least: float = THRESHOLD) -> DataFrame:
    """(label, alias): the distinct normal labels and aliases that a rule or their spelling may bring to ``least``."""
    labels, aliases = labels.toDF("label").where("label != ''").distinct(), aliases.toDF("alias").where("alias != ''").distinct()
    longest = aliases.agg(F.max(F.size(F.split("alias", " ")))).first()[0] or 0
    w = F.split("label", " ")
    leads = F.transform(F.sequence(F.lit(1), F.least(F.size(w), F.lit(max(longest, 1)))), lambda n: F.array_join(F.slice(w, F.lit(1), n), " "))
    # explode_outer() as in near_pairs
    led = labels.select("label", F.explode_outer(leads).alias("alias")).join(aliases, "alias", "left_semi").select("label", "alias")
    # only labels that hold all its words, and at most two others, are more than near; a bit for each word tells most others
    bit = lambda v: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(v), F.lit(64)).cast("int"))
    told = lambda x: F.coalesce(F.aggregate(F.split(x, " "), F.lit(0).cast("long"), lambda b, v: b.bitwiseOR(bit(v))), F.lit(0).cast("long"))
    sized = lambda s, x: s.withColumn(f"{x}_n", F.size(F.split(x, " "))).withColumn(f"{x}_b", told(x))
    words = sized(labels, "label").select("label", "label_n", "label_b", F.explode_outer(F.array_distinct(w)).alias("w"))
    often = words.groupBy("w").agg(F.count("*").alias("df"))
    named = aliases.where("alias like '% %'").select("alias", F.explode_outer(F.array_distinct(F.split("alias", " "))).alias("w")).join(often, "w", "left")
    # a word that no label has rules its alias out, as 0 is the rarest
    rarest = named.groupBy("alias").agg(F.min_by("w", F.struct(F.coalesce("df", F.lit(0)), "w")).alias("w"))
    met = _meet(words, "label", sized(rarest, "alias"), "alias", "w")
    held = met.where((F.col("label_n") <= F.col("alias_n") + 2) & (F.col("alias_b").bitwiseAND(F.bitwise_not("label_b")) == 0) & _in_order(F.col("label"), F.col("alias"))).select("label", "alias")
    near = near_pairs(labels, aliases, least).toDF("label", "alias")
    return led.unionByName(held).unionByName(near).distinct()


def score(label: Column, alias: Column, residual: Sequence[str] = (), sublines: Sequence[str] = ()) -> Column:
    """Struct (score, method) of a normal label for an alias.

    A label that begins with a residual word names another row than its alias without one; a single word followed by a
    word of ``sublines`` names a part of it. Both score 0.
    """
    lw, aw = F.split(label, " "), F.split(alias, " ")
    first = lambda x: F.get(x, 0).isin(list(residual)) if residual else F.lit(False)
    part = (F.size(aw) == 1) & (F.get(lw, 0) == alias) & F.coalesce(F.get(lw, 1).isin(list(sublines)), F.lit(False)) if sublines else F.lit(False)
    near = spelling(label, alias)
    out = lambda s, m: F.struct(s.alias("score"), F.lit(m).alias("method"))
    return (
        F.when(label == alias, out(F.lit(EXACT), "exact"))
        .when(first(lw) & ~first(aw), out(F.lit(0.0), "residual"))
        .when(part, out(F.lit(0.0), "subline"))
        .when(label.startswith(F.concat(alias, F.lit(" "))), out(F.lit(PREFIX), "prefix"))
        .when((F.size(aw) > 1) & _in_order(label, alias) & (F.size(lw) <= F.size(aw) + 2) & (near < HELD), out(F.lit(HELD), "words"))
        .otherwise(out(near, "spelling"))
    )


def rejected(label: Column, negatives: Sequence[str] = (), prose: str | None = None) -> Column:
    """Why a normal label names no row: empty, long, negative (it begins with such a label), prose (it holds such words); null if it may."""
    out = F.when(label.isNull() | (label == ""), "empty").when((F.length(label) > MOST_CHARS) | (F.size(F.split(label, " ")) > MOST_WORDS), "long")
    for n in negatives:
        out = out.when(label.startswith(n), "negative")
    return out.when(label.rlike(prose), "prose") if prose else out


def consolidation_rank(label: Column, consolidated: Sequence[str], segments: Sequence[str]) -> Column:
    """How much of the whole company a row speaks for: 2 for a word of consolidation, 1 for a leading total, 1 less for a segment."""
    has = lambda cues: F.coalesce(label.rlike("|".join(cues)), F.lit(False)).cast("int") if cues else F.lit(0)
    return 2 * has(consolidated) + F.coalesce(label.startswith("total"), F.lit(False)).cast("int") - has(segments)


def best_matches(labels: DataFrame, aliases: DataFrame, least: float = THRESHOLD, residual: Sequence[str] = (), sublines: Sequence[str] = (), negatives: Sequence[str] = (), prose: str | None = None) -> DataFrame:
    """(label, metric, alias, score, method) of each distinct normal label (column label) that reaches ``least``; ``aliases``: metric, alias.

    The best score wins, then the metric with the greater name, then the alias that comes first by length and letters.
    """
    rows = labels.select("label").where(rejected(F.col("label"), negatives, prose).isNull()).distinct()
    scored = candidates(rows, aliases.select("alias"), least).withColumn("s", score(F.col("label"), F.col("alias"), residual, sublines)).where(F.col("s.score") >= least)
    named = scored.join(aliases, "alias")
    w = Window.partitionBy("label").orderBy(F.desc("s.score"), F.desc("metric"), F.length("alias"), "alias")
    return named.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("label", "metric", "alias", F.col("s.score").alias("score"), F.col("s.method").alias("method"))


def best_rows(matched: DataFrame, group: Sequence[str], consolidated: Sequence[str] = (), segments: Sequence[str] = ()) -> DataFrame:
    """One row per group and metric: the best score, of equals the most consolidated, then the label first by letters."""
    ranked = matched.withColumn("rank", consolidation_rank(F.col("label"), consolidated, segments))
    w = Window.partitionBy(*group, "metric").orderBy(F.desc("score"), F.desc("rank"), "label")
    return ranked.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
