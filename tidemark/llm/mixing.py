"""Mixing sources to target weights: hash-random order, distributed prefix sums and an exact cut per source."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, Scratch, held_by, join_by_key, key_filter, text_or_empty

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Rows of a key range, on average: the hash-random key is cut into as many ranges as the number of rows needs.
RANGE_ROWS = 50_000
#: Columns that the mixture adds; columns of these names in the input are replaced.
ADDED = ("size", "source_size", "target", "taken")


def source_targets(scratch: Scratch, sources: DataFrame, weights: tuple, cap: int) -> DataFrame:
    """``sources`` (__source, n words, rows) with target and budget: shares of all words by weight, none above cap * n.

    Any number of sources stays distributed: their places in code point order are counted by partition of a range
    sort, and the water level rises in passes over the table, each of which fills the sources below it and
    shares what they can't take among the rest. The driver sees one row a pass and one count a partition.
    """
    named = sources.repartitionByRange(F.col("__source") == "", "__source").sortWithinPartitions(F.col("__source") == "", "__source")
    listed = scratch.save(named.withColumn("at", F.monotonically_increasing_id()), "listed")
    part = F.shiftrightunsigned("at", 33)
    counts, before = sorted((r["part"], r["n"]) for r in listed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()), 0
    starts = []
    for p, n in counts:
        starts.append((p, before))
        before += n
    base = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in starts for x in pair]), part) if starts else F.lit(0)
    rank = base + F.col("at").bitwiseAND((1 << 33) - 1)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = scratch.save(listed.select("__source", "n", "rows", weight.alias("w")), "weighed")
    most = cap * F.col("n").cast("double")
    total, everything = weighed.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    level, full = total / everything if everything else 0.0, None
    while full is None or full[0]:
        below = most / F.col("w") < F.lit(level)
        now = tuple(weighed.agg(F.count_if(below), F.coalesce(F.sum(F.when(below, F.col("n"))), F.lit(0)), F.coalesce(F.sum(F.when(below, F.col("w"))), F.lit(0))).first())
        if now == full or not now[0]:
            break
        full, level = now, (total - float(cap * now[1])) / (everything - now[2])
    target = F.least(most, F.col("w") * F.lit(float(level)))
    out = weighed.select("__source", "n", "rows", target.alias("target"))
    scratch.drop(listed)
    return out.withColumn("budget", F.least(F.floor(F.col("target") + 0.5).cast("long"), cap * F.col("n")))


def _keys(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """``docs`` with __source (never null: null is its own source), __key in hash-random order, and __size in words."""
    text = text_or_empty(text_col)
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("?"), F.xxhash64(text).cast("string")))
    source = F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit(""))
    return docs.withColumns({"__source": source, "__key": F.md5(F.concat(F.lit(seed + ":"), name)), "__size": F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long")})


def _plan(spark: SparkSession, scratch: Scratch, light: DataFrame, weights: tuple, max_epochs: int) -> tuple[DataFrame, int]:
    """(a row a source: its targets, whole epochs, the key at which the rest is cut and the words left there; rows).

    Sums per (source, key range) are aggregated before the shuffle and prefix-summed over the ranges of each
    source; only the range of each source that the cut falls into is sorted by key and summed row by row.
    """
    rows = light.count()
    digits = max(3, math.ceil(math.log(max(1, rows / RANGE_ROWS), 16)))
    light = light.withColumn("__range", F.substring("__key", 1, digits))
    ranges = scratch.save(light.groupBy("__source", "__range").agg(F.sum("__size").alias("words"), F.count("*").alias("rows")), "ranges")
    sources = ranges.groupBy("__source").agg(F.sum("words").alias("n"), F.sum("rows").alias("rows"))
    some = F.col("n") > 0
    plan = source_targets(scratch, sources, weights, max_epochs)
    plan = plan.withColumns({"whole": F.when(some, F.expr("budget div n")).otherwise(F.lit(0).cast("long")), "rest": F.when(some, F.expr("budget % n")).otherwise(F.lit(0).cast("long"))})
    plan = scratch.save(plan, "plan")
    before = F.coalesce(F.sum("words").over(Window.partitionBy("__source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = ranges.withColumn("base", before).join(plan.select("__source", "rest"), "__source").where("base < rest and rest <= base + words")
    cut = scratch.save(cut.select("__source", "__range", F.col("rest") - F.col("base")).toDF("__source", "__range", "left"), "cut")
    inside = held_by(light, scratch.save(key_filter(cut, "__source", "__range"), "asked"), "__source", "__range").where("_maybe")
    # rows of one key are one step here; _taken divides them
    steps = inside.groupBy("__source", "__range", "__key").agg(F.sum("__size").alias("words")).join(cut, ["__source", "__range"])
    upto = F.sum("words").over(Window.partitionBy("__source", "__range").orderBy("__key").rowsBetween(Window.unboundedPreceding, 0))
    steps = steps.withColumn("upto", upto).where("upto >= left and upto - words < left")
    steps = steps.select("__source", F.col("__key").alias("cut_key"), (F.col("left") - F.col("upto") + F.col("words")).alias("cut_left"))
    plan = plan.join(steps, "__source", "left").select("__source", "n", "rows", "target", "whole", "cut_key", "cut_left")
    return scratch.save(plan, "cuts"), rows


def _taken(rows: DataFrame, plan: DataFrame, total: int, id_col: str) -> DataFrame:
    """``rows`` with the plan of their source and __once, the words taken besides whole epochs: all below the source's cut key.

    Rows at the cut key (rows that repeat an id) take what is left there one after the other.
    """
    plan = plan.select("__source", F.col("n").alias("__n"), F.col("rows").alias("__rows"), F.col("target").alias("__target"), F.col("whole").alias("__whole"), F.col("cut_key").alias("__cut"), F.col("cut_left").alias("__left"))
    known = join_by_key(rows, plan, ["__source"], "__rows", total, "inner")
    at = F.coalesce(F.col("__key") == F.col("__cut"), F.lit(False))
    once = F.when(F.col("__key") < F.col("__cut"), F.col("__size")).otherwise(F.lit(0).cast("long"))
    clear = known.where(~at).withColumn("__once", once)
    order = Window.partitionBy("__source").orderBy("__size", F.xxhash64(F.col(id_col))).rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum("__size").over(order) - F.col("__size")
    crossing = known.where(at).withColumn("__once", F.greatest(F.lit(0).cast("long"), F.least("__size", F.col("__left") - start)))
    return clear.unionByName(crossing)


def mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix-1") -> DataFrame:
    """(the id, size, source_size, target, taken) of every row; taken is the number of words the mix takes, repeats counted.

    Size is the number of words; null and empty texts have none and are never taken. Sources sort by code
    point, null last, and weigh ``weights`` in turn. Each source's budget is its target to the nearest word:
    whole epochs of the source, then the rest in the order of md5(seed, id), cut inside the document that
    crosses it. A null id is ordered by a hash of its text. Rows that repeat an id take the rest by size, one
    after the other; rows equal in id and size are interchangeable. An empty table gives no rows.

    Texts are read once for their sizes and never shuffled; hot sources are spread over key ranges for the sums
    and joined to their plan by broadcast, the others by a shuffle of ids and sizes.
    """
    scratch = Scratch(spark, "mixing")
    light = scratch.save(_keys(docs, id_col, text_col, source_col, seed).select(F.col(id_col).alias("__id"), "__source", "__key", "__size"), "sizes")
    plan, total = _plan(spark, scratch, light, weights, max_epochs)
    scratch.drop_all(but=(light, plan))
    out = _taken(light, plan, total, "__id")
    return out.select(F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__n").alias("source_size"), F.col("__target").alias("target"), (F.col("__whole") * F.col("__size") + F.col("__once")).alias("taken"))


def mixed_documents(spark: SparkSession, docs: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "mix-1") -> DataFrame:
    """The mixture itself: each row as often as the mix takes it, the crossing document cut after its last taken word.

    Needs columns doc_id, text, source and n_chars; returns the columns it is given. What stays of a cut text
    keeps its white space. Null ids, repeats, ties and empty input as in ``mix``. Which row is taken how often
    is decided on ids and sizes; texts of hot sources are then written where they are read.
    """
    scratch, columns = Scratch(spark, "mixing"), docs.columns
    keyed = _keys(docs.select(*[F.col(f"`{c}`").alias(f"__c_{c}") for c in columns]), "__c_doc_id", "__c_text", "__c_source", seed)
    light = scratch.save(keyed.select("__source", "__key", "__size"), "sizes")
    plan, total = _plan(spark, scratch, light, weights, max_epochs)
    scratch.drop_all(but=(plan,))
    out = _taken(keyed, plan, total, "__c_doc_id").where((F.col("__whole") > 0) | (F.col("__key") <= F.col("__cut")))
    copies = F.concat(F.array_repeat(F.col("__size"), F.col("__whole").cast("int")), F.array("__once"))
    out = out.select(*[F.col(f"__c_{c}").alias(c) for c in columns], "__size", F.explode(copies).alias("__words")).where("__words > 0")
    out = out.withColumn("text", F.when(F.col("__words") < F.col("__size"), _first_words(F.col("text"), F.col("__words"))).otherwise(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*[f"`{c}`" for c in columns])


def _first_words(text, n):
    """The first ``n`` words of a text with the white space before and between them."""
    words = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*" + WORD_PATTERN + ")"), F.lit(1))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def op10(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return mix(spark, docs.select("doc_id", "text", "source"))


SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix-1:' || CAST(doc_id AS VARCHAR)) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (ARRAY[5, 2, 1])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST) AS k, CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(w) OVER () AS all_w FROM s),
l AS (SELECT *, (total - coalesce(sum(3.0 * source_size) OVER before, 0)) / (all_w - coalesce(sum(w) OVER before, 0)) AS level FROM r WINDOW before AS (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT min_by(level, k) AS level FROM l WHERE CAST(3.0 * source_size AS DOUBLE) / w >= level),
t AS (SELECT source, source_size, CAST(least(CAST(3.0 * source_size AS DOUBLE), w * v.level) AS DOUBLE) AS target FROM r, v),
b AS (SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * source_size) AS budget FROM t),
p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.budget, CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END AS taken FROM p
"""
