"""Search as users see it: understood queries, banded matches with their concepts, passages, tone and topics around them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import safe_div


def any_word(words: Sequence[str]) -> str:
    """Pattern of any of the words or phrases, alone in lower-cased text."""
    return r"(?<![\p{L}\p{N}])(?:" + "|".join(w.lower().replace(" ", r"\s+") for w in words) + r")(?![\p{L}\p{N}])"


def semantic_text(question: Column, hints: Mapping[str, Sequence[str]], asking: Sequence[str]) -> Column:
    """What a question is about, for an embedder: its words without those of asking, and hint words for phrases it holds."""
    kept = F.array_join(F.filter(tx.words(question), lambda w: ~w.isin(list(asking))), " ")
    low = F.lower(question)
    added = [F.when(low.rlike(any_word([phrase])), " ".join(words)) for phrase, words in hints.items()]
    return F.concat_ws(" ", F.when(kept != "", kept), *added)


def expansions(query: str, synonyms: Mapping[str, tuple[Sequence[str], float, Sequence[str]]], stopwords: frozenset[str]) -> list[tuple[str, float, Sequence[str]]]:
    """(term, weight, gate words) of a query: its own terms at 1, synonyms of phrases it holds at their weight, behind their gate."""
    terms = tx.query_terms(query, stopwords)
    low, out = " ".join(terms), [(t, 1.0, ()) for t in terms]
    for phrase, (others, weight, gate) in synonyms.items():
        if phrase in low:
            out += [(o, weight, gate) for o in others if o not in terms]
    return out


def expanded_score(text: str, expanded: Sequence[tuple[str, float, Sequence[str]]]) -> Column:
    """Weighted occurrences of a query's terms and synonyms; a gated synonym counts only where one of its gate words stands too."""
    low = F.lower(text)
    parts = []
    for term, weight, gate in expanded:
        n = F.regexp_count(low, F.lit(any_word([term]))) * F.lit(weight)
        parts.append(F.when(low.rlike(any_word(gate)), n).otherwise(0.0) if gate else n)
    return sum(parts[1:], parts[0])


def banded(docs: DataFrame, id_col: str, text_col: str, phrase: str, concepts: Mapping[str, Sequence[str]], stopwords: frozenset[str]) -> DataFrame:
    """(id, band, concepts, hits): literal where the phrase stands, strong where all of its terms do, weak where a term or a concept's form does.

    Concepts name what matched; hits counts terms and forms. One scan; documents without any match are left out.
    """
    low, terms = F.lower(text_col), tx.query_terms(phrase, stopwords)
    has = lambda words: low.rlike(any_word(words))
    named = [F.when(has(forms), name) for name, forms in concepts.items()]
    everything = list(dict.fromkeys([*terms, *[f for forms in concepts.values() for f in forms]]))
    all_terms = has([terms[0]])
    for t in terms[1:]:
        all_terms = all_terms & has([t])
    band = F.when(has([phrase]), "literal").when(all_terms, "strong").otherwise("weak")
    hits = F.regexp_count(low, F.lit(any_word(everything)))
    return docs.where(has(everything)).select(F.col(id_col).alias("id"), band.alias("band"), F.concat_ws(",", *named).alias("concepts"), hits.cast("long").alias("hits"))


def best_band(found: DataFrame) -> DataFrame:
    """Of several searches' results one row an id: its best band, all its concepts in order, its most hits."""
    rank = F.when(F.col("band") == "literal", 0).when(F.col("band") == "strong", 1).otherwise(2)
    g = found.groupBy("id").agg(F.min(rank).alias("_b"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("concepts", ","))))), ",").alias("concepts"), F.max("hits").alias("hits"))
    return g.select("id", F.when(F.col("_b") == 0, "literal").when(F.col("_b") == 1, "strong").otherwise("weak").alias("band"), "concepts", "hits")


def occurrences(docs: DataFrame, id_col: str, text_col: str, word: str) -> DataFrame:
    """(id, at, size): where a word starts in each text, from 0, and the text's length."""
    parts = docs.select(F.col(id_col).alias("id"), F.length(text_col).alias("size"), F.posexplode(F.split(F.lower(text_col), word, -1)).alias("i", "part"))
    w = Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    at = F.sum(F.length("part")).over(w) + F.col("i") * len(word)
    last = F.col("i") == F.max("i").over(Window.partitionBy("id"))
    return parts.select("id", at.alias("at"), "size", last.alias("_last")).where("not _last").drop("_last")


def passages_around(found: DataFrame, length: int, pad: int = 120) -> DataFrame:
    """(id, start, end, matches): padded windows around occurrences, merged where they overlap or touch."""
    lo, hi = F.greatest(F.lit(0), F.col("at") - pad), F.least(F.col("size"), F.col("at") + length + pad)
    w = Window.partitionBy("id").orderBy("lo", "hi")
    x = found.select("id", lo.alias("lo"), hi.alias("hi")).withColumn("_end", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    x = x.withColumn("_new", F.when(F.col("lo") <= F.col("_end"), 0).otherwise(1)).withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.groupBy("id", "_island").agg(F.min("lo").cast("long").alias("start"), F.max("hi").cast("long").alias("end"), F.count("*").alias("matches")).drop("_island")


def tone_of(text: Column, good: Sequence[str], bad: Sequence[str]) -> tuple[Column, Column, Column]:
    """(good words, bad words, their balance in -1..1) of a text."""
    low = F.lower(text)
    a, b = F.regexp_count(low, F.lit(any_word(good))), F.regexp_count(low, F.lit(any_word(bad)))
    return a, b, F.coalesce(safe_div((a - b).cast("double"), (a + b).cast("double")), F.lit(0.0))


def topics(docs: DataFrame, id_col: str, text_col: str, concepts: Mapping[str, Sequence[str]], most: int = 3, least: int = 1) -> DataFrame:
    """(id, topic, n, rank): the concepts a document speaks of most, ties by name."""
    low = F.lower(text_col)
    counted = F.array(*[F.struct(F.lit(c).alias("topic"), F.regexp_count(low, F.lit(any_word(forms))).cast("long").alias("n")) for c, forms in concepts.items()])
    rows = docs.select(F.col(id_col).alias("id"), F.explode(counted).alias("_t")).select("id", "_t.topic", "_t.n").where(F.col("n") >= least)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("n"), "topic"))
    return rows.withColumn("rank", rank.cast("long")).where(F.col("rank") <= most)
