"""Retrieval: postings, BM25, vector search, fusion, evaluation and passage work."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.numeric import safe_div
from ..functions.scratch import Stored


def postings(docs: DataFrame, id_col: str, text_col: str, terms: Sequence[str] | None = None) -> DataFrame:
    """(id, term, tf); with ``terms`` only those, found before anything is shuffled."""
    w = tx.words(text_col)
    if terms is not None:
        w = F.filter(w, lambda x: x.isin(list(terms)))
    return docs.select(F.col(id_col).alias("id"), F.explode(w).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, id_col: str, text_col: str, query: str, stopwords: frozenset[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) of documents with any query term; the larger the better.

    A query has few terms, so each text gives its length and a count per term where it is read: nothing is
    shuffled but one row of totals, and texts without a term are only measured, not scored.
    """
    terms = tx.query_terms(query, stopwords)
    low = F.lower(text_col)
    there = [low.contains(t) for t in terms]  # a plain search spares most texts the pattern
    length, counts = F.regexp_count(low, F.lit(tx.WORD)), [F.when(c, F.regexp_count(low, F.lit(tx.one_word(t)))).otherwise(0) for c, t in zip(there, terms)]
    held = [c & low.rlike(tx.one_word(t)) for c, t in zip(there, terms)]
    totals = docs.agg(F.count("*").alias("n"), F.avg(F.coalesce(length, F.lit(0))).alias("avg_len"), *[F.count_if(h).alias(f"df{i}") for i, h in enumerate(held)])
    hits = docs.where(reduce(lambda x, y: x | y, held)).select(F.col(id_col).alias("id"), length.alias("len"), *[c.alias(f"tf{i}") for i, c in enumerate(counts)])
    scored = hits.crossJoin(F.broadcast(totals))  # one row

    def part(i: int) -> Column:
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        return F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5)) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))

    return scored.select("id", reduce(lambda x, y: x + y, [part(i) for i in range(len(terms))]).alias("score"))


def top_k(df: DataFrame, score: str, tie: str, k: int) -> DataFrame:
    """The k best with rank from 1 (a report: k rows leave each task)."""
    best = df.orderBy(F.desc(score), tie).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), tie)))


#: Rows and queries of a block; a pair of blocks is one matrix product of a task.
ROW_BLOCK = 16_384
QUERY_BLOCK = 1_024


def nearest(queries: DataFrame, rows: DataFrame, id_col: str, vector: str, k: int, scope: Column | None = None) -> DataFrame:
    """(query, id, sim, rank): the k rows most similar to each of a stated set of queries.

    Rows, filtered by ``scope`` before ranking, and queries are dealt into blocks by hash. Each pair of blocks is
    one matrix product that leaves the k best of each query, so no side is broadcast and what is shuffled is the
    rows once for every ``QUERY_BLOCK`` queries. Similarities count as equal within 1e-12, ties by id. Vectors of
    different lengths don't meet; null and zero ones, and those with a null component, are no candidates.
    """
    pool = (rows if scope is None else rows.where(scope)).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    across, down = 1 + asked.count() // QUERY_BLOCK, 1 + pool.count() // ROW_BLOCK
    own = lambda df, n: df.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn("w", F.size("v"))
    dealt = own(pool, down).select(F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("qb"), F.col("_b").alias("rb"), "w", "id", "v")
    probes = own(asked, across).select(F.col("_b").alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("rb"), "w", "id", "v")

    def compare(left, right):
        import numpy as np
        import pyarrow as pa

        def unit(t):
            v = t.column("v").combine_chunks()
            x = v.values.to_numpy(zero_copy_only=False)[v.offsets[0].as_py() : v.offsets[len(v)].as_py()].reshape(len(v), -1)
            norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
            return t.column("id").to_numpy(), x / np.where(norm > 0, norm, np.nan)

        found = []
        if len(left) and len(right):
            (qi, q), (ri, r) = unit(left), unit(right)
            sims = np.round(q @ r.T, 12)
            for i, row in zip(qi, sims):
                ok = np.flatnonzero(~np.isnan(row) & (ri != i))
                best = ok[np.lexsort((ri[ok], -row[ok]))[:k]]
                found.append((np.full(len(best), i), ri[best], row[best]))
        a, b, sim = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query": pa.array(a, pa.int64()), "id": pa.array(b, pa.int64()), "sim": pa.array(sim, pa.float64())})

    sims = probes.groupBy("qb", "rb", "w").cogroup(dealt.groupBy("qb", "rb", "w")).applyInArrow(compare, "query long, id long, sim double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("sim"), "id"))
    return sims.withColumn("rank", rank).where(F.col("rank") <= k)


def reciprocal_rank_fusion(lists: Sequence[tuple[DataFrame, float]], k: int = 60) -> DataFrame:
    """(id, score): sum of weight / (k + rank) over ranked lists with ranks from 1."""
    parts = [df.select("id", (F.lit(w) / (k + F.col("rank"))).alias("s")) for df, w in lists]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("id").agg(F.sum("s").alias("score"))


def retrieval_metrics(ranked: DataFrame, query: str, rank: str, relevant: Column, queries: DataFrame, ks: Sequence[int]) -> DataFrame:
    """recall@k and mean reciprocal rank: each query by its first relevant hit, those without one count zero."""
    first = ranked.where(relevant).groupBy(query).agg(F.min(rank).alias("_r"))
    all_q = queries.select(query).distinct().join(first, query, "left")
    at = [F.avg(F.coalesce((F.col("_r") <= k).cast("double"), F.lit(0.0))).alias(f"recall_at_{k}") for k in ks]
    return all_q.agg(F.count("*").alias("queries"), *at, F.avg(F.coalesce(1 / F.col("_r"), F.lit(0.0))).alias("mrr"))


#: Shingles with over one in so many places are told apart from the others.
HOT_SHARE = 256


def boilerplate(docs: DataFrame, id_col: str, text_col: str, n: int = 8, least: int = 10, share: float = 0.5) -> DataFrame:
    """(id, shingles, common, boilerplate): a shingle is common in at least ``least`` documents, a text is boilerplate if ``share`` of its shingles are.

    Counts are aggregated before the shuffle, so a license line is one row a task there.
    """
    stored = Stored(docs.select(F.col(id_col).alias("id"), tx.shingle_hashes(text_col, n).alias("ss")), "shingles")
    sets = stored.df
    counts = sets.select(F.explode("ss").alias("s")).groupBy("s").agg(F.count("*").alias("df")).where(F.col("df") >= least)
    common = Stored(counts, "common")
    total = sets.agg(F.sum(F.size("ss"))).first()[0] or 0
    # a shingle with over one in HOT_SHARE of all is hot, so there are never more hot ones
    hot = common.df.where(F.col("df") * HOT_SHARE > total).select("s")
    held = {r["s"] for r in hot.collect()}
    many = F.array(*[F.lit(x) for x in sorted(held)]).cast("array<long>")
    counted = sets.select("id", F.size("ss").alias("shingles"), F.size(F.array_intersect("ss", many)).alias("hot"), F.array_except("ss", many).alias("ss"))
    light = common.df.join(F.broadcast(hot), "s", "left_anti").select("s")
    rest = counted.select("id", F.explode("ss").alias("s")).join(light.hint("merge"), "s", "left_semi").groupBy("id").agg(F.count("*").alias("c"))
    out = counted.where("shingles > 0").groupBy("id").agg(F.sum("shingles").alias("shingles"), F.sum("hot").alias("hot")).join(rest, "id", "left")
    out = out.select("id", "shingles", (F.col("hot") + F.coalesce("c", F.lit(0))).alias("common"))
    return out.withColumn("boilerplate", F.col("common") >= share * F.col("shingles"))


def mention_trend(docs: DataFrame, id_col: str, text_col: str, terms: Sequence[str], company: str, period: str) -> DataFrame:
    """Documents and mentions of any term per company and period."""
    hits = docs.select(company, period, tx.count_matches(text_col, terms).alias("_n")).where("_n > 0")
    return hits.groupBy(company, period).agg(F.count("*").alias("documents"), F.sum("_n").cast("long").alias("mentions"))


def latest_change(points: DataFrame, company: str, period: str, value: str) -> DataFrame:
    """Last value and its change on the one before."""
    w = Window.partitionBy(company).orderBy(period)
    back = F.row_number().over(Window.partitionBy(company).orderBy(F.desc(period)))
    return points.withColumns({"change": F.col(value) - F.lag(value).over(w), "_r": back}).where("_r = 1").select(company, period, value, "change")


def classifier_report(df: DataFrame, gold: str, predicted: str, classes: Sequence) -> DataFrame:
    """Per class: support, predicted, hits, precision, recall, f1."""
    cells = df.groupBy(F.col(gold).alias("_g"), F.col(predicted).alias("_p")).agg(F.count("*").alias("_n"))
    rows = []
    for c in classes:
        g, p = F.col("_g") == c, F.col("_p") == c
        n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("_n"))), F.lit(0))
        rows.append(cells.agg(F.lit(str(c)).alias("class"), n(g).alias("support"), n(p).alias("predicted"), n(g & p).alias("hits")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    precision, recall = safe_div("hits", "predicted"), safe_div("hits", "support")
    out = out.withColumns({"precision": precision, "recall": recall})
    return out.withColumn("f1", safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def dedupe_by_signature(hits: DataFrame, text_col: str, order: Sequence[Column]) -> DataFrame:
    """Best hit of each signature by the rerank order."""
    w = Window.partitionBy("_sig").orderBy(*order)
    return hits.withColumn("_sig", tx.signature(text_col)).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_sig", "_r")


def cap_floods(hits: DataFrame, order: str, concept: str, company: str, concept_cap: int = 6, company_cap: int = 10) -> DataFrame:
    """Ranked hits with sunk: true for those beyond a concept's or company's cap among the ones kept before; ``order`` is unique.

    Decided in rounds to a fixed point. A hit stays if it is within both caps even when all open hits before it stay; it
    sinks once as many as a cap allows stay before it. Only the first hits of each concept and company are ranked, so a
    flood of one is cut where it is read, and each round leaves one row a concept and company.
    """
    rows = hits.select(F.col(order).alias("_o"), F.col(concept).alias("_a"), F.col(company).alias("_b"))
    done, left = [], [Stored(rows, "floods")]
    kept = None
    while True:
        todo = left[-1].df
        if todo.isEmpty():
            break
        alive = todo.withColumn("_new", F.lit(True))
        if kept is not None:
            alive = alive.unionByName(kept.withColumn("_new", F.lit(False)))
        first = lambda c, cap: alive.withColumn("_r", F.row_number().over(Window.partitionBy(c).orderBy("_o"))).where(F.col("_r") <= cap)  # noqa: B023, E731
        safe = first("_a", concept_cap).where("_new").select("_o", "_a", "_b").join(first("_b", company_cap).where("_new").select("_o"), "_o", "left_semi")
        done.append(Stored(safe, "kept"))
        kept = done[0].df
        for more in done[1:]:
            kept = kept.unionByName(more.df)
        full = lambda c, cap, name: kept.groupBy(F.col(c).alias(f"_{name}")).agg(F.count("*").alias("_n"), F.max("_o").alias(f"_at{name}")).where(F.col("_n") >= cap).drop("_n")  # noqa: B023, E731
        rest = todo.join(kept.select("_o"), "_o", "left_anti")
        rest = rest.join(full("_a", concept_cap, "fa"), F.col("_a").eqNullSafe(F.col("_fa")), "left").join(full("_b", company_cap, "fb"), F.col("_b").eqNullSafe(F.col("_fb")), "left")
        sunk = F.coalesce(F.col("_o") > F.col("_atfa"), F.lit(False)) | F.coalesce(F.col("_o") > F.col("_atfb"), F.lit(False))
        left.append(Stored(rest.where(~sunk).select("_o", "_a", "_b"), "floods"))
        left[-2].drop()
    left[-1].drop()
    if kept is None:
        return hits.withColumn("sunk", F.lit(False))
    return hits.join(kept.select(F.col("_o").alias(order), F.lit(False).alias("_kept")), order, "left").withColumn("sunk", F.col("_kept").isNull()).select(*hits.columns, "sunk")


def greedy_mmr(sentences: DataFrame, group: str, key: str, score: str, vector: str, k: int, weight: float = 0.5) -> DataFrame:
    """(group, key, pick): maximal marginal relevance within each document's sentences, ties by the smaller key.

    Each pick is one pass that leaves a row per group, so a group may be of any size. Keys are unique in a group;
    rows without a vector or score are no candidates.
    """
    v = F.col("_v")
    norm = F.greatest(F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-12))
    rows = sentences.select(F.col(group).alias("_g"), F.col(key).alias("_key"), F.col(score).cast("double").alias("_s"), F.col(vector).cast("array<double>").alias("_v"))
    rows = rows.where("_v is not null and _s is not null").withColumn("_n", norm).select("_g", "_key", "_s", F.transform(v, lambda x: x / F.col("_n")).alias("_v"))
    best = F.min(F.when(~F.col("_taken"), F.struct((-F.col("_gain")).alias("loss"), F.col("_key").alias("key"), F.col("_v").alias("v"))))
    picks = None
    for _ in range(k):
        if picks is None:
            near, taken, seen = F.lit(0.0), F.lit(False), rows
        else:
            seen = rows.join(picks.withColumnRenamed("_g", "_h"), F.col("_g").eqNullSafe(F.col("_h")))
            dot = lambda p: F.aggregate(F.zip_with(v, p["v"], lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
            near, taken = F.array_max(F.transform("_picks", dot)), F.exists("_picks", lambda p: p["key"] == F.col("_key"))
        seen = seen.withColumns({"_gain": weight * F.col("_s") - (1 - weight) * near, "_taken": taken})
        before = [] if picks is None else [F.any_value("_picks").alias("_picks")]
        found = seen.groupBy("_g").agg(best.alias("_best"), *before)
        one = F.when(F.col("_best").isNotNull(), F.array("_best")).otherwise(F.slice(F.array("_best"), 1, 0))
        picks = found.select("_g", (one if not before else F.concat("_picks", one)).alias("_picks"))
    out = picks.select("_g", F.posexplode("_picks").alias("_at", "_p"))
    return out.select(F.col("_g").alias(group), F.col("_p.key").alias(key), (F.col("_at") + 1).alias("pick"))


def expand_query(text: str, synonyms: Mapping[str, Sequence[str]], stopwords: frozenset[str], weight: float = 0.5) -> dict[str, float]:
    """Terms and phrases of a query with weights: its own words 1, synonyms of phrases it holds less."""
    own = {t: 1.0 for t in tx.query_terms(text, stopwords)}
    low = " ".join(tx.query_terms(text, stopwords))
    for phrase, others in synonyms.items():
        if phrase in low:
            for o in others:
                own.setdefault(o, weight)
    return own
