"""A persistent inverted index: postings with positions in buckets of terms, written in segments, searched by BM25 and phrase.

Folder layout, all Parquet: ``postings`` (term, keys, tf, len, positions), ``blocks`` (per term and block of units: how
many, largest tf, least length) and ``units`` (keys, len), each with a partition column for the segment, postings and
blocks also for the bucket of their terms. A query reads the buckets of its own terms, and in them by pushed-down
filters the row groups of those terms; texts are never read again.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType
from pyspark.sql.utils import AnalysisException

from ..functions import text as tx

BUCKETS = 32
#: Files a bucket is dealt into by unit, so that the postings of a frequent term never meet in one task.
SHARDS = 8
#: Units of a block share a length class and a few bits of their hash.
CLASSES, SPLITS = 24, 4
K1, B = 1.2, 0.75


class TextIndex:
    """An index under ``folder`` of units known by the columns ``keys`` (name -> type)."""

    def __init__(self, spark: SparkSession, folder: str, keys: dict[str, str]):
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), keys
        own = ", ".join(f"{k} {t}" for k, t in keys.items())
        self.schemas = {
            "postings": f"term string, {own}, tf int, len int, block int, positions array<int>, segment int, bucket int",
            "blocks": "term string, block int, n long, max_tf int, min_len int, segment int, bucket int",
            "units": f"{own}, len int, segment int",
        }

    def read(self, part: str) -> DataFrame:
        """Rows of a part of all segments; none before the first append."""
        try:
            return self.spark.read.schema(self.schemas[part]).parquet(f"{self.folder}/{part}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schemas[part])

    def append(self, units: DataFrame, text_col: str = "text") -> int:
        """Indexes the units (keys and text) that the index doesn't hold yet as a new segment; returns its number.

        Files of earlier segments stay as they are. Null texts are units of no words; a key comes once in ``units``.
        """
        names = list(self.keys)
        held = self.read("units")
        segment = (held.agg(F.max("segment")).first()[0] or 0) + 1
        new = units.select(*names, tx.normalize(F.coalesce(F.col(text_col), F.lit(""))).alias("_t"))
        if segment > 1:
            new = new.join(held.select(*names), names, "left_anti")
        size = F.when(F.col("_t") == "", 0).otherwise(F.length("_t") - F.length(F.replace("_t", F.lit(" "), F.lit(""))) + 1)
        new = new.select(*names, size.cast("int").alias("len"), "_t")
        new.select(*names, "len").withColumn("segment", F.lit(segment)).write.mode("append").partitionBy("segment").parquet(f"{self.folder}/units")
        unit = F.xxhash64(*names)
        block = F.least(F.lit(CLASSES - 1), F.floor(F.log2(F.col("len") + 1)).cast("int")) * SPLITS + F.pmod(unit, F.lit(SPLITS)).cast("int")
        rows = _postings(new.where("len > 0").select(*names, "len", "_t"))
        # the only shuffle of postings: a row a term and unit, dealt by bucket and shard, which are made again behind it
        bucket = (F.crc32("term") % BUCKETS).cast("int")
        dealt = rows.repartition(bucket, F.pmod(unit, F.lit(SHARDS)))
        dealt = dealt.select("term", *names, F.size("positions").alias("tf"), "len", block.alias("block"), "positions", F.lit(segment).alias("segment"), bucket.alias("bucket"))
        dealt = dealt.sortWithinPartitions("bucket", "term", "block")
        dealt.write.mode("append").option("compression", "zstd").partitionBy("segment", "bucket").parquet(f"{self.folder}/postings")
        written = self.read("postings").where(F.col("segment") == segment)
        blocks = written.groupBy("bucket", "term", "block").agg(F.count("*").alias("n"), F.max("tf").alias("max_tf"), F.min("len").alias("min_len"))
        blocks = blocks.select("term", "block", "n", "max_tf", "min_len", F.lit(segment).alias("segment"), "bucket")
        blocks.repartition("bucket").sortWithinPartitions("bucket", "term").write.mode("append").partitionBy("segment", "bucket").parquet(f"{self.folder}/blocks")
        return segment

    def of_terms(self, part: str, terms: Sequence[str]) -> DataFrame:
        """Rows of the terms, from their buckets only."""
        buckets = sorted({zlib.crc32(t.encode()) % BUCKETS for t in terms})
        return self.read(part).where(F.col("bucket").isin(buckets) & F.col("term").isin(list(terms)))

    def _totals(self) -> tuple[int, float]:
        n, mean = self.read("units").agg(F.count("*"), F.avg("len")).first()
        return n, mean or 1.0

    def _weights(self, terms: Sequence[str]) -> tuple[list, int, float]:
        """Block statistics of the terms (at most one row a term, segment and block), number and mean length of units."""
        return self.of_terms("blocks", terms).select("term", "segment", "block", "n", "max_tf", "min_len").collect(), *self._totals()

    def _scores(self, hits: DataFrame, df: dict[str, int], n: int, mean: float) -> DataFrame:
        idf = {t: float(_log1p((n - d + 0.5) / (d + 0.5))) for t, d in df.items()}
        weight = F.lit(0.0)
        for t, w in idf.items():
            weight = F.when(F.col("term") == t, w).otherwise(weight)
        part = weight * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
        return hits.groupBy(*self.keys).agg(F.sum(part).alias("score"))

    def search(self, query: str, stopwords: frozenset[str] = frozenset()) -> DataFrame:
        """keys, score of every unit with any term of the query."""
        terms = tx.query_terms(query, stopwords)
        stats, n, mean = self._weights(terms)
        df = {t: sum(r["n"] for r in stats if r["term"] == t) for t in terms}
        return self._scores(self.of_terms("postings", terms), df, n, mean)

    def top(self, query: str, k: int, stopwords: frozenset[str] = frozenset()) -> DataFrame:
        """The k best units with rank, ties by key: blocks whose bound can't reach the k-th best score are not read.

        Blocks are taken by their bound until they hold enough units to set a k-th best score; then all blocks whose
        bound reaches it are read, so the result is that of ``search``.
        """
        terms = tx.query_terms(query, stopwords)
        stats, n, mean = self._weights(terms)
        df = {t: sum(r["n"] for r in stats if r["term"] == t) for t in terms}
        bound: dict[tuple[int, int], float] = {}
        most: dict[tuple[int, int], int] = {}
        for r in stats:
            at, tf = (r["segment"], r["block"]), r["max_tf"]
            d = df[r["term"]]
            bound[at] = bound.get(at, 0.0) + float(_log1p((n - d + 0.5) / (d + 0.5))) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * r["min_len"] / mean))
            most[at] = max(most.get(at, 0), r["n"])
        hits, best, first = self.of_terms("postings", terms), [F.desc("score"), *self.keys], []
        for at in sorted(bound, key=lambda a: -bound[a]):
            first.append(at)
            if sum(most[a] for a in first) >= k:
                break
        wanted = list(bound)
        if len(first) < len(bound):
            scores = self._scores(hits.where(_within(first)), df, n, mean).orderBy(*best).limit(k).agg(F.count("*"), F.min("score")).first()
            if scores[0] == k:
                wanted = [a for a in bound if bound[a] * (1 + 1e-9) >= scores[1]]
        out = self._scores(hits.where(_within(wanted)) if len(wanted) < len(bound) else hits, df, n, mean).orderBy(*best).limit(k)
        return out.select(*self.keys, "score", F.row_number().over(_ordered(best)).alias("rank"))

    def phrase(self, text: str) -> DataFrame:
        """keys, n: units that hold the words of ``text`` in a row, with the number of places."""
        words = "".join(c.lower() if c.isalnum() else " " for c in text).split()
        hits = self.of_terms("postings", list(dict.fromkeys(words)))
        named = [F.max(F.when(F.col("term") == w, _moved("positions", i))).alias(f"p{i}") for i, w in enumerate(words)]
        held = hits.groupBy(*self.keys).agg(*named)
        common = reduce(F.array_intersect, [F.col(f"p{i}") for i in range(len(words))])
        return held.select(*self.keys, F.size(common).cast("long").alias("n")).where("n > 0")


#: Postings of one Arrow batch.
BATCH = 20_000


def _postings(placed: DataFrame) -> DataFrame:
    """The columns of ``placed`` but its normalised text ``_t``, and term and positions: a row a term and unit, made where the text is read."""
    schema = StructType(placed.drop("_t").schema.fields).add("term", StringType()).add("positions", ArrayType(IntegerType()))

    def run(batches):
        import pyarrow as pa

        def packed(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        out = []
        for b in batches:
            for k in range(b.num_rows):
                *own, text = (c[k].as_py() for c in b.columns)
                at: dict[str, list[int]] = {}
                for i, w in enumerate(text.split(" ")):
                    at.setdefault(w, []).append(i)
                for term, places in at.items():
                    out.append((*own, term, places))
                    if len(out) == BATCH:
                        yield packed(out)
                        out = []
        if out:
            yield packed(out)
        pa.default_memory_pool().release_unused()

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return placed.mapInArrow(run, schema)


def _moved(positions: str, by: int) -> Column:
    return F.transform(positions, lambda p: p - by)


def _log1p(x: float) -> float:
    from math import log

    return log(1 + x)


def _within(blocks: Sequence[tuple[int, int]]) -> Column:
    """Whether a posting is in one of the (segment, block) pairs; at most one list a segment."""
    by: dict[int, list[int]] = {}
    for segment, block in blocks:
        by.setdefault(segment, []).append(block)
    return reduce(lambda x, y: x | y, [(F.col("segment") == s) & F.col("block").isin(b) for s, b in by.items()], F.lit(False))


def _ordered(columns):
    from pyspark.sql import Window

    return Window.orderBy(*columns)


_BUILT: dict[tuple[str, str], TextIndex] = {}


def built(spark: SparkSession, name: str, folder: str, units: DataFrame, keys: dict[str, str]) -> TextIndex:
    """The index of ``units`` known in this session as ``name``, written under ``folder`` at its first use."""
    at = (spark.sparkContext.applicationId, name)
    if at not in _BUILT:
        index = TextIndex(spark, folder, keys)
        index.append(units)
        _BUILT[at] = index
    return _BUILT[at]
