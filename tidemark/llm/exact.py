"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_CHARS, Scratch, held_by, join_by_key, key_filter, text_or_empty

PREFIX_CHARS = 64


def exact_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, sha (binary; null for rows no group could hold unless ``digest_all``).

    Texts are equal when identical without white space; null counts as empty. Of equal texts one row stays: that with
    the most code points, then the smallest id, null ids last, then the smallest hash of the text as it stands. Of rows
    alike in all of these, which repeat one another, any one stays. Each row counts in group_size, and keep_id is null
    only where all ids of the group are. An empty table gives no rows.

    Three refinements, each over what the one before left: length of the stripped text; a hash of its first 64
    characters; SHA-256 of all of it. Texts never enter a shuffle: the second scan recognises survivors by a
    filter of fixed size over the candidate groups, and hashes only those (a few that pass it by chance form
    groups of one). Groups are aggregated before the shuffle, so a hot group is one row per task there, and hot
    groups are joined to their rows by broadcast.
    """
    scratch = Scratch(spark, "exact")
    text = text_or_empty(text_col)
    bare = F.translate(text, SPACE_CHARS, "")
    rows = docs.select(F.col(id_col).alias("id"), F.length(text).alias("n_chars"), F.xxhash64(text).alias("raw"), bare.alias("bare"))
    rows = rows.select("id", "n_chars", "raw", F.length("bare").alias("len"), "bare")
    prefix = F.xxhash64(F.substring("bare", 1, PREFIX_CHARS)).alias("prefix")
    light = scratch.save(rows.select("len", prefix).groupBy("len", "prefix").count(), "prefixes")
    by_length = light.groupBy("len").agg(F.sum("count").alias("n")).where("n > 1").select("len")
    candidates = light.where("count > 1").join(by_length, "len", "left_semi")
    alive = scratch.save(key_filter(candidates, "len", "prefix"), "candidates")
    known = held_by(rows.select("id", "n_chars", "raw", "len", prefix, "bare"), alive, "len", "prefix").withColumnRenamed("_maybe", "alive")
    digest = F.unhex(F.sha2(F.col("bare").cast("binary"), 256))
    hashed = scratch.save(known.select("id", "n_chars", "raw", F.monotonically_increasing_id().alias("at"), "alive", (digest if digest_all else F.when(F.col("alive"), digest)).alias("sha")), "hashed")
    # once stored, rows are told apart by where they stand
    best = F.max_by(F.struct("id", "at"), F.struct(F.col("n_chars"), F.col("id").isNotNull(), -F.col("id"), -F.col("raw"), -F.col("at")))
    groups = scratch.save(hashed.where("alive").groupBy("sha").agg(best.alias("keep"), F.count("*").alias("size")).where("size > 1"), "groups")
    scratch.drop(light, alive)
    out = join_by_key(hashed, groups, ["sha"], "size", hashed.count())
    alone = F.col("keep").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep.id"))
    kept = alone | (F.col("keep.at") == F.col("at"))
    return out.select("id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), "sha")


def op4(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out = exact_groups(spark, docs, digest_all=True)
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
h AS (SELECT doc_id, n, sha256(bare) AS sha FROM d),
r AS (SELECT *, first_value(doc_id) OVER (PARTITION BY sha ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size FROM h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM r
"""
