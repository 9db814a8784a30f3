"""A training corpus from raw documents: reject toxic texts, delete repeated runs of lines, keep one of each group of
near-duplicates, mix the sources to their target weights and pack the result into sequences.

Each stage takes (spark, docs, sf_dir), docs being all rows its predecessor kept, and returns a DataFrame; ``run``
writes each result as Parquet into the shared folder and rereads it for the next stage. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lines, mixing, packing, simhash, toxicity
from tidemark.llm.common import Scratch, table

#: SQL can express neither the trained scores nor the fingerprint components; tests compare with a brute-force version.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose worst window scores at least the threshold go; clean ones stay as they are."""
    return toxicity.reject(spark, docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines of 50 words and more are cut from the texts; a text that held nothing else becomes empty and goes."""
    out = lines.dedup_lines(spark, docs)
    emptied = (F.col("lines_removed") > 0) & (F.trim(F.translate("text", "\t\n\x0b\x0c\r", "")) == "")
    out = out.where(~F.coalesce(emptied, F.lit(False)))
    return out.withColumn("n_chars", F.when(F.col("lines_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the smallest doc_id, null ids last, then the smallest hash of its columns."""
    return simhash.representatives(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it, the crossing one cut after its last taken word."""
    return mixing.mixed_documents(spark, docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place."""
    return packing.pack(spark, docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written to the shared folder and reread."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.save(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
