"""Queries of a resumed re-embedding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import shared_folder
from ..operators.reembed import Migration
from ..sources import bundles
from .base import query, table


@query("reembed_resumed", "SELECT doc_id AS id, CAST(length(coalesce(text, '')) AS DOUBLE) AS v0, CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), 'e', '')) AS DOUBLE) AS v1 FROM documents")
def reembed_resumed(spark, d):
    """Every text's vector after a first run over the English ones only, whose finished batches the whole run doesn't repeat unless they changed."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    letters = lambda t: F.array(F.length(t).cast("double"), (F.length(t) - F.length(F.replace(t, F.lit("e"), F.lit("")))).cast("double"))
    at = Migration(spark, shared_folder(spark, "reembed"), "v2", lambda c: letters(F.col(c)), batches=4)
    at.work(docs.where("lang = 'en'"))
    if not at.run(docs):
        raise RuntimeError("the source changed while it was read")
    return bundles.current(spark, at.root).select("id", F.get("vector", F.lit(0)).alias("v0"), F.get("vector", F.lit(1)).alias("v1"))
