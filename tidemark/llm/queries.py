"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, exact, html, lines, merkle, mixing, neighbors, packing, rules, secrets, simhash, tokenstore, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(op: Callable, *names: str) -> Query:
    return lambda spark, sf_dir: op(spark, *[table(spark, sf_dir, n) for n in names])


QUERIES: dict[str, Query] = {
    "op1_toxicity": _over(toxicity.op1, "documents", "labels"),
    "op2_embedding_neighbors": _over(neighbors.op2, "embeddings"),
    "op3_token_files": _over(tokenstore.op3, "documents"),
    "op4_exact_dedup": _over(exact.op4, "documents"),
    "op5_secrets": _over(secrets.op5, "documents"),
    "op6_line_dedup": _over(lines.op6, "documents"),
    "op7_packing": _over(packing.op7, "documents"),
    "op8_simhash": _over(simhash.op8, "documents"),
    "op9_html_text": _over(html.op9, "pages"),
    "op10_mixing": _over(mixing.op10, "documents"),
    "op11_alignment": _over(alignment.op11, "documents"),
    "op12_quality_rules": _over(rules.op12, "documents", "labels"),
    "op13_merkle_manifest": _over(merkle.op13, "documents"),
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact.SQL,
    "op10_mixing": mixing.SQL,
}
