"""Queries of label matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels
from .base import query, table

#: Labels of parts, those of odd keys misspelt: a letter doubled, dropped or replaced by the key.
LABEL_SQL = """p AS (SELECT DISTINCT lower(p_type || ' ' || p_name || ' ' || replace(p_brand, '#', ' ')) AS alias, p_partkey % 4 AS kind FROM part),
l AS (SELECT DISTINCT CASE kind WHEN 0 THEN alias WHEN 1 THEN substr(alias, 1, 3) || substr(alias, 3) WHEN 2 THEN substr(alias, 1, 4) || substr(alias, 6) ELSE replace(alias, 'e', 'i') END AS label FROM p), k AS (SELECT DISTINCT alias FROM p)"""


def _labels(spark, d):
    alias = F.lower(F.concat_ws(" ", "p_type", "p_name", F.replace("p_brand", F.lit("#"), F.lit(" "))))
    p = table(spark, d, "part").select(alias.alias("alias"), (F.col("p_partkey") % 4).alias("kind")).distinct()
    cut = lambda a, n=None: F.substring("alias", a, n) if n else F.expr(f"substring(alias, {a})")
    label = F.when(F.col("kind") == 0, F.col("alias")).when(F.col("kind") == 1, F.concat(cut(1, 3), cut(3))).when(F.col("kind") == 2, F.concat(cut(1, 4), cut(6))).otherwise(F.replace("alias", F.lit("e"), F.lit("i")))
    return p.select(label.alias("label")).distinct(), p.select("alias").distinct()


@query("near_labels", f"WITH {LABEL_SQL} SELECT label, alias, round(1 - levenshtein(label, alias) / greatest(length(label), length(alias)), 8) AS score FROM l, k WHERE 1 - levenshtein(label, alias) / greatest(length(label), length(alias)) >= 0.85")
def near_labels(spark, d):
    """Every pair of a misspelt label and a known one that are 85 % alike; few pairs are compared."""
    written, known = _labels(spark, d)
    pairs = labels.near_pairs(written, known).toDF("label", "alias").withColumn("score", labels.spelling(F.col("label"), F.col("alias")))
    return pairs.where("score >= 0.85").select("label", "alias", F.round("score", 8).alias("score"))


@query("label_matches", f"""WITH {LABEL_SQL}, s AS (SELECT label, alias, CASE WHEN label = alias THEN 1.0 WHEN starts_with(label, alias || ' ') THEN 0.98 ELSE 1 - levenshtein(label, alias) / greatest(length(label), length(alias)) END AS score FROM l, k)
SELECT label, alias, round(score, 8) AS score FROM s WHERE score >= 0.85 QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, length(alias), alias) = 1""")
def label_matches(spark, d):
    """The best known label of each written one by rule or spelling."""
    written, known = _labels(spark, d)
    aliases = known.where("alias is not null").select(F.lit("part").alias("metric"), "alias")
    return labels.best_matches(written, aliases).select("label", "alias", F.round("score", 8).alias("score"))
