"""Queries over catalog database files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import shared_folder
from ..sources import catalogsource
from .base import query, table

COLUMNS = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"


def _catalog(spark, d):
    """The orders as committed catalog files, read back as a table."""
    catalogsource.register(spark)
    at = shared_folder(spark, "catalog")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    dealt = orders.repartition(8, "o_custkey").selectExpr("cast(o_orderkey as long) o_orderkey", "cast(o_custkey as long) o_custkey", "cast(o_totalprice as double) o_totalprice", "o_orderpriority")
    dealt.write.format("catalog").mode("append").option("path", at).option("table", "orders").save()
    return spark.read.format("catalog").option("path", at).option("table", "orders").option("partRows", 50_000).schema(COLUMNS).load()


SQL = "SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 9 > 0 THEN o_orderpriority END AS p FROM orders"


@query("catalog_scan", f"WITH o AS ({SQL}) SELECT p AS priority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM o WHERE o_totalprice > 100000 AND (p IN ('1-URGENT', '2-HIGH', '5-LOW')) GROUP BY 1")
def catalog_scan(spark, d):
    """Filters answered by the database files, one task a range of rows."""
    found = _catalog(spark, d).where("o_totalprice > 100000 and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')")
    return found.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("catalog_scoped_join", f"WITH o AS ({SQL}) SELECT c_mktsegment AS segment, count(*) AS n FROM o JOIN customer ON o_custkey = c_custkey WHERE p IS NULL OR p LIKE '4-%' GROUP BY 1")
def catalog_scoped_join(spark, d):
    """A catalog's rows joined to another table, rows without a priority included."""
    found = _catalog(spark, d).where("o_orderpriority is null or o_orderpriority like '4-%'")
    return found.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"))
