"""Shared inputs of the registered queries and the SQL that describes the same inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import periods

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a query under ``name``, with its DuckDB SQL where there is one."""

    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quarterly(spark: SparkSession, d: str) -> DataFrame:
    """slug (nation), qi, revenue, units, filings of each quarter."""
    t = lambda n: table(spark, d, n)
    items = t("lineitem").select("l_orderkey", "l_extendedprice", "l_discount", "l_quantity")
    orders = t("orders").select("o_orderkey", "o_custkey", periods.quarter_index("o_orderdate").alias("qi"))
    who = t("customer").select("c_custkey", "c_nationkey").join(t("nation").select("n_nationkey", F.col("n_name").alias("slug")), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(who, F.col("o_custkey") == F.col("c_custkey"))
    revenue = F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return joined.groupBy("slug", "qi").agg(revenue.alias("revenue"), F.sum("l_quantity").alias("units"), F.count_distinct("o_orderkey").alias("filings"))


Q_SQL = """q AS (SELECT n_name AS slug, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) - 1 AS INTEGER) AS qi, sum(l_extendedprice * (1 - l_discount)) AS revenue,
 sum(l_quantity) AS units, count(DISTINCT o_orderkey) AS filings FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"""

#: dx: change on the same quarter a year earlier; sue, z and terciles follow.
SUE_SQL = Q_SQL + """, y AS (SELECT a.*, b.revenue AS prior, a.revenue - b.revenue AS dx FROM q a LEFT JOIN q b ON a.slug = b.slug AND a.qi = b.qi + 4),
s0 AS (SELECT *, CASE WHEN count(dx) OVER w >= 4 THEN stddev_samp(dx) OVER w END AS sd FROM y WINDOW w AS (PARTITION BY slug ORDER BY qi ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
s AS (SELECT *, CASE WHEN sd > 0 THEN dx / sd END AS sue FROM s0),
z0 AS (SELECT *, avg(sue) OVER w AS m, stddev_samp(sue) OVER w AS zsd, count(sue) OVER w AS pool FROM s WINDOW w AS (PARTITION BY qi)),
z AS (SELECT * EXCLUDE (m, zsd, pool, sd), CASE WHEN pool >= 5 AND zsd > 0 AND sue IS NOT NULL THEN greatest(-3.0, least(3.0, (sue - m) / zsd)) END AS z FROM z0),
b AS (SELECT *, row_number() OVER (PARTITION BY qi ORDER BY z NULLS LAST, slug) AS r, count(z) OVER (PARTITION BY qi) AS pool FROM z),
t AS (SELECT * EXCLUDE (r, pool), CASE WHEN z IS NOT NULL AND pool >= 6 THEN 1 + CAST(3 * (r - 1) >= (pool - 1) AS INTEGER) + CAST(3 * (r - 1) >= 2 * (pool - 1) AS INTEGER) END AS tercile,
 CASE WHEN z IS NOT NULL AND pool >= 25 THEN 1 + CAST(5 * (r - 1) > (pool - 1) AS INTEGER) + CAST(5 * (r - 1) > 2 * (pool - 1) AS INTEGER) + CAST(5 * (r - 1) > 3 * (pool - 1) AS INTEGER) + CAST(5 * (r - 1) > 4 * (pool - 1) AS INTEGER) END AS quintile,
 lead(revenue) OVER (PARTITION BY slug ORDER BY qi) / revenue - 1 AS fwd FROM b)"""
