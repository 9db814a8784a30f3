"""Readers and writers of the data formats around filings; network fetching is outside this library."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.catalog import latest

FACT = T.StructType([T.StructField("value", T.DoubleType()), T.StructField("unit", T.StringType()), T.StructField("instant", T.DateType()), T.StructField("period_start", T.DateType()), T.StructField("period_end", T.DateType()), T.StructField("dimensions", T.MapType(T.StringType(), T.StringType()))])
FACTS = T.MapType(T.StringType(), T.ArrayType(FACT))
SERIES = "timestamp array<long>, open array<double>, high array<double>, low array<double>, close array<double>, volume array<double>, adjclose array<double>"
PACK = "entity string, entity_kind string, field string, period string, label string, unit string, hint string, value double"


def csv_grid(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """A CSV without header, all cells as text."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    return spark.read.schema(schema).csv(path, header=False)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole files (gzip by name) with their path."""
    return spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name())


def json_facts(spark: SparkSession, path: str, pattern: str, priority: Mapping[str, int]) -> DataFrame:
    """Fact files under a glob, one per (slug, period): the folder with the best priority wins.

    ``pattern`` captures source, slug and period from the path.
    """
    rows = raw_text(spark, path)
    part = lambda i: F.regexp_extract("path", pattern, i)
    rank = F.lit(len(priority))
    for name, r in priority.items():
        rank = F.when(part(1) == name, r).otherwise(rank)
    rows = rows.select(part(2).alias("slug"), part(3).alias("period"), part(1).alias("source"), rank.alias("_k"), F.col("value"))
    return latest(rows, ["slug", "period"], F.col("_k"), F.col("source")).drop("_k")


def explode_facts(df: DataFrame, json: str, *keys: str) -> DataFrame:
    """(keys, concept, fact columns) of a JSON map of concept to facts."""
    parsed = df.select(*keys, F.from_json(json, FACTS).alias("_f"))
    return parsed.select(*keys, F.explode("_f").alias("concept", "_e")).select(*keys, "concept", F.explode("_e").alias("_x")).select(*keys, "concept", "_x.*")


def eav_pack(df: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(one row per entity and period with a column per field, refused rows with why) of an entity-attribute-value pack."""
    why = F.when(F.col("entity").isNull() | (F.trim("entity") == ""), "no entity").when(~F.col("field").isin(list(fields)), "unknown field").when(F.col("value").isNull(), "no value")
    judged = df.withColumn("why", why)
    wide = judged.where("why is null").groupBy("entity", "entity_kind", "period").pivot("field", list(fields)).agg(F.max("value"))
    return wide, judged.where("why is not null")


def bars(df: DataFrame, symbol: str, series: str, zone: str) -> DataFrame:
    """Daily bars from parallel arrays in JSON: exchange-local date, rows without a close dropped, adjustment factor."""
    s = F.from_json(series, SERIES)
    names = ("timestamp", "open", "high", "low", "close", "volume", "adjclose")
    rows = df.select(symbol, F.explode(F.arrays_zip(*[s[n].alias(n) for n in names])).alias("b"))
    day = F.to_date(F.from_utc_timestamp(F.timestamp_seconds("b.timestamp"), zone))
    out = rows.where("b.close is not null").select(symbol, day.alias("date"), *[F.col(f"b.{n}").alias(n) for n in names[1:]])
    return out.withColumn("adj_factor", F.when(F.col("close") != 0, F.col("adjclose") / F.col("close")))


def fresh_or_stale(cache: DataFrame, key: Sequence[str], now, ttl: str) -> DataFrame:
    """Latest cached row of each key and whether it is still fresh: a stale one serves while fetching fails."""
    rows = latest(cache, key, F.desc("fetched_at"))
    return rows.withColumn("fresh", F.col("fetched_at") >= now - F.expr(f"INTERVAL {ttl}"))


def served(cached: DataFrame, fetched: DataFrame, key: str, value: str, new: str) -> DataFrame:
    """(key, value, origin): fresh rows from the cache, others as fetched, and the stale row where the fetch brought nothing."""
    j = cached.join(fetched, key, "left")
    origin = F.when(F.col("fresh"), "cache").when(F.col(new).isNotNull(), "fetched").otherwise("stale")
    return j.select(key, F.when(origin == "fetched", F.col(new)).otherwise(F.col(value)).alias(value), origin.alias("origin"))


def macro_series(spark: SparkSession, path: str) -> DataFrame:
    """Observations of macro series from the JSON lines that a fetch leaves: series, year, value, number of readings."""
    return spark.read.schema("series string, fy int, value double, n long").json(path)


def feed(spark: SparkSession, path: str) -> DataFrame:
    """Items of RSS files: title, link, published, summary."""
    schema = "title string, link string, pubDate string, description string"
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path).select("title", "link", F.col("pubDate").alias("published"), F.col("description").alias("summary"))


def html_table_rows(df: DataFrame, html: str, *keys: str) -> DataFrame:
    """Cells of each table row of a page, in order, tags stripped."""
    rows = F.explode(F.regexp_extract_all(html, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1)))
    cells = F.transform(F.regexp_extract_all("_row", F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", "")))
    return df.select(*keys, rows.alias("_row")).select(*keys, cells.alias("cells"))


def text_table(df: DataFrame, text: str, pattern: str, names: Sequence[str], *keys: str) -> DataFrame:
    """Lines of a text that match a pattern, its groups as columns."""
    lines = df.select(*keys, F.explode(F.split(text, "\n")).alias("_line")).where(F.col("_line").rlike(pattern))
    return lines.select(*keys, *[F.regexp_extract("_line", pattern, i + 1).alias(n) for i, n in enumerate(names)])


def catalog_table(spark: SparkSession, url: str, name: str, predicates: Sequence[str], properties: Mapping[str, str]) -> DataFrame:
    """A catalog table over JDBC, one partition per predicate, filters pushed to the database."""
    return spark.read.jdbc(url, name, predicates=list(predicates), properties=dict(properties))


def catalog_file(spark: SparkSession, path: str, name: str, schema: str, predicates: Sequence[str]) -> DataFrame:
    """A table of a catalog database file, read-only, one task per predicate; each task opens its own copy in memory.

    A catalog file is small beside the corpus it lists; one that is not belongs behind ``catalog_table``.
    """

    def scan(batches):
        import sqlite3

        import pyarrow as pa

        for b in batches:
            for content, predicate in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                db = sqlite3.connect(":memory:")
                db.deserialize(content)
                db.execute("PRAGMA query_only = ON")
                found = db.execute(f"SELECT {columns} FROM {name} WHERE {predicate}")
                while rows := found.fetchmany(10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], columns.split(", "))
                db.close()

    columns = ", ".join(c.split()[0] for c in schema.split(", "))
    parts = spark.createDataFrame([(p,) for p in predicates], "predicate string").repartition(len(predicates))
    return spark.read.format("binaryFile").load(path).select("content").crossJoin(F.broadcast(parts)).repartition(len(predicates), "predicate").mapInArrow(scan, schema)  # a row a predicate


def markdown(rows: Sequence[Sequence], header: Sequence[str]) -> str:
    """A small report as a Markdown table."""
    line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
    return "\n".join([line(header), line(["-"] * len(header)), *map(line, rows)])
