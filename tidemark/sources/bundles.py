"""Files as tables: manifests with checksums, portable bundles, workbooks, captures and news lists, and their writers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.catalog import latest


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, size, sha256) of the files below a folder, hashed where they are read."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return raw.select(F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def write_manifest(spark: SparkSession, path: str, manifest: str, pattern: str = "*") -> None:
    """A JSON manifest of a folder's files: one line a file with size and checksum."""
    files(spark, path, pattern).write.mode("overwrite").json(manifest)


def verify(spark: SparkSession, path: str, manifest: str, pattern: str = "*") -> DataFrame:
    """(name, state) of every file of a manifest or a folder: same, changed, missing or extra."""
    want = spark.read.schema("name string, size long, sha256 string").json(manifest)
    have = files(spark, path, pattern).select("name", F.col("sha256").alias("_have"))
    state = F.when(F.col("_have").isNull(), "missing").when(F.col("sha256").isNull(), "extra").when(F.col("sha256") == F.col("_have"), "same").otherwise("changed")
    return want.join(have, "name", "full").select("name", state.alias("state"))


def export_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """Tables as Parquet folders of one bundle, with a manifest of all part files beside them."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/data/{name}")
    write_manifest(spark, f"{path}/data", f"{path}/manifest", "*.parquet")


def sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, row, column, value) of the cells of workbooks, as text; a workbook is one row of a binary scan."""

    def cells(batches: Iterator) -> Iterator:
        import io
        import re
        import zipfile
        from xml.etree import ElementTree as X

        import pyarrow as pa

        ns = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
        for b in batches:
            out: list[tuple] = []
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as book:
                    names = book.namelist()
                    shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in si.iter(f"{ns}t")) for si in X.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{ns}si")]
                    for part in sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
                        for c in X.fromstring(book.read(part)).iter(f"{ns}c"):
                            at = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r", ""))
                            v = c.find(f"{ns}v")
                            text = "".join(t.text or "" for t in c.iter(f"{ns}t")) if c.get("t") == "inlineStr" else None if v is None else shared[int(v.text)] if c.get("t") == "s" else v.text
                            if at and text is not None:
                                out.append((name, part.rsplit("/", 1)[1][:-4], int(at[2]), at[1], text))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*out)], ["file", "sheet", "row", "column", "value"])

    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    return raw.select(F.substring_index("path", "/", -1).alias("name"), "content").mapInArrow(cells, "file string, sheet string, row long, column string, value string")


def news(spark: SparkSession, path: str) -> DataFrame:
    """Articles of news lists that a fetch leaves as JSON lines: one row a link without its query, the first seen wins."""
    raw = spark.read.schema("url string, title string, domain string, seendate string, language string").json(path)
    rows = raw.where("url is not null").withColumns({"link": F.regexp_replace("url", r"[?#].*$", ""), "seen": F.to_timestamp("seendate", "yyyyMMdd'T'HHmmss'Z'")})
    return latest(rows, ["link"], F.col("seen"), F.col("title")).select("link", "title", "domain", "seen", "language")


def markdown_blocks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ordinal, kind, text) of the blocks of Markdown texts: headings, list items, table rows, quotes and paragraphs, marks taken off."""
    lines = df.select(key, F.posexplode(F.split(text, "\n", -1)).alias("ordinal", "line")).where(F.trim("line") != "")
    kinds: Sequence[tuple[str, str]] = (("heading", r"^#{1,6}\s+"), ("item", r"^\s*(?:[-*+]|\d+\.)\s+"), ("quote", r"^>\s?"), ("row", r"^\|"))
    kind, plain = F.lit("paragraph"), F.col("line")
    for name, mark in reversed(kinds):
        hit = F.col("line").rlike(mark)
        kind, plain = F.when(hit, name).otherwise(kind), F.when(hit, F.regexp_replace("line", mark, "")).otherwise(plain)
    return lines.select(key, F.col("ordinal").cast("long").alias("ordinal"), kind.alias("kind"), F.trim(F.regexp_replace(plain, r"\*\*|__|`", "")).alias("text"))


def publish(df: DataFrame, root: str, version: str) -> None:
    """A new version of a table beside the old ones, then the pointer to it put in place by one rename.

    Readers see the old version until the rename and the new one after it, never a part of either.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{root}/versions/{version}")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    fs = path("").getFileSystem(conf)
    out = fs.create(path("CURRENT.next"), True)
    out.write(bytearray(version.encode()))
    out.close()
    fs.delete(path("CURRENT"), False)
    fs.rename(path("CURRENT.next"), path("CURRENT"))


def current(spark: SparkSession, root: str) -> DataFrame:
    """The version that the pointer names."""
    version = spark.read.text(f"{root}/CURRENT").first()["value"]
    return spark.read.parquet(f"{root}/versions/{version}")


INSTANCE = "context array<struct<_id: string, period: struct<instant: date, startDate: date, endDate: date>>>, fact array<struct<_name: string, _contextRef: string, _unitRef: string, _VALUE: double>>, note array<struct<_name: string, _VALUE: string>>"


def xbrl(df: DataFrame, xml: str, *keys: str) -> tuple[DataFrame, DataFrame]:
    """(facts with the dates of their contexts, text notes) of XBRL instances."""
    x = df.select(*keys, F.from_xml(F.col(xml), INSTANCE).alias("_x"))
    contexts = x.select(*keys, F.explode("_x.context").alias("_c")).select(*keys, F.col("_c._id").alias("_ref"), "_c.period.instant", F.col("_c.period.startDate").alias("period_start"), F.col("_c.period.endDate").alias("period_end"))
    facts = x.select(*keys, F.explode("_x.fact").alias("_f")).select(*keys, F.col("_f._name").alias("concept"), F.col("_f._contextRef").alias("_ref"), F.col("_f._unitRef").alias("unit"), F.col("_f._VALUE").alias("value"))
    notes = x.select(*keys, F.explode("_x.note").alias("_n")).select(*keys, F.col("_n._name").alias("name"), F.trim("_n._VALUE").alias("text"))
    return facts.join(contexts, [*keys, "_ref"], "left").drop("_ref"), notes


def html_row(*columns: str) -> Column:
    """A row of a report as HTML, cells escaped."""
    cell = lambda c: F.concat(F.lit("<td>"), F.replace(F.replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("</td>"))
    return F.concat(F.lit("<tr>"), *[cell(c) for c in columns], F.lit("</tr>"))
