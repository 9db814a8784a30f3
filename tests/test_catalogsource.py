"""The catalog data source: what is pushed, what is read, and what stays after a failed write."""

from __future__ import annotations

import sqlite3

import pytest
from pyspark.sql import functions as F

from tidemark.sources import catalogsource

SCHEMA = "id long, kind string, score double, raw binary"
ROWS = [(i, None if i % 5 == 0 else f"k{i % 3}'\"_%", None if i % 7 == 0 else i / 3, bytes([i % 256])) for i in range(200)] + [(None, "", -1.5, None)]


@pytest.fixture(scope="module")
def file(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("catalog") / "one.db")
    db = sqlite3.connect(path)
    db.execute('CREATE TABLE "docs" (id INTEGER, kind TEXT, score REAL, raw BLOB, other TEXT)')
    db.executemany("INSERT INTO docs VALUES (?, ?, ?, ?, 'x')", ROWS)
    db.commit()
    db.close()
    return path


def load(spark, path, **options):
    catalogsource.register(spark)
    return spark.read.format("catalog").options(path=path, table="docs", **options).schema(SCHEMA).load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


CASES = [
    ("true", None), ("id = 7", "EqualTo"), ("id > 100 and id <= 150", "GreaterThan"), ("kind is null", "IsNull"), ("kind = 'k1''\"_%'", "EqualTo"), ("id in (1, 5, 900)", "In"), ("kind like 'k2%'", "StringStartsWith"),
    ("score < 10 and kind is not null", "LessThan"), ("not (id = 3)", "Not"), ("kind <=> 'k0''\"_%'", "EqualNullSafe"), ("length(kind) = 0", None), ("id = 1 or id = 190", None), ("score >= 66.0", "GreaterThanOrEqual"), ("kind = ''", "EqualTo"),
]


@pytest.mark.parametrize("where, pushed", CASES)
def test_filters(spark, file, where, pushed):
    want = spark.createDataFrame(ROWS, SCHEMA).where(where).collect()
    found = load(spark, file, partRows=64).where(where)
    key = lambda r: (r["id"] is not None, r["id"] or 0)
    assert sorted(found.collect(), key=key) == sorted(want, key=key)
    # what the database answers leaves no filter behind in the plan
    assert ("Filter (" in plan(found)) == (pushed is None and where != "true")


def test_only_what_the_database_cannot_answer_stays(spark, file):
    left = plan(load(spark, file).where("id > 100 and kind like 'k2%' and length(kind) > 1"))
    assert "length(kind" in left and "id#" not in left.split("Filter (")[1].split(")\n")[0]


def test_rows_are_read_in_ranges(file):
    reader = catalogsource.CatalogReader({"path": file, "table": "docs", "partrows": "50"}, None)
    assert [(p.lo, p.hi) for p in reader.partitions()] == [(1, 50), (51, 100), (101, 150), (151, 200), (201, 201)]


def test_round_trip_and_append(spark, tmp_path):
    at = f"file://{tmp_path}/store"
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    catalogsource.register(spark)
    write = lambda x, mode="append": x.write.format("catalog").mode(mode).options(path=at, table="docs").save()
    write(df)
    assert load(spark, at).exceptAll(df).isEmpty() and load(spark, at).count() == len(ROWS)
    write(df.where("id < 10"))
    assert load(spark, at).count() == len(ROWS) + 10
    write(df.limit(0))
    assert load(spark, at).count() == len(ROWS) + 10
    with pytest.raises(Exception, match="lost"):
        write(df.withColumn("kind", F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("kind"))))
    assert load(spark, at).count() == len(ROWS) + 10  # nothing of a failed write is seen
    write(df.where("id = 1"), "overwrite")
    assert [r["id"] for r in load(spark, at).collect()] == [1]
    assert load(spark, f"file://{tmp_path}/nothing").count() == 0
    with pytest.raises(Exception, match="can't hold"):
        write(df.select(F.current_timestamp().alias("at")))
