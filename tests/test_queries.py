"""Every registered query of the library against its DuckDB SQL; those without SQL give rows and a stable schema."""

from __future__ import annotations

import math

import pytest

from tidemark.plans import registry

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple(str(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x) for x in r))


def same(a, b):
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=1e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, sf_dir, name):
    got = registry.QUERIES[name](spark, sf_dir)
    data = [tuple(r) for r in got.collect()]
    if name not in registry.ORACLES:
        assert got.columns
        return
    want = con.execute(registry.ORACLES[name].strip())
    columns = [x[0] for x in want.description]
    expected = want.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert len(data) == len(expected)
    for a, b in zip(rows(got.columns, data), rows(columns, expected)):
        assert all(same(x, y) for x, y in zip(a, b)), (a, b)
