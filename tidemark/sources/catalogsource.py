"""Catalog database files as a Spark data source: ranges of rows as partitions, filters answered by the database.

    spark.dataSource.register(CatalogSource)
    df.write.format("catalog").mode("append").option("path", folder).option("table", "documents").save()
    spark.read.format("catalog").option("path", folder).option("table", "documents").schema("id long, kind string").load()

A folder holds database files and a manifest of those that were committed; what a lost task wrote is in no manifest. A
single file is read as it is.
"""

from __future__ import annotations

import json
import os
import sqlite3
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringStartsWith, WriterCommitMessage,
)
from pyspark.sql.types import StructType

#: Rows of a file that one task reads, and of one batch.
PART_ROWS, BATCH_ROWS = 1_000_000, 10_000
MANIFEST = "manifest.json"
_TYPES = {"bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER", "double": "REAL", "float": "REAL", "string": "TEXT", "binary": "BLOB"}
_COMPARED = {EqualTo: "=", EqualNullSafe: "IS", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _store(uri: str):
    """(file system, path) of a place any worker can reach."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), os.path.abspath(uri))


@contextmanager
def _opened(uri: str) -> Iterator[sqlite3.Connection]:
    """The database of a file, read-only; one that is not on a local path is copied for the time it is open."""
    from pyarrow import fs

    store, path = _store(uri)
    with tempfile.TemporaryDirectory() as own:
        if not isinstance(store, fs.LocalFileSystem):
            fs.copy_files(path, f"{own}/copy", source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
            path = f"{own}/copy"
        db = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
        try:
            yield db
        finally:
            db.close()


def _name(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


def condition(f: Filter) -> tuple[str, list] | None:
    """A filter as SQL with its values; None where the database can't be trusted to see it as Spark does."""
    if isinstance(f, Not):
        inner = condition(f.child)
        return (f"NOT ({inner[0]})", inner[1]) if inner else None
    if len(f.attribute) > 1:
        return None
    name = _name(f.attribute[0])
    if isinstance(f, (IsNull, IsNotNull)):
        return f"{name} IS {'NOT ' * isinstance(f, IsNotNull)}NULL", []
    values = list(f.value) if isinstance(f, In) else [f.value]
    # no number here is NaN, which SQLite has not, and truth values are no numbers in Spark
    if not all(isinstance(v, (int, float, str)) and not isinstance(v, bool) and v == v for v in values):
        return None
    if isinstance(f, In):
        return f"{name} IN ({', '.join('?' * len(values))})", values
    if isinstance(f, StringStartsWith):
        return f"substr({name}, 1, {len(f.value)}) = ?", values
    return (f"{name} {_COMPARED[type(f)]} ?", values) if type(f) in _COMPARED else None


@dataclass
class Rows(InputPartition):
    """Rows of a file whose numbers lie from ``lo`` to ``hi``."""

    file: str
    lo: int
    hi: int


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.rows = int(options.get("partrows", PART_ROWS))
        self.where: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            found = condition(f)
            if found is None:
                yield f
            else:
                self.where.append(found)

    def _files(self) -> list[str]:
        from pyarrow import fs

        store, path = _store(self.path)
        if store.get_file_info(path).type == fs.FileType.File:
            return [self.path]
        info = store.get_file_info(f"{path}/{MANIFEST}")
        if info.type == fs.FileType.NotFound:
            return []
        with store.open_input_stream(f"{path}/{MANIFEST}") as f:
            return [f"{self.path.rstrip('/')}/{name}" for name in json.loads(f.read())]

    def partitions(self) -> list[Rows]:
        out = []
        for file in self._files():
            with _opened(file) as db:
                lo, hi = db.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
            if lo is not None:
                out += [Rows(file, at, min(hi, at + self.rows - 1)) for at in range(lo, hi + 1, self.rows)]
        return out or [Rows("", 1, 0)]

    def read(self, part: Rows):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        if not part.file:
            return
        arrow = to_arrow_schema(self.schema)
        wanted = " AND ".join(["rowid BETWEEN ? AND ?", *[f"({sql})" for sql, _ in self.where]])
        values = [part.lo, part.hi, *[v for _, vs in self.where for v in vs]]
        with _opened(part.file) as db:
            found = db.execute(f"SELECT {', '.join(map(_name, arrow.names))} FROM {_name(self.table)} WHERE {wanted}", values)
            while rows := found.fetchmany(BATCH_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class CatalogWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.table, self.schema, self.overwrite = options["path"].rstrip("/"), options["table"], schema, overwrite
        unknown = [f.name for f in schema if f.dataType.simpleString() not in _TYPES]
        if unknown:
            raise ValueError(f"columns of types that a catalog file can't hold: {', '.join(unknown)}")

    def write(self, iterator) -> Written:
        from pyarrow import fs

        name, n = f"part-{uuid.uuid4().hex}.db", 0
        columns = ", ".join(f"{_name(f.name)} {_TYPES[f.dataType.simpleString()]}" for f in self.schema)
        with tempfile.TemporaryDirectory() as own:
            db = sqlite3.connect(f"{own}/{name}")
            db.execute(f"CREATE TABLE {_name(self.table)} ({columns})")
            for batch in iterator:
                db.executemany(f"INSERT INTO {_name(self.table)} VALUES ({', '.join('?' * len(self.schema))})", zip(*[c.to_pylist() for c in batch.columns]))
                n += batch.num_rows
            db.commit()
            db.close()
            if not n:
                return Written("", 0)
            store, path = _store(self.path)
            store.create_dir(path, recursive=True)
            fs.copy_files(f"{own}/{name}", f"{path}/{name}", source_filesystem=fs.LocalFileSystem(), destination_filesystem=store)
        return Written(name, n)

    def commit(self, messages) -> None:
        from pyarrow import fs

        store, path = _store(self.path)
        store.create_dir(path, recursive=True)
        held = []
        if not self.overwrite and store.get_file_info(f"{path}/{MANIFEST}").type == fs.FileType.File:
            with store.open_input_stream(f"{path}/{MANIFEST}") as f:
                held = json.loads(f.read())
        with store.open_output_stream(f"{path}/{MANIFEST}") as f:
            f.write(json.dumps(held + [m.file for m in messages if m and m.file]).encode())

    def abort(self, messages) -> None:
        store, path = _store(self.path)
        for m in messages:
            if m and m.file:
                store.delete_file(f"{path}/{m.file}")


class CatalogSource(DataSource):
    """Options: path (a folder or one file), table, partRows."""

    @classmethod
    def name(cls) -> str:
        return "catalog"

    def schema(self) -> StructType:
        raise ValueError("give the catalog's columns by schema(...)")

    def reader(self, schema: StructType) -> CatalogReader:
        return CatalogReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> CatalogWriter:
        return CatalogWriter(self.options, schema, overwrite)


def register(spark) -> None:
    """Makes the format known to the session, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CatalogSource)
