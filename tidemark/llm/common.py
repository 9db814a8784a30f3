"""Shared plumbing of the training-data operators: tables, scratch storage and text constants."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract here: space and the five control characters \x09-\x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


_OWN_ROOT: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where the session names none and all runs in one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN_ROOT:
            _OWN_ROOT[app] = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        root = _OWN_ROOT[app]
    return root.rstrip("/")


class Scratch:
    """Tables in the shared folder that cut lineage, so a lost executor costs a reread, not a recomputation.

    ``drop`` removes a table whose readers have all been materialised; ``keep`` hands back the
    DataFrame of one that a lazily returned result still reads.
    """

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.tag, self.paths = spark, tag, {}

    def path(self, name: str) -> str:
        return f"{scratch_root(self.spark)}/tidemark/{self.tag}-{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        path = self.path(name)
        df.write.option("compression", codec).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            path, _ = self.paths.pop(id(df), (None, None))
            if path:
                remove(self.spark, path)

    def drop_all(self, *, but: tuple = ()) -> None:
        """Removes all tables except those in ``but``."""
        self.drop(*[df for _, df in self.paths.values() if not any(df is x for x in but)])


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Words of 64 bits in a key filter, however many keys it holds: under 20 MB when broadcast.
FILTER_WORDS = 1 << 19
#: A key is hot with over one in so many rows, so there are never more hot keys than this.
HOT_SHARE = 1024


def key_filter(keys: DataFrame, *names: str) -> DataFrame:
    """(word, bits): one bit for the hash of each row's ``names``, in at most ``FILTER_WORDS`` rows whatever their number.

    ``held_by`` then tells rows whose key can't be among ``keys`` from those whose key may be. With far more
    keys than bits it lets everything pass: less is saved, nothing is lost.
    """
    h = F.xxhash64(F.lit("filter"), *names)
    bit = F.expr("shiftleft(1L, cast(_h & 63 as int))")
    return keys.select(h.alias("_h")).groupBy(F.pmod(F.shiftrightunsigned("_h", 6), F.lit(FILTER_WORDS)).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def held_by(rows: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """``rows`` with boolean _maybe: false only where the key is surely not in the filter ``keys``."""
    rows = rows.withColumn("_h", F.xxhash64(F.lit("filter"), *names))
    rows = rows.withColumn("_at", F.pmod(F.shiftrightunsigned("_h", 6), F.lit(FILTER_WORDS)))
    # at most FILTER_WORDS rows of two longs
    rows = rows.join(F.broadcast(keys), F.col("_at") == F.col("_word"), "left")
    return rows.withColumn("_maybe", F.coalesce(F.expr("(shiftright(_bits, cast(_h & 63 as int)) & 1) = 1"), F.lit(False))).drop("_h", "_at", "_word", "_bits")


def join_by_key(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` joined (left or inner) with ``groups``, which has one row a key and its number of rows in ``size``.

    The hot keys, those with over one in ``HOT_SHARE`` of all ``total`` rows and so never more than that many,
    are broadcast and their rows stay where they are; the other keys are joined by a shuffle, in which none has
    more rows than that share. Null keys match nothing and aren't shuffled. ``rows`` is read once for each part.
    """
    hot = groups.where(F.col(size) * HOT_SHARE > total)
    cold = groups.where(F.col(size) * HOT_SHARE <= total)
    some = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    # at most HOT_SHARE rows are broadcast
    spread = rows.join(F.broadcast(hot), keys, "inner")
    dealt = rows.where(some).join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold.hint("merge"), keys, how)
    out = spread.unionByName(dealt)
    if how == "left":
        extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in groups.schema if f.name not in keys]
        out = out.unionByName(rows.where(~some).select(*rows.columns, *extra))
    return out


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def release_memory() -> None:
    """Hands freed memory back to the system at the end of a task: Python workers live on through later stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def arrow_column(each: Callable, kind: str, *columns: Column) -> Column:
    """Column of type ``kind`` that ``each`` makes of the columns' Arrow arrays, batch by batch; a task hands back its memory at its end."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            yield each(*b) if isinstance(b, tuple) else each(b)
        release_memory()

    one = pa.Array if len(columns) == 1 else tuple[pa.Array, ...]
    run.__annotations__ = {"batches": Iterator[one], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)(*columns)


#: Rows and bytes after which ``map_rows`` hands on a batch.
BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20


def map_rows(df: DataFrame, each: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``each`` over a partition's rows as tuples of the columns of ``df``; it yields tuples of ``schema``, which travel in Arrow batches. A task hands back its memory at its end."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        import pyarrow as pa

        def batch(part):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)

        part, held = [], 0
        for row in each(row for b in batches for row in zip(*[c.to_pylist() for c in b.columns])):
            part.append(row)
            held += sum(len(v) for v in row if isinstance(v, bytes))
            if len(part) == BATCH_ROWS or held > BATCH_BYTES:
                yield batch(part)
                part, held = [], 0
        if part:
            yield batch(part)
        release_memory()

    return df.mapInArrow(run, schema)


_TOKENIZERS: dict = {}


def load_tokenizer(path: str):
    """One tokenizer a Python worker, as the library reads it from its file."""
    if path not in _TOKENIZERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]
