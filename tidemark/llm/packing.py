"""Best-fit packing of token sequences under token, document-count and attention-cost capacities.

An item's demand (tokens, 1 document, tokens squared) depends on its length alone, and lengths are bounded by
the sequence length. So the packing is solved on the histogram of lengths: bins with equal contents are one
class with a multiplicity, and vector best-fit decreasing places whole groups of equal items. Items then find
their place by their rank within their length, a distributed prefix sum.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, text_or_empty, tokenizer_path
from .tokens import encoder

SEQUENCE_TOKENS = 1024
END_ID = 2
#: Characters of texts that a packing worker encodes together: fewer than the token files' workers, as it runs behind other stages.
GROUP_CHARS = 1 << 22
#: A length is dealt into so many hash parts for ranking, and one more for every so many rows of it.
RANK_PARTS = 128
RANK_ROWS = 20_000


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds; the weights set how much each residual counts in the choice of a bin."""

    tokens: int = SEQUENCE_TOKENS
    documents: int = SEQUENCE_TOKENS
    cost: int = SEQUENCE_TOKENS**2
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"

    def fits(self, length: int) -> int:
        """Copies of an item that an empty sequence holds."""
        return min(self.tokens // length, self.documents, self.cost // (length * length))


def pack_histogram(counts: dict[int, int], cap: Capacity = Capacity()) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Bins as (multiplicity, [(length, copies, offset), ...]) that hold ``counts`` items of each length.

    Lengths go from long to short. Of the classes with room in every dimension, ``norm`` takes the one whose
    weighted residual after placing is smallest, ``dot`` the one whose residual has the largest weighted dot
    product with the demand; then a class takes as many copies as it can before the next choice.
    """
    import numpy as np

    tokens, docs, cost, many = (np.zeros(64, dtype=np.int64) for _ in range(4))
    contents: list[list[tuple[int, int, int]]] = []
    scale = np.array([w / c for w, c in zip(cap.weights, (cap.tokens, cap.documents, cap.cost))])

    def add(t: int, d: int, c: int, m: int, content: list) -> None:
        nonlocal tokens, docs, cost, many
        i = len(contents)
        if i == len(tokens):
            tokens, docs, cost, many = (np.concatenate((x, np.zeros_like(x))) for x in (tokens, docs, cost, many))
        tokens[i], docs[i], cost[i], many[i] = t, d, c, m
        contents.append(content)

    for length in sorted(counts, reverse=True):
        left, square = counts[length], length * length
        if left and (length < 1 or not cap.fits(length)):
            raise ValueError(f"an item of {length} tokens fits no sequence")
        while left:
            k = len(contents)
            room = np.minimum(np.minimum(tokens[:k] // length, docs[:k]), cost[:k] // square)
            room[many[:k] == 0] = 0
            if room.any():
                ok = np.flatnonzero(room)
                residual = np.stack((tokens[ok], docs[ok], cost[ok]))
                demand = np.array([length, 1, square])
                if cap.rule == "norm":
                    best = int(ok[np.argmin((((residual - demand[:, None]) * scale[:, None]) ** 2).sum(0))])
                else:
                    best = int(ok[np.argmax((residual * (demand * scale**2)[:, None]).sum(0))])
                each, bins = int(room[best]), int(many[best])
                start = (int(tokens[best]), int(docs[best]), int(cost[best]), contents[best])
            else:
                each, bins, best = cap.fits(length), -1, -1
                start = (cap.tokens, cap.documents, cap.cost, [])
            copies = min(each, left)
            wanted = left // copies
            used = wanted if bins < 0 else min(bins, wanted)
            if best >= 0:
                many[best] -= used
            t, d, c, content = start
            add(t - copies * length, d - copies, c - copies * square, used, [*content, (length, copies, cap.tokens - t)])
            left -= used * copies
            if len(contents) > 4096 and (many[: len(contents)] == 0).mean() > 0.5:
                live = np.flatnonzero(many[: len(contents)])
                contents = [contents[i] for i in live]
                tokens, docs, cost, many = (np.concatenate((x[live], np.zeros(len(live) + 64, np.int64))) for x in (tokens, docs, cost, many))
    return [(int(many[i]), contents[i]) for i in range(len(contents)) if many[i]]


def slots(bins: list[tuple[int, list[tuple[int, int, int]]]]):
    """Arrays (length, first rank, sequence base, copies, offset), by length and rank: where the items of a rank range go."""
    import numpy as np

    taken: dict[int, int] = {}
    rows, base = [], 0
    for many, content in bins:
        for length, copies, offset in content:
            rank = taken.get(length, 0)
            rows.append((length, rank, base, copies, offset))
            taken[length] = rank + many * copies
        base += many
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(spark: SparkSession, items: DataFrame, cap: Capacity = Capacity()) -> DataFrame:
    """``items`` (a materialised table with column length, 1 to cap.tokens) with sequence_id and offset.

    The driver gets one count per length and holds the bin classes, whose number depends on the capacities and
    not on the rows. Items of one length are ranked in hash parts of at most about ``RANK_ROWS`` plus the parts' prefix
    sums, so a length that holds a third of all rows is spread the wider the more they are. Equal rows are
    separate items.
    """
    sizes = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    parts = F.array(*[F.lit(RANK_PARTS + sizes.get(n, 0) // RANK_ROWS) for n in range(1, cap.tokens + 1)])
    items = items.withColumn("_part", F.pmod(F.xxhash64(*items.columns), F.element_at(parts, F.col("length").cast("int"))).cast("long"))
    tally = items.groupBy("length", "_part").agg(F.count("*").alias("n"))
    table = slots(pack_histogram(sizes, cap))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tally.select("length", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    ranked = items.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_part").orderBy(*[c for c in items.columns if c not in ("length", "_part")])) - 1)
    # both sides are dealt by (length, part) already, so nothing has to be broadcast
    ranked = ranked.join(bases.hint("merge"), ["length", "_part"])

    names = [c for c in items.columns if c != "_part"]

    def find(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        keys = table[:, 0] << 44 | table[:, 1]
        for b in batches:
            length, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (len(names), len(names) + 1))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            _, first, base, copies, offset = table[at].T
            nth = rank - first
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(base + nth // copies), pa.array(offset + nth % copies * length)], [*names, "sequence_id", "offset"])

    schema = T.StructType([*[T.StructField(c, items.schema[c].dataType) for c in names], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*names, F.col("length").cast("long").alias("_length"), (F.col("_base") + F.col("_rank")).cast("long").alias("_place")).mapInArrow(find, schema)


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, most: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Pieces of every text's ids with ``end_id`` after them: doc_id, piece, start, length, ids_crc32; null counts as empty.

    Texts of over ``most`` tokens are cut from the end, so only the first piece may be shorter.
    """
    model = tokenizer or tokenizer_path()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        enc, tail = encoder(model), np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows = []
            for key, found in zip(b.column(0).to_pylist(), enc.encode_all((text.as_py() for text in b.column(1)), GROUP_CHARS)):
                ids = memoryview(found + tail)
                n = len(ids) // 4
                lo, piece = 0, 0
                while lo < n:
                    hi = lo + ((n - lo) % most or most) if lo == 0 else lo + most
                    rows.append((key, piece, lo, hi - lo, zlib.crc32(ids[4 * lo : 4 * hi])))
                    lo, piece = hi, piece + 1
            key, piece, lo, n, crc = zip(*rows) if rows else ((),) * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((key, piece, lo, n, crc), kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        enc.forget()

    return docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t")).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(spark: SparkSession, docs: DataFrame, cap: Capacity = Capacity(), **how) -> DataFrame:
    """Every piece of every text with its sequence and place; an empty table gives no rows."""
    pieces = Scratch(spark, "packing").save(cut_pieces(docs, most=cap.tokens, **how), "pieces")
    return place(spark, pieces, cap)


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack(spark, docs)
