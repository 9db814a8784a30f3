"""Token-id files: canonical length-limited Huffman codes from global counts, in independently decodable blocks.

A store is a folder with ``codebook`` (one row: code length of every id) and ``blocks`` (rows in ascending
document order, one binary block each, inside Parquet so that any Hadoop file system holds it and a retried
task never leaves half a file). A block, little-endian:

    magic "TMB2", u32 documents, u32 tokens, u32 stride, u64 tokens before the block,
    i64 id of each document, u8 whether it has an id, u32 tokens of each document,
    u64 bit offset of every stride-th token, then the codes, most significant bit first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, text_or_empty, tokenizer_path
from .tokens import encoder

MAX_CODE_BITS = 16
BLOCK_TOKENS = 1 << 18
STRIDE = 128
_HEAD = struct.Struct("<4sIIIQ")


def code_lengths(counts, limit: int = MAX_CODE_BITS):
    """Optimal code length (u8) of every id for ``counts``, at most ``limit`` bits, by package-merge; 0 where never used."""
    import numpy as np

    counts = np.asarray(counts, dtype=np.int64)
    out = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order]
    level, marks = leaves, [np.ones(len(leaves), bool)]
    for _ in range(limit - 1):
        pairs = len(level) // 2
        packages = level[0 : 2 * pairs : 2] + level[1 : 2 * pairs : 2]
        both = np.concatenate((leaves, packages))
        rank = np.argsort(both, kind="stable")
        level = both[rank]
        marks.append(rank < len(leaves))
    need = 2 * (len(leaves) - 1)
    for mark in reversed(marks):
        taken = int(mark[:need].sum())
        out[order[:taken]] += 1
        need = 2 * (need - taken)
    return out


def canonical_codes(lengths):
    """Codes (u32) of the canonical code with these lengths: ordered by length, then id."""
    import numpy as np

    codes, code, before = np.zeros(len(lengths), dtype=np.uint32), 0, 0
    used = np.flatnonzero(lengths)
    for i in used[np.lexsort((used, lengths[used]))]:
        code <<= int(lengths[i]) - before
        before = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def pack_bits(ids, codes, lengths) -> tuple[bytes, object]:
    """(bit stream, bit offset of every token) of the ids."""
    import numpy as np

    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros((total >> 5) + 2, dtype=np.uint64)
    if len(ids):
        word = at >> 5
        value = codes[ids].astype(np.uint64) << (64 - size - (at & 31)).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes()[: (total + 7) >> 3], at


def decode_table(lengths):
    """(id, bits) by the next ``MAX_CODE_BITS`` bits of a stream."""
    import numpy as np

    ids, bits = np.zeros(1 << MAX_CODE_BITS, np.uint32), np.ones(1 << MAX_CODE_BITS, np.uint8)
    codes = canonical_codes(lengths)
    for i in np.flatnonzero(lengths):
        spare = MAX_CODE_BITS - int(lengths[i])
        lo = int(codes[i]) << spare
        ids[lo : lo + (1 << spare)], bits[lo : lo + (1 << spare)] = i, lengths[i]
    return ids, bits


def encode_block(docs: list[tuple[int | None, object]], before: int, codes, lengths) -> bytes:
    """One block of (id, token ids) documents; ``before`` counts the tokens of all documents ahead of it."""
    import numpy as np

    sizes = np.array([len(x) for _, x in docs], dtype="<u4")
    ids = np.concatenate([x for _, x in docs]) if docs else np.zeros(0, np.uint32)
    stream, at = pack_bits(ids, codes, lengths)
    head = _HEAD.pack(b"TMB2", len(docs), len(ids), STRIDE, before)
    keys = np.array([k or 0 for k, _ in docs], dtype="<i8").tobytes() + bytes(k is not None for k, _ in docs)
    return head + keys + sizes.tobytes() + at[::STRIDE].astype("<u8").tobytes() + stream


def decode_block(block: bytes, table) -> Iterator[tuple[int | None, int, object]]:
    """(id, tokens before the document, its token ids as u32) of each document; runs from all checkpoints side by side."""
    import numpy as np

    magic, docs, tokens, stride, start = _HEAD.unpack_from(block)
    if magic != b"TMB2":
        raise ValueError("not a token block")
    at = _HEAD.size
    keys = np.frombuffer(block, "<i8", docs, at)
    known = np.frombuffer(block, "u1", docs, at + 8 * docs)
    sizes = np.frombuffer(block, "<u4", docs, at + 9 * docs).astype(np.int64)
    lanes = -(-tokens // stride)
    pos = np.frombuffer(block, "<u8", lanes, at + 13 * docs).astype(np.int64)
    raw = np.frombuffer(block, "u1", offset=at + 13 * docs + 8 * lanes)
    raw = np.concatenate((raw, np.zeros(stride * 2 + 8, np.uint8))).astype(np.uint32)
    peek = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    symbol, bits = table
    out = np.empty((stride, lanes), dtype="<u4")
    for step in range(min(stride, tokens)):
        view = (peek[pos >> 3] >> (8 - (pos & 7)).astype(np.uint32)) & np.uint32(0xFFFF)
        out[step] = symbol[view]
        pos = np.minimum(pos + bits[view], 8 * (len(peek) - 1))
    ids = out.T.reshape(-1)[:tokens]
    for key, has, size, end in zip(keys.tolist(), known.tolist(), sizes.tolist(), np.cumsum(sizes).tolist()):
        yield key if has else None, start + end - size, ids[end - size : end]


def write_store(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0) -> None:
    """Encodes every whole text (null: empty) with ``end_id`` after it, in ascending id order (null ids first).

    Texts are range-partitioned by id once and their ids written to the shared folder; counts, partition totals
    and the encoding read that table. The driver sees one count per vocabulary id and one total per partition.
    Rows that repeat an id are documents of their own, side by side in the order of their texts' hash; an empty
    table gives an empty store.
    """
    import numpy as np

    model, scratch = tokenizer or tokenizer_path(), Scratch(spark, "tokens")

    def tokenize(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, done, enc = TaskContext.get().partitionId(), 0, encoder(model)
        for b in batches:
            rows: list[tuple] = []
            size = 0
            for key, found in zip(b.column(0).to_pylist(), enc.encode_all(text.as_py() for text in b.column(1))):
                ids = np.append(np.frombuffer(found, "<u4"), np.uint32(end_id)).astype("<u2" if _small(enc) else "<u4")
                rows.append((part, done, key, len(ids), ids.tobytes()))
                done, size = done + len(ids), size + len(ids)
                if size > 1 << 20:
                    yield _rows(pa, rows)
                    rows, size = [], 0
            if rows:
                yield _rows(pa, rows)
        enc.forget()

    ordered = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t")).withColumn("h", F.xxhash64("t")).repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    listed = scratch.save(ordered.mapInArrow(tokenize, "part int, start long, id long, n int, ids binary"), "ids")
    kind = "<u2" if _small(encoder(model)) else "<u4"

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for b in batches:
            ids = b.column(0)
            ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + len(ids) + 1]
            if len(ids) and ends[-1] > ends[0]:
                one = np.bincount(np.frombuffer(ids.buffers()[2], "u1")[ends[0] : ends[-1]].view(kind))
                if len(one) > len(total):
                    total = np.concatenate((total, np.zeros(len(one) - len(total), np.int64)))
                total[: len(one)] += one
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["token", "n"])

    counts = listed.select("ids").mapInArrow(count, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    vocabulary = max(encoder(model).tokenizer.get_vocab_size(), end_id + 1)
    full = np.zeros(vocabulary, np.int64)
    full[counts["token"]] = counts["n"]
    lengths = code_lengths(full)
    totals = sorted((r["part"], r["n"]) for r in listed.groupBy("part").agg(F.sum("n").alias("n")).collect())
    bases, before = {}, 0
    for part, n in totals:
        bases[part], before = before, before + n

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codes, held, size, start = canonical_codes(lengths), [], 0, None
        for b in batches:
            done: list[tuple] = []
            for part, at, key, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                begin = bases[part] + at
                if held and (begin != start + size or size >= BLOCK_TOKENS):
                    done.append((start, encode_block(held, start, codes, lengths)))
                    held, size = [], 0
                if not held:
                    start = begin
                held.append((key, np.frombuffer(ids.as_py(), kind)))
                size += len(held[-1][1])
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.binary())], ["start", "block"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), pa.array([encode_block(held, start, codes, lengths)], pa.binary())], ["start", "block"])

    blocks = listed.select("part", "start", "id", "ids").mapInArrow(encode, "start long, block binary")
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame([(bytearray(lengths.tobytes()), end_id)], "lengths binary, end_id int").coalesce(1).write.parquet(f"{path}/codebook")
    scratch.drop(listed)


def read_store(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Per document: doc_id, start, n_tokens and ``ids`` (array<int>), or with ``digest`` ids_crc32 of them as u32."""
    import numpy as np

    lengths = np.frombuffer(bytes(spark.read.parquet(f"{path}/codebook").first()["lengths"]), np.uint8)

    def decode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = decode_table(lengths)
        for b in batches:
            for block in b.column(0):
                docs = list(decode_block(block.as_py(), table))
                last = pa.array([zlib.crc32(x.tobytes()) for _, _, x in docs], pa.int64()) if digest else pa.array([x.astype(np.int32) for _, _, x in docs], pa.list_(pa.int32()))
                columns = [pa.array([k for k, _, _ in docs], pa.int64()), pa.array([s for _, s, _ in docs], pa.int64()), pa.array([len(x) for _, _, x in docs], pa.int64()), last]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    kind = "ids_crc32 long" if digest else "ids array<int>"
    return spark.read.parquet(f"{path}/blocks").select("block").mapInArrow(decode, f"doc_id long, start long, n_tokens long, {kind}")


def _small(enc) -> bool:
    return enc.tokenizer.get_vocab_size() <= 1 << 16


def _rows(pa, rows: list[tuple]):
    part, start, key, n, ids = zip(*rows)
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((part, start, key, n, ids), kinds)], ["part", "start", "id", "n", "ids"])


def op3(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = Scratch(spark, "store").path("op3")
    write_store(spark, docs, path)
    return read_store(spark, path, digest=True)
