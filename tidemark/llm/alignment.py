"""Alignment of two tokenizers over the same texts: groups of tokens between shared boundaries, and links of overlapping tokens.

Each token is an event at the byte offset where it ends. Events of both tokenizers are dealt out by document in blocks
of neighbouring offsets, sorted, and streamed through a machine whose state is the open group, the running hash and the
counts of one document. Its links are stored once, counted over the corpus as pairs of ids, and read again to be
scored by those counts.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, map_rows, tokenizer_path
from .tokens import PATTERN, _byte_letters, _byte_level

#: Bytes of text whose events make up one block.
BLOCK = 1 << 16
#: Texts of so many characters go through the tokenizers library itself.
LONG_TEXT = 500_000
#: Links of a document stored in one row at most.
ROW_LINKS = 1 << 20
#: A pair of ids is frequent with over one in so many links, so there are never more frequent pairs than this.
FREQUENT = 1 << 21
#: Distinct pairs a task counts before it hands them on.
COUNTED = 1 << 21


def bytes_a(path: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer."""
    from tokenizers import Tokenizer

    vocab = Tokenizer.from_file(path).get_vocab(with_added_tokens=True)
    back = {letter: byte for byte, letter in _byte_letters().items()}
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return out


def bytes_b(path: str) -> list[bytes]:
    """Bytes of each id of a sentencepiece model."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    return [bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]


def _fast(path: str, known: list[bytes]):
    """The byte-level tokenizer of a file on tiktoken's engine, which takes ids for ranks; None where a file isn't of that kind."""
    import json

    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = set(tokenizer.get_added_tokens_decoder())
    model = json.loads(tokenizer.to_str())["model"]
    if not _byte_level(tokenizer):
        return None
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    made = [model["vocab"][m] for m in merged]
    if made != sorted(made) or any(len(known[i]) > 1 for i in set(range(len(known))) - set(made) - added):
        return None
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks={b: i for i, b in enumerate(known) if i not in added}, special_tokens={})


class Encoders:
    """Ids of both tokenizers for a text."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        self.bytes = bytes_a(path_a), bytes_b(path_b)
        self.fast = _fast(path_a, self.bytes[0])

    def _first(self, text: str) -> list[int]:
        # the engine's pattern gives up on very long runs of white space
        if self.fast is not None and len(text) < LONG_TEXT:
            return self.fast.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of space and text; none for null, empty and for texts that a tokenizer doesn't give back."""
        if not text:
            return [], []
        spaced = " " + text
        ids, want = (self._first(spaced), self.b.encode(text)), spaced.encode()
        if any(b"".join(map(known.__getitem__, one)) != want for one, known in zip(ids, self.bytes)):
            return [], []
        return ids


_ENCODERS: dict[tuple[str, str], Encoders] = {}
_LENGTHS: dict[tuple[str, str], tuple] = {}


def _lengths(path_a: str, path_b: str) -> tuple:
    """Byte length of each id of A and of B."""
    import numpy as np

    if (path_a, path_b) not in _LENGTHS:
        _LENGTHS[path_a, path_b] = tuple(np.array([len(x) for x in known], np.int64) for known in (bytes_a(path_a), bytes_b(path_b)))
    return _LENGTHS[path_a, path_b]


def _events(path_a: str, path_b: str, kind: str):
    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        """(doc_id, text) -> (key, doc_id, block, side, ids of the tokens that end there) of every document, at least one block a side."""
        import numpy as np
        from pyspark import TaskContext

        lengths = _lengths(path_a, path_b)
        if (path_a, path_b) not in _ENCODERS:
            _ENCODERS[path_a, path_b] = Encoders(path_a, path_b)
        encode = _ENCODERS[path_a, path_b].encode
        key = TaskContext.get().partitionId() << 33
        for doc_id, text in rows:
            for side, (ids, length) in enumerate(zip(encode(text), lengths)):
                tokens = np.array(ids, np.uint32)
                if (whole := int(length[tokens].sum())) > BLOCK:
                    ends = length[tokens].cumsum()
                    cuts = np.searchsorted(ends, np.arange(BLOCK, whole, BLOCK), "right")
                else:
                    cuts = ()
                for block, part in enumerate(np.split(tokens, cuts) if len(cuts) else (tokens,)):
                    yield key, doc_id, block, side, part.astype(kind).tobytes()
            key += 1

    return each


class Sweep:
    """The machine over the events of one document; ``links`` holds the pairs of ids found and not yet taken."""

    def __init__(self, doc_id, lengths: tuple, digits: tuple, kinds: tuple):
        import numpy as np

        self.doc_id, self.lengths, self.digits, (self.kind, self.pair) = doc_id, lengths, digits, kinds
        self.open = [np.zeros(0, np.int64)] * 2
        self.counts, self.groups, self.n_links, self.hash, self.links = [0, 0], 0, 0, sha256(), []

    def take(self, side: int, ids) -> None:
        import numpy as np

        self.counts[side] += len(ids)
        self.open[side] = np.concatenate([self.open[side], ids]) if len(self.open[side]) else ids

    def close(self) -> None:
        """Emits the groups that end in what was taken and leaves the open one."""
        import numpy as np

        a, b = self.open
        ends = np.concatenate([self.lengths[0][a].cumsum(), self.lengths[1][b].cumsum()])
        order = ends.argsort(kind="stable")  # the merge of two sorted runs, of equal ends A's first
        ends, of_a = ends[order], order < len(a)
        last = np.ones(len(ends), bool)
        np.not_equal(ends[1:], ends[:-1], out=last[:-1])
        at = np.flatnonzero(last)
        shared = np.zeros(len(at), bool)
        shared[1:] = np.diff(at) > 1
        shared[:1] = at[:1] > 0
        closed = np.flatnonzero(shared)
        if not len(closed):
            return
        size = int(closed[-1]) + 1
        at, shared = at[:size], shared[:size]
        # at each end: how many tokens of a side end there or before, and whether one does there
        seen_a = of_a.cumsum()[at]
        seen_b, a_ends = at + 1 - seen_a, of_a[at] | shared
        b_ends = ~of_a[at] | shared
        n, m = seen_a[-1], seen_b[-1]
        self.open = [a[n:], b[m:]]
        # between two neighbouring ends of either side lies the overlap of exactly one pair
        pairs = a[seen_a - a_ends] * len(self.lengths[1]) + b[seen_b - b_ends]
        self.links.append(pairs.astype(self.pair).tobytes())
        self.n_links += size
        group = shared.cumsum() - shared
        self._write(a[:n], b[:m], group[a_ends], group[b_ends])
        self.groups += len(closed)

    def _write(self, a, b, group_a, group_b) -> None:
        """Hashes the ids in decimal: those of A, a bar, those of B, a semicolon between groups."""
        import numpy as np

        table, size = self.digits
        place = np.concatenate([group_a * 2, group_b * 2 + 1])
        order = place.argsort(kind="stable")
        ids, place = np.concatenate([a, b])[order], place[order]
        marks = np.where(place[1:] == place[:-1], 44, np.where(place[:-1] % 2, 59, 124))  # , ; |
        text = table[ids]
        text[np.arange(len(ids) - 1), size[ids[:-1]]] = marks
        self.hash.update((b";" if self.groups else b"") + text[text != 0].tobytes())

    def digest(self) -> str:
        return self.hash.hexdigest() if self.groups else ""


def _digits(most: int) -> tuple:
    """Decimal digits of each id with room for a mark, padded with zero bytes, and their number."""
    import numpy as np

    texts = [str(i).encode() for i in range(most)]
    wide = len(texts[-1]) + 1
    return np.frombuffer(b"".join(t.ljust(wide, b"\0") for t in texts), np.uint8).reshape(most, wide).copy(), np.array([len(t) for t in texts])


def _sweep(path_a: str, path_b: str, kinds: tuple):
    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        """Sorted events -> (key, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links): the last row of a document has its figures."""
        import numpy as np

        lengths = _lengths(path_a, path_b)
        digits = _digits(max(map(len, lengths)))
        at, run, block_at = None, None, None

        def finished():
            run.close()
            if len(run.open[0]) or len(run.open[1]):
                raise ValueError("the two sides of a document differ in length")
            return at, run.doc_id, *run.counts, run.groups, run.n_links, run.digest(), b"".join(run.links)

        for key, doc_id, block, side, ids in rows:
            if key != at:
                if run:
                    yield finished()
                at, run, block_at, held = key, Sweep(doc_id, lengths, digits, kinds), 0, 0
            elif block != block_at:
                run.close()
                if run.n_links - held >= ROW_LINKS:
                    yield key, doc_id, None, None, None, None, None, b"".join(run.links)
                    run.links, held = [], run.n_links
                block_at = block
            run.take(side, np.frombuffer(ids, kinds[0]).astype(np.int64))
        if run:
            yield finished()

    return each


def _count(pair: str):
    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        """(links) -> (pair, n), each pair once or a few times a task."""
        import numpy as np

        pairs, n, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged():
            new, count = np.unique(np.frombuffer(b"".join(waiting), pair), return_counts=True)
            both, where = np.unique(np.concatenate([pairs, new.astype(np.int64)]), return_inverse=True)
            return both, np.bincount(where, np.concatenate([n, count])).astype(np.int64)

        for (links,) in rows:
            waiting.append(links)
            held += len(links)
            if held > 32 << 20:
                pairs, n = merged()
                waiting, held = [], 0
                if len(pairs) > COUNTED:
                    yield from zip(pairs.tolist(), n.tolist())
                    pairs, n = pairs[:0], n[:0]
        if waiting:
            pairs, n = merged()
        yield from zip(pairs.tolist(), n.tolist())

    return each


def _score(frequent, pair: str):
    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        """(key, links) -> (key, n_best, count_sum) over the frequent pairs, and the other pairs with how often each comes."""
        import numpy as np

        known, counts, top = (np.frombuffer(x, k) for x, k in zip(frequent.value, (np.int64, np.int64, np.bool_)))
        for key, links in rows:
            found = np.frombuffer(links, pair).astype(np.int64)
            at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
            hit = known[at] == found if len(known) else np.zeros(len(found), bool)
            rare, times = np.unique(found[~hit], return_counts=True)
            yield key, int(top[at[hit]].sum()), int(counts[at[hit]].sum()), rare.tolist(), times.tolist()

    return each


def align(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A reads a space and the text, B the text (it adds the space); special tokens in texts are plain text. A text that is
    null or empty or that one of them doesn't give back byte by byte has no tokens: zeros and an empty string. Rows are
    told apart by where they are read, so ids may be null or repeat. Texts are read whole; an empty table gives no rows.
    """
    n_a, n_b = len(bytes_a(path_a)), len(bytes_b(path_b))
    kinds = "<u2" if max(n_a, n_b) <= 1 << 16 else "<u4", "<u4" if n_a * n_b <= 1 << 32 else "<u8"
    scratch = Scratch(spark, "alignment")
    key = f"key long, id {docs.schema[id_col].dataType.simpleString()}"
    events = map_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), _events(path_a, path_b, kinds[0]), f"{key}, block int, side int, ids binary")
    swept = events.repartition("key").sortWithinPartitions("key", "block", "side")
    figures = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    links = scratch.save(map_rows(swept, _sweep(path_a, path_b, kinds), f"{key}, {figures}, links binary"), "links")
    counted = map_rows(links.select("links"), _count(kinds[1]), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = scratch.save(counted.withColumn("b", F.col("pair") % n_b), "counts")
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    pairs = scratch.save(counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("top")), "pairs")
    scratch.drop(counted)
    total = pairs.agg(F.sum("n")).first()[0] or 0
    # at most FREQUENT rows of 17 bytes
    often = pairs.where(F.col("n") * FREQUENT > total).orderBy("pair").toArrow()
    values = often["pair"].to_numpy(), often["n"].to_numpy(), often["top"].to_numpy(zero_copy_only=False)
    frequent = spark.sparkContext.broadcast(tuple(x.tobytes() for x in values))
    scored = map_rows(links.select("key", "links"), _score(frequent, kinds[1]), "key long, n_best long, count_sum long, rare array<long>, times array<long>")
    scored = scratch.save(scored, "scored")
    frequent.destroy()
    rest = scored.where("size(rare) > 0").select("key", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("key", F.col("x.rare").alias("pair"), F.col("x.times").alias("times"))
    # a pair that isn't frequent has so few links that no key of this join is hot
    rest = rest.join(pairs.where(F.col("n") * FREQUENT <= total), "pair").select("key", F.expr("if(top, times, 0L)").alias("n_best"), (F.col("n") * F.col("times")).alias("count_sum"))
    sums = scored.select("key", "n_best", "count_sum").unionByName(rest).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = links.where("n_a is not null").drop("links").join(sums, "key")
    return out.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op11(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return align(spark, docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")
