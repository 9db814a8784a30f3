"""Line dedup: winnowed line hashes find runs of lines that appeared before; later copies are deleted."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE_CHARS, Scratch, held_by, join_by_key, key_filter, release_memory, text_or_empty

#: Words that a repeated run must have; a window of consecutive lines is as short as reaches them.
RUN_WORDS = 50


def text_lines(text: str) -> list[tuple[int, int, int]]:
    """(index among all lines, signed hash, words) of each line that has a word; lines end at \\n, outer white space doesn't count."""
    import xxhash

    out = []
    for i, line in enumerate(text.split("\n")):
        words = len(line.encode("utf-8", "surrogatepass").split())
        if words:
            h = xxhash.xxh64_intdigest(line.strip(SPACE_CHARS).encode("utf-8", "surrogatepass"), 7)
            out.append((i, h - (1 << 64) if h >> 63 else h, words))
    return out


def _spans(words: list[int], run_words: int) -> list[tuple[int, int]]:
    """(first line, last line) of every shortest window: forward from each line and backward from each line."""
    total = [0]
    for w in words:
        total.append(total[-1] + w)
    spans, end = set(), 0
    for i in range(len(words)):
        end = max(end, i)
        while end < len(words) and total[end + 1] - total[i] < run_words:
            end += 1
        if end == len(words):
            break
        spans.add((i, end))
    begin = 0
    for j in range(len(words)):
        while begin < j and total[j + 1] - total[begin + 1] >= run_words:
            begin += 1
        if total[j + 1] - total[begin] >= run_words:
            spans.add((begin, j))
    return sorted(spans)


def winnow(hashes: list[int], words: list[int], run_words: int = RUN_WORDS) -> list[tuple[int, int, int]]:
    """(place, first line, last line) of each fingerprint: the minima of all windows, with the lines their windows reach.

    Any line of a repeated run with ``run_words`` words lies in a window inside the run, so a minimum of the run's
    own lines is a guaranteed fingerprint of it; of equal minima the last counts.
    """
    reach: dict[int, list[int]] = {}
    for i, j in _spans(words, run_words):
        part = hashes[i : j + 1]
        at = j - part[::-1].index(min(part))
        if at in reach:
            reach[at] = [min(reach[at][0], i), max(reach[at][1], j)]
        else:
            reach[at] = [i, j]
    return sorted((at, lo, hi) for at, (lo, hi) in reach.items())


def extensions(at: int, hashes: list[int], words: list[int], run_words: int = RUN_WORDS) -> list[tuple[int, int, int]]:
    """(first line, last line, hash) of what a fingerprint at ``at`` extends to, both ways, until it has ``run_words`` words."""
    import struct

    import xxhash

    out = []
    for i, j in _spans(words, run_words):
        part = hashes[i : j + 1]
        if i <= at <= j and j - part[::-1].index(min(part)) == at:
            h = xxhash.xxh64_intdigest(struct.pack(f"<{len(part)}q", *part), 11)
            out.append((i, j, h - (1 << 64) if h >> 63 else h))
    return out


def erase(text: str, spans: list[tuple[int, int]]) -> tuple[str, int]:
    """``text`` without the lines of the spans (numbered among lines with words) and the blank lines inside a span."""
    if not spans:
        return text, 0
    numbers = [i for i, _, _ in text_lines(text)]
    raw, gone, removed = text.split("\n"), set(), set()
    for lo, hi in spans:
        removed.update(range(lo, hi + 1))
        gone.update(range(numbers[lo], numbers[hi] + 1))
    return "\n".join(x for i, x in enumerate(raw) if i not in gone), len(removed)


def dedup_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_words: int = RUN_WORDS) -> DataFrame:
    """``docs`` with ``text_col`` less every later repeated run of lines, and lines_removed (long).

    A run is consecutive lines with words (blank lines between don't count) holding at least ``run_words``
    words, in this library's definition; it is later if the same run starts earlier in the order of (id, text
    hash, line). Lines of the earlier copy itself always stay, also where copies overlap in one text. Null texts
    stay null, empty ones empty. Rows that repeat both id and text count as one document and share the result.
    An empty table gives no rows.

    Each text is winnowed to its fingerprints, the minima of windows of lines, with the lines around them. Their
    positions are joined on the fingerprint, and those at one place only drop out. The others extend both ways,
    line by line until the match has ``run_words`` words; extensions that are equal join the first place where
    they stand (a star, not all pairs). Overlapping extensions make up the whole of a longer run. Only the texts
    of rows that may have something to cut are shuffled.
    """
    scratch = Scratch(spark, "lines")

    def fingerprints(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows: list[tuple] = []
            for key, mark, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                known = text_lines(text)
                hashes, words = array("q", [h for _, h, _ in known]), array("q", [w for _, _, w in known])
                for at, lo, hi in winnow(hashes.tolist(), words.tolist(), run_words):
                    rows.append((key, mark, hashes[at], at, lo, hashes[lo : hi + 1].tobytes() + words[lo : hi + 1].tobytes()))
                if len(rows) > 20_000:
                    yield _batch(pa, rows, _FINGERPRINTS)
                    rows = []
            if rows:
                yield _batch(pa, rows, _FINGERPRINTS)
        release_memory()

    def extend(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            rows = []
            for key, mark, at, lo, around in zip(*[c.to_pylist() for c in b.columns]):
                both = array("q")
                both.frombytes(around)
                n = len(both) // 2
                rows += [(key, mark, lo + i, lo + j, h) for i, j, h in extensions(at - lo, both[:n].tolist(), both[n:].tolist(), run_words)]
            if rows:
                yield _batch(pa, rows, _EXTENSIONS)
        release_memory()

    keyed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__mark": F.xxhash64(text_or_empty(text_col))})
    listed = scratch.save(keyed.select("__id", "__mark", text_or_empty(text_col).alias("t")).mapInArrow(fingerprints, _FINGERPRINTS), "fingerprints")
    place = F.struct("id", "mark", "at")
    shared = scratch.save(listed.groupBy("f").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("n")).where("a != b").select("f", "n"), "shared")
    alive = join_by_key(listed, shared, ["f"], "n", listed.count(), "inner").select("id", "mark", "at", "lo", "around")
    matches = scratch.save(alive.mapInArrow(extend, _EXTENSIONS), "extensions")
    first = matches.groupBy("w").agg(F.min(F.struct("id", "mark", "lo", "hi")).alias("src"), F.count("*").alias("n")).where("n > 1")
    later = join_by_key(matches, scratch.save(first, "first"), ["w"], "n", matches.count(), "inner").where(F.struct("id", "mark", "lo") > F.struct("src.id", "src.mark", "src.lo"))
    same = F.col("id").eqNullSafe(F.col("src.id")) & (F.col("mark") == F.col("src.mark"))
    later = later.select("id", "mark", F.when(same, F.greatest("lo", F.col("src.hi") + 1)).otherwise(F.col("lo")).alias("lo"), "hi").where("lo <= hi")
    # a document's own extensions, at most two a line
    cuts = scratch.save(later.groupBy(F.col("id").alias("__cut_id"), F.col("mark").alias("__cut_mark")).agg(F.collect_set(F.struct("lo", "hi")).alias("__spans")), "cuts")
    held = scratch.save(key_filter(cuts, "__cut_id", "__cut_mark"), "held")
    scratch.drop_all(but=(cuts, held))
    asked = held_by(keyed, held, "__id", "__mark")
    # one plan at every size: a small table of cuts would be broadcast and a large one not
    joined = asked.where("_maybe").join(cuts.hint("merge"), F.col("__id").eqNullSafe(F.col("__cut_id")) & (F.col("__mark") == F.col("__cut_mark")), "left")

    given = [c for c in docs.columns if c != "lines_removed"]
    at = given.index(text_col)

    def rewrite(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = b.column(at).to_pylist()
            done = [(t, 0) if t is None or s is None else erase(t, [(x["lo"], x["hi"]) for x in s]) for t, s in zip(texts, b.column(len(given)).to_pylist())]
            columns = [*b.columns[:-1], pa.array([n for _, n in done], pa.int64())]
            columns[at] = pa.array([t for t, _ in done], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, [*given, "lines_removed"])
        release_memory()

    names = [F.col(f"`{c}`") for c in given]
    schema = T.StructType([*[T.StructField(c, docs.schema[c].dataType) for c in given], T.StructField("lines_removed", T.LongType())])
    whole = asked.where("not _maybe").select(*names, F.lit(0).cast("long").alias("lines_removed"))
    return whole.unionByName(joined.select(*names, "__spans").mapInArrow(rewrite, schema))


_FINGERPRINTS = "id long, mark long, f long, at int, lo int, around binary"
_EXTENSIONS = "id long, mark long, lo int, hi int, w long"


def _batch(pa, rows: list[tuple], schema: str):
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*[c.split() for c in schema.split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, k in zip(zip(*rows), types)], list(names))


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, lines_removed and the SHA-256 and length of what stays."""
    out = dedup_lines(spark, docs.select("doc_id", "text"))
    text = text_or_empty()
    return out.select("doc_id", "lines_removed", F.length(text).cast("long").alias("n_chars"), F.sha2(text.cast("binary"), 256).alias("text_sha256"))
