"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked through pigeonring chains."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, held_by, join_by_key, key_filter, release_memory
from .components import connected_components

BITS = 64
#: Shingles hashed at a time, so one long text never needs more than a few MB.
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of ``text``: a bit is 1 if set in over half the shingle hashes; no words give 0."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").translate(_ASCII_LOWER).split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    ones, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_intdigest
    for lo in range(0, n, CHUNK):
        part = np.array([digest(joined[a:b], seed) for a, b in zip(starts[lo : lo + CHUNK], stops[lo : lo + CHUNK])], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


_ASCII_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, also: tuple[str, ...] = ()) -> DataFrame:
    """(id, fp long and the long columns ``also``) of every row; null texts count as empty."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x - (1 << 64) if x >> 63 else x for x in fps], pa.int64()), *b.columns[2:]], ["id", "fp", *also])
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"), *also).mapInArrow(run, ", ".join(f"{c} long" for c in ("id", "fp", *also)))


def segments(parts: int) -> list[tuple[int, int]]:
    """(shift, width) of ``parts`` near-equal segments of the ring of 64 bits."""
    cuts = [BITS * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def ring_links(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at most ``max_bits`` apart; ``prints`` has each fp once.

    Pigeonring: with m = max_bits + 1 segments on a ring, two fingerprints within the distance have a start
    segment from which every chain of l consecutive segments differs in at most floor(l * max_bits / m) bits,
    that is l - 1. Chains of one and two segments are the join key (first segment equal, second at most one
    bit off: the probe side lists those variants); chains of three and more are checked inside the join before
    the full distance, so only links leave it. No pair is lost and no bucket is capped.
    """
    m = max_bits + 1
    ring = segments(m)
    fp, other = F.col("fp"), F.col("g")

    def part(x: Column, i: int) -> Column:
        shift, width = ring[i % m]
        return F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << width) - 1))

    wide = max(w for _, w in ring)

    def key(x: Column, i: int) -> Column:
        return F.lit(i << (2 * wide)).bitwiseOR(F.shiftleft(part(x, i), wide)).bitwiseOR(part(x, i + 1))

    exact = F.array(*[key(fp, i) for i in range(m)])
    near = F.array(*[key(fp, i).bitwiseXOR(F.lit(flip)) for i in range(m) for flip in [0, *(1 << b for b in range(ring[(i + 1) % m][1]))]])
    build = prints.select(F.col("fp").alias("g"), F.explode(exact).alias("k"))
    probe = prints.select("fp", F.explode(near).alias("k"))
    differ = fp.bitwiseXOR(other)
    start = F.shiftright(F.col("k"), 2 * wide).cast("int") + 1

    def chain(length: int) -> Column:
        masks = []
        for i in range(m):
            mask = 0
            for j in range(length):
                shift, width = ring[(i + j) % m]
                mask |= ((1 << width) - 1) << shift
            masks.append(F.lit(mask - (1 << 64) if mask >> 63 else mask))
        return F.bit_count(differ.bitwiseAND(F.element_at(F.array(*masks), start))) <= length * max_bits // m

    keep = fp < other
    for length in range(3, m):
        keep = keep & chain(length)
    keep = keep & (F.bit_count(differ) <= max_bits)
    build = build.withColumnRenamed("k", "bk")
    return probe.join(build, (F.col("k") == F.col("bk")) & keep).select(fp.alias("a"), other.alias("b"))


def _components(spark: SparkSession, scratch: Scratch, classes: DataFrame, max_bits: int) -> DataFrame:
    """``classes`` (one row per fp) with component: the smallest fingerprint reachable over links, itself included."""
    labels, held = connected_components(spark, ring_links(classes.select("fp"), max_bits).select(F.col("a").alias("u"), F.col("b").alias("v")))
    out = scratch.save(classes.join(labels, classes["fp"] == labels["node"], "left").select(*classes.columns, F.coalesce("component", "fp").alias("component")), "components")
    held.drop_all()
    return out


def simhash_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(id, fp long, component) of every row: component is the smallest id reachable over links, itself included.

    Rows with one fingerprint are one class from the start, so copies are never paired with each other; what is
    paired are different fingerprints, of which at most 2,081 can lie within four bits of each other.
    Null and empty texts have fingerprint 0 and link like any other; rows that repeat an id share its result;
    a null id takes part in its class and its links but never names it. An empty table gives an empty result.
    """
    scratch = Scratch(spark, "simhash")
    prints = scratch.save(fingerprints(docs, id_col, text_col, shingle), "prints")
    classes = scratch.save(prints.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "classes")
    linked = _components(spark, scratch, classes, max_bits)
    named = linked.groupBy("component").agg(F.min("rep").alias("first"), F.count("*").alias("m"))
    comp = scratch.save(join_by_key(linked, named, ["component"], "m", linked.count(), "inner").select("fp", "n", F.col("first").alias("component")), "named")
    scratch.drop(classes, linked)
    return join_by_key(prints, comp, ["fp"], "n", prints.count(), "inner").select("id", "fp", "component")


def representatives(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of each group of rows whose fingerprints link, decided for each row whatever its id.

    The row with the smallest id stays, null ids last, and among equal ids the one with the smallest hash of its
    columns; of rows equal in all columns one stays. Null and empty texts are one group. An empty table gives no
    rows. Only rows that may have to go are shuffled with their texts; the others are kept where they are read.
    """
    scratch = Scratch(spark, "simhash")
    cells = [c for name in docs.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]  # hashes pass over nulls
    keys = {"_h1": F.xxhash64(*cells), "_h2": F.xxhash64(F.lit("second"), *cells)}
    keyed = docs.withColumns(keys)
    prints = scratch.save(fingerprints(keyed, id_col, text_col, shingle, tuple(keys)), "prints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_h1", "_h2")).alias("first")
    classes = scratch.save(prints.groupBy("fp").agg(first, F.count("*").alias("n")), "classes")
    linked = _components(spark, scratch, classes, max_bits)
    groups = linked.groupBy("component").agg(F.min("first").alias("lead"), F.sum("n").alias("rows"), F.count("*").alias("m")).where("rows > 1")
    comp = join_by_key(linked.drop("first"), groups, ["component"], "m", linked.count(), "inner").select("fp", "n", F.col("lead._h1").alias("_k1"), F.col("lead._h2").alias("_k2"))
    shared = join_by_key(prints.select("fp", "_h1", "_h2"), scratch.save(comp, "shared"), ["fp"], "n", prints.count(), "inner")
    own = (F.col("_h1") == F.col("_k1")) & (F.col("_h2") == F.col("_k2"))
    shared = scratch.save(shared.groupBy("_h1", "_h2").agg(F.max(own).alias("first"), F.count("*").alias("copies")), "rows")
    going = shared.where("not first or copies > 1").select("_h1", "_h2", "first")
    asked = held_by(keyed, scratch.save(key_filter(going, "_h1", "_h2"), "going"), "_h1", "_h2")
    names = [F.col(f"`{c}`") for c in docs.columns]
    asked_for = asked.where("_maybe").dropDuplicates(["_h1", "_h2"])
    stays = asked_for.join(going.where("not first").select("_h1", "_h2").hint("merge"), ["_h1", "_h2"], "left_anti")
    scratch.drop(prints, classes, linked)
    return asked.where("not _maybe").select(*names).unionByName(stays.select(*names))


def op8(spark: SparkSession, docs: DataFrame) -> DataFrame:
    groups = simhash_groups(spark, docs)
    return groups.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
