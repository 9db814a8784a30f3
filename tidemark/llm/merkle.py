"""Merkle manifest of a table: a tree of hashes per language over all rows, one over the languages, and a proof for each row.

Every row is a leaf. Leaves are range-sorted and numbered inside their language, and each one is an event: its parent
takes the digest under the child's place and, once it holds as many children as the size of the language says it has,
becomes an event of the next level. Tasks do this over their own sorted rows first, where all but the parents that
straddle two tasks are completed (the map-side combine of a combineByKey); what stays open is dealt out by a common
ancestor three levels up and completed there, round after round, until each language has one root. Each completed
parent leaves its children's digests behind; those links are followed from the root down to give every leaf its proof.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, map_rows

ARITY, BITS = 8, 3
#: Levels that a round of the shuffle completes: one task holds at most 8^3 nodes of one ancestor at a time.
SPAN = 3
DIGEST = 32

_NODE = "pid long, grp string, level int, idx long, digest binary, kids binary"


def _h(text: bytes) -> bytes:
    return sha256(text).digest()


def width(size: int, level: int) -> int:
    """Nodes of a level over so many leaves."""
    return (size + (1 << BITS * level) - 1) >> BITS * level


def height(size: int) -> int:
    level = 0
    while width(size, level) > 1:
        level += 1
    return level


class Parents:
    """Partial parents by (level, place): each child's digest under its place, until the arity is met."""

    def __init__(self):
        self.open: dict[tuple[int, int], dict[int, bytes]] = {}

    def add(self, level: int, idx: int, digest: bytes, size: int | None = None, top: int | None = None) -> Iterator[tuple]:
        """Takes one node; yields (level, idx, digest, children) of every parent that it completes and, with a
        ``size``, (level, idx, digest, None) of the node that reaches the level ``top`` or the root."""
        while True:
            if size is not None and (level >= top or width(size, level) == 1):
                yield level, idx, digest, None
                return
            key, arity = (level + 1, idx >> BITS), ARITY
            if size is not None:
                arity = min(ARITY, width(size, level) - (key[1] << BITS))
            held = self.open.setdefault(key, {})
            held[idx & ARITY - 1] = digest
            if len(held) < arity:
                return
            del self.open[key]
            kids = b"".join(held[i] for i in range(arity))
            level, idx, digest = *key, _h(kids.hex().encode())
            yield level, idx, digest, kids

    def left(self) -> Iterator[tuple]:
        """The children of parents that stay open, and forgets them."""
        for (level, parent), held in self.open.items():
            for place, digest in held.items():
                yield level - 1, (parent << BITS) + place, digest, None
        self.open.clear()


def _number(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(grp, ...) rows of a sorted partition -> partition, place inside the group there, row."""
    from pyspark import TaskContext

    pid, last, k = TaskContext.get().partitionId(), object(), 0
    for row in rows:
        if row[0] != last:
            last, k = row[0], 0
        yield pid, k, *row
        k += 1


def _resolve(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(pid, grp, idx, digest), sorted -> completed parents with their children, then open nodes."""
    parents, at = Parents(), None
    for pid, grp, idx, digest in rows:
        if at != (pid, grp):
            yield from ((*at, *node) for node in parents.left())
            at = pid, grp
        yield from ((*at, *node) for node in parents.add(0, idx, digest))
    if at:
        yield from ((*at, *node) for node in parents.left())


def _merge(top: int):
    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        """(grp, block, size, level, idx, digest), sorted by group and block -> completed parents, and nodes that reached ``top`` or are roots."""
        parents, at = Parents(), None
        for grp, block, size, level, idx, digest in rows:
            if at != (grp, block):
                if parents.open:
                    raise ValueError(f"nodes are missing under {at}")
                at = grp, block
            yield from ((size, grp, *node) for node in parents.add(level, idx, digest, size, top))
        if parents.open:
            raise ValueError(f"nodes are missing under {at}")

    return each


def _descend(base: int, out: str):
    """Paths of nodes above ``base`` and the links below them -> by ``out`` the "paths" of the nodes of level ``base``, or
    those of the "rows", or the rows' "proofs". A path lists what stands left and right of the node, then of its parent, and so on."""

    def each(rows: Iterator[tuple]) -> Iterator[tuple]:
        at, known, root = None, {}, None
        for grp, block, _, level, idx, path, subroot, kids, leaf, bad, payload in rows:
            if at != (grp, block):
                at, known = (grp, block), {}
            if path is not None:
                root = subroot
                if level <= base and out == "paths":
                    yield grp, level, idx, path, root
                else:
                    known[level, idx] = path
            elif kids is not None:
                above, text = known.pop((level, idx)), kids.hex()
                for j in range(len(kids) // DIGEST):
                    cut = 2 * DIGEST * j
                    beside = [text[:cut], text[cut + 2 * DIGEST :], *above]
                    if level - 1 == base and out == "paths":
                        yield grp, base, (idx << BITS) + j, beside, root
                    else:
                        known[level - 1, (idx << BITS) + j] = beside
            elif out == "rows":
                yield payload, known[0, idx]
            else:
                path, digest = known[0, idx], (bad or leaf).hex()
                for left, right in zip(path[::2], path[1::2]):
                    digest = sha256(f"{left}{digest}{right}".encode()).hexdigest()
                yield payload, leaf.hex(), root, sha256("".join(path).encode()).hexdigest(), digest

    return each


_SCHEMAS = {
    "paths": "grp string, level int, idx long, path array<string>, subroot string",
    "rows": "payload string, path array<string>",
    "proofs": "payload string, leaf string, subroot string, proof_sha256 string, folded_root string",
}


def _block(level: str, top: int):
    """Ancestor at the level ``top`` by which nodes are dealt out."""
    return F.expr(f"case when {level} < {top} then shiftright(idx, {BITS} * ({top} - {level})) else idx end").alias("block")


class Tree:
    """Trees over the groups of ``rows`` (grp, then the columns of the order, leaf, bad, payload), one for each group.

    Groups ascend, null first; inside a group rows ascend by ``order``. ``bad`` is the leaf of the altered row or null,
    ``payload`` a string carried along.
    """

    def __init__(self, spark: SparkSession, scratch: Scratch, rows: DataFrame, order: list[str]):
        self.scratch = scratch
        sort = ["grp", *order]
        # rows that are alike in all columns are told apart by where they were stored, so that no range is too wide
        stored = scratch.save(rows.withColumn("_at", F.monotonically_increasing_id()), "leaves")
        sort += [F.col("leaf"), F.col("_at")]
        dealt = stored.repartitionByRange(*sort).sortWithinPartitions(*sort).select("grp", "leaf", "bad", "payload")
        placed = scratch.save(map_rows(dealt, _number, "pid int, k long, grp string, leaf binary, bad binary, payload string"), "placed")
        scratch.drop(stored)
        counts = scratch.save(placed.groupBy("pid", "grp").count(), "counts")
        spread = self._spread(spark, counts)
        # one row a partition is broadcast
        self.rows = placed.join(F.broadcast(spread), "pid").select(
            "pid", "grp", (F.col("k") + F.when(F.col("grp").eqNullSafe(F.col("first")), F.col("skip")).otherwise(0)).alias("idx"), "leaf", "bad", "payload"
        )
        sizes = counts.join(F.broadcast(spread), "pid").select(
            "pid",
            "grp",
            F.when(F.col("grp").eqNullSafe(F.col("last")), F.col("last_size")).when(F.col("grp").eqNullSafe(F.col("first")), F.col("first_size")).otherwise(F.col("count")).alias("size"),
        )
        self._grow(sizes)

    def _spread(self, spark: SparkSession, counts: DataFrame) -> DataFrame:
        """One row a partition: its first and last group, their whole sizes, and the rows of the first in earlier partitions."""
        g = F.struct(F.col("grp").isNotNull(), F.col("grp"))
        ends = counts.groupBy("pid").agg(
            F.min_by(F.struct("grp", "count"), g).alias("a"), F.max_by(F.struct("grp", "count"), g).alias("b"), F.max("count").alias("most")
        )
        parts = [(pid, *a, *b) for pid, a, b, _ in ends.orderBy("pid").collect()]
        whole: dict[str | None, int] = {}
        skips = []
        for _, first, n, last, m in parts:
            skips.append(whole.get(first, 0))
            whole[first] = whole.get(first, 0) + n
            if last != first:
                whole[last] = whole.get(last, 0) + m
        self.largest = max([*whole.values(), *(n for n, in counts.agg(F.max("count")).collect() if n)], default=0)
        out = [(p, first, last, skip, whole[first], whole[last]) for (p, first, _, last, _), skip in zip(parts, skips)]
        return spark.createDataFrame(out, "pid int, first string, last string, skip long, first_size long, last_size long")

    def _grow(self, sizes: DataFrame) -> None:
        scratch = self.scratch
        found = scratch.save(map_rows(self.rows.select("pid", "grp", "idx", "leaf"), _resolve, _NODE), "nodes")
        self.links = [found.where("kids is not null").select("grp", "level", "idx", "kids")]
        # a partition leaves at most seven nodes open at either end of a level
        edge = found.where("kids is null").withColumn("_g", F.col("grp"))
        sized = sizes.select("pid", F.col("grp").alias("_s"), "size")
        nodes = edge.join(sized, (edge.pid == sized.pid) & edge._g.eqNullSafe(sized._s)).select("size", "grp", "level", "idx", "digest")
        self.rounds = -(-height(max(self.largest, 1)) // SPAN)
        for top in range(SPAN, SPAN * self.rounds + 1, SPAN):
            dealt = nodes.select("grp", _block("level", top), "size", "level", "idx", "digest").repartition("grp", "block").sortWithinPartitions("grp", "block")
            done = scratch.save(map_rows(dealt, _merge(top), _NODE.replace("pid", "size")), f"round{top}")
            self.links.append(done.where("kids is not null").select("grp", "level", "idx", "kids"))
            nodes = done.where("kids is null").select("size", "grp", "level", "idx", "digest")
        self.roots = nodes.select("grp", "level", F.lit(0).cast("long").alias("idx"), F.lower(F.hex("digest")).alias("subroot"))

    def descend(self, paths: DataFrame, out: str) -> DataFrame:
        """From the paths of the roots (grp, level, idx, path, subroot) down to the "rows" or their "proofs"."""
        links = self.links[0]
        for more in self.links[1:]:
            links = links.unionByName(more)
        none = lambda kind, *names: [F.lit(None).cast(kind).alias(n) for n in names]
        for base in range(SPAN * max(self.rounds - 1, 0), -1, -SPAN):
            top = base + SPAN
            parts = paths.select("grp", _block("level", top), F.lit(0).alias("kind"), "level", "idx", "path", "subroot", *none("binary", "kids", "leaf", "bad"), *none("string", "payload"))
            here = links.where(f"level > {base} and level <= {top}")
            parts = parts.union(here.select("grp", _block("level", top), F.lit(1), "level", "idx", *none("array<string>", "path"), *none("string", "subroot"), "kids", *none("binary", "leaf", "bad"), *none("string", "payload")))
            if not base:
                parts = parts.union(self.rows.select("grp", _block("0", top), F.lit(2), F.lit(0), "idx", *none("array<string>", "path"), *none("string", "subroot"), *none("binary", "kids"), "leaf", "bad", "payload"))
            dealt = parts.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind", F.col("level").desc())
            kind = "paths" if base else out
            paths = map_rows(dealt, _descend(base, kind), _SCHEMAS[kind])
            if base:
                paths = self.scratch.save(paths, f"paths{base}")
        return paths


def _field(name: str):
    text = F.col(name).cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaves(docs: DataFrame) -> DataFrame:
    """grp, doc_id, leaf and bad (the leaf after tampering, null where nothing is tampered with) of each row, by JVM hashes."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = [_field(c) for c in ("doc_id", "source", "lang", "n_chars")]
    hashed = lambda text: F.unhex(F.sha2(F.concat(*fields, text), 256))
    struck = (F.crc32(F.col("doc_id").cast("string")) % 3 == 0) & F.col("text").isNotNull()
    octets = F.concat(F.octet_length("text").cast("string"), F.lit(":"), lowered)
    return docs.select(F.col("lang").alias("grp"), "doc_id", hashed(_field("text")).alias("leaf"), F.when(struck, hashed(octets)).alias("bad"), F.col("doc_id").cast("string").alias("payload"))


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Rows of a language ascend by doc_id, null ids first, rows of one id by their leaf; those alike in all columns are each
    a leaf. Null columns are hashed as "-", a null language is one of its own and comes first. Columns beside the five
    are no part of the leaf. An empty table gives no rows.
    """
    scratch = Scratch(spark, "manifest")
    none = F.lit(None)
    by_lang = Tree(spark, scratch, leaves(docs), ["doc_id"])
    tops = by_lang.roots.select(F.lit("").alias("grp"), F.col("grp").alias("lang"), F.unhex("subroot").alias("leaf"), none.cast("binary").alias("bad"), F.col("grp").alias("payload"))
    over = Tree(spark, scratch, tops, ["lang"])
    root = (over.roots.select("subroot").first() or [""])[0]
    upper = over.descend(over.roots.select("grp", "level", "idx", F.array().cast("array<string>").alias("path"), "subroot"), "rows")
    paths = by_lang.roots.join(upper, by_lang.roots.grp.eqNullSafe(upper.payload)).select("grp", "level", "idx", "path", "subroot")
    out = by_lang.descend(paths, "proofs").withColumn("root", F.lit(root)).withColumn("doc_id", F.col("payload").cast(docs.schema["doc_id"].dataType))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return manifest(spark, docs)
