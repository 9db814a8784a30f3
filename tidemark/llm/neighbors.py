"""Near-duplicate embeddings by NN-descent over a neighbour graph.

Equal vectors are one class first. A random-projection start gives every class some neighbours; rounds of
neighbours-of-neighbours joins refine the lists until they settle. Pairs at or above the threshold link.
A list full of links is saturated: its node's list then grows to its whole linked component, which is compared
in blocks by their centres and radii, so link counts are exact inside components, and further starts give every node ``LIST`` more places
that only rows of other components take, until no start links two components. An audit against all rows
measures what was missed, by number of links, and adds starts until the recall is met; if it never is, a
warning tells the recall.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, join_by_key
from .components import connected_components

THRESHOLD = 0.9
#: Neighbours below this similarity are no help in finding links.
FLOOR = 0.8
LIST = 10
TABLES = 24
REACH = 10
ROUNDS = 8
BLOCK = 256
#: Angles within this of the threshold's are compared one by one.
SURE = 1e-7
#: The audit compares so many classes with all rows, or four times the root of the number of classes if that is more.
AUDIT_QUERIES = 512
AUDIT_RECALL = 0.995
STARTS = 12
#: After all starts, a result with a recall under this is an error, one under AUDIT_RECALL a warning.
LEAST_RECALL = 0.9
#: Strata of fewer queries than this don't raise an error, and a single missed query in one doesn't ask for another start.
JUDGED = 20
#: Starts where the audit finds no link to measure by.
BLIND_STARTS = 3


def _unit(vectors: list[bytes], kind: str):
    """(rows scaled to length 1 in double precision, their dimensions); shorter rows are padded with zeros."""
    import numpy as np

    width = np.dtype(kind).itemsize
    dims = np.array([len(v) // width for v in vectors], dtype=np.int64)
    if len(dims) and (dims == dims[0]).all():
        x = np.frombuffer(b"".join(vectors), kind).astype(np.float64).reshape(len(dims), -1)
    else:
        x = np.zeros((len(dims), dims.max(initial=0)))
        for row, v in zip(x, vectors):
            row[: len(v) // width] = np.frombuffer(v, kind)
    top = np.abs(x).max(axis=1, keepdims=True) if x.size else x
    x = x / top  # keeps squares of huge and tiny components finite
    return x / np.linalg.norm(x, axis=1, keepdims=True), dims


def _settle(sim, x, y, threshold: float):
    """``sim`` = x @ y.T with what lies within a rounding error of the threshold summed anew, exactly rounded in any order."""
    import numpy as np

    for i, j in np.argwhere(np.abs(sim - threshold) < 1e-12):
        sim[i, j] = math.fsum((x[i] * y[j]).tolist())
    return sim


def _groups(batches: Iterator, keys: int, work: Callable) -> Iterator:
    """Calls ``work(rows)`` for each run of rows with equal first ``keys`` columns, over batch borders."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            if held and held[0][:keys] != row[:keys]:
                yield from work(held)
                held = []
            held.append(row)
    if held:
        yield from work(held)


def _classes(scratch: Scratch, vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame, str]:
    """(rows with class keys, classes with smallest id, number of copies and vector, number type)."""
    double = isinstance(vectors.schema[vector_col].dataType.elementType, T.DoubleType)
    kind = "<f8" if double else "<f4"
    v = F.col(vector_col).cast("array<double>" if double else "array<float>")
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    keyed = vectors.select(F.col(id_col).cast("long").alias("id"), F.when(F.coalesce(usable, F.lit(False)), v).alias("v"))
    keyed = keyed.withColumns({"k1": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "k2": F.when(F.col("v").isNotNull(), F.xxhash64(F.lit("second"), "v"))})
    rows = scratch.save(keyed.select("id", "k1", "k2"), "rows")
    grouped = keyed.where("v is not null and id is not null").groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("v").alias("v"))

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            packed = pa.array([np.asarray(x.values, dtype=kind).tobytes() for x in b.column(4)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:4], packed], ["k1", "k2", "id", "copies", "vec"])

    return rows, scratch.save(grouped.mapInArrow(pack, "k1 long, k2 long, id long, copies long, vec binary"), "classes"), kind


def _component(df: DataFrame, id_col: str, labels: DataFrame | None, name: str = "comp") -> DataFrame:
    """``df`` with the component of ``id_col``; an id without links is its own."""
    if labels is None:
        return df.withColumn(name, F.col(id_col))
    named = labels.select(F.col("node").alias("_node"), F.col("component").alias("_c"))
    return df.join(named, F.col(id_col) == F.col("_node"), "left").withColumn(name, F.coalesce("_c", id_col)).drop("_node", "_c")


def start_pairs(classes: DataFrame, kind: str, tables: int, seed: int, floor: float, threshold: float, reach: int = REACH, labels: DataFrame | None = None) -> DataFrame:
    """(a, b, sim) at or above ``floor`` among rows that stand close in random-projection order.

    Each table sorts all rows by the signs of random projections, ties by a hash, and compares each row with
    the ``reach`` rows before its run of rows of one component (without ``labels``, before itself); pairs inside
    a component are left out. The work is linear however many rows share their signs.
    """

    def codes(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            x, dims = _unit(b.column(1).to_pylist(), kind)
            for t in range(tables):
                code = np.zeros(len(x), dtype=np.int64)
                for d in np.unique(dims):
                    planes = np.random.default_rng([seed, t, int(d)]).normal(size=(int(d), 40))
                    mine = dims == d
                    code[mine] = ((x[mine, :d] @ planes) > 0) @ (1 << np.arange(40, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), t, np.int32)), pa.array(dims), pa.array(code), *b.columns], ["t", "d", "code", "id", "vec", "comp"])

    def near(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held: tuple = ()
        for b in batches:
            keys = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1, 5, 3)], axis=1)
            x, _ = _unit(b.column(4).to_pylist(), kind)
            fresh = 0
            if held:
                wide = max(held[1].shape[1], x.shape[1])
                x = np.concatenate([np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (held[1], x)])
                keys, fresh = np.concatenate((held[0], keys)), len(held[0])
            if not len(keys):
                continue
            begins = np.concatenate(([True], (keys[1:, :3] != keys[:-1, :3]).any(axis=1)))
            run = np.maximum.accumulate(np.where(begins, np.arange(len(keys)), 0))
            found = []
            for w in range(1, reach + 1):
                i = fresh + np.flatnonzero(run[fresh:] >= w)
                j = run[i] - w
                ok = (keys[i, :2] == keys[j, :2]).all(axis=1) & (keys[i, 2] != keys[j, 2])
                i, j = i[ok], j[ok]
                sim = np.einsum("ij,ij->i", x[i], x[j])
                for k in np.flatnonzero(np.abs(sim - threshold) < 1e-12):
                    sim[k] = math.fsum((x[i[k]] * x[j[k]]).tolist())
                ok = sim >= floor
                found.append((keys[i[ok], 3], keys[j[ok], 3], sim[ok]))
            i, j, sim = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j)), pa.array(sim)], ["a", "b", "sim"])
            last = run[-1]
            keep = np.r_[max(0, last - reach) : last, max(last, len(keys) - reach) : len(keys)]
            held = keys[keep], x[keep]

    rows = _component(classes.select("id", "vec"), "id", labels).mapInArrow(codes, "t int, d long, code long, id long, vec binary, comp long")
    rows = rows.withColumn("tie", F.xxhash64("t", "id", F.lit(seed)))
    rows = rows.repartitionByRange("t", "d", "code", "tie").sortWithinPartitions("t", "d", "code", "tie").select("t", "d", "code", "id", "vec", "comp")
    return _best(rows.mapInArrow(near, "a long, b long, sim double"))


def _best(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))


def _lists(pairs: DataFrame, size: int) -> DataFrame:
    """(id, nbr, sim): the ``size`` most similar neighbours of every id."""
    both = pairs.select(F.col("a").alias("id"), F.col("b").alias("nbr"), "sim").unionByName(pairs.select(F.col("b").alias("id"), F.col("a").alias("nbr"), "sim"))
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("sim"), "nbr"))
    return both.withColumn("_r", place).where(F.col("_r") <= size).drop("_r")


def _around(lists: DataFrame, size: int, turn: int) -> DataFrame:
    """(id, nbr): listed neighbours and ``size`` of those that list the id, others in each turn."""
    listed = Window.partitionBy("id").orderBy(F.xxhash64("id", "nbr", F.lit(turn)))
    back = lists.select(F.col("nbr").alias("id"), F.col("id").alias("nbr")).withColumn("_r", F.row_number().over(listed)).where(F.col("_r") <= size).drop("_r")
    return lists.select("id", "nbr").unionByName(back)


def descend(lists: DataFrame, classes: DataFrame, kind: str, floor: float, threshold: float, size: int, turn: int = 0, own: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """(a, b, sim) among the neighbours of each node: those in its list and ``size`` of those that list it.

    With ``labels`` ``own`` has as many neighbours again, and only pairs of different components are returned.
    """
    around = _around(lists, size, turn)
    if own is not None:
        around = around.unionByName(_around(own, size, turn)).unionByName(lists.select("id", F.col("id").alias("nbr")))
    members = _component(around.distinct(), "nbr", labels).join(classes.select(F.col("id").alias("nbr"), "vec"), "nbr").select("id", "nbr", "vec", "comp")

    def join(rows: list[tuple]) -> Iterator:
        import numpy as np
        import pyarrow as pa

        if len(rows) > 1:
            ids, comps = np.array([r[1] for r in rows]), np.array([r[3] for r in rows])
            x, dims = _unit([r[2] for r in rows], kind)
            sim = _settle(x @ x.T, x, x, threshold)
            i, j = np.nonzero(np.triu(sim >= floor, 1) & (dims[:, None] == dims[None]) & (comps[:, None] != comps[None]))
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j])), pa.array(sim[i, j])], ["a", "b", "sim"])

    dealt = members.repartition("id").sortWithinPartitions("id")
    return _best(dealt.mapInArrow(lambda batches: _groups(batches, 1, join), "a long, b long, sim double"))


def complete(scratch: Scratch, classes: DataFrame, labels: DataFrame, kind: str, threshold: float) -> DataFrame:
    """(id, n): links of every class inside its component, copies counted.

    A component of any size is dealt into blocks of about ``BLOCK`` members that stand close together (signs of
    random projections, then a hash). A task compares the members of one block and gives the block's centre and
    radius in angles. Blocks are then compared by their centres, in tiles: two blocks surely linked throughout
    count as a whole, two surely unlinked drop out, and only members of the others are compared one by one.
    """
    sizes = labels.groupBy("component").agg(F.count("*").alias("m"))
    member = classes.join(labels, classes["id"] == labels["node"]).select("component", "id", "copies", "vec")
    member = join_by_key(member, sizes, ["component"], "m", labels.count(), "inner").select("component", "id", "copies", "vec", "m")

    def deal(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            x, dims = _unit(b.column(3).to_pylist(), kind)
            bucket, m = np.zeros(len(x), dtype=np.int64), b.column(4).to_numpy()
            bits = np.ceil(np.log2(np.maximum(1, -(-m // BLOCK)))).astype(np.int64)
            for d in np.unique(dims[bits > 0]):
                mine = (dims == d) & (bits > 0)
                planes = np.random.default_rng([int(d), 1]).normal(size=(int(d), 40))
                signs = (x[mine, :d] @ planes > 0) @ (1 << np.arange(40, dtype=np.int64))
                bucket[mine] = signs & ((1 << bits[mine]) - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket)], ["component", "id", "copies", "vec", "m", "bucket"])

    dealt = scratch.save(member.mapInArrow(deal, "component long, id long, copies long, vec binary, m long, bucket long"), "dealt")
    counts = dealt.groupBy("component", "bucket").agg(F.count("*").alias("n"))
    placed = join_by_key(dealt, counts, ["component", "bucket"], "n", dealt.count(), "inner")
    block = F.shiftleft("bucket", 32).bitwiseOR(F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BLOCK)))
    placed = scratch.save(placed.select("component", block.alias("block"), "id", "copies", "vec", (F.col("m") > BLOCK).alias("more")), "placed")
    scratch.drop(dealt)

    def within(rows: list[tuple]) -> Iterator:
        import numpy as np
        import pyarrow as pa

        component, block, more = rows[0][0], rows[0][1], rows[0][5]
        x, _ = _unit([r[4] for r in rows], kind)
        copies = np.array([r[3] for r in rows])
        linked = _settle(x @ x.T, x, x, threshold) >= threshold
        np.fill_diagonal(linked, False)
        n = (linked @ copies).astype(np.int64)
        centre, radius = x.mean(axis=0), math.pi
        if (length := np.linalg.norm(centre)) > 1e-9:
            centre = centre / length
            radius = float(np.arccos(np.clip((x @ centre).min(), -1, 1)))
        size = len(rows)
        columns = [pa.array([r[2] for r in rows] + [None], pa.int64()), pa.array([*n.tolist(), int(copies.sum())], pa.int64())]
        columns += [pa.array([c] * (size + 1), pa.int64()) for c in (component, block)]
        columns += [pa.array([None] * size + [centre.astype("<f8").tobytes() if more else None], pa.binary()), pa.array([None] * size + [radius], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n", "component", "block", "centre", "radius"])

    grouped = placed.select("component", "block", "id", "copies", "vec", "more").repartition("component", "block").sortWithinPartitions("component", "block")
    first = scratch.save(grouped.mapInArrow(lambda batches: _groups(batches, 2, within), "id long, n long, component long, block long, centre binary, radius double"), "within")
    inner = first.where("id is not null").select("id", "n")
    blocks = first.where("id is null and centre is not null").select("component", "block", F.col("n").alias("copies"), "centre", "radius")
    many = blocks.groupBy("component").agg(F.count("*").alias("b"))
    tiles = join_by_key(blocks, many, ["component"], "b", blocks.count(), "inner").withColumn("tiles", F.ceil(F.col("b") / BLOCK).cast("int"))
    tiles = tiles.withColumn("own", F.pmod(F.xxhash64("block"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiles = tiles.select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "block", "copies", "centre", "radius")

    def between(rows: list[tuple]) -> Iterator:
        import numpy as np
        import pyarrow as pa

        component, i, j = rows[0][:3]
        own, ids, copies, radius = (np.array([r[k] for r in rows]) for k in (3, 4, 5, 7))
        centres = np.stack([np.frombuffer(r[6], "<f8") for r in rows])
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        angle, limit = np.arccos(np.clip(centres[left] @ centres[right].T, -1, 1)), math.acos(threshold)
        reach = radius[left][:, None] + radius[right][None]
        different = ids[left][:, None] != ids[right][None]
        whole, none = different & (angle + reach < limit - SURE), angle - reach > limit + SURE
        check = different & ~whole & ~none
        if i == j:
            check = np.triu(check)
        a, b = np.nonzero(check)
        found = [(ids[left], whole @ copies[right])] + ([(ids[right], whole.T @ copies[left])] if i != j else [])
        out, n = (np.concatenate(c) for c in zip(*found))
        size = len(out) + len(a)
        columns = [pa.array(np.full(size, component)), pa.array(np.concatenate((out, ids[left][a]))), pa.array([None] * len(out) + ids[right][b].tolist(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(n.tolist() + [None] * len(a), pa.int64())], ["component", "block", "with", "n"])

    tiled = tiles.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    pairs = scratch.save(tiled.mapInArrow(lambda batches: _groups(batches, 3, between), "component long, block long, with long, n long"), "pairs")
    sure = pairs.where("n > 0").groupBy("component", "block").agg(F.sum("n").alias("n"))
    sure = placed.where("more").join(sure, ["component", "block"]).select("id", "n")
    asked = pairs.where("with is not null").select("component", F.col("block").alias("i"), F.col("with").alias("j"))
    sides = asked.select("component", F.col("i").alias("block"), "i", "j").unionByName(asked.select("component", F.col("j").alias("block"), "i", "j"))
    asked = placed.where("more").join(sides, ["component", "block"]).select("component", "i", "j", "block", "id", "copies", "vec")

    def compare(rows: list[tuple]) -> Iterator:
        import numpy as np
        import pyarrow as pa

        _, i, j = rows[0][:3]
        x, _ = _unit([r[6] for r in rows], kind)
        own, ids, copies = (np.array([r[k] for r in rows]) for k in (3, 4, 5))
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
        linked = _settle(x[left] @ x[right].T, x[left], x[right], threshold) >= threshold
        out, n = np.concatenate((ids[left], ids[right])), np.concatenate((linked @ copies[right], linked.T @ copies[left]))
        yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(n.astype(np.int64))], ["id", "n"])

    asked = asked.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    checked = asked.mapInArrow(lambda batches: _groups(batches, 3, compare), "id long, n long")
    return inner.unionByName(sure).unionByName(checked).groupBy("id").agg(F.sum("n").alias("n"))


def audited(classes: DataFrame) -> int:
    return max(AUDIT_QUERIES, math.ceil(4 * math.sqrt(classes.count())))


def audit(classes: DataFrame, counts: DataFrame, kind: str, threshold: float, seed: int) -> list[tuple[int, int, float]]:
    """(least links, queries, recall) of hash-chosen classes by their number of links, in powers of two.

    Each query is compared with all rows; a class of queries has the mean of its queries' shares of links that
    ``counts`` has, so a large group of copies can't outweigh the small ones.
    """
    many = audited(classes)
    queries = classes.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(many).select("id", "vec").collect()
    if not queries:
        return []
    keys, vectors = [q["id"] for q in queries], [bytes(q["vec"]) for q in queries]

    def brute(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        q, qd = _unit(vectors, kind)
        total, mine = np.zeros(len(keys), np.int64), np.array(keys)
        for b in batches:
            x, xd = _unit(b.column(2).to_pylist(), kind)
            if x.shape[1] != q.shape[1]:
                wide = max(x.shape[1], q.shape[1])
                x, q = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (x, q))
            ids, copies = b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo in range(0, len(keys), BLOCK):
                part = slice(lo, lo + BLOCK)
                linked = (_settle(q[part] @ x.T, q[part], x, threshold) >= threshold) & (qd[part, None] == xd[None]) & (mine[part, None] != ids[None])
                total[part] += linked @ copies
        yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(total)], ["id", "want"])

    want = classes.select("id", "copies", "vec").mapInArrow(brute, "id long, want long").groupBy("id").agg(F.sum("want").alias("want"))
    share = F.least("want", F.coalesce("n", F.lit(0))) / F.col("want")
    by = want.where("want > 0").join(counts, "id", "left").groupBy(F.floor(F.log2("want")).alias("k")).agg(F.count("*").alias("queries"), F.avg(share).alias("recall"))
    return sorted((1 << r["k"], r["queries"], r["recall"]) for r in by.collect())


def lucky(queries: int, recall: float) -> bool:
    """Whether a stratum of so few queries is within one missed query of the recall asked for, so that it decides nothing alone."""
    return queries < JUDGED and queries * (1 - recall) <= 1 and recall > 0


def near_duplicates(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD, seed: int = 7) -> DataFrame:
    """(id, n_links, component, kept) of every row.

    Links are pairs of other rows with cosine at least ``threshold`` in double precision. Vectors that are
    null, empty, zero or hold a null or non-finite component link with nothing, nor do vectors of different
    lengths. Where no audited vector has a link, recall can't be measured: then ``BLIND_STARTS`` starts are made. Equal vectors link with each other. Rows with a null id count for nothing and are their own. An
    empty table gives no rows.
    """
    scratch = Scratch(spark, "neighbors")
    rows, classes, kind = _classes(scratch, vectors, id_col, vector_col)
    floor, links, own, labels = min(FLOOR, threshold), [], None, None
    for start in range(STARTS):
        pairs = scratch.save(start_pairs(classes, kind, TABLES, seed + start, floor, threshold, labels=labels), "start")
        links.append(scratch.save(pairs.where(F.col("sim") >= threshold).select("a", "b"), "links"))
        lists = scratch.save(_lists(pairs, LIST), "lists")
        scratch.drop(pairs)
        before, joined = _mark(lists), not links[-1].isEmpty()
        for turn in range(ROUNDS):
            if not before[0]:
                break
            found = scratch.save(descend(lists, classes, kind, floor, threshold, LIST, turn, own, labels), "found")
            links.append(scratch.save(found.where(F.col("sim") >= threshold).select("a", "b"), "links"))
            known = lists.where("id < nbr").select(F.col("id").alias("a"), F.col("nbr").alias("b"), "sim").unionByName(lists.where("id > nbr").select(F.col("nbr").alias("a"), F.col("id").alias("b"), "sim"))
            after = scratch.save(_lists(_best(known.unionByName(found)), LIST), "lists")
            scratch.drop(lists, found)
            joined |= not links[-1].isEmpty()
            lists, settled = after, _mark(after)
            done = abs(settled[1] - before[1]) <= 0.001 * settled[1] and settled[0] - before[0] <= 0.001 * settled[0]
            before = settled
            if done:
                break
        if own is None:
            own = lists
        else:
            scratch.drop(lists)
        if joined or labels is None:
            everything = reduce(DataFrame.unionByName, links).select(F.col("a").alias("u"), F.col("b").alias("v"))
            trees, held = connected_components(spark, everything)
            roots = trees.select(F.col("component").alias("node")).distinct().withColumn("component", F.col("node"))
            if labels is not None:
                scratch.drop(labels)
            labels = scratch.save(trees.unionByName(roots), "labels")
            held.drop_all()
            # Lists of more links than they have places may hide a link to another component.
            saturated = not labels.groupBy("component").count().where(F.col("count") > LIST).isEmpty()
            if saturated and start + 1 < STARTS:
                continue
        blocks = Scratch(spark, "blocks")
        counts = scratch.save(complete(blocks, classes, labels, kind, threshold), "counts")
        blocks.drop_all()
        recall = audit(classes, counts, kind, threshold, seed + start)
        if recall and all(r >= AUDIT_RECALL or lucky(q, r) for _, q, r in recall):
            break
        if not recall and (left := classes.count() - (asked := audited(classes))) <= 0:
            break  # all vectors were asked, and none has a link
        if not recall and start + 1 >= BLIND_STARTS:
            warnings.warn(f"none of {asked} audited vectors has a link, so recall is not measured; under {3 / asked:.2%} of the {left} others have one (95 %)", stacklevel=2)
            break
        if start + 1 < STARTS:
            scratch.drop(counts)
    else:
        told = ", ".join(f"{r:.4f} of {q} vectors with {n} to {2 * n - 1} links" for n, q, r in recall)
        message = f"recall of links is under {AUDIT_RECALL} after {STARTS} starts: {told}"
        if any(r < LEAST_RECALL and q >= JUDGED for _, q, r in recall):
            raise RuntimeError(message)
        warnings.warn(message, stacklevel=2)
    if own is not None:
        scratch.drop(own)
    scratch.drop(*links)
    known = classes.select("k1", "k2", "id", "copies").join(labels, F.col("id") == F.col("node"), "left").join(counts, "id", "left")
    known = known.select("k1", "k2", "copies", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    known = scratch.save(known, "known")
    scratch.drop(classes, labels, counts)
    out = join_by_key(rows, known, ["k1", "k2"], "copies", rows.count())
    links = F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select("id", links.alias("n_links"), component.alias("component"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _mark(lists: DataFrame) -> tuple[int, float]:
    """(entries, sum of their similarities): a round that changes neither much has settled."""
    row = lists.agg(F.count("*"), F.coalesce(F.sum("sim"), F.lit(0.0))).first()
    return row[0], row[1]


def op2(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    out = near_duplicates(spark, vectors)
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")
