"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is scored by its worst window of a few words: the bag of a window is all character n-grams of its
words (word ends marked), so a misspelling or an unseen compound shares most of its n-gram vectors with words
seen in training. Training alternates between picking each text's worst window and a joint step on the n-gram
vectors and the softmax weights.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release_memory, text_or_empty

NGRAMS = (3, 4, 5, 6)
BUCKET_BITS = 18
DIMENSIONS = 12
WINDOW_WORDS = 2
THRESHOLD = 0.7
#: Bounds of the training sample: labelled rows of each class, characters of a row that may be in it, and characters of a
#: class's rows together, which keeps the n-grams of both classes under 100 MB on the driver.
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = 3_000_000
ROUNDS = 6
SEED = 20240101
_MULTIPLIER = 0x9E3779B1
_POWER = 0x01000193


def _codes(text: str):
    """Lower-cased code points with one 0 before, between and after words (runs of letters, digits and non-ASCII)."""
    import numpy as np

    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    word = (raw > 127) & ~((raw >= 0x2000) & (raw <= 0x206F)) & (raw != 0xA0)
    word |= ((raw >= 48) & (raw <= 57)) | ((raw >= 97) & (raw <= 122))
    codes = np.zeros(len(raw) + 2, dtype=np.uint32)
    codes[1:-1] = np.where(word, raw, 0)
    keep = codes != 0
    keep[1:] |= codes[:-1] != 0  # of a run of separators the first stays
    keep[0] = True
    return codes[keep]


def _grams(codes):
    """For each n: (bucket of the n-gram that starts at each position, whether it lies in one word)."""
    import numpy as np

    size = len(codes)
    zeros = np.flatnonzero(codes == 0)
    left = np.zeros(size, dtype=np.int32)  # characters from each position to the end of its word
    left[:-1] = np.repeat(zeros[1:], np.diff(zeros))
    left -= np.arange(size, dtype=np.int32)
    h, power = np.zeros(size, dtype=np.uint32), 1
    for j in range(max(NGRAMS)):
        if j >= size:
            return
        h[: size - j] += codes[j:] * np.uint32(power)
        power = power * _POWER & 0xFFFFFFFF
        n = j + 1
        if n in NGRAMS:
            count = size - n + 1
            mixed = (h[:count] ^ np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) * np.uint32(_MULTIPLIER)
            yield (mixed >> np.uint32(32 - BUCKET_BITS)).astype(np.int32), left[:count] >= n - 1


def window_logits(text: str, scalars, bias: float):
    """Logit of every window of words; one window (the bias) for a text without words."""
    import numpy as np

    codes = _codes(text)
    zeros = np.flatnonzero(codes == 0)
    words = len(zeros) - 1
    if words < 1:
        return np.array([bias])
    total, count = np.zeros(len(codes), dtype=np.float32), np.zeros(len(codes), dtype=np.int32)
    for buckets, valid in _grams(codes):
        total[: len(buckets)] += scalars[buckets] * valid
        count[: len(buckets)] += valid
    sums = np.concatenate(([0], np.cumsum(np.add.reduceat(total, zeros[:-1]), dtype=np.float64)))
    counts = np.concatenate(([0], np.cumsum(np.add.reduceat(count, zeros[:-1]))))
    k = min(WINDOW_WORDS, words)
    return (sums[k:] - sums[:-k]) / np.maximum(1, counts[k:] - counts[:-k]) + bias


def _bags(text: str):
    """(buckets of all n-grams, first n-gram of each word and the end) of a text, grouped by word."""
    import numpy as np

    codes = _codes(text)
    zeros = np.flatnonzero(codes == 0)
    found, at = [], []
    for buckets, valid in _grams(codes):
        here = np.flatnonzero(valid)
        found.append(buckets[here])
        at.append(here)
    if not found or len(zeros) < 2:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    at, found = np.concatenate(at), np.concatenate(found)
    word = np.searchsorted(zeros, at, side="right") - 1
    order = np.argsort(word, kind="stable")
    return found[order], np.searchsorted(word[order], np.arange(len(zeros)))


def train(texts: list[str], labels: list[int], seed: int = SEED) -> dict:
    """Fits vectors and softmax jointly; returns the projected n-gram scalars and the bias.

    Without rows of both classes the model is constant: score 0.
    """
    import numpy as np

    buckets, y = 1 << BUCKET_BITS, np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        return {"scalars": np.zeros(buckets, np.float32), "bias": -60.0}
    rng = np.random.default_rng(seed)
    bags = [_bags(t) for t in texts]
    seen = np.zeros((2, buckets))
    for (grams, _), label in zip(bags, y):
        seen[label][np.unique(grams)] += 1
    rate = (seen + 0.5) / (np.bincount(y, minlength=2)[:, None] + 1)
    # The first windows come from class rates of n-grams; later ones from the model itself.
    scalars, bias = np.where(seen.sum(0) > 1, np.log(rate[1] / rate[0]), 0.0), 0.0
    vectors = rng.normal(0, 0.1, (buckets, DIMENSIONS)).astype(np.float32)
    weights, offset = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32), np.zeros(2, np.float32)
    grad_v, grad_w, grad_o = np.full(buckets, 1e-6, np.float32), np.full_like(weights, 1e-6), np.full(2, 1e-6, np.float32)
    for step in range(ROUNDS):
        picked: list = []
        for (grams, first), label in zip(bags, y):
            words = len(first) - 1
            if words < 1 or not len(grams):
                continue
            k = min(WINDOW_WORDS, words)
            sums = np.concatenate(([0], np.cumsum(scalars[grams])))[first]
            means = (sums[k:] - sums[:-k]) / np.maximum(1, first[k:] - first[:-k])
            worst = int(np.argmax(means))
            picked.append((grams[first[worst] : first[worst + k]], label))
            if label == 0 and len(means) > 1:
                other = int(rng.integers(len(means)))
                picked.append((grams[first[other] : first[other + k]], 0))
        picked = [p for p in picked if len(p[0])]
        for _ in range(3):
            for lo in range(0, len(order := rng.permutation(len(picked))), 128):
                batch = [picked[i] for i in order[lo : lo + 128]]
                sizes = np.array([len(g) for g, _ in batch])
                flat, owner = np.concatenate([g for g, _ in batch]), np.repeat(np.arange(len(batch)), sizes)
                mean = np.add.reduceat(vectors[flat], np.concatenate(([0], np.cumsum(sizes)[:-1])), axis=0) / sizes[:, None]
                logits = mean @ weights + offset
                p = np.exp(logits - logits.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(batch)), [label for _, label in batch]] -= 1
                gw, go = mean.T @ p / len(batch), p.mean(0)
                gv = ((p @ weights.T) / sizes[:, None])[owner]
                np.add.at(grad_v, flat, (gv * gv).sum(1) * 25)
                grad_w += gw * gw
                grad_o += go * go
                np.add.at(vectors, flat, -0.15 * gv / np.sqrt(grad_v[flat])[:, None])
                weights -= (0.1 * gw / np.sqrt(grad_w)).astype(np.float32)
                offset -= (0.1 * go / np.sqrt(grad_o)).astype(np.float32)
        scalars = vectors @ (weights[:, 1] - weights[:, 0])
        scalars[seen.sum(0) == 0] = 0  # n-grams never seen have no evidence
        bias = float(offset[1] - offset[0])
    top = np.array([window_logits(t, scalars, bias).max() for t in texts])
    slope, shift = _calibrate(top, y)
    return {"scalars": (slope * scalars).astype(np.float32), "bias": slope * bias + shift}


def _calibrate(top, y) -> tuple[float, float]:
    """Slope and shift of worst-window logits: ridge logistic regression with both classes weighed alike."""
    import numpy as np

    x = np.stack([top, np.ones_like(top)], axis=1)
    weight, beta = 0.5 / np.bincount(y, minlength=2)[y], np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(x @ beta).clip(-30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-4 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        beta = beta - np.linalg.solve(hess, grad).clip(-2, 2)
    return (float(beta[0]), float(beta[1])) if beta[0] > 0 else (1.0, 0.0)


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows to learn from: crc32(doc_id as text) mod 3 is not 1; of each class the first in hash order, within the bounds."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 3 != 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select("doc_id", text_or_empty().alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    sized = usable.join(rows.select("doc_id", F.length("text").alias("n")), "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("n").alias("n"))
    picked: list[int] = []
    for label in (1, 0):
        total = 0
        for r in sized.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS).collect():
            total += r["n"]
            if total <= SAMPLE_TOTAL:
                picked.append(r["doc_id"])
    # at most 2 * SAMPLE_ROWS ids
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in picked], "doc_id long"))
    return rows.join(chosen, "doc_id").join(F.broadcast(usable.join(chosen, "doc_id")), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    rows = sorted(training_rows(docs, labels).collect(), key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows], [r["toxic"] for r in rows])


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row's whole text; null and empty texts get the score of a text without words.

    Repeated rows give a row each, an empty table none; rows without an id are scored like others.
    """
    scalars, bias = model["scalars"], model["bias"]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for b in batches:
            top = np.array([window_logits(t, scalars, bias).max() for t in b.column(1).to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-top.clip(-60, 60))))], ["id", "score"])
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("t")).mapInArrow(run, "id long, score double")


def op1(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, fit(docs, labels))
    held = F.coalesce(F.crc32(F.col("id").cast("string")) % 3 == 1, F.lit(False))
    return out.select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(spark: SparkSession, docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text scores at least ``THRESHOLD``; all columns as they were. Null texts count as empty."""
    model, at = fit(docs, labels), docs.columns.index(text_col)
    scalars, bias = model["scalars"], model["bias"]

    def keep(batches: Iterator) -> Iterator:
        import math

        import pyarrow as pa

        limit = math.log(THRESHOLD / (1 - THRESHOLD))
        for b in batches:
            yield b.filter(pa.array([bool(window_logits(t.as_py() or "", scalars, bias).max() < limit) for t in b.column(at)], pa.bool_()))
        release_memory()

    return docs.mapInArrow(keep, docs.schema)
