"""Vector expressions over array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import col, safe_div


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    return safe_div(dot(a, b), norm(a) * norm(b))


def unit(a: Column | str) -> Column:
    """Scaled to length 1; null for a zero vector."""
    n = norm(a)
    return F.when(n > 0, F.transform(col(a), lambda x: x.cast("double") / n))


def centroid(df: DataFrame, keys: list[str], vector: str, alias: str = "centroid") -> DataFrame:
    """Mean vector of each group: one aggregate per component keeps partial aggregation."""
    places = df.select(*keys, F.posexplode(vector).alias("_i", "_x"))
    means = places.groupBy(*keys, "_i").agg(F.avg("_x").alias("_x"))
    return means.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"]).alias(alias))


def hashing_embedder(dimensions: int = 256):
    """UDF: words to signed buckets by 32-bit FNV-1a, scaled to length 1."""

    def fnv(word: str) -> int:
        h = 2166136261
        for byte in word.encode("utf-8"):
            h = (h ^ byte) * 16777619 & 0xFFFFFFFF
        return h

    def embed(texts):
        import numpy as np
        import pandas as pd

        known, out = {}, []
        for text in texts:
            v = np.zeros(dimensions, dtype=np.float64)
            for w in "".join(c.lower() if c.isalnum() else " " for c in text or "").split():
                if (h := known.get(w)) is None:
                    h = known[w] = fnv(w)
                v[h % dimensions] += 1.0 if h >> 31 else -1.0
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype(np.float32))
        return pd.Series(out)

    return F.pandas_udf(embed, "array<float>")
