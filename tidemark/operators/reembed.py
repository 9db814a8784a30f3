"""Recomputing what is derived from every text in batches that survive a stop: finished batches are kept, changed ones redone.

A batch holds the ids of one hash value. Its signature sums up its ids and texts; what was derived is stored under it, so a
later run finds what is still good by name. The new version is published only if the source still has the signatures
that it was derived from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import bundles


class Migration:
    """A migration of ``root`` to ``version``; ``derive`` makes the new column of a text column."""

    def __init__(self, spark: SparkSession, root: str, version: str, derive: Callable[[str], Column], name: str = "vector", batches: int = 16):
        self.spark, self.root, self.version, self.derive, self.name, self.batches = spark, root.rstrip("/"), version, derive, name, batches

    def _batched(self, source: DataFrame) -> DataFrame:
        return source.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(self.batches)).cast("int").alias("batch"))

    def signatures(self, source: DataFrame) -> dict[int, str]:
        """Batch -> hex of the number of its rows and two sums over their ids and texts; one pass, a row a batch."""
        h = lambda seed: F.sum(F.xxhash64(F.lit(seed), "id", "text").cast("decimal(38,0)"))
        by = self._batched(source).groupBy("batch").agg(F.sha2(F.concat_ws("|", F.count("*"), h(1), h(2)), 256).alias("s"))
        return {r["batch"]: r["s"] for r in by.collect()}

    def _place(self, batch: int, signature: str) -> str:
        return f"{self.root}/work/{self.version}/{batch}-{signature[:32]}"

    def _done(self, place: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def missing(self, wanted: dict[int, str]) -> list[int]:
        return [b for b in sorted(wanted) if not self._done(self._place(b, wanted[b]))]

    def work(self, source: DataFrame) -> dict[int, str]:
        """Derives the batches that are not there yet, each in one job; returns the signatures they were derived from."""
        wanted = self.signatures(source)
        rows = self._batched(source)
        for b in self.missing(wanted):
            rows.where(F.col("batch") == b).select("id", self.derive("text").alias(self.name)).write.mode("overwrite").parquet(self._place(b, wanted[b]))
        return wanted

    def publish(self, source: DataFrame, wanted: dict[int, str]) -> bool:
        """Makes the batches the current version if all are there and ``source`` still has their signatures."""
        if self.missing(wanted) or self.signatures(source) != wanted:
            return False
        if wanted:
            bundles.publish(self.spark.read.parquet(*[self._place(b, s) for b, s in sorted(wanted.items())]), self.root, self.version)
        return bool(wanted)

    def run(self, source: DataFrame, rounds: int = 3) -> bool:
        """Works until the source stood still for one round; False if it never did."""
        return any(self.publish(source, self.work(source)) for _ in range(rounds))
