"""Tables in the shared folder that cut lineage: written once, read by every round that follows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder in the shared place the session names; a local one only where it names none and all runs in one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/tidemark/{tag}-{uuid.uuid4().hex[:12]}"


class Stored:
    """A written table; ``drop`` removes it once nothing reads it any more."""

    def __init__(self, df: DataFrame, tag: str):
        self.spark, self.path = df.sparkSession, shared_folder(df.sparkSession, tag)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
