"""Lineage cuts as written tables in the folder all executors share.

A cut survives the loss of executors because its data lie in ``spark.checkpoint.dir``; a cut that is
no longer read can be released at once, so iterative operators hold two generations at most.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A temporary one stands in only on a single machine; a cluster must name one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    where = "file://" + tempfile.mkdtemp(prefix="folia-")
    spark.conf.set("spark.checkpoint.dir", where)
    return where


class Cuts:
    """Written generations of one iterative job."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.base = f"{shared_dir(spark)}/folia-{label}-{uuid.uuid4().hex}"
        self.count = 0

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Write ``df`` and read it back; returns the new frame and its path."""
        self.count += 1
        path = f"{self.base}/g{self.count}"
        schema = df.schema
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(schema).parquet(path), path

    def write_counted(self, df: DataFrame, where: str = "true") -> tuple[DataFrame, str, int]:
        """:meth:`write` with the number of written rows that meet a condition, counted while writing."""
        seen = Observation()
        out, path = self.write(df.observe(seen, F.count_if(F.expr(where)).alias("n")))
        return out, path, seen.get["n"]

    def release(self, *paths: str | None) -> None:
        """Delete generations that no later step reads."""
        jvm = self.spark._jvm
        for path in paths:
            if path:
                where = jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)
