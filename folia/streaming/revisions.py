"""Later revisions supersede earlier ones, as a stream and as a batch.

The stream keeps one row per key in a table of buckets by the key's hash. A micro-batch is reduced to its own
latest rows first and then merged with the buckets that it touches; only those are written again, as a new
generation. A batch that is run again after a failure writes the same generation again, so results do not
depend on retries; generations of a bucket behind the last two are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of the greatest ``order`` of every key."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(key, "_r.*")


class LatestTable:
    """The latest rows by bucket and generation, for ``foreachBatch``."""

    def __init__(self, spark: SparkSession, root: str, key: str, order: list[str], *, buckets: int = 64) -> None:
        self.spark, self.root, self.key, self.order, self.buckets = spark, root.rstrip("/"), key, order, buckets

    def _held(self) -> dict[int, list[int]]:
        """Bucket to the generations that it was written in, in order."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/g*/bucket=*")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path) or []
        held: dict[int, list[int]] = {}
        for status in found:
            where = status.getPath()
            held.setdefault(int(where.getName().partition("=")[2]), []).append(int(where.getParent().getName()[1:]))
        return {k: sorted(v) for k, v in held.items()}

    def _current(self, epoch: int, only: set[int] | None = None) -> list[str]:
        """Folders of the last generation up to ``epoch`` of every bucket."""
        last = {k: max((g for g in v if g <= epoch), default=None) for k, v in self._held().items() if only is None or k in only}
        return [f"{self.root}/g{g}/bucket={k}" for k, g in sorted(last.items()) if g is not None]

    def merge(self, batch: DataFrame, epoch: int) -> None:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        own = latest(batch, self.key, self.order)
        touched = {r.b for r in own.select(bucket.alias("b")).distinct().collect()}
        before = self._current(epoch - 1, touched)
        if before:
            own = latest(own.unionByName(self.spark.read.schema(own.schema).parquet(*before)), self.key, self.order)
        own.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/g{epoch}")
        self._sweep(epoch)

    def _sweep(self, epoch: int) -> None:
        """Delete what neither this epoch nor a second run of it reads."""
        for k, v in self._held().items():
            kept = max((g for g in v if g < epoch), default=None)
            for g in v:
                if kept is not None and g < kept:
                    path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/g{g}/bucket={k}")
                    path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, epoch: int, schema) -> DataFrame:
        """The table after an epoch, which must be one of the last two."""
        folders = self._current(epoch)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def follow(stream: DataFrame, target: LatestTable, checkpoint: str):
    """Start a query that keeps ``target`` current from a stream of revisions, one pass over what is there."""
    return stream.writeStream.foreachBatch(target.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, *, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) of events by time window; as a stream, later rows than ``late`` are left out."""
    source = events.withWatermark("ts", late) if events.isStreaming else events
    g = source.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("window.start").alias("start"), "event_type", "n", "total")
