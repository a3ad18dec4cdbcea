"""Review decisions as a stream: an extension, the batch form being operators.decisions.latest.

Each micro-batch of the log is merged into a table of latest decisions, written as a new version in the
shared folder, so that a lost executor or a restart finds the last complete one: versions are looked for in
the folder, not remembered, and one without its _SUCCESS mark does not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from derlem.operators.decisions import latest


class LatestDecisions:
    """The table of latest decisions below folder; version n holds all batches up to the n-th."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def versions(self) -> list[int]:
        """The complete versions in the folder, in order."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/v=*/_SUCCESS")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
        return sorted(int(f.getPath().getParent().getName().removeprefix("v=")) for f in found)

    def before(self, epoch: int | None = None) -> DataFrame:
        """The last complete version, or the last before an epoch."""
        known = [v for v in self.versions() if epoch is None or v < epoch]
        if not known:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path(known[-1]))

    def path(self, version: int) -> str:
        return f"{self.folder}/v={version:08d}"

    def current(self) -> DataFrame:
        return self.before()

    def merge(self, batch: DataFrame, epoch: int) -> None:
        """Idempotent: a batch that is replayed makes the same version again. Versions older than the one before go."""
        before = self.before(epoch)
        latest(before.unionByName(batch.select(*before.columns))).select(*before.columns).write.mode("overwrite").parquet(self.path(epoch))
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for v in [v for v in self.versions() if v < epoch][:-1]:
            old = fs.Path(self.path(v))
            old.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    def follow(self, log: DataFrame, checkpoint: str) -> StreamingQuery:
        return log.writeStream.foreachBatch(self.merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_counts(log: DataFrame, column: str = "islenme", delay: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Rows per window of event time, windows closing after the delay; later rows are dropped by the watermark."""
    return log.withWatermark(column, delay).groupBy(F.window(column, window)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("gun"), "n")
