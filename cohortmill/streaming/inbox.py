"""A curation inbox as a stream: arriving snapshots update when each label was first and last seen; and counts by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def label_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The finished versions of a state, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n) for n in names if n.isdigit() and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS")))


def latest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{versions(spark, folder)[-1]}")


def _forget(spark: SparkSession, folder: str, before: int) -> None:
    """Removes versions that nothing reads any more."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for n in versions(spark, folder):
        if n < before:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}"), True)


def keep_inbox(stream: DataFrame, key: list[str], week: str, state: str, checkpoint: str):
    """Every micro-batch folds into the inbox, written as a new version beside the last one; a replayed batch changes nothing, older versions go."""

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        now = batch.groupBy(*key).agg(F.min(week).alias("first_seen"), F.max(week).alias("last_seen"))
        held = [n for n in versions(spark, state) if n < epoch]
        if held:
            now = spark.read.parquet(f"{state}/{held[-1]}").unionByName(now).groupBy(*key).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
        now.write.mode("overwrite").parquet(f"{state}/{epoch}")
        _forget(spark, state, epoch - 1)

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, key: list[str], ids: list[str], width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by event-time window; rows later than the watermark are left out, repeated ids within it count once."""
    once = stream.withWatermark(time, late).dropDuplicatesWithinWatermark(ids)
    return once.groupBy(F.window(time, width), *key).agg(F.count("*").alias("n"))


def keep_totals(counts: DataFrame, state: str, checkpoint: str):
    """Every micro-batch's whole counts as a new version; older ones go."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/{epoch}")
        _forget(batch.sparkSession, state, epoch - 1)

    return counts.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
