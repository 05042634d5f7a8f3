"""Incremental runs: a stream of daily rows upserted into rolling stores, and windowed aggregates of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.operators.store import upsert_rolloff


def rolling_store(stream: DataFrame, path: str, checkpoint: str, key: list[str], keep_last: int) -> StreamingQuery:
    """Each micro-batch overrides the store's rows with its key, of several rows with one key the last in the batch's order; the last
    keep_last values of the first key column stay. Versions are written side by side and the newest complete one is read, so a batch
    that is run again gives the same store; of older versions one stays for readers."""

    def upsert(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old = read_store(spark, path, before=number)
        new = batch.withColumn("arrival", F.monotonically_increasing_id())
        rows = upsert_rolloff(batch.limit(0) if old is None else old, new, key, keep_last, order=["arrival"]).drop("arrival")
        rows.write.mode("overwrite").parquet(f"{path}/version={number:012d}")
        _drop_versions(spark, path, number)

    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _drop_versions(spark: SparkSession, path: str, number: int, stay: int = 2) -> None:
    """Deletes all versions up to `number` but the newest `stay`."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(root)) if n.startswith("version=") and int(n.partition("=")[2]) <= number)
    for name in names[:-stay]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)


def read_store(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The newest complete version, or None."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))
    names = [n for n in names if n.startswith("version=") and (before is None or int(n.partition("=")[2]) < before)]
    return spark.read.parquet(f"{path}/{names[-1]}") if names else None


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums by window and type; on a stream, rows later than `late` are left out."""
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    e = events.withWatermark("ts", late) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")
