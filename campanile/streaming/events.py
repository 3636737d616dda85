"""Event-time windows, incremental recomputing and processing-time timeouts.

Each works on a static DataFrame as on a stream; watermarks only matter on a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str, by: str = "event_type", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Count and sum of value in each window and group."""
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = marked.groupBy(window.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A row for each user's run of events without a longer gap."""
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = marked.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def outdated(sources: DataFrame, cache: DataFrame, key: str = "path") -> DataFrame:
    """Sources without a cached result that is as new as they are: only these are computed again."""
    fresh = cache.select(F.col(key).alias("_key"), F.col("source_mtime").alias("_at"))
    return sources.join(fresh, (F.col(key) == F.col("_key")) & (F.col("_at") >= F.col("mtime")), "left_anti")


def silent(signals: DataFrame, now: Column, hours: float, key: str = "job_dir") -> DataFrame:
    """Jobs whose last signal is older than so many hours: code -2."""
    last = signals.groupBy(key).agg(F.max("ts").alias("last"))
    return last.select(key, "last", F.when(F.unix_timestamp("last") < F.unix_timestamp(now) - int(hours * 3600), -2).otherwise(0).alias("code"))


def read_events(spark: SparkSession, folder: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """A stream of Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def each_batch(stream: DataFrame, apply: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Applies a plan to each micro-batch. A batch has a folder of its own that a retry overwrites, so nothing is written twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Buffered:
    """Outcomes of running jobs as a stream, applied so many at a time.

    Each micro-batch is kept as it came in ``out/pending/batch=N``; once ``every`` rows or more wait, the plan is applied to all of them and written to
    ``out/flushed/upto=N``. What has been flushed follows from those folders' names, so a batch that is run again after a failure finds its rows and
    replaces what it had written: nothing is lost, and nothing is applied twice.
    """

    def __init__(self, spark: SparkSession, out: str, apply: Callable[[DataFrame], DataFrame], every: int = 10) -> None:
        self.spark, self.out, self.apply, self.every = spark, out.rstrip("/"), apply, every

    def _numbers(self, kind: str, name: str) -> list[int]:
        jvm = self.spark._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.out}/{kind}/{name}=*/_SUCCESS")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def _flush(self, upto: int, least: int) -> bool:
        done = max((n for n in self._numbers("flushed", "upto") if n < upto), default=-1)
        waiting = [n for n in self._numbers("pending", "batch") if done < n <= upto]
        if not waiting:
            return False
        rows = self.spark.read.parquet(*[f"{self.out}/pending/batch={n}" for n in waiting])
        if rows.count() < least:
            return False
        self.apply(rows).write.mode("overwrite").parquet(f"{self.out}/flushed/upto={upto}")
        return True

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.out}/pending/batch={batch_id}")
        self._flush(batch_id, self.every)

    def finish(self) -> bool:
        """Applies what still waits, however little; whether there was anything."""
        waiting = self._numbers("pending", "batch")
        return bool(waiting) and waiting[-1] not in self._numbers("flushed", "upto") and self._flush(waiting[-1], 1)

    def start(self, stream: DataFrame, checkpoint: str, window: str | None = None):
        """The query; window: a trigger's interval for a stream that goes on, else all that is there now."""
        writer = stream.writeStream.foreachBatch(self.write).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=window) if window else writer.trigger(availableNow=True)).start()
