"""Streams: an inbox of record files, duplicates within a watermark, error windows, breaker streaks, sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_inbox(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "csv", max_files: int = 100) -> DataFrame:
    """Files of a folder as a stream; all-string CSV with quoted line breaks, or parquet or JSON."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.load(path)


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "1 hour") -> DataFrame:
    """Rows whose key is new within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def run_batches(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True):
    """Feeds micro-batches to a sink; the checkpoint makes a rerun go on where the last one stopped."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if once else writer.start()


def error_windows(events: DataFrame, time: str, failed: Column, width: str = "1 hour", delay: str | None = None) -> DataFrame:
    """(window_start, n, errors, error_rate) of tumbling windows, for a batch or (with a delay) a stream."""
    e = events.withWatermark(time, delay) if delay else events
    g = e.groupBy(F.window(time, width)).agg(F.count("*").alias("n"), F.count(F.when(failed, 1)).alias("errors"))
    return g.select(F.col("window.start").alias("window_start"), "n", "errors", (F.col("errors") / F.col("n")).alias("error_rate"))


def rolling_breaker(events: DataFrame, by: str, order: list[str], failed: Column, size: int = 10, rate: float = 0.8, streak: int = 5) -> DataFrame:
    """Adds fails (in the last `size`), streak and tripped: a run of failures, or a full window of too many."""
    w = Window.partitionBy(by).orderBy(*order)
    f = failed.cast("int")
    e = events.withColumn("fails", F.sum(f).over(w.rowsBetween(-(size - 1), 0))).withColumn("seen", F.count("*").over(w.rowsBetween(-(size - 1), 0)))
    e = e.withColumn("_ok", F.sum(1 - f).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    e = e.withColumn("streak", F.sum(f).over(Window.partitionBy(by, "_ok").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    return e.withColumn("tripped", (F.col("streak") >= streak) | ((F.col("seen") == size) & (F.col("fails") >= rate * size))).drop("_ok", "seen")


def longest_streaks(events: DataFrame, by: str, order: list[str], failed: Column) -> DataFrame:
    """(by, longest): the longest run of failures of each group."""
    w = Window.partitionBy(by).orderBy(*order)
    e = events.withColumn("_f", failed.cast("int")).withColumn("_ok", F.sum(1 - F.col("_f")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy(by, "_ok").agg(F.sum("_f").alias("n")).groupBy(by).agg(F.max("n").alias("longest"))


def sessions(events: DataFrame, by: str, time: str, gap: str = "30 minutes") -> DataFrame:
    """(by, session_start, n): sessions that end after a gap without events."""
    return events.groupBy(F.col(by), F.session_window(F.col(time), gap)).agg(F.count("*").alias("n")).select(by, F.col("session_window.start").alias("session_start"), "n")
