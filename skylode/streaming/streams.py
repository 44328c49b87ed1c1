"""Streams: incremental queues, deduplicated ingest, tumbling speeds, sessions, latest states.

Every function takes a streaming DataFrame and gives one; the same code runs on a batch. Sources are files
(``trigger(availableNow=True)`` works off what is there and ends). State is bounded by watermarks where time closes a row: rows
later than that are dropped, in append and update mode. :func:`latest` keeps one row for each key for ever.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, pattern: str, schema: T.StructType, per_trigger: int = 1000) -> DataFrame:
    """Parquet files as they appear; a query's checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(pattern)


def work_off(df: DataFrame, target: str, checkpoint: str, mode: str = "append") -> None:
    """Writes what there is to do as Parquet, once each, then ends; a later call takes up what came since."""
    df.writeStream.outputMode(mode).format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def changed_files(scans: DataFrame, seen_at: str, late: str = "1 day") -> DataFrame:
    """Each (path, size_bytes, mtime) once, though scans list it again and again."""
    return scans.withWatermark(seen_at, late).dropDuplicatesWithinWatermark(["path", "size_bytes", "mtime"])


def tumbling_speeds(moves: DataFrame, time: str, key: str, speed: str, width: str = "1 second", late: str = "10 seconds") -> DataFrame:
    """(key, from_time, n, speed): mean speed of each window; complete windows come out once the watermark passes them."""
    w = F.window(F.col(time), width)
    return moves.withWatermark(time, late).groupBy(F.col(key), w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.avg(speed).alias("speed")).select(key, F.col("w.start").alias("from_time"), "n", "speed")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(key, from_time, to_time, n): runs of events no further apart than a gap."""
    s = F.session_window(F.col(time), gap)
    return events.withWatermark(time, late).groupBy(F.col(key), s.alias("s")).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("s.start").alias("from_time"), F.col("s.end").alias("to_time"), "n")


def latest(states: DataFrame, key: str, time: str, value: str) -> DataFrame:
    """(key, value, time): the state of each key with the latest time, for output mode update or complete."""
    return states.groupBy(key).agg(F.max_by(value, time).alias(value), F.max(time).alias(time))
