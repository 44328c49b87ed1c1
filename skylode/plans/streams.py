"""Streaming queries over the events table, run to their end on the files that are there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.session import cut, ensure_checkpoint_dir
from skylode.streaming import streams


def _events(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    # a file source takes a folder or pattern; the pattern matches the one file or folder
    return streams.file_stream(spark, f"{path}*", schema).withColumn("at", F.timestamp_seconds(F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01', ts)")))


def _worked_off(spark: SparkSession, df: DataFrame, *keys: str) -> DataFrame:
    """Result of a stream in update mode: a batch writes only the rows that it changed, and of each key the last batch's row counts.

    The stream's folder lies where the executors share one, and goes once its result is cut from it.
    """
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        # a batch that runs again after a failure replaces what it wrote
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    values = [c for c in df.columns if c not in keys]
    got = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{base}/out")
    last = got.groupBy(*keys).agg(F.max(F.struct("batch", *values)).alias("r")).select(*keys, *[f"r.{c}" for c in values])
    return _kept(spark, last, base)


def _kept(spark: SparkSession, df: DataFrame, base: str) -> DataFrame:
    """``df`` cut from the folder it reads, which is then removed."""
    out = cut(df)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return out


def _complete(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Result of a stream in complete mode: for sessions, which Spark doesn't update and which end only when later events come."""
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out")

    df.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return _kept(spark, spark.read.parquet(f"{base}/out"), base)


def t03_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Mean value of each user and hour."""
    got = _worked_off(spark, streams.tumbling_speeds(_events(spark, folder), "at", "user_id", "value", "1 hour", "2 days"), "user_id", "from_time")
    return got.select("user_id", F.unix_seconds("from_time").alias("from_s"), "n", (F.floor(F.col("speed") * 1e6 + 0.5) / 1e6).alias("speed"))


def t04_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of a user's events at most 6 hours apart."""
    got = _complete(spark, streams.sessions(_events(spark, folder), "at", "user_id", "6 hours", "2 days"))
    return got.select("user_id", F.unix_seconds("from_time").alias("from_s"), "n")


def t06_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's latest event."""
    e = _events(spark, folder).withColumn("order", F.struct("ts", "event_id"))
    return _worked_off(spark, streams.latest(e, "user_id", "order", "event_type"), "user_id").select("user_id", "event_type")


QUERIES = {f.__name__: f for f in (t03_hourly, t04_sessions, t06_latest)}
SQL = {
    "t03_hourly": "SELECT user_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS from_s, count(*) AS n, floor(avg(value) * 1e6 + 0.5) / 1e6 AS speed FROM events GROUP BY 1, 2",
    "t04_sessions": """WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
        n AS (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY user_id ORDER BY s) < 21600 THEN 0 ELSE 1 END AS fresh FROM e),
        g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM n)
        SELECT user_id, min(s) AS from_s, count(*) AS n FROM g GROUP BY user_id, k""",
    "t06_latest": "SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS v WHERE rn = 1",
}
