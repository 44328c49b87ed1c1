"""Enough tasks for stages whose cost is in Python, not in bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    A small compressed table may be read as one or two partitions. Only then are its rows dealt out anew; a table whose
    files are as many as the cores, or larger, isn't shuffled for that. What the plan reads is told from its files' number and
    Spark's estimate of their bytes, so nothing runs before the query does.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(plan.stats().sizeInBytes())
    wide = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    return df if len(df.inputFiles()) >= cores or size >= cores * wide else df.repartition(2 * cores)
