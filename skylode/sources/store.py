"""Snapshots of tables, and changes to them as joins.

Parquet files aren't changed in place: every change makes a new snapshot folder, and a pointer file that is
replaced in one step names the current one, so readers see the old rows or the new ones, never both.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.operators.order import places_in_group

SCHEMA_VERSION = 8


class SnapshotStore:
    """Tables under one folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointer(self, table: str):
        return self._path(f"{self.folder}/{table}/CURRENT")

    def current(self, table: str) -> str | None:
        """Name of the current snapshot, None before the first."""
        if not self._fs.exists(self._pointer(table)):
            return None
        stream = self._fs.open(self._pointer(table))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def version(self, table: str) -> int | None:
        """The version of the schema that the current snapshot was written in; None before the first snapshot."""
        name = self.current(table)
        return None if name is None else int(name.removeprefix("v").split("-")[0])

    def migrate(self, table: str, schema: T.StructType) -> bool:
        """Writes a table of an older version anew in ``schema`` and stamps it; nothing to do for a current one or none at all."""
        have = self.version(table)
        if have is None or have >= SCHEMA_VERSION:
            return False
        self.write(table, conform(self.read(table), schema))
        return True

    def read(self, table: str) -> DataFrame:
        name = self.current(table)
        if name is None:
            raise FileNotFoundError(f"{table} has no snapshot in {self.folder}")
        return self.spark.read.parquet(f"{self.folder}/{table}/{name}")

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), version: int = SCHEMA_VERSION) -> str:
        """Writes a snapshot in a version of the schema and makes it the current one; a failed write changes nothing."""
        name = f"v{version}-{uuid.uuid4().hex}"
        w = df.write.option("compression", "zstd")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{self.folder}/{table}/{name}")
        fresh = self._path(f"{self.folder}/{table}/.CURRENT-{name}")
        out = self._fs.create(fresh, True)
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fresh, self._pointer(table), options)
        return name


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in a newer schema: missing columns as NULL, types cast, columns it doesn't name kept at the end."""
    have = set(df.columns)
    named = [(F.col(f"`{f.name}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    return df.select(*named, *[F.col(f"`{c}`") for c in df.columns if c not in set(schema.fieldNames())])


def upsert(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Rows of ``base`` with the columns that ``changes`` supplies, and its new rows.

    Columns that ``changes`` lacks keep their values (NULL in new rows); supplied NULLs overwrite. ``key`` is
    unique in both; NULL keys match nothing.
    """
    given = set(changes.columns)
    j = base.alias("b").join(changes.alias("c"), F.col(f"b.{key}") == F.col(f"c.{key}"), "full")
    there = F.col(f"c.{key}").isNotNull()

    def column(c: str) -> Column:
        if c == key:
            return F.coalesce(F.col(f"c.{key}"), F.col(f"b.{key}")).alias(key)
        return (F.when(there, F.col(f"c.`{c}`")).otherwise(F.col(f"b.`{c}`")) if c in given else F.col(f"b.`{c}`")).alias(c)

    return j.select(*[column(c) for c in base.columns], *[F.col(f"c.`{c}`") for c in changes.columns if c not in base.columns])


def patch(base: DataFrame, changes: DataFrame, key: str, flags: Mapping[str, str]) -> DataFrame:
    """``base`` with the columns named in ``flags`` replaced where the change's flag column is true, also by NULL.

    Keys that ``base`` lacks add nothing; rows without a change stay.
    """
    c = changes.select(F.col(key).alias("__k"), *[F.col(f"`{n}`").alias(f"__v_{n}") for n in flags], *[F.col(f"`{f}`").alias(f"__f_{n}") for n, f in flags.items()])
    j = base.join(c, F.col(key) == F.col("__k"), "left")
    return j.select(*[F.when(F.coalesce(F.col(f"__f_{n}"), F.lit(False)), F.col(f"__v_{n}")).otherwise(F.col(f"`{n}`")).alias(n) if n in flags else F.col(f"`{n}`") for n in base.columns])


def number_segments(segments: DataFrame, source: str, order: str, *, most: int = 1 << 20) -> DataFrame:
    """``segments`` with shot_index (from 0 in order) and continuous_move (1 if it is its source's only one).

    A source with more than ``most`` segments is sorted over all tasks (see :func:`skylode.operators.order.places_in_group`).
    """
    placed = places_in_group(segments, source, order, "shot_index", "__size", most=most)
    return placed.withColumn("continuous_move", (F.col("__size") == 1).cast("int")).drop("__size")


def replace_children(base: DataFrame, fresh: DataFrame, source: str, order: str) -> DataFrame:
    """``base`` with all rows of the sources in ``fresh`` replaced by its rows, numbered anew; other columns are NULL there."""
    numbered = number_segments(fresh, source, order)
    kept = base.join(fresh.select(source).distinct(), source, "left_anti")
    return kept.unionByName(numbered, allowMissingColumns=True)


def without_orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent is still there."""
    return children.join(parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_semi")


def ingest_plan(scan: DataFrame, known: DataFrame) -> DataFrame:
    """(path, status): added, updated or skipped for each scanned file (path, size_bytes, mtime).

    A file is skipped if it is known with the same size, a modification time within a microsecond, and a duration.
    """
    k = known.select(F.col("path").alias("__p"), F.col("size_bytes").alias("__s"), F.col("mtime").alias("__m"), F.col("duration").alias("__d"))
    same = (F.col("size_bytes") == F.col("__s")) & (F.abs(F.col("mtime") - F.col("__m")) < 1e-6) & F.col("__d").isNotNull()
    status = F.when(F.col("__p").isNull(), "added").when(F.coalesce(same, F.lit(False)), "skipped").otherwise("updated")
    return scan.join(k, F.col("path") == F.col("__p"), "left").select("path", status.alias("status"))


def violations(rows: DataFrame, rules: Mapping[str, Column], key: str) -> DataFrame:
    """(key, rule) for each rule that a row breaks; a rule that is NULL isn't broken."""
    broken = F.filter(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]), lambda x: x.isNotNull())
    return rows.select(key, F.explode(broken).alias("rule"))


def repeated(rows: DataFrame, *key: str) -> DataFrame:
    """(key, n) of keys that aren't unique."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
