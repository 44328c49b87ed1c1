"""The current version of each row among repeats and older versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Types that an aggregation buffer holds in place, so that Spark hashes instead of sorting.
_FLAT = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz")


def current_rows(df: DataFrame, key: str, version: str, *columns: str) -> DataFrame:
    """One row (``key``, ``columns``) per key: the one with the greatest ``version``.

    Repeats of a key are reduced before the shuffle, so a key that holds a third of all rows costs no more
    than others. If all columns are of fixed width this is a hash aggregation; else a sort aggregation over
    one struct. Ties in ``version`` are meant to be exact repeats; where they aren't, columns that aren't
    all of fixed width come from the greatest row. A NULL version is older than any other. Rows whose key is
    NULL have no identity and are left out. No rows give no rows. Columns not named aren't read.
    """
    columns = tuple(dict.fromkeys(c for c in columns if c != key))
    kinds = dict(df.dtypes)
    rows = df.where(F.col(key).isNotNull())
    if columns and kinds[version].startswith("timestamp") and all(kinds[c] in _FLAT for c in columns):
        order = F.coalesce(F.col(version), F.lit("0001-01-01").cast(kinds[version]))
        return rows.groupBy(key).agg(*[F.max_by(c, order).alias(c) for c in columns])
    packed = F.max(F.struct(F.col(version).alias("v"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])).alias("r")
    got = rows.groupBy(key).agg(packed)
    return got.select(key, *[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)])
