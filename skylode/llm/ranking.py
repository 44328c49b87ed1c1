"""One ranking from several scores that differ in scale and distribution.

Each score becomes its empirical percentile, ties at their average, then the normal quantile of that, so
that every score has the same distribution; items are ordered by the weighted mean. Percentiles come from the
distinct values, which are sorted by range over all tasks and given their ranks from the sums of the
partitions before. A monotone change of any score's scale changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skylode.operators.order import positions  # noqa: F401  (the ranking's last step)
from skylode.session import cut

# Coefficients of the published rational approximations to the normal quantile (algorithm AS 241,
# double precision), numerators and denominators from the highest power down.
_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0),
)
_FLANK = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0),
)
_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0),
)


def normal_quantile(p: np.ndarray) -> np.ndarray:
    """The standard normal quantile of probabilities strictly between 0 and 1."""
    p = np.asarray(p, np.float64)
    q = p - 0.5
    r = 0.180625 - q * q
    middle = q * np.polyval(_CENTRE[0], r) / np.polyval(_CENTRE[1], r)
    s = np.sqrt(-np.log(np.minimum(p, 1 - p)))
    far = np.where(s <= 5, np.polyval(_FLANK[0], s - 1.6) / np.polyval(_FLANK[1], s - 1.6), np.polyval(_TAIL[0], s - 5) / np.polyval(_TAIL[1], s - 5))
    return np.where(np.abs(q) <= 0.425, middle, np.copysign(far, q))


@dataclass
class _Ranked:
    """Distinct values of each metric with their counts, in order, and what the metrics hold in all."""

    scores: DataFrame  # metric, value, c, z
    total: dict[int, int]
    distinct: dict[int, int]


def _ranked(values: DataFrame) -> _Ranked:
    counts = values.groupBy("metric", "value").agg(F.count(F.lit(1)).alias("c"))
    # checkpointed, so that a partition keeps its number and rows in the second pass
    ordered = cut(counts.repartitionByRange("metric", "value").sortWithinPartitions("metric", "value"))
    sums = ordered.groupBy(F.spark_partition_id().alias("part"), "metric").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d")).orderBy("metric", "part").collect()
    below: dict[tuple[int, int], int] = {}
    total: dict[int, int] = {}
    distinct: dict[int, int] = {}
    for r in sums:
        below[r.part, r.metric] = total.get(r.metric, 0)
        total[r.metric] = total.get(r.metric, 0) + r.n
        distinct[r.metric] = distinct.get(r.metric, 0) + r.d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        so_far: dict[int, int] = {}
        for b in batches:
            metric, c = b.column(0).to_numpy(), b.column(2).to_numpy()
            z = np.empty(len(c))
            for m in np.unique(metric).tolist():
                mine = metric == m
                start = so_far.get(m, below[part, m])
                upto = start + np.cumsum(c[mine])
                z[mine] = normal_quantile((upto - c[mine] / 2) / total[m])
                so_far[m] = int(upto[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(z)], ["metric", "value", "c", "z"])

    return _Ranked(ordered.mapInArrow(run, "metric int, value double, c bigint, z double"), total, distinct)


def normal_scores(values: DataFrame) -> DataFrame:
    """(metric, value, z) of each distinct value: the normal quantile of its average rank.

    ``values`` has metric int and value double, without NULL or NaN. With n values of a metric, a value that
    ``less`` are below and that ``c`` have gets the quantile of (less + c / 2) / n.
    """
    return _ranked(values).scores.select("metric", "value", "z")


def combined(df: DataFrame, key: str, scores: dict[str, Column | str], weights: dict[str, float] | None = None, carry: Sequence[str] = (), *, most_values: int = 1 << 18, hot_share: int = 1 << 12) -> DataFrame:
    """(key, carry, scores, rating) of each row: the weighted mean of its normal scores.

    ``scores`` gives each score's name and its Column, NULL where it is missing or invalid; NaN counts as
    missing. Missing scores are left out of the mean, whose weights are taken anew (equal by default); with none the
    rating is NULL. ``key`` is unique, ``carry`` are columns to keep. The sum is taken in a fixed order, so
    equal scores have equal ratings.

    A score with at most ``most_values`` distinct values (counted first) is looked up in a broadcast table of them, so rows
    don't move for it. For one with more, rows meet the ranks by a join on the value; values that more than one in ``hot_share`` rows
    have, of which there are fewer than ``hot_share``, are looked up like the others, so no task gets all rows of a frequent value.
    """
    names = list(scores)
    weights = weights or dict.fromkeys(names, 1.0)
    x = {n: F.expr(c).cast("double") if isinstance(c, str) else c.cast("double") for n, c in scores.items()}
    base = cut(df.select(F.col(f"`{key}`").alias("__key"), *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(carry)], *[F.when(~F.isnan(x[n]), x[n] + 0.0).alias(f"__s{i}") for i, n in enumerate(names)]))
    every = F.filter(F.array(*[F.struct(F.lit(i).alias("metric"), F.col(f"__s{i}").alias("value")) for i in range(len(names))]), lambda s: s.value.isNotNull())
    ranked = _ranked(base.select(F.explode(every).alias("e")).select("e.metric", "e.value"))
    many = sorted(m for m, d in ranked.distinct.items() if d > most_values)
    wanted = ~F.col("metric").isin(many)
    for m in many:
        wanted = wanted | ((F.col("metric") == m) & (F.col("c") > ranked.total[m] / hot_share))
    known = ranked.scores.where(wanted).select("metric", "value", "z").toArrow().sort_by([("metric", "ascending"), ("value", "ascending")])
    metric, value, z = (known.column(c).to_numpy() for c in ("metric", "value", "z"))
    ends = np.searchsorted(metric, np.arange(len(names) + 1))
    sent = base.sparkSession.sparkContext.broadcast([(value[i:j], z[i:j]) for i, j in zip(ends[:-1], ends[1:], strict=True)])
    width = len(base.columns) - len(names)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for i, (value, z) in enumerate(sent.value):
                v = b.column(width + i).to_numpy(zero_copy_only=False).astype(np.float64)
                at = np.minimum(np.searchsorted(value, v), max(0, len(value) - 1))
                hit = value[at] == v if len(value) else np.zeros(len(v), bool)
                found.append(pa.array(z[at] if len(value) else v, mask=~hit))
            yield pa.RecordBatch.from_arrays([*b.columns, *found], [*b.schema.names, *[f"__z{i}" for i in range(len(names))]])

    wide = base.mapInArrow(look_up, T.StructType([*base.schema.fields, *[T.StructField(f"__z{i}", T.DoubleType()) for i in range(len(names))]]))
    if many:
        wide = cut(wide)
    for m in many:
        open_ = F.col(f"__s{m}").isNotNull() & F.col(f"__z{m}").isNull()
        rest = ranked.scores.where(F.col("metric") == m).select(F.col("value").alias("__v"), F.col("z").alias("__zv"))
        met = wide.where(open_).join(rest, F.col(f"__s{m}") == F.col("__v")).withColumn(f"__z{m}", F.col("__zv")).drop("__v", "__zv")
        wide = wide.where(~open_).unionByName(met)
    over = sum((F.when(F.col(f"__z{i}").isNotNull(), F.lit(float(weights[n]))).otherwise(0.0) for i, n in enumerate(names)), F.lit(0.0))
    mean = sum((F.coalesce(F.col(f"__z{i}") * float(weights[n]), F.lit(0.0)) for i, n in enumerate(names)), F.lit(0.0)) / F.nullif(over, F.lit(0.0))
    return wide.select(F.col("__key").alias(key), *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)], *[F.col(f"__s{i}").alias(n) for i, n in enumerate(names)], mean.alias("rating"))
