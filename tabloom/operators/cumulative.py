"""Exact running totals over sorted values without a single-task window.

Rank statistics (two-sample distances, ROC and precision-recall curves) need totals that run
over *all* rows in value order. A window without ``partitionBy`` would pull every distinct
value into one task, so the work is cut up:

1. one pass finds approximate quantiles of every value column; they become bucket borders,
   fixed numbers from then on, so evaluating the plan twice gives the same buckets;
2. rows are summed per (series, bucket, value). Map-side combining shrinks hot values to one
   row per task before anything is shuffled;
3. running sums are taken inside each bucket, and every bucket is shifted by the total of the
   buckets below it.

The borders decide only how evenly the work is spread. The result is exact for any borders.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

MIN_BUCKETS = 16
MAX_BUCKETS = 4096
# Sketches of input partitions are first merged in this many groups.
MERGE_GROUPS = 1024
# Bucket totals have (buckets + 1) rows per series; up to this many rows they are broadcast.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Series:
    """A value column and the whole-number weights to be summed along it."""

    name: str
    value: Column | str
    weights: Mapping[str, Column] = field(default_factory=dict)


def bucket_count(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_BUCKETS, min(MAX_BUCKETS, 4 * partitions))


def sketch_size(buckets: int) -> int:
    return max(200, min(8192, 2 * buckets))


def finite_borders(partial: DataFrame, sketches: Sequence[str], buckets: int) -> list[list[float]]:
    """Borders from columns of partial sketches: at most ``buckets - 1`` numbers each reach the driver."""
    steps = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    merged = partial.agg(*[F.kll_merge_agg_double(c).alias(c) for c in sketches])
    # A sketch without any value has no quantiles to ask for.
    quantiles = merged.select(
        *[F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, steps)).alias(c) for c in sketches]
    ).first()
    borders = []
    for column in sketches:
        inner = sorted({q for q in quantiles[column] or [] if math.isfinite(q)}) or [0.0]
        borders.append([-math.inf, *inner, math.inf])
    return borders


def _borders(df: DataFrame, columns: Sequence[str], buckets: int) -> list[list[float]]:
    """Bucket borders per column, from one pass.

    Every task builds one small sketch per column. The sketches are merged in two steps, so that
    no task receives one from every input partition.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    partial = df.groupBy(group.alias("g")).agg(*[F.kll_sketch_agg_double(c, sketch_size(buckets)).alias(c) for c in columns])
    return finite_borders(partial, columns, buckets)


def cumulative_weights(
    df: DataFrame, series: Sequence[Series], buckets: int | None = None, borders: list[list[float]] | None = None
) -> DataFrame:
    """Running weight totals per series in ascending value order.

    Returns one row per series and distinct non-null value: ``series``, ``value`` and, for each
    weight ``w``, its sum at that value ``w``, the running sum up to and including it ``cum_w``
    and the grand total ``total_w``. NaN counts as the largest value. ``value`` is a double; long
    and decimal values that are one double but differ keep a row each, in their own order. Known
    ``borders``, one list per series, save the pass that looks for them.
    """
    weights = list(series[0].weights)
    if any(list(s.weights) != weights for s in series):
        raise ValueError("all series must carry the same weights")
    buckets = buckets or bucket_count(df)

    def as_column(value: Column | str) -> Column:
        return F.col(value) if isinstance(value, str) else value

    count = range(len(series))
    kinds = [f.dataType for f in df.select(*[as_column(s.value).alias(f"value_{i}") for i, s in enumerate(series)]).schema.fields]
    own = [isinstance(kind, (T.LongType, T.DecimalType)) for kind in kinds]
    # What tells values apart that are equal as doubles; only where a series can hold such values.
    tie = ["tie"] if any(own) else []
    ties = [as_column(s.value).try_cast("decimal(38,18)") if o else F.lit(None).cast("decimal(38,18)") for s, o in zip(series, own, strict=True)]
    prepared = df.select(
        *[t.alias(f"tie_{i}") for i, t in enumerate(ties) if tie],
        # Adding 0.0 turns -0.0 into 0.0, so both fall into one bucket.
        *[(as_column(s.value).cast("double") + F.lit(0.0)).alias(f"value_{i}") for i, s in enumerate(series)],
        *[w.cast("bigint").alias(f"{name}_{i}") for i, s in enumerate(series) for name, w in s.weights.items()],
    )
    bucketed = Bucketizer(
        splitsArray=borders or _borders(prepared, [f"value_{i}" for i in count], buckets),
        inputCols=[f"value_{i}" for i in count],
        outputCols=[f"bucket_{i}" for i in count],
        handleInvalid="keep",
    ).transform(prepared)

    rows = [
        F.struct(
            F.lit(s.name).alias("series"),
            F.col(f"bucket_{i}").cast("int").alias("bucket"),
            F.col(f"value_{i}").alias("value"),
            *[F.col(f"tie_{i}").alias(t) for t in tie],
            *[F.col(f"{name}_{i}").alias(name) for name in weights],
        )
        for i, s in enumerate(series)
    ]
    stacked = bucketed.select(F.inline(F.array(*rows))) if len(rows) > 1 else bucketed.select(rows[0].alias("r")).select("r.*")
    # The bucket test is implied by the value test. Spelled out, it makes both uses of ``counts``
    # below the same plan, so its shuffle is run once and reused.
    counts = (
        stacked.where(F.col("value").isNotNull() & F.col("bucket").isNotNull())
        .groupBy("series", "bucket", "value", *tie)
        .agg(*[F.sum(name).alias(name) for name in weights])
    )

    # At most buckets + 1 rows per series: small enough for a window over each series.
    by_series = Window.partitionBy("series")
    below = by_series.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counts.groupBy("series", "bucket")
        .agg(*[F.sum(name).alias(f"sum_{name}") for name in weights])
        .select(
            "series",
            "bucket",
            *[F.coalesce(F.sum(f"sum_{name}").over(below), F.lit(0)).alias(f"below_{name}") for name in weights],
            *[F.sum(f"sum_{name}").over(by_series).alias(f"total_{name}") for name in weights],
        )
    )

    within = Window.partitionBy("series", "bucket").orderBy("value", *tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = counts.select("*", *[F.sum(name).over(within).alias(f"run_{name}") for name in weights])
    if (buckets + 1) * len(series) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    # Beyond that the join runs on the keys the window is already partitioned by, so either way
    # the large side is not moved again.
    return running.join(offsets, ["series", "bucket"]).select(
        "series",
        "value",
        *weights,
        *[(F.col(f"below_{name}") + F.col(f"run_{name}")).alias(f"cum_{name}") for name in weights],
        *[F.col(f"total_{name}") for name in weights],
    )
