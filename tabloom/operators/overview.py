"""One pass that feeds every profile report: counts, moments, ranges and sketches together.

The pass groups by class and by a number of the input partition. A group's row holds exact counts,
mean and squared deviations, the least and greatest value, the range of finite values and a mergeable
quantile sketch of every numeric column. There are at most a few thousand such rows, whatever the input; they are
stored, and reports merge them: deviations by the parallel formula, so nothing cancels, and sketches in
a second step, so no task receives one from every input partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.operators.cumulative import MERGE_GROUPS, bucket_count, finite_borders, sketch_size
from tabloom.roles import Roles
from tabloom.sources.shared import stored

NEGATIVE, POSITIVE, OTHER = 0, 1, 2


def class_code(roles: Roles) -> Column:
    """0 and 1 for the two target values, 2 for any other and for null."""
    label = F.col(f"`{roles.label}`")
    return F.when(label == F.lit(roles.negative), NEGATIVE).when(label == F.lit(roles.positive), POSITIVE).otherwise(OTHER)


def finite(column: str) -> Column:
    """The value as a double, null where it is infinite or not a number."""
    value = F.col(f"`{column}`").cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


@dataclass(frozen=True)
class Overview:
    """What one pass over a table found; ``groups`` is the stored table of partial results."""

    groups: DataFrame
    roles: Roles
    buckets: int

    @property
    def columns(self) -> Sequence[str]:
        return self.roles.numeric

    def row_count(self) -> DataFrame:
        """``n_rows``, the same as counting the table."""
        return self.groups.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"))

    def described(self) -> DataFrame:
        """The rows of ``profile.describe_by_class``."""
        per_class = Window.partitionBy("code")
        parts = self.groups.where(F.col("code") != OTHER)
        centre = {i: F.sum(F.col(f"n_{i}") * F.col(f"mean_{i}")).over(per_class) / F.nullif(F.sum(f"n_{i}").over(per_class), F.lit(0)) for i in range(len(self.columns))}
        centred = parts.select("*", *[c.alias(f"centre_{i}") for i, c in centre.items()])
        aggregates = []
        for i in centre:
            n, off = F.col(f"n_{i}"), F.col(f"mean_{i}") - F.col(f"centre_{i}")
            squares = F.sum(F.col(f"squares_{i}") + n * off * off)
            aggregates += [
                F.sum(n).alias(f"count_{i}"),
                F.max(f"centre_{i}").alias(f"mean_{i}"),
                F.when(F.sum(n) > 1, F.sqrt(squares / (F.sum(n) - 1))).alias(f"stddev_{i}"),
                F.min(f"min_{i}").alias(f"min_{i}"),
                F.max(f"max_{i}").alias(f"max_{i}"),
            ]
        wide = centred.groupBy("code").agg(*aggregates)
        name = F.when(F.col("code") == NEGATIVE, self.roles.class_names[0]).otherwise(self.roles.class_names[1])
        rows = [
            F.struct(
                F.lit(c).alias("feature"),
                name.alias("label"),
                *[F.col(f"{s}_{i}").alias(s) for s in ("count", "mean", "stddev", "min", "max")],
            )
            for i, c in enumerate(self.columns)
        ]
        return wide.select(F.inline(F.array(*rows)))

    def finite_ranges(self) -> dict[str, tuple[float | None, float | None]]:
        """Least and greatest finite value of every numeric column over the two classes."""
        of_classes = self.groups.where(F.col("code") != OTHER)
        row = of_classes.agg(*[f(f"{name}_{i}").alias(f"{name}_{i}") for i in range(len(self.columns)) for name, f in (("low", F.min), ("high", F.max))]).first()
        return {c: (row[f"low_{i}"], row[f"high_{i}"]) for i, c in enumerate(self.columns)}

    def borders(self) -> list[list[float]]:
        """Bucket borders of every numeric column over the two classes, for ``cumulative_weights``."""
        names = [f"sketch_{i}" for i in range(len(self.columns))]
        return finite_borders(self.groups.where(F.col("code") != OTHER), names, self.buckets)


def overview(df: DataFrame, roles: Roles, buckets: int | None = None) -> Overview:
    """Scan ``df`` once, for the label and the numeric columns of ``roles``."""
    roles.require(df)
    buckets = buckets or bucket_count(df)
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, column in enumerate(roles.numeric):
        value = F.col(f"v_{i}")
        within = F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)
        aggregates += [
            F.count(value).alias(f"n_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            (F.var_pop(value) * F.count(value)).alias(f"squares_{i}"),
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
            F.min(within).alias(f"low_{i}"),
            F.max(within).alias(f"high_{i}"),
            F.kll_sketch_agg_double(value, sketch_size(buckets)).alias(f"sketch_{i}"),
        ]
    # Adding 0.0 turns -0.0 into 0.0, as running totals do.
    values = [(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(f"v_{i}") for i, c in enumerate(roles.numeric)]
    grouped = df.select(class_code(roles).alias("code"), *values).groupBy("code", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part"))
    return Overview(stored(grouped.agg(*aggregates), "overview"), roles, buckets)
