"""Kolmogorov-Smirnov distances of numeric columns, all columns and classes in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.kolmogorov import one_sample, two_sample
from tabloom.functions.normal import normal_cdf
from tabloom.operators.cumulative import Series, cumulative_weights
from tabloom.operators.overview import Overview, overview
from tabloom.operators.profile import pair_classes
from tabloom.roles import Roles


def class_counts(df: DataFrame, roles: Roles, buckets: int | None = None, borders: list[list[float]] | None = None) -> DataFrame:
    """Running row counts of both classes along every numeric column.

    ``(feature, value, n0, n1, cum_n0, cum_n1, total_n0, total_n1)``; rows of other classes and
    null values do not count. Every distance below is an aggregate of this table.
    """
    roles.require(df)
    present = df.where(F.col(roles.label).isin(*roles.classes))
    weights = {
        "n0": (F.col(roles.label) == F.lit(roles.negative)).cast("int"),
        "n1": (F.col(roles.label) == F.lit(roles.positive)).cast("int"),
    }
    series = [Series(c, c, weights) for c in roles.numeric]
    return cumulative_weights(present, series, buckets, borders).withColumnRenamed("series", "feature")


def _share(count: Column, total: Column) -> Column:
    return count / F.nullif(total, F.lit(0))


def _gap() -> Column:
    return F.abs(_share(F.col("cum_n0"), F.col("total_n0")) - _share(F.col("cum_n1"), F.col("total_n1")))


def ks_two_sample(counts: DataFrame) -> DataFrame:
    """``(feature, ks_statistic)``: largest gap between the two class distributions."""
    return counts.groupBy("feature").agg(F.max(_gap()).alias("ks_statistic"))


def ks_two_sample_test(counts: DataFrame) -> DataFrame:
    """``(feature, ks_statistic, n_0, n_1, p_value)``: the distance between the classes, their sizes,
    and the chance of such a distance if both had one distribution. The p-value is exact for small
    classes without ties and too large with ties; for large classes it is the limit. A class without values gives nulls."""
    found = counts.groupBy("feature").agg(F.max(_gap()).alias("ks_statistic"), *[F.max(f"total_n{i}").alias(f"n_{i}") for i in (0, 1)])
    sound = (F.col("n_0") > 0) & (F.col("n_1") > 0)
    p_value = F.when(sound, two_sample(F.col("ks_statistic"), F.col("n_0"), F.col("n_1")))
    return found.withColumn("p_value", p_value)


def _distances(counts: DataFrame, described: DataFrame, roles: Roles, fit: str) -> DataFrame:
    """``(feature, ks_0, ks_1, ks_between, n_0, n_1)`` from one pass over the running counts."""
    if fit not in ("class0", "own"):
        raise ValueError(f"fit must be 'class0' or 'own', not {fit!r}")
    moments = described.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("label") == name, F.col(statistic))).alias(f"{statistic}_{i}")
            for statistic in ("mean", "stddev")
            for i, name in enumerate(roles.class_names)
        ]
    )
    # Each distribution function is a column of its own: it is used twice and is not cheap.
    fits = (0,) if fit == "class0" else (0, 1)
    normals = {f"normal_{k}": normal_cdf(F.col("value"), F.col(f"mean_{k}"), F.col(f"stddev_{k}")) for k in fits}

    def distance(i: int) -> Column:
        normal = F.col(f"normal_{0 if fit == 'class0' else i}")
        upper = _share(F.col(f"cum_n{i}"), F.col(f"total_n{i}"))
        lower = _share(F.col(f"cum_n{i}") - F.col(f"n{i}"), F.col(f"total_n{i}"))
        # Values that only the other class has are no steps of this class's distribution.
        return F.when(F.col(f"n{i}") > 0, F.greatest(F.abs(upper - normal), F.abs(normal - lower)))

    # One row of moments per numeric column: its size is the width of the table.
    return (
        counts.join(F.broadcast(moments), "feature")
        .withColumns(normals)
        .groupBy("feature")
        .agg(
            *[F.max(distance(i)).alias(f"ks_{i}") for i in (0, 1)],
            F.max(_gap()).alias("ks_between"),
            *[F.max(f"total_n{i}").alias(f"n_{i}") for i in (0, 1)],
        )
    )


def ks_normal(counts: DataFrame, described: DataFrame, roles: Roles, fit: str = "class0") -> DataFrame:
    """``(feature, label, ks_statistic, p_value)``: distance of each class from a normal.

    ``fit="class0"`` compares both classes with the normal that has the mean and standard
    deviation of the negative class; ``fit="own"`` gives every class its own. A class without
    spread gets a null statistic. The p-value is exact below 100 values and the limit beyond, both
    for a normal that is not fitted to the same values.
    """
    rows = [
        F.struct(
            F.lit(name).alias("label"),
            F.col(f"ks_{i}").alias("ks_statistic"),
            F.when(F.col(f"ks_{i}").isNotNull(), one_sample(F.col(f"ks_{i}"), F.col(f"n_{i}"))).alias("p_value"),
        )
        for i, name in enumerate(roles.class_names)
    ]
    return _distances(counts, described, roles, fit).select("feature", F.inline(F.array(*rows)))


def numeric_report(df: DataFrame, roles: Roles, fit: str = "class0", buckets: int | None = None, seen: Overview | None = None) -> DataFrame:
    """``(feature, statistic, class_0, class_1)`` for every numeric column.

    The five describe statistics, the distance of each class from a normal (``ks_normal``) and
    the distance between the classes (``ks_two_sample``, the same in both columns). Two scans: one
    for statistics and bucket borders together, unless an overview is given, and one for the counts.
    """
    seen = seen or overview(df, roles, buckets)
    described = seen.described()
    rows = [
        F.struct(F.lit(name).alias("statistic"), F.col(a).alias("class_0"), F.col(b).alias("class_1"))
        for name, a, b in (("ks_normal", "ks_0", "ks_1"), ("ks_two_sample", "ks_between", "ks_between"))
    ]
    counts = class_counts(df, roles, seen.buckets, seen.borders())
    distances = _distances(counts, described, roles, fit).select("feature", F.inline(F.array(*rows)))
    return pair_classes(described, roles).unionByName(distances)
