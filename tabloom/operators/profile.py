"""Data profiling against a binary target, one pass over the data per report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.operators.overview import OTHER, class_code, finite
from tabloom.roles import Roles
from tabloom.sources.shared import stored

STATISTICS = ("count", "mean", "stddev", "min", "max")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def schema_table(df: DataFrame) -> DataFrame:
    """``(position, column, type, nullable)``, one row per column."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def first_rows(df: DataFrame, n: int = 5, order_by: Sequence[Column | str] = ()) -> DataFrame:
    """The first ``n`` rows; which ones is only defined when an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def register_view(df: DataFrame, name: str) -> str:
    """Make ``df`` available to ``spark.sql`` under ``name``."""
    df.createOrReplaceTempView(name)
    return name


def of_class(df: DataFrame, label: str, value: object) -> DataFrame:
    return df.where(F.col(label) == F.lit(value))


def column_mean(df: DataFrame, column: str, alias: str) -> DataFrame:
    return df.agg(F.avg(column).alias(alias))


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, min, max)`` of every numeric column from one aggregate."""
    bounds = df.agg(*[f(c).cast("double").alias(f"{name}_{i}") for i, c in enumerate(columns) for name, f in (("min", F.min), ("max", F.max))])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"min_{i}").alias("min"), F.col(f"max_{i}").alias("max")) for i, c in enumerate(columns)]
    return bounds.select(F.inline(F.array(*rows)))


def _long_categories(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        list(keep), list(columns), "feature", "value"
    )


def crosstab(df: DataFrame, roles: Roles) -> DataFrame:
    """``(feature, value, label, n)`` for all categorical columns at once.

    The rows are summed per task before the shuffle, so what travels grows with the number of
    categories and not with the number of rows. Null categories and labels are kept.
    """
    roles.require(df)
    long = _long_categories(df.withColumn("label", F.col(roles.label).cast("string")), roles.categorical, ["label"])
    return long.groupBy("feature", "value", "label").agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, roles: Roles) -> DataFrame:
    """``(feature, value, n_negative, n_positive, n_other, n_null)``: rows by target value; the
    four counts sum up to all rows."""
    roles.require(df)
    label = F.col("label")
    return (
        _long_categories(df.withColumn("label", F.col(roles.label)), roles.categorical, ["label"])
        .groupBy("feature", "value")
        .agg(
            F.count_if(label == F.lit(roles.negative)).alias("n_negative"),
            F.count_if(label == F.lit(roles.positive)).alias("n_positive"),
            F.count_if(~label.isin(*roles.classes)).alias("n_other"),
            F.count_if(label.isNull()).alias("n_null"),
        )
    )


def crosstab_by_label(df: DataFrame, roles: Roles, max_labels: int = 1000) -> DataFrame:
    """``(feature, value, n_<label>, ...)``: one count column for every target value there is, whatever
    the two named ones are, in order of the values; rows without a target value count in ``n_null``.

    One scan: the long table is stored, its target values become the columns. More than ``max_labels``
    of them are an error, and so are a null and a value ``null`` side by side."""
    long = stored(crosstab(df, roles), "crosstab")
    labels = [r["label"] for r in long.select("label").distinct().limit(max_labels + 1).collect()]
    if len(labels) > max_labels:
        raise ValueError(f"more than {max_labels} target values in {roles.label}")
    if None in labels and "null" in labels:
        raise ValueError(f"{roles.label} holds nulls and the value 'null'")
    names = sorted("null" if label is None else label for label in labels)
    named = long.withColumn("label", F.coalesce("label", F.lit("null")))
    wide = named.groupBy("feature", "value").pivot("label", names).agg(F.sum("n"))
    return wide.select("feature", "value", *[F.coalesce(F.col(f"`{name}`"), F.lit(0)).alias(f"n_{name}") for name in names])


def describe_by_class(df: DataFrame, roles: Roles) -> DataFrame:
    """``(feature, label, count, mean, stddev, min, max)`` of every numeric column and class.

    One aggregate computes all columns side by side, so each input row is touched once and only
    one row per class and task is shuffled; the small result is then turned into long form.
    """
    roles.require(df)
    parts = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = (
        df.where(F.col(roles.label).isin(*roles.classes))
        .groupBy(F.col(roles.label).cast("string").alias("label"))
        .agg(*[f(F.col(c).cast("double")).alias(f"{name}_{i}") for i, c in enumerate(roles.numeric) for name, f in parts.items()])
    )
    rows = [
        F.struct(F.lit(c).alias("feature"), "label", *[F.col(f"{name}_{i}").alias(name) for name in parts])
        for i, c in enumerate(roles.numeric)
    ]
    return wide.select(F.inline(F.array(*rows)))


def describe_long(described: DataFrame) -> DataFrame:
    """``(feature, label, statistic, value)`` from ``describe_by_class``, all values double."""
    doubles = described.select("feature", "label", *[F.col(s).cast("double").alias(s) for s in STATISTICS])
    return doubles.unpivot(["feature", "label"], list(STATISTICS), "statistic", "value")


def pair_classes(described: DataFrame, roles: Roles) -> DataFrame:
    """``(feature, statistic, class_0, class_1)``: the statistics of both classes side by side."""
    sides = [F.max(F.when(F.col("label") == name, F.col("value"))).alias(f"class_{i}") for i, name in enumerate(roles.class_names)]
    return describe_long(described).groupBy("feature", "statistic").agg(*sides)


def describe_column(df: DataFrame, column: str, roles: Roles) -> DataFrame:
    """``(Statistic, <column>_<label>_<negative>, <column>_<label>_<positive>)`` for one column."""
    one = Roles(roles.label, roles.negative, roles.positive, numeric=(column,))
    names = [f"{column}_{roles.label}_{value}" for value in roles.class_names]
    return pair_classes(describe_by_class(df, one), one).drop("feature").toDF("Statistic", *names)


def join_class_statistics(left: DataFrame, right: DataFrame, on: str = "statistic") -> DataFrame:
    """Inner join of two statistic tables on the statistic name, which is kept once."""
    return left.join(right, on, "inner")


def _bin_of(column: str, limits: tuple[float | None, float | None], bins: int) -> Column:
    """Bin 1..bins of a value; 0, bins + 1 and bins + 2 for the infinities and NaN."""
    lower, upper = limits
    value = F.col(f"`{column}`").cast("double")
    if lower is None or lower == upper:
        place = F.lit(1)
    else:
        place = F.least(F.width_bucket(finite(column), F.lit(lower), F.lit(upper), F.lit(bins)), F.lit(bins)).cast("int")
    infinity = F.lit(float("inf"))
    beyond = F.when(F.isnan(value), F.lit(bins + 2)).when(value == infinity, F.lit(bins + 1)).when(value == -infinity, F.lit(0))
    return F.when(value.isNotNull(), F.coalesce(beyond, place))


def _with_limits(counts: DataFrame, ranges: dict[str, tuple[float | None, float | None]], bins: int) -> DataFrame:
    """``(feature, label, bin, lower, upper, n)`` from counts per bin."""
    known = {c: r for c, r in ranges.items() if r[0] is not None}
    if not known:
        raise ValueError("none of the numeric columns has a value")
    lowest = F.create_map(*[part for c, r in known.items() for part in (F.lit(c), F.lit(r[0]))])
    width = F.create_map(*[part for c, r in known.items() for part in (F.lit(c), F.lit((r[1] - r[0]) / bins))])
    inside = (F.col("bin") >= 1) & (F.col("bin") <= bins)
    lower = F.when(inside, lowest[F.col("feature")] + width[F.col("feature")] * (F.col("bin") - 1))
    return counts.select("feature", "label", "bin", lower.alias("lower"), (lower + width[F.col("feature")]).alias("upper"), "n")


def histogram(df: DataFrame, roles: Roles, bins: int = 10) -> DataFrame:
    """``(feature, label, bin, lower, upper, n)``: equal-width bins, 1..bins, per numeric column and class.

    The range of each column is found first, by one aggregate that returns a single row. The top
    of the range belongs to the last bin. A column with one value has only bin 1; nulls are left out.
    The range covers finite values: negative infinity counts in bin 0, infinity in bin ``bins + 1``
    and NaN in bin ``bins + 2``, whose borders are null.
    """
    roles.require(df)
    present = df.where(F.col(roles.label).isin(*roles.classes))
    only = present.select(*[finite(c).alias(c) for c in roles.numeric])
    ranges = {r["feature"]: (r["min"], r["max"]) for r in column_ranges(only, roles.numeric).collect()}
    binned = present.select(F.col(roles.label).cast("string").alias("label"), *[_bin_of(c, ranges[c], bins).alias(c) for c in roles.numeric])
    counts = (
        binned.unpivot(["label"], list(roles.numeric), "feature", "bin")
        .where(F.col("bin").isNotNull())
        .groupBy("feature", "label", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _with_limits(counts, ranges, bins)


def counted(df: DataFrame, roles: Roles, ranges: dict[str, tuple[float | None, float | None]], bins: int = 10) -> tuple[DataFrame, DataFrame]:
    """The rows of ``crosstab`` and of ``histogram`` from one scan: categories and bins are counted by
    the same aggregate, whose result, one row per category or bin and target value, is stored."""
    roles.require(df)
    columns = {f"c{i}": F.col(f"`{c}`").cast("string") for i, c in enumerate(roles.categorical)}
    columns |= {f"b{i}": _bin_of(c, ranges[c], bins).cast("string") for i, c in enumerate(roles.numeric)}
    known = class_code(roles) != OTHER
    narrow = df.select(F.col(f"`{roles.label}`").cast("string").alias("label"), known.alias("known"), *[c.alias(n) for n, c in columns.items()])
    long = narrow.unpivot(["label", "known"], list(columns), "kind", "value")
    counts = stored(long.groupBy("kind", "value", "label", "known").agg(F.count(F.lit(1)).alias("n")), "profile-counts")
    kind, place = F.substring("kind", 1, 1), F.expr("int(substring(kind, 2))")
    names = {k: F.get(F.array(*[F.lit(c) for c in cs]) if cs else F.array().cast("array<string>"), place) for k, cs in (("c", roles.categorical), ("b", roles.numeric))}
    crossed = counts.where(kind == "c").select(names["c"].alias("feature"), "value", "label", "n")
    in_bins = counts.where((kind == "b") & F.col("known") & F.col("value").isNotNull())
    in_bins = in_bins.select(names["b"].alias("feature"), "label", F.col("value").cast("int").alias("bin"), "n")
    return crossed, _with_limits(in_bins, ranges, bins)
