"""Role-driven feature pipeline: indexing, one-hot encoding, min-max scaling, assembly.

A fitted pipeline is an ordinary ``PipelineModel`` of MLlib's own stages, but for one: a string
indexer keeps every category of a column in its model, on the driver and in each task, so columns
with many categories are indexed by a join instead (``wide_index``). The estimate of the number of
categories chooses the way, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel

from tabloom.operators.wide_index import WideIndexer, WideIndexerModel
from tabloom.roles import Roles
from tabloom.sources.shared import stored

LABEL_COLUMN = "label"
NUMERIC_VECTOR = "numericalfeatures"
SCALED_VECTOR = "scaledfeatures"
FEATURES = "features"
MAX_LEVELS = 10_000
UNKNOWN = "rows with categories that the features were not fitted on, use handle_invalid='keep'"


def index_name(column: str) -> str:
    return f"idx_{column}"


def one_hot_name(column: str) -> str:
    return f"vec_idx_{column}"


@dataclass(frozen=True)
class FittedFeatures:
    """A fitted pipeline, the categorical columns left out because they have one value only, and the
    number of rows it was fitted on."""

    model: PipelineModel
    roles: Roles
    dropped: tuple[str, ...] = ()
    rows: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def input_report(df: DataFrame, roles: Roles) -> DataFrame:
    """``(column, role, rows, nulls, levels)`` from one aggregate over the role columns.

    ``levels`` is an approximate distinct count, for label and categorical columns only.
    """
    roles.require(df)
    kinds = {roles.label: "label", **{c: "categorical" for c in roles.categorical}, **{c: "numeric" for c in roles.numeric}}
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, (column, kind) in enumerate(kinds.items()):
        aggregates.append(F.count_if(F.col(column).isNull()).alias(f"nulls_{i}"))
        levels = F.lit(None).cast("bigint") if kind == "numeric" else F.approx_count_distinct(column)
        aggregates.append(levels.alias(f"levels_{i}"))
    rows = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(kind).alias("role"),
            F.col("rows"),
            F.col(f"nulls_{i}").alias("nulls"),
            F.col(f"levels_{i}").alias("levels"),
        )
        for i, (column, kind) in enumerate(kinds.items())
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def check_input(df: DataFrame, roles: Roles) -> tuple[dict[str, int], int]:
    """Raise on columns without any value; return approximate numbers of categories, and of rows."""
    report = input_report(df, roles).collect()
    empty = [r["column"] for r in report if r["rows"] > 0 and r["nulls"] == r["rows"]]
    if empty:
        raise ValueError(f"columns in which every value is null (wrong separator or type?): {empty}")
    return {r["column"]: r["levels"] for r in report if r["levels"] is not None}, report[0]["rows"]


def label_stage(roles: Roles, order: str = "roles"):
    """Label index. ``"roles"`` makes the positive value 1.0 and refuses any third value;
    ``"frequency"`` gives 0.0 to the most frequent value."""
    if order == "roles":
        return StringIndexerModel.from_labels(list(roles.class_names), inputCol=roles.label, outputCol=LABEL_COLUMN)
    if order == "frequency":
        return StringIndexer(inputCol=roles.label, outputCol=LABEL_COLUMN)
    raise ValueError(f"order must be 'roles' or 'frequency', not {order!r}")


def feature_stages(roles: Roles, handle_invalid: str = "error", label_order: str = "roles", wide: Sequence[str] = ()) -> list:
    """Unfitted stages: label index, category indexes, one-hot vectors, scaled numerics, features.

    All categorical columns share one indexer and one encoder, so fitting them is a single pass; the
    columns in ``wide`` share an indexer that joins.
    """
    stages: list = [label_stage(roles, label_order)]
    parts: list[str] = []
    if roles.categorical:
        indexes = [index_name(c) for c in roles.categorical]
        vectors = [one_hot_name(c) for c in roles.categorical]
        narrow = [c for c in roles.categorical if c not in wide]
        if narrow:
            stages.append(StringIndexer(inputCols=narrow, outputCols=[index_name(c) for c in narrow], handleInvalid=handle_invalid))
        if wide:
            stages.append(WideIndexer(inputCols=list(wide), outputCols=[index_name(c) for c in wide], handleInvalid=handle_invalid))
        stages.append(OneHotEncoder(inputCols=indexes, outputCols=vectors, handleInvalid="error"))
        parts += vectors
    if roles.numeric:
        stages.append(VectorAssembler(inputCols=list(roles.numeric), outputCol=NUMERIC_VECTOR, handleInvalid="error"))
        stages.append(MinMaxScaler(inputCol=NUMERIC_VECTOR, outputCol=SCALED_VECTOR))
        parts.append(SCALED_VECTOR)
    stages.append(VectorAssembler(inputCols=parts, outputCol=FEATURES))
    return stages


def fit_features(
    df: DataFrame, roles: Roles, handle_invalid: str = "error", label_order: str = "roles", max_levels: int = MAX_LEVELS
) -> FittedFeatures:
    """Fit the pipeline on ``df``. ``handle_invalid="keep"`` gives unseen categories a level of their own.

    A categorical column with a single value carries nothing and cannot be one-hot encoded; it is
    left out and reported in ``dropped``. Columns with more than about ``max_levels`` categories are
    indexed by a join; their number has no limit, though a one-hot vector names each of its entries.
    The role columns are read once and kept in the executors' cache while the stages are fitted.
    """
    roles.require(df)
    kept = df.select(*roles.columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_stages(kept, roles, handle_invalid, label_order, max_levels)
    finally:
        kept.unpersist()


def _fit_stages(df: DataFrame, roles: Roles, handle_invalid: str, label_order: str, max_levels: int) -> FittedFeatures:
    levels, rows = check_input(df, roles)
    dropped = tuple(c for c in roles.categorical if levels[c] < 2) if handle_invalid != "keep" else ()
    used = Roles(roles.label, roles.negative, roles.positive, roles.numeric, tuple(c for c in roles.categorical if c not in dropped))
    if not used.numeric and not used.categorical:
        raise ValueError("no usable feature column")
    wide = tuple(c for c in used.categorical if levels[c] > max_levels)
    return FittedFeatures(Pipeline(stages=feature_stages(used, handle_invalid, label_order, wide)).fit(df), used, dropped, rows)


def check_known(fitted: FittedFeatures, df: DataFrame) -> None:
    """Raise if ``df`` has null or unknown categories, which would stop the scoring of its rows.

    One aggregate over all categorical columns that an indexer holds, and one join for each of the
    others, for pipelines fitted with ``handle_invalid="error"``."""
    for stage in fitted.model.stages:
        if isinstance(stage, WideIndexerModel) and stage.getHandleInvalid() == "error" and (found := stage.unknown(df)):
            raise ValueError(f"{UNKNOWN}: {found}")
        if isinstance(stage, StringIndexerModel) and stage.isSet(stage.inputCols) and stage.getHandleInvalid() == "error":
            known = dict(zip(stage.getInputCols(), stage.labelsArray, strict=True))
            unknown = [
                F.count_if(~F.coalesce(F.col(f"`{c}`").cast("string").isin(list(labels)), F.lit(False))).alias(c)
                for c, labels in known.items()
            ]
            found = {c: n for c, n in df.agg(*unknown).first().asDict().items() if n}
            if found:
                raise ValueError(f"{UNKNOWN}: {found}")


def stage_table(model: PipelineModel, spark) -> DataFrame:
    """``(position, stage, uid, inputs, outputs)`` of every stage of a fitted pipeline."""

    def names(stage, *params: str) -> str:
        found = []
        for param in params:
            if stage.hasParam(param) and stage.isDefined(param):
                value = stage.getOrDefault(param)
                found += value if isinstance(value, list) else [value]
        return ", ".join(found)

    rows = [
        (i, type(s).__name__, s.uid, names(s, "inputCols") or names(s, "inputCol"), names(s, "outputCols") or names(s, "outputCol"))
        for i, s in enumerate(model.stages)
    ]
    return spark.createDataFrame(rows, "position int, stage string, uid string, inputs string, outputs string")


def category_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value, n, idx)``: categories ranked by frequency, ties by value, from 0.

    The ranking a string indexer applies, as a table, for any number of categories: they are sorted
    into ranges, ranked inside each range, and shifted by the sizes of the ranges before it. The
    ranges are stored, so that a lost executor cannot draw them anew.
    """
    counts = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = (F.desc("n"), F.asc("value"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_counts = counts.repartitionByRange(ranges, F.asc("feature"), *order)
    ranged = stored(sorted_counts.withColumn("range", F.spark_partition_id()), "category-counts")
    before = Window.partitionBy("feature").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per range and column.
    sizes = ranged.groupBy("feature", "range").agg(F.count(F.lit(1)).alias("size"))
    shifts = sizes.select("feature", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("shift"))
    within = ranged.withColumn("place", F.row_number().over(Window.partitionBy("feature", "range").orderBy(*order)) - 1)
    return within.join(shifts, ["feature", "range"]).select("feature", "value", "n", (F.col("place") + F.col("shift")).cast("double").alias("idx"))


def vector_entries(vector: str, size: int, prefix: str) -> list[Column]:
    """``<prefix>0`` .. ``<prefix>{size-1}``: the entries of a vector column as double columns."""
    entries = vector_to_array(F.col(vector))
    return [F.get(entries, i).alias(f"{prefix}{i}") for i in range(size)]


def feature_names(prepared: DataFrame, column: str = FEATURES) -> list[str]:
    """Names of the entries of an assembled vector, in order, from its ML attributes."""
    attributes = prepared.schema[column].metadata["ml_attr"]["attrs"]
    entries = [entry for group in attributes.values() for entry in group]
    return [entry["name"] for entry in sorted(entries, key=lambda entry: entry["idx"])]
