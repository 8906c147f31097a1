"""Cross-validated model search. One routine serves every classifier; the differences are data."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from tabloom.operators.features import FEATURES, LABEL_COLUMN
from tabloom.operators.metrics import evaluate
from tabloom.sources.shared import Scratch, stored


@dataclass(frozen=True)
class ModelSpec:
    """A classifier with its settings and the values to search, both by parameter name."""

    name: str
    estimator: Callable[..., Estimator]
    settings: Mapping[str, object]
    grid: Mapping[str, Sequence[object]] = field(default_factory=dict)

    def build(self, label: str = LABEL_COLUMN, features: str = FEATURES) -> Estimator:
        return self.estimator(labelCol=label, featuresCol=features, **self.settings)

    def param_maps(self, estimator: Estimator) -> list[dict]:
        builder = ParamGridBuilder()
        for name, values in self.grid.items():
            builder.addGrid(estimator.getParam(name), list(values))
        return builder.build()


# Settings and search grids of the three classifiers.
LOGISTIC = ModelSpec(
    "lr",
    LogisticRegression,
    {
        "maxIter": 100,
        "regParam": 0.0025,
        "elasticNetParam": 0.0075,
        "family": "binomial",
        "fitIntercept": True,
        "threshold": 0.35,
    },
    {"regParam": (0.1, 0.0025), "elasticNetParam": (0.5, 0.0075), "threshold": (0.35,)},
)
BOOSTED = ModelSpec(
    "gbt",
    GBTClassifier,
    {
        "maxDepth": 4,
        "maxIter": 10,
        "minInstancesPerNode": 8,
        "stepSize": 0.4,
        "maxBins": 32,
        "featureSubsetStrategy": "auto",
        "seed": 42,
    },
    {"minInstancesPerNode": (8,), "maxDepth": (4,), "stepSize": (0.4,)},
)
FOREST = ModelSpec(
    "rf",
    RandomForestClassifier,
    {"maxBins": 32, "maxDepth": 12, "numTrees": 150, "seed": 42},
    {"numTrees": (150,), "maxDepth": (12,), "minInstancesPerNode": (1, 2, 5)},
)
DEFAULT_SPECS = (LOGISTIC, BOOSTED, FOREST)


# Partitions of training rows. Each holds a bounded number of rows, smaller tables are dealt
# to some dozen tasks, and those below the last value stay in the partitions they have.
MOST_ROWS_PER_TASK = 500_000
TASKS = 24
LEAST_ROWS_PER_TASK = 25_000
DEALT_FROM = 100_000


def dealt(training: DataFrame, rows: int) -> DataFrame:
    """``training``, a table of about ``rows`` rows, in even partitions.

    A source's partitions can be few or uneven: a Parquet file with one row group is read by one task
    however large it is, and a model is then fitted by that one. Rows are dealt in turn, so that no
    key or frequent value decides where they go."""
    if rows < DEALT_FROM:
        return training
    return training.repartition(max(math.ceil(rows / MOST_ROWS_PER_TASK), min(TASKS, rows // LEAST_ROWS_PER_TASK)))


@contextmanager
def kept_for_training(prepared: DataFrame) -> Iterator[DataFrame]:
    """``prepared`` in the executors' cache while the block runs, in the partitions it has.

    Tree ensembles draw rows per partition, so what is fitted depends on the partitioning; see ``dealt``
    for even partitions and ``training_partitions`` of the train job for some that do not depend on the source."""
    kept = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


# Rows times trees up to which a forest's rows remember their nodes, at four bytes each and up
# to three levels at a time, and what forests fitted at once have of that together.
NODES_KEPT = 1_000_000_000
NODES_KEPT_TOGETHER = 1_000_000_000


def most_trees(estimator: Estimator, maps: Sequence[Mapping] = ()) -> int:
    """Trees of the largest forest that ``maps`` name."""
    return max(params.get(estimator.numTrees, estimator.getNumTrees()) for params in maps or [{}])


def remembering_nodes(estimator: Estimator, rows: int, maps: Sequence[Mapping] = ()) -> Estimator:
    """``estimator``, to be fitted on about ``rows`` rows. A forest finds the open node of every row in every tree
    once per level. Remembered, it needn't be sought from the root; the trees are the same. Larger tables do
    without, and settings that name ``cacheNodeIds`` decide themselves."""
    if not estimator.hasParam("numTrees") or estimator.isSet("cacheNodeIds"):
        return estimator
    if rows * most_trees(estimator, maps) > NODES_KEPT:
        return estimator
    # No checkpoint: there are no more levels than maxDepth, and the cache goes to disk where memory ends.
    kept = {"cacheNodeIds": True} if estimator.isSet("checkpointInterval") else {"cacheNodeIds": True, "checkpointInterval": -1}
    return estimator.setParams(**kept)


# Fixed value: rows that fits running at once have together. Each fit keeps a copy of its rows in the executors'
# cache, some 60 bytes a row for a dozen features; copies that exceed it are read from disk in every iteration.
ROWS_FITTED_TOGETHER = 80_000_000


def fits_at_once(parallelism: int, rows: int, trees: int = 0) -> int:
    """``parallelism``, or fewer fits where the table of ``rows`` rows is large or has many nodes to remember in
    ``trees`` trees. One fit alone then has tasks for all cores."""
    return max(1, min(parallelism, ROWS_FITTED_TOGETHER // max(1, rows), NODES_KEPT_TOGETHER // max(1, rows * trees)))


def fit(spec: ModelSpec, training: DataFrame, label: str = LABEL_COLUMN, features: str = FEATURES, rows: int | None = None) -> Model:
    """Fit with the settings alone, no search. ``rows`` is the approximate size of ``training``, if it is known."""
    estimator = spec.build(label, features)
    return (estimator if rows is None else remembering_nodes(estimator, rows)).fit(training.select(label, features))


def search(
    spec: ModelSpec,
    training: DataFrame,
    fold_column: str = "fold",
    folds: int = 10,
    parallelism: int = 2,
    label: str = LABEL_COLUMN,
    features: str = FEATURES,
    resume: str | None = None,
) -> CrossValidatorModel:
    """Search the grid of ``spec`` by cross-validated area under the precision-recall curve.

    The folds are the caller's, 0..folds-1 in ``fold_column`` (see ``split.add_fold``), so they repeat
    exactly. Rows are read from ``training`` as it is; keep it cached (``kept_for_training``): no fold is
    copied. All candidates of a fold are fitted, score its rows side by side in one pass, and their
    exact areas are taken together from running totals over that narrow table. ``parallelism`` fits run at
    once, fewer on large tables (``fits_at_once``); where a fold has fewer candidates, as many folds as fill
    it are fitted together.

    With ``resume``, a folder that outlives the driver, the areas of every finished fold are noted
    there, and a search over the same rows, settings and grid takes them up instead of fitting again.
    """
    estimator = spec.build(label, features)
    maps = spec.param_maps(estimator)
    rows = training.select(label, features, fold_column)
    counted = _check_folds(rows, fold_column, folds)
    remembering_nodes(estimator, counted, maps)
    remembered = estimator.hasParam("numTrees") and estimator.getCacheNodeIds()
    parallelism = fits_at_once(parallelism, counted, most_trees(estimator, maps) if remembered else 0)
    noted = Manifest(resume, spec, rows, folds) if resume else None
    areas: dict[int, list[float]] = noted.finished(len(maps)) if noted else {}
    spark = training.sparkSession
    missing = [fold for fold in range(folds) if fold not in areas]
    together = max(1, parallelism // len(maps))
    for first in range(0, len(missing), together):
        some = missing[first : first + together]
        # One iterator of fits per fold; each next() fits one candidate.
        fits = {fold: estimator.fitMultiple(rows.where(F.col(fold_column) != fold).select(label, features), maps) for fold in some}
        due = [fold for fold in some for _ in maps]
        fitted: dict[int, dict[int, Model]] = {fold: {} for fold in some}
        with ThreadPool(max(1, min(parallelism, len(due)))) as pool:
            for fold, (i, model) in pool.imap_unordered(inheritable_thread_target(spark)(lambda fold: (fold, next(fits[fold]))), due):
                fitted[fold][i] = model
        for fold in some:
            areas[fold] = candidate_areas([fitted[fold][i] for i in range(len(maps))], rows.where(F.col(fold_column) == fold), label)
            if noted:
                noted.add(fold, areas[fold])
    table = np.array([areas[fold] for fold in range(folds)])
    best = int(table.mean(axis=0).argmax())
    model = estimator.fit(rows.select(label, features), maps[best])
    return CrossValidatorModel(model, table.mean(axis=0).tolist(), None, table.std(axis=0).tolist())


def _check_folds(rows: DataFrame, fold_column: str, folds: int) -> int:
    """The number of rows. Raises unless every row has a fold and every fold has rows."""
    if folds < 2:
        raise ValueError("a search needs two folds at least")
    inside = F.col(fold_column).isin(*range(folds))
    found = rows.agg(F.collect_set(F.when(inside, F.col(fold_column).cast("int"))), F.count_if(~F.coalesce(inside, F.lit(False))), F.count(F.lit(1))).first()
    if found[1] or len(found[0]) < folds:
        raise ValueError(f"folds must be 0..{folds - 1}, each with rows; found {sorted(found[0])} and {found[1]} other rows")
    return found[2]


def candidate_areas(candidates: Sequence[Model], rows: DataFrame, label: str = LABEL_COLUMN) -> list[float]:
    """The exact area under the precision-recall curve of every candidate on ``rows``."""
    scored = rows
    for i, model in enumerate(candidates):
        scored = model.copy({model.rawPredictionCol: f"raw_{i}", model.probabilityCol: "", model.predictionCol: ""}).transform(scored)
    narrow = scored.select(label, *[F.get(vector_to_array(f"raw_{i}"), 1).alias(f"score_{i}") for i in range(len(candidates))])
    with Scratch(rows.sparkSession):
        kept = stored(narrow, "fold-scores")
        measured = evaluate(kept, {str(i): (f"score_{i}", None) for i in range(len(candidates))}, label)
        found = {int(r["model"]): r["area_under_pr"] for r in measured.select("model", "area_under_pr").collect()}
    return [found[i] for i in range(len(candidates))]


class Manifest:
    """Areas of the finished folds of one search, as a small table in a folder of the caller's.

    Its rows carry a fingerprint of settings, grid, folds and training rows; others' rows are passed over."""

    SCHEMA = "model string, fold int, candidate int, params string, area double, fingerprint string"

    def __init__(self, folder: str, spec: ModelSpec, rows: DataFrame, folds: int) -> None:
        self.spark, self.spec = rows.sparkSession, spec
        self.path = f"{folder.rstrip('/')}/{spec.name}"
        self.params = [described(m) for m in spec.param_maps(spec.build())]
        label, features, fold = rows.columns
        content = rows.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(label, vector_to_array(features), fold))).first()
        told = [spec.estimator.__name__, sorted(map(str, spec.settings.items())), self.params, folds, *content]
        self.fingerprint = hashlib.sha256(repr(told).encode()).hexdigest()

    def finished(self, candidates: int) -> dict[int, list[float]]:
        try:
            noted = self.spark.read.schema(self.SCHEMA).parquet(self.path).where(F.col("fingerprint") == self.fingerprint)
            rows = noted.select("fold", "candidate", "area").distinct().collect()
        except AnalysisException as failure:
            if failure.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        folds: dict[int, dict[int, float]] = {}
        for fold, candidate, area in rows:
            folds.setdefault(fold, {})[candidate] = area
        return {fold: [areas[i] for i in range(candidates)] for fold, areas in folds.items() if len(areas) == candidates}

    def add(self, fold: int, areas: Sequence[float]) -> None:
        rows = [(self.spec.name, fold, i, self.params[i], float(area), self.fingerprint) for i, area in enumerate(areas)]
        self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def described(params: Mapping) -> str:
    """A grid point as text, parameters by name."""
    return ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda item: item[0].name))


def search_table(found: CrossValidatorModel, spec: ModelSpec, spark: SparkSession) -> DataFrame:
    """``(model, candidate, params, mean, std)``: one row per grid point."""
    maps = spec.param_maps(spec.build())
    rows = [
        (
            spec.name,
            i,
            described(params),
            float(found.avgMetrics[i]),
            float(found.stdMetrics[i]),
        )
        for i, params in enumerate(maps)
    ]
    return spark.createDataFrame(rows, "model string, candidate int, params string, mean double, std double")


def parameter_table(model: Model, spark: SparkSession) -> DataFrame:
    """``(param, value, doc)`` of a fitted model."""
    rows = [
        (p.name, str(model.getOrDefault(p)) if model.isDefined(p) else None, p.doc)
        for p in sorted(model.params, key=lambda p: p.name)
    ]
    return spark.createDataFrame(rows, "param string, value string, doc string")


def parameter_help(spec: ModelSpec) -> str:
    """Names, meanings, defaults and current values of the parameters of a classifier."""
    return spec.build().explainParams()
