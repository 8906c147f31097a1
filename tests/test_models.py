from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from registry.inputs import LINE_KEYS, TARGET_ROLES
from registry.modelling import fitted_scores, modelling_lines
from tabloom import Settings
from tabloom.functions.scores import logistic
from tabloom.operators import metrics, models, scoring
from tabloom.operators.features import FEATURES, LABEL_COLUMN, fit_features
from tabloom.operators.split import add_fold
from tabloom.plans import jobs
from tabloom.presets import BANK_CONTACTS_SCHEMA
from tabloom.roles import JdbcSource
from tabloom.sources.fitted import load_model, load_pipeline
from tabloom.sources.shared import shared_folder

SMALL = (
    dataclasses.replace(models.LOGISTIC, settings={**models.LOGISTIC.settings, "maxIter": 15}),
    dataclasses.replace(models.BOOSTED, settings={**models.BOOSTED.settings, "maxIter": 3}),
    dataclasses.replace(models.FOREST, settings={**models.FOREST.settings, "numTrees": 5, "maxDepth": 5}, grid={}),
)

TWO = dataclasses.replace(SMALL[0], settings={**SMALL[0].settings, "maxIter": 5}, grid={"regParam": (0.1, 0.0025)})


@pytest.fixture(scope="module")
def lines(spark, sf_dir):
    return modelling_lines(spark, sf_dir)


@pytest.fixture(scope="module")
def prepared(lines):
    lines = add_fold(lines, LINE_KEYS, 3)
    return fit_features(lines, TARGET_ROLES).transform(lines).select(LABEL_COLUMN, FEATURES, "fold").cache()


@pytest.mark.parametrize("spec, size", [(models.LOGISTIC, 4), (models.BOOSTED, 1), (models.FOREST, 3)])
def test_grids(spark, spec, size):
    estimator = spec.build()
    maps = spec.param_maps(estimator)
    assert len(maps) == size
    for name, value in spec.settings.items():
        assert estimator.getOrDefault(name) == value
    assert "maxIter" in models.parameter_help(models.LOGISTIC)


def test_search_does_not_depend_on_partitioning(spark, prepared):
    tables = [
        [tuple(r) for r in models.search_table(models.search(TWO, p, folds=3, parallelism=4), TWO, spark).collect()]
        for p in (prepared, prepared.repartition(5))
    ]
    assert len(tables[0]) == 2
    for a, b in zip(*tables):
        assert a[:3] == b[:3]
        assert a[3:] == pytest.approx(b[3:], abs=1e-9)


@pytest.mark.parametrize("spec", [TWO, SMALL[1]])
def test_search_equals_mllib_validator(spark, prepared, spec):
    estimator = spec.build()
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=spec.param_maps(estimator),
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0),
        numFolds=3,
        foldCol="fold",
    )
    theirs, ours = validator.fit(prepared), models.search(spec, prepared, folds=3)
    assert ours.avgMetrics == pytest.approx(theirs.avgMetrics, abs=1e-9)
    assert ours.stdMetrics == pytest.approx(theirs.stdMetrics, abs=1e-9)
    for name in spec.grid:
        assert ours.bestModel.getOrDefault(name) == theirs.bestModel.getOrDefault(name)


def test_search_keeps_one_cached_copy_and_leaves_no_table(spark, lines, monkeypatch):
    rows = add_fold(lines, LINE_KEYS, 2)
    fitted = fit_features(rows, TARGET_ROLES).transform(rows).select(LABEL_COLUMN, FEATURES, "fold")
    cached, measure = [], models.candidate_areas
    before = spark.sparkContext._jsc.getPersistentRDDs().size()

    def watched(candidates, held, label):
        cached.append(spark.sparkContext._jsc.getPersistentRDDs().size() - before)
        return measure(candidates, held, label)

    monkeypatch.setattr(models, "candidate_areas", watched)
    tables = set(os.listdir(shared_folder(spark)))
    with models.kept_for_training(fitted) as kept:
        models.search(TWO, kept, folds=2, parallelism=4)
    assert cached == [1, 1]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    assert set(os.listdir(shared_folder(spark))) == tables


def test_a_stopped_search_is_taken_up(spark, prepared, monkeypatch, tmp_path):
    whole = models.search_table(models.search(TWO, prepared, folds=3), TWO, spark).collect()
    measure, calls = models.candidate_areas, []

    def failing(candidates, held, label):
        calls.append(len(candidates))
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return measure(candidates, held, label)

    monkeypatch.setattr(models, "candidate_areas", failing)
    with pytest.raises(RuntimeError):
        models.search(TWO, prepared, folds=3, resume=str(tmp_path))
    again = models.search(TWO, prepared.repartition(3), folds=3, resume=str(tmp_path))
    assert calls == [2] * 4
    found = models.search_table(again, TWO, spark).collect()
    assert [r[:3] for r in found] == [r[:3] for r in whole]
    assert [v for r in found for v in r[3:]] == pytest.approx([v for r in whole for v in r[3:]], abs=1e-9)
    # Other rows or another grid start anew.
    smaller = dataclasses.replace(TWO, grid={"regParam": (0.1,)})
    models.search(smaller, prepared, folds=3, resume=str(tmp_path))
    models.search(smaller, prepared.limit(3000), folds=3, resume=str(tmp_path))
    assert calls == [2] * 4 + [1] * 6


class Recording(models.LogisticRegression):
    """Notes how many rows each partition of its training rows holds."""

    sizes: list[list[int]] = []

    def _fit(self, dataset):
        counts = dataset.groupBy(F.spark_partition_id().alias("part")).count().collect()
        Recording.sizes.append(sorted(r["count"] for r in counts))
        return super()._fit(dataset)


RECORDED = models.ModelSpec("lr", Recording, {"maxIter": 1, "threshold": 0.35})


@pytest.fixture()
def one_partition(spark):
    """Many rows that a source gives in one piece, as a file with one row group does."""
    rows = spark.range(120_000).selectExpr(
        "id DIV 4 AS l_orderkey", "cast(id % 4 AS int) AS l_linenumber", "cast(id % 3 = 0 AS double) AS target",
        "cast(id % 50 AS double) AS l_quantity", "cast(id % 997 AS double) AS l_extendedprice",
        "id % 11 / 100 AS l_discount", "id % 9 / 100 AS l_tax", "if(id % 5 = 0, 'R', 'A') AS l_returnflag",
    )
    Recording.sizes = []
    return rows.coalesce(1)


def test_no_task_trains_on_the_whole_table(one_partition, monkeypatch):
    monkeypatch.setattr("registry.modelling.modelling_lines", lambda *_: one_partition)
    fitted_scores(one_partition.sparkSession, "unused", RECORDED)
    jobs.train(one_partition, TARGET_ROLES, LINE_KEYS, [RECORDED], folds=0)
    assert len(Recording.sizes) == 2
    for sizes in Recording.sizes:
        assert len(sizes) == 4 and sizes[-1] - sizes[0] <= 4 and sum(sizes) > 100_000


def test_search_fits_on_dealt_rows(one_partition):
    jobs.train(one_partition, TARGET_ROLES, LINE_KEYS, [RECORDED], folds=2)
    assert len(Recording.sizes) == 3 and all(len(sizes) == 4 for sizes in Recording.sizes)


def test_rows_of_a_task_are_bounded(spark):
    rows = spark.range(10).coalesce(1)
    partitions = {n: models.dealt(rows, n).rdd.getNumPartitions() for n in (6_000, 99_999, 540_000, 5_400_000, 194_400_000)}
    assert partitions == {6_000: 1, 99_999: 1, 540_000: 21, 5_400_000: 24, 194_400_000: 389}
    assert sorted(r["id"] for r in models.dealt(rows, 540_000).collect()) == list(range(10))


def test_folds_are_checked(prepared):
    with pytest.raises(ValueError, match="folds must be"):
        models.search(SMALL[0], prepared, folds=4)


def test_node_cache_does_not_change_the_forest(prepared):
    spec = SMALL[2]
    plain = dataclasses.replace(spec, settings={**spec.settings, "cacheNodeIds": True})
    trees = [models.fit(s, prepared).toDebugString.split("\n")[1:] for s in (spec, plain)]
    assert trees[0] == trees[1]


class WatchedForest(models.RandomForestClassifier):
    """Notes whether rows remember their nodes, and how many fits run at once."""

    settings: list[tuple[bool, int]] = []
    running, most = 0, 0

    def _fit(self, dataset):
        WatchedForest.settings.append((self.getCacheNodeIds(), self.getCheckpointInterval()))
        WatchedForest.running += 1
        WatchedForest.most = max(WatchedForest.most, WatchedForest.running)
        try:
            return super()._fit(dataset)
        finally:
            WatchedForest.running -= 1


WATCHED = dataclasses.replace(SMALL[2], estimator=WatchedForest)


@pytest.fixture()
def watched():
    WatchedForest.settings, WatchedForest.running, WatchedForest.most = [], 0, 0


def test_forests_remember_nodes_and_folds_fill_the_parallelism(prepared, watched, monkeypatch):
    n, halves = prepared.count(), prepared.withColumn("fold", F.col("fold") % 2)
    monkeypatch.setattr(models, "NODES_KEPT", n * 5 - 1)
    plain = models.search(WATCHED, halves, folds=2, parallelism=1)
    assert WatchedForest.settings == [(False, 10)] * 3 and WatchedForest.most == 1
    monkeypatch.setattr(models, "NODES_KEPT", n * 5)
    kept = models.search(WATCHED, halves, folds=2, parallelism=2)
    assert WatchedForest.settings[3:] == [(True, -1)] * 3 and WatchedForest.most == 2
    assert kept.avgMetrics == plain.avgMetrics and kept.stdMetrics == plain.stdMetrics
    trees = [m.bestModel.toDebugString.split("\n")[1:] for m in (kept, plain)]
    assert trees[0] == trees[1]


def test_fewer_fits_run_at_once_on_large_tables(prepared, watched, monkeypatch):
    n, halves = prepared.count(), prepared.withColumn("fold", F.col("fold") % 2)
    monkeypatch.setattr(models, "ROWS_FITTED_TOGETHER", 2 * n - 1)
    alone = models.search(WATCHED, halves, folds=2, parallelism=2)
    assert WatchedForest.most == 1
    monkeypatch.setattr(models, "ROWS_FITTED_TOGETHER", 2 * n)
    together = models.search(WATCHED, halves, folds=2, parallelism=2)
    assert WatchedForest.most == 2
    assert alone.avgMetrics == together.avgMetrics and alone.stdMetrics == together.stdMetrics


@pytest.mark.parametrize("rows, fits", [(0, 4), (600_000, 4), (20_000_000, 4), (20_000_001, 3), (36_000_000, 2), (216_000_000, 1)])
def test_fits_at_once(rows, fits):
    assert models.fits_at_once(4, rows) == fits


def test_forests_of_some_million_rows_remember_their_nodes(spark):
    assert models.remembering_nodes(models.FOREST.build(), 3_240_000).getCacheNodeIds()
    assert models.remembering_nodes(models.FOREST.build(), 5_400_000).getCacheNodeIds()
    assert not models.remembering_nodes(models.FOREST.build(), 194_400_000).getCacheNodeIds()


def test_nodes_of_forests_fitted_at_once_are_bounded(prepared, watched, monkeypatch):
    assert [models.fits_at_once(4, rows, 150) for rows in (900_000, 3_240_000, 5_400_000)] == [4, 2, 1]
    n, halves = prepared.count(), prepared.withColumn("fold", F.col("fold") % 2)
    monkeypatch.setattr(models, "NODES_KEPT_TOGETHER", 2 * n * 5 - 1)
    alone = models.search(WATCHED, halves, folds=2, parallelism=2)
    assert WatchedForest.most == 1 and WatchedForest.settings == [(True, -1)] * 3
    monkeypatch.setattr(models, "NODES_KEPT_TOGETHER", 2 * n * 5)
    together = models.search(WATCHED, halves, folds=2, parallelism=2)
    assert WatchedForest.most == 2
    assert alone.avgMetrics == together.avgMetrics and alone.stdMetrics == together.stdMetrics


def test_nodes_are_remembered_up_to_a_bound(spark):
    spec = dataclasses.replace(SMALL[2], grid={"numTrees": (5, 7)})

    def remembered(spec, rows):
        estimator = spec.build()
        return models.remembering_nodes(estimator, rows, spec.param_maps(estimator)).getCacheNodeIds()

    assert remembered(spec, models.NODES_KEPT // 7) and not remembered(spec, models.NODES_KEPT // 7 + 1)
    assert remembered(SMALL[2], models.NODES_KEPT // 5) and not remembered(SMALL[2], models.NODES_KEPT // 5 + 1)
    assert not remembered(SMALL[1], 1) and not remembered(dataclasses.replace(spec, settings={"cacheNodeIds": False}), 1)


def test_parameters_of_the_best_model(spark, prepared):
    model = models.fit(SMALL[0], prepared)
    values = {r["param"]: r["value"] for r in models.parameter_table(model, spark).collect()}
    assert (values["threshold"], values["regParam"], values["maxIter"]) == ("0.35", "0.0025", "15")


def test_summary_equals_mllib(prepared):
    model = models.fit(models.LOGISTIC, prepared)
    table = {r["Metric"]: (r["Class_0"], r["Class_1"]) for r in metrics.fit_summary(scoring.apply_model(model, prepared)).collect()}
    summary = model.summary
    assert table["True Positive Rate"] == pytest.approx(tuple(summary.truePositiveRateByLabel))
    assert table["Recall"] == pytest.approx(tuple(summary.recallByLabel))
    assert table["Precision"] == pytest.approx(tuple(summary.precisionByLabel))
    assert table["False Positive Rate"] == pytest.approx(tuple(summary.falsePositiveRateByLabel))
    assert table["F-measure"] == pytest.approx(tuple(summary.fMeasureByLabel()))
    assert table["Total Accuracy"] == pytest.approx((0.0, summary.accuracy))
    assert table["Area Under ROC"][1] == pytest.approx(summary.areaUnderROC, abs=1e-3)


def test_linear_scorer_equals_the_model(prepared):
    model = models.fit(SMALL[0], prepared)
    weights = {f"x{i}": float(w) for i, w in enumerate(model.coefficients)}
    entries = vector_to_array(F.col(FEATURES))
    flat = scoring.apply_model(model, prepared).select("p1", *[entries[i].alias(f"x{i}") for i in range(len(weights))])
    both = scoring.linear_score(flat, weights, model.intercept, "mine")
    assert both.agg(F.max(F.abs(F.col("mine") - F.col("p1")))).first()[0] < 1e-12
    assert both.select(logistic(F.lit(0.0)).alias("half")).first()["half"] == 0.5


def test_models_side_by_side(prepared):
    fitted = {s.name: models.fit(s, prepared) for s in SMALL[:2]}
    together = scoring.score_side_by_side(fitted, prepared, (LABEL_COLUMN,))
    assert together.columns == ["label", "p1_lr", "p1_gbt", "prediction_lr", "prediction_gbt"]
    alone = scoring.apply_model(fitted["gbt"], prepared).agg(F.sum("p1")).first()[0]
    assert together.agg(F.sum("p1_gbt")).first()[0] == pytest.approx(alone)


def test_train_and_score_jobs(spark, lines, tmp_path):
    paths = {s.name: str(tmp_path / s.name) for s in SMALL}
    settings = Settings(TARGET_ROLES, str(tmp_path / "pipeline"), paths, str(tmp_path / "out"), input_path="unused", key_columns=LINE_KEYS, folds=2)
    trained = jobs.run_train(lines, settings, SMALL)
    table = {(r["model"], r["metric"]): r["value"] for r in trained.metrics.collect()}
    assert {m for m, _ in table} == {"lr", "gbt", "rf"}
    assert all(table[(m, "area_under_pr")] > 0.5 for m in paths)
    assert len(trained.searches["lr"].avgMetrics) == 4
    unlabelled = lines.drop("target")
    for kind in paths:
        scored = jobs.run_score(unlabelled, settings, kind)
        assert scored.count() == lines.count()
    expected = scoring.score(unlabelled, load_pipeline(settings.pipeline_path), load_model("rf", paths["rf"])).agg(F.sum("p1")).first()[0]
    back = spark.read.option("header", True).option("inferSchema", True).csv(settings.output_path)
    assert "features" not in back.columns and "idx_l_returnflag" not in back.columns
    assert back.agg(F.sum("p1")).first()[0] == pytest.approx(expected)


def test_every_model_needs_a_path(lines, prepared, tmp_path):
    from tabloom.sinks.fitted import save_models

    with pytest.raises(ValueError, match="rf"):
        save_models({"rf": None}, {"lr": str(tmp_path)})


def test_train_without_search_on_all_rows(lines):
    trained = jobs.train(lines, TARGET_ROLES, LINE_KEYS, SMALL[:1], folds=0, fit_features_on="all")
    assert trained.searches == {} and trained.metrics.count() == 7
    with pytest.raises(ValueError):
        jobs.train(lines, TARGET_ROLES, fit_features_on="some")


def test_only_the_chosen_source_is_touched(spark, tmp_path):
    path = tmp_path / "contacts.csv"
    path.write_text(",".join(BANK_CONTACTS_SCHEMA.names) + "\n")
    settings = Settings(TARGET_ROLES, "p", {}, input_path=str(path))
    assert jobs.read_input(spark, settings, BANK_CONTACTS_SCHEMA).count() == 0
    with pytest.raises(ValueError, match="schema"):
        jobs.read_input(spark, settings)
    both = dataclasses.replace(settings, jdbc=JdbcSource("u", "t", "d"))
    with pytest.raises(ValueError, match="either"):
        jobs.read_input(spark, both)


def test_explore(lines):
    tables = jobs.explore(lines, TARGET_ROLES)
    assert set(tables) == {"schema", "rows", "sample", "crosstab", "numeric", "histogram"}
    assert tables["rows"].first()["n_rows"] == lines.count()
    assert tables["sample"].count() == 5
