"""The plans behind the operators: what is read, what is shuffled, what stays on the JVM."""

from __future__ import annotations

import dataclasses
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from registry.inputs import LINE_KEYS, LINE_NUMERIC, STATUS_ROLES, TARGET_ROLES, scored_lines, table
from registry.modelling import modelling_lines
from tabloom.operators import distance, metrics, models, profile
from tabloom.operators.features import fit_features
from tabloom.plans import jobs
from tabloom.sources.shared import Scratch, shared_folder


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan_of(df) -> str:
    df.collect()
    return plan_of(df).split("Initial Plan")[0]


def read_columns(plan: str) -> set[str]:
    return {c.split(":")[0] for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan) for c in schema.split(",")}


def shuffles(plan: str) -> int:
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning", plan))


@pytest.fixture()
def lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem")


def test_crosstab_is_one_scan_and_one_shuffle(lines):
    plan = plan_of(profile.crosstab(lines, STATUS_ROLES)).split("Initial Plan")[-1]
    assert plan.count("FileScan parquet") == 1
    assert shuffles(plan) == 1 and "partial_count" in plan
    assert read_columns(plan) == {"l_linestatus", "l_returnflag", "l_linenumber"}


def test_describe_is_one_scan_without_row_expansion(lines):
    plan = plan_of(profile.describe_by_class(lines, STATUS_ROLES))
    assert plan.count("FileScan parquet") == 1 and shuffles(plan) == 1
    assert "Expand" not in plan
    assert read_columns(plan) == {"l_linestatus", *LINE_NUMERIC}


def test_class_filter_reaches_the_scan(lines):
    assert "EqualTo(l_linestatus,O)" in plan_of(profile.of_class(lines, "l_linestatus", "O"))


def test_running_totals_scan_once_and_window_inside_buckets(lines):
    plan = executed_plan_of(distance.class_counts(lines, STATUS_ROLES))
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1
    assert "SinglePartition" not in plan
    assert "BuildRight" in plan and "partial_sum" in plan


@pytest.mark.parametrize("name", ["numeric_report", "ks_two_sample", "threshold_curve", "curve_areas", "evaluate_scores", "fit_summary"])
def test_rank_statistics_read_their_rows_once(spark, sf_dir, name):
    plan = executed_plan_of(contract.queries()[name](spark, sf_dir))
    # The report also describes the columns, which is a scan with another aggregate.
    assert plan.count("FileScan parquet") == (2 if name == "numeric_report" else 1)


def test_only_bucket_totals_meet_in_one_task(spark, sf_dir):
    plan = executed_plan_of(metrics.evaluate(scored_lines(spark, sf_dir), {"m": ("p1", "prediction")}))
    assert plan.count("FileScan parquet") == 1
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    keys = re.search(r"HashAggregate\(keys=\[([^\]]*)\]", lines[single[0] + 1]).group(1)
    assert "bucket" in keys and "value" not in keys


def test_scoring_does_not_shuffle(spark, sf_dir):
    from registry.modelling import modelling_lines

    lines = modelling_lines(spark, sf_dir)
    plan = plan_of(fit_features(lines, TARGET_ROLES).transform(lines))
    assert "Exchange" not in plan


@pytest.mark.parametrize("name", ["numeric_report", "threshold_curve", "fit_summary", "feature_vector", "histogram", "class_probability"])
def test_no_python_worker(spark, sf_dir, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|NestedLoop", plan)


def test_categories_of_held_out_rows_only_are_found_before_fitting(spark):
    from tabloom.operators import models
    from tabloom.operators.split import split
    from tabloom.plans import jobs
    from tabloom.roles import Roles

    roles = Roles("y", 0, 1, numeric=("x",), categorical=("c",))
    rows = spark.range(300).selectExpr("id", "cast(id % 2 as int) y", "cast(id as double) x", "cast(id % 3 as string) c")
    held = {r["id"] for r in split(rows, ["id"])[1].collect()}
    odd = rows.withColumn("c", F.when(F.col("id") == min(held), "unseen").otherwise(F.col("c")))
    fitted = []

    class Never(models.LogisticRegression):
        def _fit(self, dataset):
            fitted.append(1)
            return super()._fit(dataset)

    spec = models.ModelSpec("lr", Never, {"maxIter": 2})
    with pytest.raises(ValueError, match="keep"):
        jobs.train(odd, roles, ["id"], [spec], folds=0)
    assert not fitted
    saved = []
    trained = jobs.train(odd, roles, ["id"], [spec], folds=0, handle_invalid="keep", training_partitions=3, save=lambda f, m: saved.append(sorted(m)))
    assert saved == [["lr"]] and trained.metrics.count() > 0


def counting(df):
    """``df`` and a counter of the rows that were read from it, whoever asked for them."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def passed(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    return df.mapInPandas(passed, df.schema), read


def test_explore_takes_four_scans_at_most(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", "l_linenumber", *LINE_NUMERIC)
    rows = lines.count()
    counted, read = counting(lines)
    tables = jobs.explore(counted, STATUS_ROLES)
    assert read.value == 2 * rows
    for name in ("schema", "rows", "crosstab", "histogram"):
        tables[name].collect()
    assert read.value == 2 * rows
    tables["numeric"].collect()
    assert read.value == 3 * rows
    tables["sample"].collect()
    assert read.value <= 4 * rows


def test_numeric_report_takes_two_scans(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", "l_linenumber", *LINE_NUMERIC)
    counted, read = counting(lines)
    distance.numeric_report(counted, STATUS_ROLES).collect()
    assert read.value == 2 * lines.count()


def test_features_are_fitted_on_one_scan(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_linestatus", "l_returnflag", "l_linenumber", *LINE_NUMERIC)
    counted, read = counting(lines)
    fit_features(counted, STATUS_ROLES)
    assert read.value == lines.count()


def test_train_and_score_leave_no_tables(spark, sf_dir, tmp_path):
    lines = modelling_lines(spark, sf_dir)
    small = dataclasses.replace(models.LOGISTIC, settings={**models.LOGISTIC.settings, "maxIter": 5})
    before = set(os.listdir(shared_folder(spark)))
    with Scratch(spark) as scratch:
        trained = jobs.train(lines, TARGET_ROLES, LINE_KEYS, [small], folds=2)
        assert trained.metrics.count() == 7
        assert set(os.listdir(shared_folder(spark))) > before and scratch.paths
    assert set(os.listdir(shared_folder(spark))) == before
