from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom.functions.keys import arithmetic_bucket
from tabloom.operators.split import add_fold, split


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 13).alias("v"))


@pytest.mark.parametrize("method", ["hash", "arithmetic"])
def test_sides_are_disjoint_and_complete(keyed, method):
    training, held_out = split(keyed, ["k"], 90, method=method)
    assert training.join(held_out, "k").count() == 0
    n = training.count()
    assert n + held_out.count() == 20_000
    assert 0.88 < n / 20_000 < 0.92


def test_split_does_not_depend_on_partitioning(keyed):
    a = split(keyed, ["k"])[1].select("k")
    b = split(keyed.repartition(17), ["k"])[1].select("k")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_seed_changes_the_split(keyed):
    a, b = (split(keyed, ["k"], seed=s)[1].select("k") for s in (1, 2))
    assert a.exceptAll(b).count() > 0


@pytest.mark.parametrize("method", ["hash", "arithmetic"])
def test_folds_are_even_on_the_training_side(keyed, method):
    training, _ = split(keyed, ["k"], method=method)
    sizes = {r["fold"]: r["count"] for r in add_fold(training, ["k"], 5, method=method).groupBy("fold").count().collect()}
    assert set(sizes) == set(range(5))
    assert max(sizes.values()) / min(sizes.values()) < 1.15


def test_equal_rows_without_keys_share_a_side(spark):
    df = spark.createDataFrame([(i % 50, i % 50) for i in range(1000)], "a int, b int")
    training, held_out = split(df, train_percent=50)
    assert training.join(held_out, ["a", "b"]).count() == 0
    assert training.count() + held_out.count() == 1000


def test_large_and_negative_keys(spark):
    df = spark.createDataFrame([(9_223_372_036_854_775_807,), (-9_223_372_036_854_775_808,), (-5,)], "k bigint")
    buckets = [r["b"] for r in df.select(arithmetic_bucket(["k"], 10, 3).alias("b")).collect()]
    assert all(0 <= b < 10 for b in buckets)


def test_unknown_method(keyed):
    with pytest.raises(ValueError):
        split(keyed, ["k"], method="other")


@pytest.mark.parametrize("percent", [5, 95])
def test_arithmetic_folds_do_not_follow_the_split(keyed, percent):
    side = split(keyed, ["k"], percent, method="arithmetic")[0 if percent == 5 else 1]
    sizes = {r["fold"]: r["count"] for r in add_fold(side, ["k"], 10, method="arithmetic").groupBy("fold").count().collect()}
    assert set(sizes) == set(range(10))
    assert max(sizes.values()) / min(sizes.values()) < 2
