from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom import Roles
from tabloom.operators import profile
from tabloom.operators.overview import overview

ROLES = Roles("y", 0, 1, ("x",), ("a", "b"))
ROWS = [(0, 1.0, "p", 1), (0, 2.0, "p", 2), (1, 3.0, "q", 1), (1, None, None, 1), (None, 9.0, "p", 2)]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(ROWS, "y int, x double, a string, b int")


def test_crosstab_counts_nulls_too(df):
    got = {(r["feature"], r["value"], r["label"]): r["n"] for r in profile.crosstab(df, ROLES).collect()}
    assert got == {
        ("a", "p", "0"): 2, ("a", "q", "1"): 1, ("a", None, "1"): 1, ("a", "p", None): 1,
        ("b", "1", "0"): 1, ("b", "2", "0"): 1, ("b", "1", "1"): 2, ("b", "2", None): 1,
    }


def test_crosstab_equals_pairwise_crosstab(df):
    for column in ROLES.categorical:
        expected = {r[f"{column}_y"]: (r["0"], r["1"]) for r in df.where("y is not null and a is not null").crosstab(column, "y").collect()}
        wide = profile.crosstab_wide(df.where("y is not null and a is not null"), ROLES).where(F.col("feature") == column)
        assert {r["value"]: (r["n_negative"], r["n_positive"]) for r in wide.collect()} == expected


def test_describe_equals_builtin(df):
    got = {r["label"]: r for r in profile.describe_by_class(df, ROLES).collect()}
    for value in (0, 1):
        expected = {r["summary"]: r["x"] for r in df.where(F.col("y") == value).describe("x").collect()}
        mine = got[str(value)]
        assert mine["count"] == int(expected["count"])
        for name in ("mean", "stddev", "min", "max"):
            assert mine[name] == (None if expected[name] is None else pytest.approx(float(expected[name])))


def test_describe_column_names(df):
    assert profile.describe_column(df, "x", ROLES).columns == ["Statistic", "x_y_0", "x_y_1"]


def test_boolean_target(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 3.0)], "y boolean, x double")
    wide = {r["Statistic"]: (r["x_y_false"], r["x_y_true"]) for r in profile.describe_column(df, "x", Roles("y", False, True, ("x",))).collect()}
    assert wide["mean"] == (3.0, 1.0)


def test_histogram_folds_the_top_into_the_last_bin(spark):
    df = spark.createDataFrame([(0, float(v)) for v in range(11)] + [(1, None)], "y int, x double")
    rows = profile.histogram(df, Roles("y", 0, 1, ("x",)), bins=5).orderBy("bin").collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 3)]
    assert (rows[0]["lower"], rows[-1]["upper"]) == (0.0, 10.0)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(0, 3.0), (1, 3.0)], "y int, x double")
    assert [(r["bin"], r["n"]) for r in profile.histogram(df, Roles("y", 0, 1, ("x",))).collect()] == [(1, 1), (1, 1)]


def test_histogram_without_values(spark):
    with pytest.raises(ValueError):
        profile.histogram(spark.createDataFrame([(0, None)], "y int, x double"), Roles("y", 0, 1, ("x",)))


def test_schema_table(df):
    assert [tuple(r) for r in profile.schema_table(df).orderBy("position").collect()] == [
        (0, "y", "int", True), (1, "x", "double", True), (2, "a", "string", True), (3, "b", "int", True),
    ]


def test_one_row(spark):
    rows = spark.createDataFrame([(1, "a", "b", 2)], "n int, s string, t string, l bigint")
    assert profile.row_count(rows).first()["n_rows"] == 1


def test_roles_are_checked(df):
    with pytest.raises(ValueError, match="nowhere"):
        profile.crosstab(df, Roles("y", 0, 1, (), ("nowhere",)))
    with pytest.raises(ValueError, match="more than one role"):
        Roles("y", 0, 1, ("x",), ("x",))
    with pytest.raises(ValueError, match="differ"):
        Roles("y", 0, 0)


def test_crosstab_by_all_labels(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), (None, "y"), ("a b.c", None)], "y string, k string")
    roles = Roles("y", "a", "b", categorical=("k",))
    found = profile.crosstab_by_label(df, roles)
    assert found.columns == ["feature", "value", "n_a", "n_a b.c", "n_b", "n_null"]
    assert sorted((tuple(r)[1:] for r in found.collect()), key=repr) == [("x", 1, 0, 1, 0), ("y", 0, 0, 1, 1), (None, 0, 1, 0, 0)]
    with pytest.raises(ValueError, match="more than 2"):
        profile.crosstab_by_label(df, roles, max_labels=2)
    with pytest.raises(ValueError, match="null"):
        profile.crosstab_by_label(df.union(spark.createDataFrame([("null", "x")], df.schema)), roles)


def test_one_pass_gives_the_rows_of_the_separate_reports(spark):
    """Infinities, NaN, nulls, a third class, an empty class and far-off values."""
    nan, inf = float("nan"), float("inf")
    rows = [("n", x, 1e9 + x) for x in (1.0, 2.5, -0.0, 4.0)] + [("p", x, 1e9 - x) for x in (nan, inf, 3.0, -inf)]
    rows += [("p", None, 1e9), ("other", 100.0, 5.0), (None, -100.0, None)]
    df = spark.createDataFrame(rows, "y string, x double, z double").withColumn("k", F.col("x") > 2).repartition(4)
    roles = Roles("y", "n", "p", ("x", "z"), ("k",))

    def same(a, b):
        def cells(t):
            return sorted((tuple("nan" if isinstance(v, float) and v != v else round(v, 6) if isinstance(v, float) else v for v in r) for r in t.select(b.columns).collect()), key=repr)

        assert cells(a) == cells(b)

    seen = overview(df, roles)
    same(seen.row_count(), profile.row_count(df))
    same(seen.described(), profile.describe_by_class(df, roles))
    crossed, binned = profile.counted(df, roles, seen.finite_ranges())
    same(crossed, profile.crosstab(df, roles))
    same(binned, profile.histogram(df, roles))
    assert overview(df.where("false"), roles).row_count().first()[0] == 0
