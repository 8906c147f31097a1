"""Running totals and distances against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from tabloom import Roles
from tabloom.functions.normal import normal_cdf
from tabloom.operators import distance, profile
from tabloom.operators.cumulative import Series, cumulative_weights

ROLES = Roles("y", "no", "yes", ("x",))


def frame(spark, rows):
    return spark.createDataFrame(rows, "x double, y string")


def brute_force(rows):
    """Distinct values with class counts and running class counts."""
    result, run = [], [0, 0]
    values = sorted({x + 0.0 for x, _ in rows if x is not None})
    for v in values:
        n = [sum(1 for x, y in rows if x == v and y == c) for c in ("no", "yes")]
        run = [a + b for a, b in zip(run, n)]
        result.append((v, *n, *run))
    return result


def computed(df, buckets=None):
    rows = distance.class_counts(df, ROLES, buckets).orderBy("value").collect()
    return [(r["value"], r["n0"], r["n1"], r["cum_n0"], r["cum_n1"]) for r in rows]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.one_of(st.none(), st.integers(-4, 4).map(float), st.floats(-1e6, 1e6)), st.sampled_from(["no", "yes"])),
        min_size=1,
        max_size=60,
    ),
    st.integers(2, 9),
)
def test_equals_brute_force(spark, rows, buckets):
    assert computed(frame(spark, rows), buckets) == brute_force(rows)


def test_a_third_of_the_rows_share_one_value(spark):
    rows = [(7.0, "no")] * 3000 + [(7.0, "yes")] * 1000 + [(float(i % 2003), "yes" if i % 3 else "no") for i in range(8000)]
    df = frame(spark, rows)
    assert computed(df, 16) == brute_force(rows)
    assert computed(df.repartition(7), 5) == brute_force(rows)


def test_negative_zero_is_zero(spark):
    rows = [(-0.0, "no"), (0.0, "yes"), (1.0, "no"), (-1.0, "yes")]
    assert computed(frame(spark, rows), 4) == [(-1.0, 0, 1, 0, 1), (0.0, 1, 1, 1, 2), (1.0, 1, 0, 2, 2)]


def test_nan_and_infinities_have_a_place(spark):
    rows = [(math.nan, "no"), (math.inf, "yes"), (-math.inf, "no"), (2.0, "yes")]
    got = computed(frame(spark, rows), 4)
    assert [g[1:] for g in got] == [(1, 0, 1, 0), (0, 1, 1, 1), (0, 1, 1, 2), (1, 0, 2, 2)]
    assert math.isnan(got[-1][0])


def test_several_series_at_once(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.lit(1).alias("one"))
    totals = cumulative_weights(df, [Series(c, c, {"n": F.col("one")}) for c in ("a", "b")], 8)
    got = {(r["series"], r["value"]): r["cum_n"] for r in totals.collect()}
    assert len(got) == 1007
    assert all(got[("a", float(i))] == i + 1 for i in range(1000))
    assert got[("b", 6.0)] == 1000 and got[("b", 0.0)] == 143


def test_series_need_the_same_weights(spark):
    df = frame(spark, [(1.0, "no")])
    with pytest.raises(ValueError):
        cumulative_weights(df, [Series("a", "x", {"n": F.lit(1)}), Series("b", "x", {"m": F.lit(1)})])


def test_empty_input(spark):
    assert computed(frame(spark, []), 4) == []


def test_normal_cdf_is_accurate(spark):
    rows = spark.range(-4000, 4001).select((F.col("id") / 500.0).alias("x")).select("x", normal_cdf(F.col("x")).alias("p")).collect()
    assert max(abs(r.p - 0.5 * math.erfc(-r.x / math.sqrt(2))) for r in rows) < 1e-15


def test_known_normal_distance(spark):
    df = frame(spark, [(float(x), c) for c in ("no", "yes") for x in (1, 2, 3)])
    got = distance.ks_normal(distance.class_counts(df, ROLES), profile.describe_by_class(df, ROLES), ROLES, "own").collect()
    assert [round(r["ks_statistic"], 10) for r in got] == [0.1746780794] * 2


@pytest.mark.parametrize("fit", ["class0", "own"])
def test_normal_distance_equals_mllib(spark, fit):
    rng = np.random.default_rng(5)
    rows = [(float(v), "no") for v in np.round(rng.normal(3, 2, 400), 1)] + [(float(v), "yes") for v in rng.exponential(2, 300)]
    df = frame(spark, rows)
    described = {r["label"]: r for r in profile.describe_by_class(df, ROLES).collect()}
    got = {r["label"]: r for r in distance.ks_normal(distance.class_counts(df, ROLES), profile.describe_by_class(df, ROLES), ROLES, fit).collect()}
    for label in ROLES.class_names:
        moments = described["no" if fit == "class0" else label]
        expected = KolmogorovSmirnovTest.test(df.where(F.col("y") == label), "x", "norm", moments["mean"], moments["stddev"]).first()
        assert got[label]["ks_statistic"] == pytest.approx(expected["statistic"], abs=1e-12)
        assert got[label]["p_value"] == pytest.approx(expected["pValue"], abs=0.02)


def test_no_spread_gives_null(spark):
    df = frame(spark, [(5.0, "no")] * 4 + [(1.0, "yes"), (2.0, "yes")])
    rows = distance.ks_normal(distance.class_counts(df, ROLES), profile.describe_by_class(df, ROLES), ROLES, "own").collect()
    got = {r["label"]: (r["ks_statistic"], r["p_value"]) for r in rows}
    assert got["no"] == (None, None) and None not in got["yes"]


def test_two_sample_distance(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(0, 1, 500), np.round(rng.normal(0.3, 1, 700), 1)
    df = frame(spark, [(float(v), "no") for v in a] + [(float(v), "yes") for v in b])
    points = np.concatenate([a, b])
    expected = max(abs((a <= p).mean() - (b <= p).mean()) for p in points)
    assert distance.ks_two_sample(distance.class_counts(df, ROLES)).first()["ks_statistic"] == pytest.approx(expected, abs=1e-12)


def test_report_holds_every_statistic(spark):
    df = frame(spark, [(float(i), "no" if i % 3 else "yes") for i in range(60)])
    rows = {r["statistic"]: r for r in distance.numeric_report(df, ROLES).collect()}
    assert set(rows) == {"count", "mean", "stddev", "min", "max", "ks_normal", "ks_two_sample"}
    assert (rows["count"]["class_0"], rows["count"]["class_1"]) == (40.0, 20.0)


def test_longs_beyond_double_precision_stay_apart(spark):
    top = 2**53
    rows = [(top, "no"), (top + 1, "yes"), (top + 1, "yes"), (top + 2, "no"), (2**63 - 1, "yes"), (-(2**63), "no")]
    counts = distance.class_counts(spark.createDataFrame(rows, "x long, y string"), ROLES)
    found = sorted((r["cum_n0"], r["cum_n1"], r["n0"], r["n1"]) for r in counts.collect())
    assert found == [(1, 0, 1, 0), (2, 0, 1, 0), (2, 2, 0, 2), (3, 2, 1, 0), (3, 3, 0, 1)]


def test_offsets_that_are_joined_give_the_same(spark, monkeypatch):
    df = frame(spark, [(float(i * 7 % 101), "yes" if i % 3 else "no") for i in range(1000)])
    wanted = computed(df)
    monkeypatch.setattr("tabloom.operators.cumulative.BROADCAST_ROWS", 0)
    assert computed(df) == wanted
