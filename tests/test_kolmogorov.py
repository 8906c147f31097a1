"""p-values of distances: tables, enumeration, and agreement with the limit."""

from __future__ import annotations

from itertools import combinations
from math import comb

import pytest
from pyspark.sql import functions as F

from tabloom import Roles
from tabloom.functions import kolmogorov
from tabloom.operators import distance, profile


@pytest.mark.parametrize(("n", "critical"), [(3, 0.70760), (4, 0.62394), (5, 0.56328), (10, 0.40925), (15, 0.33760), (20, 0.29408)])
def test_one_sample_critical_values(n, critical):
    """The published two-sided 5 % points."""
    assert kolmogorov.one_sample_p_value(critical, n) == pytest.approx(0.05, abs=2e-4)


def test_one_sample_by_hand():
    assert kolmogorov.one_sample_p_value(0.7, 1) == pytest.approx(0.6)  # 2 (1 - d)
    assert kolmogorov.one_sample_p_value(0.8, 2) == pytest.approx(0.08)  # 2 (1 - d)^2 beyond 1 - 1/n
    assert kolmogorov.one_sample_p_value(0.9, 3) == pytest.approx(0.002)
    assert kolmogorov.one_sample_p_value(0.1, 3) == 1.0 and kolmogorov.one_sample_p_value(1.0, 3) == 0.0


def enumerated(d, n, m):
    """Share of all orders of the pooled draws whose distance is at least d."""
    hits = 0
    for mine in combinations(range(n + m), n):
        i = j = 0
        worst = 0.0
        for k in range(n + m):
            if k in mine:
                i += 1
            else:
                j += 1
            worst = max(worst, abs(i / n - j / m))
        hits += worst >= d - 1e-12
    return hits / comb(n + m, n)


@pytest.mark.parametrize(("n", "m"), [(1, 1), (3, 3), (4, 4), (2, 5), (6, 4)])
def test_two_sample_equals_enumeration(n, m):
    for d in sorted({abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)}):
        assert kolmogorov.two_sample_p_value(d, n, m) == pytest.approx(enumerated(d, n, m), abs=1e-12)
    assert kolmogorov.two_sample_p_value(1.0, 3, 3) == pytest.approx(0.1)


def test_exact_values_approach_the_limit(spark):
    rows = [(0.15, 99), (0.13, 100), (0.12, 60)]
    df = spark.createDataFrame(rows, "d double, n long").select("d", "n", kolmogorov.one_sample(F.col("d"), F.col("n")).alias("p"))
    for d, n, p in df.collect():
        limit = spark.range(1).select(kolmogorov.limiting_p_value(F.lit(d * n**0.5))).first()[0]
        assert p == pytest.approx(limit, abs=0.06) and (p == limit) == (n >= kolmogorov.EXACT_ROWS)
    pair = spark.range(1).select(kolmogorov.two_sample(F.lit(0.2), F.lit(90), F.lit(100)).alias("a"), kolmogorov.two_sample(F.lit(0.2), F.lit(100), F.lit(100)).alias("b"))
    exact, limit = pair.first()
    assert exact == pytest.approx(kolmogorov.two_sample_p_value(0.2, 90, 100)) and exact == pytest.approx(limit, abs=0.02)


def test_tests_of_small_tables(spark):
    df = spark.createDataFrame([("n", 1.0), ("n", 2.0), ("n", 3.0), ("p", 4.0), ("p", 5.0), ("p", 6.0)], "y string, x double")
    roles = Roles("y", "n", "p", numeric=("x",))
    counts = distance.class_counts(df, roles)
    assert tuple(distance.ks_two_sample_test(counts).first()) == ("x", 1.0, 3, 3, pytest.approx(0.1))
    normal = distance.ks_normal(counts, profile.describe_by_class(df, roles), roles, "own").collect()
    for r in normal:
        assert r["p_value"] == pytest.approx(kolmogorov.one_sample_p_value(r["ks_statistic"], 3))
    one = distance.ks_two_sample_test(distance.class_counts(df.where("y = 'n'"), roles)).first()
    assert one["ks_statistic"] is None and one["p_value"] is None
