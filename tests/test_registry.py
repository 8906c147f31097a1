"""Every query with SQL must give the rows DuckDB gives."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from check_registry import connect, differences

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert differences(spark, con, name, contract.queries()[name], SQL[name], sf_dir) is None


@pytest.mark.parametrize("name", ["fitted_stages", "model_scores", "explore_job", "saved_models_score", "score_job"])
def test_query_gives_rows(spark, sf_dir, name):
    assert contract.queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    rows = {r["metric"]: r["value"] for r in contract.entry(spark).collect()}
    assert rows["area_under_roc"] > 0.85
    assert set(rows) == {
        "area_under_pr", "area_under_roc", "log_loss", "false_positives", "true_positives", "true_negatives", "false_negatives",
    }
