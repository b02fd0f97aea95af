"""Every query with an oracle against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from tallyfold.plans.catalogue import REGISTRY

SF = "/root/testdata/sf0.001"
SLOW = {"train_rf", "train_kfold", "select_rfe", "select_stepwise", "synth_gmm", "fair_mitigate_egr"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is not None])
def test_matches_sql(spark, con, name):
    assert difference(REGISTRY[name].run(spark, SF), con, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is None and n not in SLOW])
def test_rows_only(spark, name):
    assert REGISTRY[name].run(spark, SF).limit(1).count() == 1


def test_contract(spark):
    assert contract.entry(spark).count() == 20
    assert set(contract.oracle_sql()) <= set(contract.queries())
