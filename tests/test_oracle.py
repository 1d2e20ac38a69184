"""Every query equals its SQL counterpart on the smallest test tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


TRAINED = {"train_eval", "feature_importance", "score_profiles"}


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - TRAINED))
def test_query_equals_sql(spark, con, name):
    assert compare(queries()[name](spark, SMALL), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(TRAINED & set(oracle_sql())))
def test_trained_query_equals_sql(spark, name):
    """On tables large enough for forests."""
    assert compare(queries()[name](spark, MEDIUM), connect(MEDIUM), oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_signals(spark):
    assert entry(spark).count() > 0
