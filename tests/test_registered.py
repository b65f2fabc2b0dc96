"""Every registered query against its SQL, on the smallest driver data."""

from pathlib import Path

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries
from tremorlake.checks.oracles import ORACLES
from tremorlake.checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Trains three hundred trees; its parts are covered by test_model.
SLOW = {"train_variations"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver data is absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() == 49


def test_only_models_go_without_sql():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLES) == {"train_gbt", "train_variations", "batch_score", "feature_importance"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None
