"""Every registered query against its SQL twin, on the smallest test tables."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from oreworks.workload import registered

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query_agrees_with_sql(spark, db, name):
    df = contract.queries()[name](spark, FOLDER)
    assert len(set(df.columns)) == len(df.columns)
    oracle.compare(df, db, contract.oracle_sql()[name])


def test_every_query_has_sql():
    assert set(registered()) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[-3:] == ["quality_score", "processed_timestamp", "pipeline_stage"]
