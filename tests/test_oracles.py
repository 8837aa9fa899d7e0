"""Every named query against the SQL that states its result (``ORACLE_SF_DIR`` picks another scale)."""

import os

import pytest

from __spark_entry__ import entry, queries
from compare import difference, duck
from ledgerloom.queries import ORACLES, QUERIES

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    assert difference(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
