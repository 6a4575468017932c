"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_queries import compare, database
from ledgerhub.warehouse_queries import ORACLES, QUERIES
from tests.plans_text import plan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert result.columns == [
        "GL_Account", "Entity", "API_Amount", "Staging_Amount", "Datamart_Amount", "Deviation",
    ]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    good, note = compare(result, con, ORACLES[name])
    assert good, note
    text = plan(result)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text
