"""Every registered query against its SQL on the supplied tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from riskloom.catalog import spark_queries
from riskloom.catalog.oracle_queries import ORACLES
from riskloom.catalog.spark_queries import QUERIES
from riskloom.operators.boosting import BoostParams


@pytest.fixture(scope="module", autouse=True)
def few_rounds():
    """The SQL states what holds of any model, so tests spare the 200 rounds of the registered queries."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(spark_queries, "PARAMS", BoostParams(n_estimators=4))
        yield


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, folder, con, name):
    assert differences(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
