"""Every query against its DuckDB counterpart on the small tables."""

import pytest

from conftest import TESTDATA
from registry.compare import connect, difference
from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(TESTDATA)


def test_every_counterpart_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, TESTDATA).toPandas()
    assert difference(got, duck.sql(ORACLE[name]).df()) is None
    assert len(got) > 0 or name == "check_range"
