import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paddock.session import local_session  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("4", partitions=4, memory="4g")


@pytest.fixture(scope="session")
def tables(spark):
    from paddock.sources.derived import derived_tables

    return derived_tables(spark, TESTDATA)


def rows(df, *columns):
    """Rows of a small result as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
