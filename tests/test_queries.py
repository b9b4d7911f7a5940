"""Every registered query against its SQL."""

import pytest
from compare import compare, connect
from conftest import SMALL

from tablemill.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES.get(name), SMALL) is None


def test_entry_file(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
