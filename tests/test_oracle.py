"""Every registered query beside its SQL at the smallest scale."""

import pytest

from corpusprep.queries import ORACLES, QUERIES
from tests.conftest import SF
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
