"""Every query with checking SQL, at the smallest scale factor."""

import pytest

import __spark_entry__ as entry
from queries import check
from tests.conftest import SF

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert check.compare(got, con.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "grid_id" in df.columns
