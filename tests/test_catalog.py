"""Every catalog query against its SQL, or at least for rows."""

import oracle
import pytest

from tallymark.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("key", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, key):
    df = catalog.QUERIES[key](spark, FOLDER)
    assert oracle.differences(df, duck, catalog.ORACLES[key]) == []


@pytest.mark.parametrize("key", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, key):
    assert catalog.QUERIES[key](spark, FOLDER).count() > 0
