"""Every named query of the library against its SQL, on the smallest data folder.

The training-data operators are an add-on with tests of their own.
"""

from __future__ import annotations

import __spark_entry__ as entry
import oracles
import pytest
from compare import connect, difference
from ledgerlift.plans import registry

QUERIES = registry.build()
SQL = oracles.build()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= entry.queries().keys() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, duck, name):
    problem, rows = difference(QUERIES[name](spark, small), duck, SQL[name])
    assert problem is None
    assert rows > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["felt", "beloep", "sekvensnummer"]
    assert df.count() == 458
