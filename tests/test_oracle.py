"""Every registered query against its DuckDB statement on the small tables."""

import pytest

from __spark_entry__ import entry
from compare import connect, difference
from haulgrid.plans import registry
from oracle_queries import STATEMENTS
from tests.conftest import SMALL

QUERIES = registry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_rows_match(spark, duck, name):
    rows = QUERIES[name](spark, SMALL)
    result = duck.execute(STATEMENTS[name])
    names = [d[0] for d in result.description]
    assert difference(rows.collect(), rows.columns, result.fetchall(), names) is None


def test_every_query_has_a_statement():
    assert set(STATEMENTS) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 5
