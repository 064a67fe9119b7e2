"""The queries that SQL can express against their statements."""

import pytest

from compare import connect, difference
from haulgrid.llm.queries import QUERIES, STATEMENTS

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_rows_match(spark, name):
    rows = QUERIES[name](spark, SMALL)
    result = connect(SMALL).execute(STATEMENTS[name])
    names = [d[0] for d in result.description]
    assert difference(rows.collect(), rows.columns, result.fetchall(), names) is None


def test_names():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{i}" for i in range(1, 14)]
