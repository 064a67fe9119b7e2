"""Verdicts on generated answers, each written out."""

import pytest

from haulgrid.functions.responses import classified

# (response, verdict, cleaned text, reason)
CASES = [
    ("UNSUPPORTED: no such column ", "unsupported", None, "no such column"),
    ("unsupported: lower case", "not_select", None, None),
    (" \n UNSUPPORTED:", "unsupported", None, ""),
    ("UNSUPPORTED", "not_select", None, None),
    ("SELECT 1", "accepted", "SELECT 1", None),
    ("select", "accepted", "select", None),
    ("selection of loads", "not_select", None, None),
    ("select_1", "not_select", None, None),
    ("with a as (select 1) select * from a;", "accepted", "with a as (select 1) select * from a;", None),
    ("WITH\tx", "accepted", "WITH\tx", None),
    ("  select 1 ;; ", "accepted", "select 1 ;;", None),
    ("select 1; select 2", "multi_statement", None, None),
    ("select ';' from t", "multi_statement", None, None),
    ("select 1;;;", "accepted", "select 1;;;", None),
    ("```sql\nselect 1\n```", "accepted", "select 1", None),
    ("```SQL select 1```", "accepted", "select 1", None),
    ("```\nselect 1;\n```", "accepted", "select 1;", None),
    ("``` select 1; ```", "accepted", "select 1;", None),
    ("```select 1", "accepted", "select 1", None),
    ("select 1\n```", "accepted", "select 1", None),
    ("```python\nselect 1\n```", "not_select", None, None),
    ("```sql\n```", "not_select", None, None),
    ("```", "not_select", None, None),
    ("select load_count from t", "accepted", "select load_count from t", None),
    ("select Load from t", "not_read_only", None, None),
    ("select 'drop' from t", "not_read_only", None, None),
    ("select dropped", "accepted", "select dropped", None),
    ("select a.update.b", "not_read_only", None, None),
    ("select truncate(1)", "not_read_only", None, None),
    ("select create\xe9", "accepted", "select create\xe9", None),
    ("select \xe9copy", "accepted", "select \xe9copy", None),
    ("select \xe9 copy", "not_read_only", None, None),
    ("select call_1", "accepted", "select call_1", None),
    ("select x -- DELETE", "not_read_only", None, None),
    ("\xa0select 1\xa0", "accepted", "select 1", None),
    ("\u2003UNSUPPORTED: x\u3000", "unsupported", None, "x"),
    ("select\xa01", "accepted", "select\xa01", None),
    ("select\xe9 1", "not_select", None, None),
    ("\u017felect 1", "accepted", "\u017felect 1", None),
    ("select in\u017fert", "not_read_only", None, None),
    ("explain select 1", "not_select", None, None),
    ("", "not_select", None, None),
    ("   ", "not_select", None, None),
    ("a" * 5000, "not_select", None, None),
    ("select " + " " * 20000 + "x", "accepted", "select " + " " * 20000 + "x", None),
    ("select 1" + ";" * 5000 + "x", "multi_statement", None, None),
    ("select '\x1c'", "accepted", "select '\x1c'", None),
    ("\x1fselect 1\x1e", "accepted", "select 1", None),
    ("select \U0001d41dload", "accepted", "select \U0001d41dload", None),
    ("select drop\U0001d7ce", "accepted", "select drop\U0001d7ce", None),
    (None, None, None, None),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = spark.createDataFrame([(i, case[0]) for i, case in enumerate(CASES)], "i int, response string")
    return {r.i: (r.verdict, r.cleaned, r.reason) for r in classified(rows, "response").collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_verdict(verdicts, i):
    assert verdicts[i] == CASES[i][1:]
