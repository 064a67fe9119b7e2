import random
import time

import pytest
from pyspark.sql import functions as F
from tests.llm.brute import contamination as brute

from haulgrid.llm import decontaminate
from haulgrid.llm.decontaminate import contamination

ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta"), (2, "Beta-Gamma, delta epsilon zeta eta theta"), (3, "omega"),
    (10, "one TWO"), (10, "three four five six"), (None, "alpha"), (4, None), (5, " .,"), (1, "alpha beta gamma delta epsilon zeta"),
    (6, "É é ß x y z w v"),
]


def documents():
    random.seed(4)
    parts = [text for _, text in ITEMS if text] + ["filler words here", "alpha beta", "delta epsilon zeta eta", "é"]
    rows = [(i, " ".join(random.choice(parts) for _ in range(random.randint(0, 6)))) for i in range(60)]
    return [*rows, *rows[:5], (3, "omega one"), (None, "omega"), (90, None), (91, ""), (92, "omega " * 20_000)]


@pytest.mark.parametrize("window, gram", [(4, 2), (5, 5)])
def test_equals_brute_force(spark, window, gram):
    rows = documents()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, words string, n_hit int")
    items = spark.createDataFrame([(i, t, "y") for i, t in ITEMS], "item_id long, text string, window string")
    found = contamination(docs, items, window, gram)
    got = [(r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, ITEMS, window), key=repr)


def test_no_documents_and_no_items(spark):
    docs = spark.createDataFrame([(1, "omega")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert contamination(docs.limit(0), items).count() == 0
    assert [(r.n_words, r.n_hit, r.item_ids) for r in contamination(docs, items.limit(0)).collect()] == [(1, 0, [])]


def in_lambdas(plan):
    """The text of every lambda function in a plan."""
    found = []
    for part in plan.split("lambdafunction(")[1:]:
        depth = 1
        for at, letter in enumerate(part):
            depth += (letter == "(") - (letter == ")")
            if not depth:
                found.append(part[:at])
                break
    return found


@pytest.mark.parametrize("lengths", [[10], [1], [1, 2, 10]])
def test_no_text_is_split_again_for_each_gram(spark, lengths):
    docs = spark.createDataFrame(documents(), "doc_id long, text string").withColumn("text_hash", F.xxhash64("text"))
    places = "array<struct<length:int,hash:bigint,at:int>>"
    matched = docs.select("doc_id", "text_hash", F.lit(None).cast(places).alias("places"))
    for rows in (decontaminate.prints(docs, lengths, 10, 5), decontaminate.around(docs, matched, 10, 5)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        lambdas = in_lambdas(plan)
        assert lambdas and not any("regexp_extract_all" in part for part in lambdas)
        assert plan.count("regexp_extract_all") == 1


def test_short_items_and_a_long_text_take_seconds(spark):
    docs = spark.createDataFrame([(1, "omega " * 20_000), (2, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "omega"), (2, "omega omega")], "item_id long, text string")
    started = time.monotonic()
    found = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in contamination(docs, items).collect()}
    assert found == {1: (20_000, 20_000, ["1", "2"]), 2: (1, 0, [])}
    assert time.monotonic() - started < 60


def test_plan_runs_no_python(spark):
    docs = spark.createDataFrame(documents(), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    plan = contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
