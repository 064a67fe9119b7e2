import random

import pytest
from pyspark.sql import functions as F

from haulgrid.llm.topk import products, top_k

import numpy as np


def brute(rows, k):
    found = []
    scaled = sorted({
        (i, tuple(int(np.floor(256 * x)) for x in v)) for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    })
    for query, q in scaled:
        if query % 5:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in scaled if i != query)
        found += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(found)


def rows_with_ties():
    random.seed(1)
    same = [0.5, -0.25, 1.0]
    rows = [(i, [random.choice([-1.0, -0.5, 0.1, 0.5, 2.0]) for _ in range(3)]) for i in range(60)]
    rows += [(i, same) for i in range(60, 100)]  # copies, queries among them
    rows += rows[:5]  # repeated rows
    return rows + [
        (200, None), (205, [None, 1.0, 1.0]), (210, [float("nan"), 1.0, 1.0]),
        (215, [float("inf"), 0.0, 0.0]), (None, same), (220, []), (225, [3.0]), (230, [1.0] * 9),
    ]


@pytest.mark.parametrize("lists", [1, 3])
def test_equals_brute_force(spark, lists):
    rows = rows_with_ties()
    table = spark.createDataFrame(
        [(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, vid string, score double"
    )
    found = top_k(table, F.col("vec_id") % 5 == 0, k=4, lists=lists).collect()
    assert sorted(map(tuple, found)) == brute(rows, 4)


def test_fewer_rows_than_asked_and_none(spark):
    kinds = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], kinds)
    assert [tuple(r) for r in top_k(few, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 256 * 512)]
    assert top_k(spark.createDataFrame([], kinds), F.col("vec_id") == 0).count() == 0


def test_products_stay_exact():
    big = np.array([[2**40, 3]]), np.array([[2**20 + 1, 5]])
    assert products(*big)[0, 0] == 2**40 * (2**20 + 1) + 15
