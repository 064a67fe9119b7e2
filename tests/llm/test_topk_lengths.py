"""Vectors of unlike lengths are as if they ended in zeros."""

import numpy as np

from haulgrid.llm.topk import best


def test_unlike_lengths_against_brute_force(spark):
    random = np.random.default_rng(6)
    vectors = [random.integers(-256, 257, size).tolist() for size in [8, 3, 5, 16, 1, 0, 7, 12] * 5]
    rows = spark.createDataFrame(list(enumerate(vectors)), "vid long, vector array<long>")
    queries = rows.where("vid % 4 = 1").withColumnRenamed("vid", "qid")
    found = {}
    for r in best(queries, rows, 5, 2).collect():
        found.setdefault(r.qid, []).append((-r.score, r.vid))
    score = [[sum(x * y for x, y in zip(a, b)) for b in vectors] for a in vectors]
    wanted = {q: sorted((-s, v) for v, s in enumerate(score[q]))[:5] for q in range(1, 40, 4)}
    assert {q: sorted(rows) for q, rows in found.items()} == wanted
