"""The chain keeps every telling feature; held-out figures; sums and stops of the fit."""

import numpy as np

from haulgrid.llm import linear, toxicity

SF = "/root/testdata/sf0.1"


def test_every_feature_above_chance_is_kept(spark):
    markers = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}q{i:03d}" for i in range(400)]
    rows = [(i, " ".join(markers), 1) for i in range(40)] + [(100 + i, f"plain words {i}", 0) for i in range(160)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert {word + toxicity.END for word in markers} <= set(toxicity.chosen_features(known, ["toxic"]))


def test_held_out_recall_and_false_positives(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    toxic = {r.doc_id: r.toxic for r in labels.where("doc_id % 5 = 1").collect()}
    held = docs.where("doc_id % 5 = 1").select("doc_id", "text")
    learned = docs.where("doc_id % 5 <> 1").select("doc_id", "text")
    found = toxicity.toxicity(held.union(learned), labels.where("doc_id % 5 <> 1")).select("doc_id", "toxic")
    rows = [r for r in found.collect() if r.doc_id in toxic]
    caught = [r.toxic for r in rows if toxic[r.doc_id] == 1]
    wrong = [r.toxic for r in rows if toxic[r.doc_id] == 0]
    assert np.mean(caught) >= 0.9 and np.mean(wrong) <= 0.005


def some_rows():
    random = np.random.default_rng(5)
    rows = [sorted({int(x) for x in random.integers(0, 30, random.integers(0, 6))}) for _ in range(200)]
    return rows, np.array([float(0 in row or random.random() < 0.2) for row in rows])


def test_sums_over_rows_and_features():
    rows, errors = some_rows()
    weights = np.arange(33.0)
    found = linear.SparseRows(rows, 32)  # the last features are in no row
    assert np.allclose(found.scores(weights), [sum(weights[x] for x in row) + 32 for row in rows])
    wanted = [sum(e for e, row in zip(errors, rows) if x in row) for x in range(32)]
    assert np.allclose(found.gradient(errors), [*wanted, errors.sum()])


def test_counts_stand_for_repeated_rows():
    rows, labels = some_rows()
    times = np.arange(200) % 3 + 1
    again = [row for row, n in zip(rows, times) for _ in range(n)]
    one = linear.fit(linear.SparseRows(rows, 30), labels, times.astype(float))
    other = linear.fit(linear.SparseRows(again, 30), np.repeat(labels, times))
    assert np.allclose(one, other, atol=1e-6)


def test_the_fit_goes_on_until_it_is_flat():
    rows, labels = some_rows()
    found = linear.SparseRows(rows, 30)
    weights = linear.fit(found, labels)
    slope = found.gradient((linear.sigmoid(found.scores(weights)) - labels) / len(rows))
    slope[:-1] += 1e-4 * weights[:-1]
    assert np.abs(slope).max() < 1e-5
    assert (weights == linear.fit(found, labels, steps=10_000)).all()
