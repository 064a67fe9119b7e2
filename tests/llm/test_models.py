"""The trained operators: held-out accuracy on the given tables, and the defined results of odd rows."""

import zlib

import numpy as np
import pytest

from haulgrid.llm import language, licenses, linear, quality, toxicity

SF = "/root/testdata/sf0.01"
ODD = [(None, "A plain line"), (-1, None), (-2, ""), (-3, " \n\t"), (-4, "123 456 !"), (-5, "word " * 60_000)]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def with_odd_rows(spark, *clashing):
    rows = spark.createDataFrame([(i, t, *["x"] * len(clashing)) for i, t in [*ODD, *ODD[:2]]],
                                 ", ".join(["doc_id long, text string", *[f"{c} string" for c in clashing]]))
    return rows


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_quality(spark):
    found = {r.doc_id: r for r in quality.op2_quality(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in table(spark, "labels").collect()}
    assert all(r.held_out == (fold(i, 4) == 2) and 0 <= r.score <= 1 for i, r in found.items())
    held = [i for i in labels if i in found and found[i].held_out]
    assert np.mean([found[i].predicted == labels[i] for i in held]) > 0.9


def test_quality_of_odd_rows_and_without_labels(spark):
    docs, labels = with_odd_rows(spark, "score", "label"), table(spark, "labels")
    found = quality.quality_scores(docs, table(spark, "documents").limit(300), labels)
    assert found.columns == ["doc_id", "text", "score", "label"]
    rows = found.collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    blank = {r.score for r in rows if not r.text}
    assert len(blank) == 1
    none = quality.quality_scores(docs, docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.quality_scores(docs.limit(0), docs, labels.limit(0)).count() == 0


def test_language(spark):
    lang = {r.doc_id: r.lang for r in table(spark, "documents").collect()}
    found = {r.doc_id: r for r in language.op4_language(spark, SF).collect()}
    assert all(r.held_out == (fold(i, 3) == 1) and 0 <= r.score <= 1 for i, r in found.items())
    held = [i for i in found if found[i].held_out]
    assert np.mean([found[i].lang_pred == lang[i] for i in held]) > 0.97


def test_language_of_odd_rows_and_without_learning(spark):
    docs = with_odd_rows(spark, "lang_pred", "score")
    learned = table(spark, "documents").select("doc_id", "text", "lang").limit(200)
    found = language.languages(docs, learned)
    assert found.columns == ["doc_id", "text", "lang_pred", "score"]
    for r in found.collect():
        assert (r.lang_pred == "und" and r.score == 0) == (r.text is None or not any(map(str.isalpha, r.text)))
    none = language.languages(docs, learned.limit(0)).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_windows_hold_every_place():
    for size in (0, 1, 3, 255, 256, 257, 509, 5000):
        data = bytes(1 + i % 250 for i in range(size))
        windows = language.windows_of(data)
        for width in language.WIDTHS:
            seen = {bytes(w[i:i + width]) for w in windows for i in range(language.WINDOW - width + 1)}
            assert {data[i:i + width] for i in range(size - width + 1)} <= seen


def test_network_responses_are_those_of_the_filters():
    network = language.Network(["a", "b"])
    window = np.random.default_rng(1).integers(0, 256, (2, language.WINDOW)).astype(np.uint8)
    network._prepare()
    for at, width in enumerate(language.WIDTHS):
        got = network._responses(window, at)
        for place in (0, 7, language.WINDOW - width):
            wanted = sum(network.filters[at][j][window[:, place + j]] for j in range(width))
            assert np.allclose(got[:, place], wanted, atol=1e-5)


def test_toxicity(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    learned = labels.where("doc_id % 5 <> 1")
    found = toxicity.toxicity(docs.select("doc_id", "text"), learned).collect()
    held = [r for r in found if r.doc_id in toxic and r.doc_id % 5 == 1]
    clean = [r for r in held if toxic[r.doc_id] == 0]
    caught = [r.toxic for r in held if toxic[r.doc_id] == 1]
    assert sum(r.toxic for r in clean) <= 0.03 * len(clean) and np.mean(caught) > 0.5


def test_toxicity_of_odd_rows_and_without_labels(spark):
    docs = with_odd_rows(spark, "toxic", "p_junk", "row")
    labels = table(spark, "labels")
    found = toxicity.toxicity(docs, labels.limit(0))
    assert found.columns == ["doc_id", "text", "row", "p_junk", "p_toxic", "p_abusive_junk", "toxic"]
    rows = found.collect()
    assert len(rows) == 8 and not any(r.toxic for r in rows)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_labels_count_the_worse(spark):
    rows = [(1, 1, 0), (1, 0, 1), (2, None, 1), (3, 1, None), (None, 0, 1), (4, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, toxicity.categories(labels).collect())) == [(1, 1, 1, 1), (4, 0, 1, 0)]


def test_logistic_regression_finds_the_signal():
    random = np.random.default_rng(2)
    rows = [sorted(set(random.integers(1, 50, 5))) + ([0] if i % 4 == 0 else []) for i in range(400)]
    labels = np.array([float(i % 4 == 0) for i in range(400)])
    weights = linear.fit(linear.SparseRows(rows, 50), labels)
    scores = linear.sigmoid(linear.SparseRows(rows, 50).scores(weights))
    assert ((scores > 0.5) == (labels == 1)).all()
    only = linear.fit(linear.SparseRows(rows, 50), np.zeros(400))
    assert (only[:-1] == 0).all() and only[-1] < -5


LINES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "note: released under the mit license, see below": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "The quick brown fox was granted a license to run.": "unknown",
    "this is the version of the work under the sun": "unknown",
    "": "unknown",
}


@pytest.fixture(scope="module")
def model(spark):
    return licenses.fit_licenses(table(spark, "documents").select("text"))


@pytest.mark.parametrize("line", list(LINES))
def test_licence_of_a_line(model, line):
    family, probability = model.classify(line)
    assert family == LINES[line] and (probability >= 0.5 or family == "unknown")


def test_licences_of_documents(spark):
    docs = spark.createDataFrame(
        [(i, t, "x", "y") for i, t in [*ODD, (1, "\n\n".join(LINES)), (1, "\n\n".join(LINES))]],
        "doc_id long, text string, families string, row string",
    )
    found = licenses.license_scan(docs)
    assert found.columns == ["doc_id", "text", "row", "n_paragraphs", "licenses", "families"]
    rows = found.collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].families == ["Apache-2.0", "CC-BY-NC", "GPL", "MIT"] and by_id[1].n_paragraphs == 7
    assert [x.place for x in by_id[1].licenses] == [0, 1, 2, 3, 4]
    assert all(not r.licenses for r in rows if r.doc_id != 1) and by_id[-1].n_paragraphs == 0
    assert licenses.license_scan(docs.limit(0)).count() == 0
