import random

import numpy as np
import pytest
from tests.llm.brute import without_repeats as brute

from haulgrid.llm.fmindex import WaveletMatrix, WordIndex
from haulgrid.llm.substrings import anchors, word_hashes, without_repeats


def documents():
    random.seed(3)
    words = ["a", "b", "c", "dé", "E"]
    rows = []
    for i in range(60):
        text = random.choice([" ", "\n", " \t"]).join(random.choice(words) for _ in range(random.choice([0, 1, 5, 30, 60])))
        rows.append((random.choice([i, i, i, None, 3]), text))
    return [*rows, *rows[:10], (70, None), (71, "  "), (72, "a b " * 2000), (73, "b a " * 2000)]


@pytest.mark.parametrize("window, crowded", [(2, 2000), (5, 1)])
def test_equals_brute_force(spark, window, crowded):
    rows = documents()
    table = spark.createDataFrame(
        [(i, t, 0, "x", "y") for i, t in rows], "doc_id long, text string, n_words int, key string, _row string"
    )
    found = without_repeats(table, window, gram=2, crowded=crowded, shard_words=50)
    assert found.columns == ["doc_id", "text", "key", "_row", "n_words", "n_removed", "spans", "kept"]
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, window), key=repr)
    assert all(sum(s["to"] - s["from"] for s in r.spans) == r.n_removed for r in found.collect())


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert without_repeats(empty).count() == 0


def test_hash_of_a_word_does_not_depend_on_its_neighbours(monkeypatch):
    words = [b"one", b"two", b"one", "é".encode(), b"x" * 3000, b"one"]
    whole = word_hashes(words)
    monkeypatch.setattr("haulgrid.llm.substrings.CHUNK", 8)
    assert (whole == word_hashes(words)).all()
    assert whole[0] == whole[2] == whole[5] != whole[1]


def test_each_window_has_one_anchor_that_equal_windows_share():
    words = [random.choice([b"a", b"b", b"c"]) for _ in range(300)]
    key, first, last = anchors(words, 10, 3)
    of = {}
    for k, i, j in zip(key, first, last):
        for at in range(i, j + 1):
            assert of.setdefault(at, k) == k
    assert sorted(of) == list(range(291))
    seen = {}
    for at, k in of.items():
        assert seen.setdefault(tuple(words[at:at + 10]), k) == k


def test_ranks():
    random_ = np.random.default_rng(1)
    symbols = random_.integers(0, 37, 1000)
    matrix = WaveletMatrix(symbols, 37)
    for place in (0, 1, 64, 500, 999, 1000):
        every = np.arange(37)
        assert (matrix.rank(every, np.full(37, place)) == np.bincount(symbols[:place], minlength=37)).all()


def test_least_document_of_every_window():
    random.seed(5)
    texts = [" ".join(random.choice("abc") for _ in range(random.randint(1, 40))).encode() for _ in range(50)]
    documents_ = np.array([random.randint(0, 30) for _ in texts])
    for depth in (2, 3, 4, 5, 8):
        least = {}
        for text, document in zip(texts, documents_):
            words = text.split()
            for i in range(len(words) - depth + 1):
                span = tuple(words[i:i + depth])
                least[span] = min(least.get(span, 99), document)
        found = WordIndex(texts, documents_, depth).least_documents()
        for text, row in zip(texts, found):
            words = text.split()
            assert list(row) == [least[tuple(words[i:i + depth])] for i in range(len(words) - depth + 1)]


def test_texts_are_cut_without_going_to_python(spark):
    passage = "p q r s"
    texts = [passage, f" \x0b{passage}\x1c\t{passage}   x{passage} \n", f"a {passage} {passage} b\x85", "  ", None]
    rows = list(enumerate(texts))
    found = without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), 3, gram=2)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in found.collect()]
    assert sorted(got) == sorted(brute(rows, 3))
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    calls = [line for line in plan if "EvalPython" in line]
    assert calls and not any("text#" in line for line in calls)
