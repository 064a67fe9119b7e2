"""Near words and forms against brute force, and the machines themselves."""

import itertools
import random
import zlib
from collections import Counter

import pytest

from haulgrid.llm import spelling
from haulgrid.llm.spelling import Acceptor, composed, near_words, variants

KINDS = "word string, n long, near string, key string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=spelling.RATIO):
    """[(word, n, n_near, form, form_n, root)] of {word: n}."""
    links = {a: [b for b in counts if near(a, b)] for a in counts}
    form = {}
    for word, others in links.items():
        best = min(others, key=lambda other: (-counts[other], other), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    out = []
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.append((word, n, len(links[word]), form[word], counts.get(form[word]), root))
    return out


def vocabularies():
    random.seed(13)
    some = {"".join(random.choice("abé") for _ in range(random.randint(1, 7))) for _ in range(300)}
    long = "".join(random.choice("abcdefgh") for _ in range(4000))
    odd = {long, long[:70] + "x" + long[70:], long[:3000] + long[3001:], long + "a", "aaaaaa", "aaaaa", "aaaaaaa", "÷×"}
    hot = {"prefix" + "".join(tail) for tail in itertools.product("abc", repeat=4)} | {"prefix" + t for t in "abcd"}
    return {"small": some, "odd": odd, "hot": hot, "one": {"a"}}


@pytest.mark.parametrize("cell", [5, 5000])
@pytest.mark.parametrize("name", list(vocabularies()))
def test_equals_brute_force(spark, name, cell):
    counts = {word: random.Random(word).choice([1, 1, 5, 6, 30, 31, 200]) for word in vocabularies()[name]}
    rows = [(word, n, "x", "y") for word, n in counts.items()]
    words = spark.createDataFrame([*rows, (None, 3, "x", "y")], KINDS)
    found = [tuple(row) for row in variants(words, cell=cell).collect()]
    assert sorted(found) == sorted(brute(counts))


def test_pairs_come_once(spark):
    words = spark.createDataFrame([(word, 1, "", "") for word in vocabularies()["small"]], KINDS)
    found = [tuple(row)[:2] for row in near_words(words, 20).collect()]
    every = vocabularies()["small"]
    assert sorted(found) == sorted((a, b) for a in every for b in every if near(a, b))


def test_acceptor_is_minimal():
    acceptor = Acceptor()
    first = acceptor.initial(sorted(["tap", "taps", "top", "tops"]))
    assert len(acceptor.register) == 5  # after t, a or o, p, s
    assert acceptor.initial(["tap", "taps", "top", "tops"]) is first
    assert sorted(composed(acceptor.initial([]), first, 9)) == [("tap", "top"), ("taps", "tops")]


def test_no_words(spark):
    assert variants(spark.createDataFrame([], KINDS)).count() == 0


def test_whole_query_on_a_fixture(spark, tmp_path):
    random.seed(1)
    base = ["straße", "strasse", "Running", "runnings", "abcdef", "été", "Montréal", "a×÷b√c"]
    rows = [(i, " ".join(random.choice(base) for _ in range(random.randint(0, 60))) + ", don't_stop!") for i in range(300)]
    rows += [(None, "running " * 9), (5, None), (6, ""), (7, "x" * 50_000), rows[0], rows[0]]
    spark.createDataFrame([(*row, "en") for row in rows], "doc_id long, text string, run string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    counts = Counter()
    for doc_id, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if "a" <= c <= "z" or "À" <= c <= "ÿ" else " " for c in lower).split(" "):
            if run:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                counts[run[:h % len(run)] + run[h % len(run) + 1:] if doc_id is not None and h % 199 == 0 else run] += 1
    counts = {word: n for word, n in counts.items() if len(word) >= 6 and n >= 5}
    assert len(counts) > 6
    found = spelling.op13_spelling(spark, str(tmp_path))
    wanted = [(word, form, root, n, n_near, form_n) for word, n, n_near, form, form_n, root in brute(counts)]
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
