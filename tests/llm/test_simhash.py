import random

import numpy as np
import pytest
from tests.llm.brute import components as brute_components
from tests.llm.brute import grouped, simhash

from haulgrid.llm.components import components
from haulgrid.llm.simhash import GrayIndex, fingerprint, gray_rank, links, near_duplicates, one_of_each

TEXT = "The quick brown fox jumps over the lazy dog while Éva reads\tone\nlong book about " * 4


def documents():
    words = TEXT.split()
    near = " ".join(words[:-1] + ["novel"])
    rows = [
        (5, TEXT), (3, TEXT), (3, TEXT), (9, near), (8, None), (7, ""), (6, " \n\t"), (None, TEXT), (11, "one"),
        (12, "ONE"), (13, "one two"), (14, "x " * 50_000), (15, "x " * 50_001), (16, "ß ſ É é"), (None, "alone here"),
    ]
    random.seed(2)
    return rows + [(20 + i, " ".join(random.choice("abcdefgh") for _ in range(30))) for i in range(20)]


def close_prints(number=1200):
    random = np.random.default_rng(1)
    found = []
    for base in random.integers(0, 2**63, 20, dtype=np.uint64):
        for _ in range(number // 20):
            value = int(base)
            for bit in random.integers(0, 64, random.integers(0, 5)):
                value ^= 1 << int(bit)
            found.append(value)
    return np.unique(np.array(found, np.uint64))


@pytest.mark.parametrize("text", [row[1] for row in documents()[:15]])
def test_fingerprint(text):
    assert fingerprint(text) == simhash(text)


def test_gray_order_is_that_of_the_code():
    rank = np.arange(4096, dtype=np.uint64)
    code = rank ^ (rank >> np.uint64(1))
    assert (gray_rank(code) == rank).all()


def test_index_finds_all_close_pairs():
    prints = close_prints()
    cell = np.arange(len(prints)) % 3
    index = GrayIndex(cell, prints)
    found = {
        frozenset((int(index.prints[a]), int(index.prints[b]))) for one, other in index.pairs(3)
        for a, b in zip(one, other)
    }
    wanted = {
        frozenset((int(prints[i]), int(prints[j]))) for i in range(len(prints)) for j in range(i)
        if cell[i] == cell[j] and bin(int(prints[i] ^ prints[j])).count("1") <= 3
    }
    assert found == wanted


@pytest.mark.parametrize("cell", [8192, 4])  # 4: through all levels of nodes, and chunks
def test_links_connect_what_is_close(spark, cell):
    prints = close_prints(400).view(np.int64)
    table = spark.createDataFrame([(int(x),) for x in prints], "fp long")
    root = {r.node: r.root for r in components(links(table, 3, cell)).collect()}
    order = np.sort(prints)
    wanted = grouped(len(order), [
        (i, j) for i in range(len(order)) for j in range(i)
        if bin((int(order[i]) ^ int(order[j])) & (2**64 - 1)).count("1") <= 3
    ])
    assert [root.get(int(x), int(x)) for x in order] == [int(order[g]) for g in wanted]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    table = spark.createDataFrame(chain, "a long, b long")
    root = {r.node: r.root for r in components(table).collect()}
    assert root == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, 201: 200}
    assert components(table.limit(0)).count() == 0


def test_near_duplicates(spark):
    rows = documents()
    table = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int")
    found = [(r.doc_id, r.fp % 2**64, r.component_id) for r in near_duplicates(table).collect()]
    key = repr
    assert sorted(found, key=key) == sorted(brute_components(rows), key=key)


def test_one_of_each(spark):
    rows = documents()
    kinds = "doc_id long, text string, node string"
    found = one_of_each(spark.createDataFrame([(i, t, "x") for i, t in rows], kinds))
    wanted = {i for i, _, c in brute_components(rows) if i is not None and i == c}
    ids = [r.doc_id for r in found.collect()]
    assert found.columns == ["doc_id", "text", "node"]
    assert sorted(i for i in ids if i is not None) == sorted(wanted) and ids.count(None) == 2
    assert one_of_each(spark.createDataFrame([], kinds)).count() == 0
