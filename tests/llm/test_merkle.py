"""The manifest against a plain restatement, and cases without an answer in the given tables."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from haulgrid.llm import merkle
from haulgrid.llm.merkle import FANOUT, FIELDS, manifest

KINDS = "doc_id long, source string, lang string, n_chars long, text string, number int, digest string, family string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([sha("".join(last[at:at + FANOUT])) for at in range(0, len(last), FANOUT)])
    return found


def steps(found, at):
    """[(run, slot)] from a node at the bottom to the top."""
    out = []
    for nodes in found[:-1]:
        first = at - at % FANOUT
        out.append((nodes[first:first + FANOUT], at - first))
        at //= FANOUT
    return out


def brute(rows, changed):
    """[(doc_id, leaf, subroot, root, proof, folded_root)] of rows of the fields; changed gives texts."""
    families = {}
    for row in rows:
        families.setdefault(row[2], []).append((row[0], leaf(row), row))
    names = sorted(families, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for name in names:
        families[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[name] = levels([digest for _, digest, _ in families[name]])
    top = levels([trees[name][-1][0] for name in names])
    out = []
    for rank, name in enumerate(names):
        for at, (doc_id, digest, row) in enumerate(families[name]):
            path = steps(trees[name], at) + steps(top, rank)
            text = changed(row)
            value = digest if text is None else leaf((*row[:4], text))
            for run, slot in path:
                value = sha("".join([*run[:slot], value, *run[slot + 1:]]))
            proof = "".join("".join(run[:slot] + run[slot + 1:]) for run, slot in path)
            out.append((doc_id, digest, trees[name][-1][0], top[-1][0], proof, value))
    return out


def tables():
    random.seed(12)
    langs = [None, "de", "en", "", "é", "Z"] + [f"l{i}" for i in range(9)]
    many = [(i, "s", "en", 3, f"Text {i}") for i in range(600)]  # more than a block
    odd = [
        (None, None, None, None, None), (None, "s", None, 1, ""), (1, "", "de", 0, "É ABC " * 20_000),
        (1, "", "de", 0, "a"), (1, "", "de", 0, "a"), (-5, "1:a", "de", 2, "-"),
    ]
    some = [(random.randrange(50), random.choice("ab"), random.choice(langs), i, "Ab" * i) for i in range(120)]
    return {"mixed": odd + some, "large": many + odd, "one": [(7, "s", "en", 1, "X")], "two": odd[:1] + odd[3:4]}


@pytest.mark.parametrize("name", list(tables()))
def test_equals_brute_force(spark, monkeypatch, name):
    monkeypatch.setattr(merkle, "LEVELS", 3 if name == "large" else 1)  # the latter has many rounds
    rows = tables()[name]
    docs = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], KINDS)
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lower("text"))
    found = [tuple(row) for row in manifest(docs, text).collect()]
    lower = lambda row: None if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 3 else row[4].lower()
    assert sorted(found, key=repr) == sorted(brute(rows, lower), key=repr)


def test_all_hold_where_nothing_changed(spark):
    rows = tables()["mixed"]
    found = manifest(spark.createDataFrame([(*row, 1, "x", "y") for row in rows], KINDS)).collect()
    assert len(found) == len(rows) and all(row.folded_root == row.root for row in found)
    assert len({row.root for row in found}) == 1


def test_no_documents(spark):
    docs = spark.createDataFrame([], KINDS)
    assert manifest(docs, F.lower("text")).count() == 0


def test_fields_do_not_run_together(spark):
    docs = spark.createDataFrame([(1, "a", "b", 1, "c"), (1, "a1:b", None, 1, "c")], ", ".join(KINDS.split(", ")[:5]))
    leaves = docs.select(merkle.leaf_of(*map(F.col, FIELDS))).collect()
    assert leaves[0] != leaves[1]
