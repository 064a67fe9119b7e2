"""The pipeline stage by stage against plain restatements, each on what its predecessor kept."""

import pytest
import xxhash
from tests.llm import brute

import corpus_pipeline
from haulgrid.llm import decontaminate, mixing, substrings, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage and what comes out of the last."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(None, "no id", "en", "s", 5), (9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, " ", "en", "s", 1)],
        docs.schema,
    )
    docs = docs.union(docs.limit(3)).union(odd)
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, kept[-1], SF).write.parquet(path)
        kept.append(spark.read.parquet(path))
    return [[tuple(r) for r in rows.select(*COLUMNS).collect()] for rows in kept]


def ordered(rows):
    return sorted(rows, key=repr)


def test_order_and_columns(spark, stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "substring_dedup", "decontamination", "mixing"
    ]
    assert all(len(a) >= len(b) for a, b in zip(stages, stages[1:])) and len(stages[-1]) > 0


def test_toxic_documents_go(spark, stages):
    docs = spark.createDataFrame(stages[0], spark.read.parquet(f"{SF}/documents.parquet").schema)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    chain = toxicity.fit_chain(docs, toxicity.categories(labels), toxicity.NAMES)
    shares = chain.probabilities([row[1] for row in stages[0]])[:, 1]
    assert ordered(stages[1]) == ordered([row for row, p in zip(stages[0], shares) if p < toxicity.THRESHOLD])


def test_one_of_each_group_stays(stages):
    prints = [brute.simhash(row[1]) for row in stages[1]]
    groups = brute.grouped(len(prints), [
        (i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3
    ])
    first = {}
    for row, group in zip(stages[1], groups):
        first[group] = min(first.get(group, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    assert ordered(stages[2]) == ordered(first.values())


def test_repeated_passages_go(stages):
    wanted = []
    for row, (_, n_words, n_removed, kept) in zip(stages[2], brute.without_repeats([r[:2] for r in stages[2]], substrings.WINDOW)):
        if not n_removed:
            wanted.append(row)
        elif n_removed < n_words:
            wanted.append((row[0], kept, row[2], row[3], len(kept)))
    assert ordered(stages[3]) == ordered(wanted)


def test_documents_with_benchmark_windows_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.contamination([row[:2] for row in stages[3]], items, decontaminate.WINDOW)
    assert ordered(stages[4]) == ordered([row for row, (_, _, hit, _) in zip(stages[3], found) if not hit])


def test_sample_follows_the_probabilities(spark, stages):
    docs = spark.createDataFrame(stages[4], spark.read.parquet(f"{SF}/documents.parquet").schema)
    rows = mixing.mixture(mixing.with_topics(docs)).collect()
    share = {(r.doc_id, r.text_hash): r.probability for r in rows}
    wanted = []
    for row in stages[4]:
        unsigned = 42 if row[1] is None else xxhash.xxh64(row[1].encode(), seed=42).intdigest()
        text_hash = unsigned - 2**64 if unsigned >= 2**63 else unsigned
        drawn = brute.uniform((mixing.SEED, "<i"), (row[0], "<q"), (text_hash, "<q"))
        if drawn < share[row[0], text_hash]:
            wanted.append(row)
    assert ordered(stages[5]) == ordered(wanted)


def test_no_documents(spark):
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_other_columns_pass_whatever_their_names(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").drop("n_chars")
    names = ["row", "text_hash", "kept", "n_removed", "spans", "_cut", "_doc_id", "toxic", "weight", "prints", "key"]
    more = docs.limit(60).union(docs.limit(3)).selectExpr("*", *[f"concat('{name} ', doc_id) AS `{name}`" for name in names])
    seen = {row.doc_id for row in more.collect()}
    for _, stage in corpus_pipeline.STAGES:
        found = stage(spark, more, SF)
        assert found.columns == more.columns
        rows = found.collect()
        assert rows and {row.doc_id for row in rows} <= seen
        assert all(row[name] == f"{name} {row.doc_id}" for row in rows for name in names)


def test_passages_are_cut_once_a_row(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words, "a"), (2, words, "b"), (3, "x " + words, "c")], "doc_id long, text string, source string")
    found = corpus_pipeline.without_repeated_passages(spark, docs, "")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted((r.doc_id, r.text) for r in found.collect()) == [(1, words), (3, "x")]
