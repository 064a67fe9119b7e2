"""From raw documents to a training mixture: five stages, each written before the next reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm import decontaminate, mixing, simhash, substrings, toxicity
from haulgrid.llm.common import table
from haulgrid.session import shared_folder


def beside_text(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all columns but the text in one, so that no operator's columns clash."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "doc_id", "text")


def restored(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` again, those named with these values; the text must be named."""
    return [changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic."""
    scored = toxicity.toxicity(beside_text(docs), table(spark, sf_dir, "labels"))
    return scored.where("not toxic").select(*restored(docs, text=F.col("text")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link: of smallest doc_id, if any has one."""
    return simhash.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has, or not at all if nothing else is left.

    Texts from which nothing is removed stay as they are, blanks included.
    """
    found = substrings.without_repeats(beside_text(docs)).where("n_removed = 0 or n_removed < n_words")
    changed = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(F.col("row")["n_chars"])
    return found.select(*restored(docs, **changed))


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = found.where("n_hit > 0").select("doc_id", "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(dirty["doc_id"]) & (
        F.xxhash64(docs["text"].cast("string")) == dirty["text_hash"]
    )
    return docs.join(dirty, same, "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents with source, language and topic near their target weights."""
    rows = mixing.with_topics(docs, F.struct("*").alias("row"))
    return mixing.mixture(rows).where("kept").select("row.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("decontamination", without_benchmarks),
    ("mixing", mixed),
]

#: Classifiers, 64-bit hashes of shingles and fitted weights are beyond SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each to all that the one before it kept."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
