"""Toxicity categories by a chain of linear classifiers over the words of whole texts.

The categories are predicted one after the other. Each one's model is a logistic regression on the
words a text has and on the probabilities of the categories before it; in training those are the
out-of-fold ones, as a model's view of its own training rows would be too good to learn from.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import bounded, mapped, stored, table
from haulgrid.llm.linear import SparseRows, fit, logit, sigmoid

#: Labelled texts that a chain is fitted on, at most about. Scoring covers all texts.
SAMPLE = 10_000
#: Each feature is in so many of the sampled texts: the chi-square test needs that many to hold.
LEAST_TEXTS = 5
FOLDS = 4
#: Words whose features a worker keeps at a time.
KEPT_WORDS = 100_000
#: What is rejected as toxic.
THRESHOLD = 0.4

#: A feature is a word's beginning of so many letters, or the whole word with an end mark.
BEGINNINGS = range(3, 9)
END = "$"

_WORD = re.compile(r"[^\W_]+")


def words_in(text: str | None) -> set[str]:
    """The distinct words of a whole text, in lower case."""
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    found = {word + END for word in words}
    for size in BEGINNINGS:
        found.update([word[:size] for word in words if len(word) >= size])
    return found


def categories(labels: DataFrame) -> DataFrame:
    """(doc_id, junk, toxic, abusive_junk) as 0 or 1, from labels of quality and toxicity.

    Rows that lack a label or doc_id are left out; of several for one doc_id the worse counts.
    """
    rows = labels.where("doc_id is not null and quality is not null and toxic is not null")
    rows = rows.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    junk, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return rows.select(
        "doc_id", junk.cast("int").alias("junk"), toxic.cast("int").alias("toxic"),
        (junk & toxic).cast("int").alias("abusive_junk"),
    )


class Chain:
    """Fitted classifiers of the categories, in their order."""

    def __init__(self, names: list[str], vocabulary: list[str], weights: list[np.ndarray]):
        self.names, self.weights = names, weights
        self.number = {feature: at for at, feature in enumerate(vocabulary)}
        self.of_word: dict[str, list[int]] = {}

    def features(self, text: str | None) -> list[int]:
        found: set[int] = set()
        for word in words_in(text):
            mine = self.of_word.get(word)
            if mine is None:
                if len(self.of_word) >= KEPT_WORDS:
                    self.of_word.clear()
                mine = [self.number[feature] for feature in features_of({word}) & self.number.keys()]
                self.of_word[word] = mine
            found.update(mine)
        return list(found)

    def probabilities(self, texts) -> np.ndarray:
        rows = SparseRows([self.features(text) for text in texts], len(self.number))
        earlier, out = [], []
        for weights in self.weights:
            out.append(sigmoid(rows.with_dense(earlier).scores(weights)))
            earlier = [*earlier, logit(out[-1])]
        return np.column_stack(out) if out else np.zeros((rows.number, 0))


def chosen_features(known: DataFrame, names: list[str]) -> list[str]:
    """All features whose presence tells about some category, by their chi-square statistic.

    Those that tell no more than the best of as many chance features would are left out.
    """
    kinds = [f"{name} int" for name in names]

    def counted(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for kind, rows in batch.groupby(names):
            counts = Counter()
            for text in rows["text"]:
                counts.update(features_of(words_in(text)))
            out.append(pd.DataFrame({"feature": list(counts), "n": list(counts.values())}).assign(**dict(zip(names, kind))))
        return pd.concat(out) if out else pd.DataFrame(columns=["feature", "n", *names])

    total, *positives = known.agg(F.count("*"), *[F.sum(name).cast("double") for name in names]).first()
    if not total:
        return []
    counts = stored(
        mapped(known.select("text", *names), counted, ", ".join(["feature string, n long", *kinds]))
        .groupBy("feature").agg(*[F.sum(F.col("n") * F.col(name)).alias(name) for name in names], F.sum("n").alias("n"))
        .where(F.col("n") >= LEAST_TEXTS), "features",
    )
    chance = 2 * np.log(max(counts.count(), 2))
    chosen: set[str] = set()
    for name, positive in zip(names, positives):
        if not positive or positive == total:
            continue
        share = positive / total
        chi = (F.col(name) - F.col("n") * share) ** 2 / (
            F.col("n") * share * (1 - share) * (1 - F.col("n") / F.lit(total + 1.0))
        )
        chosen.update(row["feature"] for row in counts.where(chi > chance).select("feature").collect())
    return sorted(chosen)


def fit_chain(docs: DataFrame, labels: DataFrame, names: list[str], sample: int = SAMPLE) -> Chain:
    """Fit a chain on documents (doc_id, text) that have labels (doc_id and the names).

    If there are more labels than ``sample``, or more rows of theirs, a draw by hash of so many is
    used, so a run again fits the same model. The draw bounds what is broadcast and what comes back to the driver.
    Texts with the same features and labels are one row there, with their number.
    """
    share = min(1.0, sample / max(labels.count(), 1))
    drawn = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    known = bounded(stored(
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(drawn), "doc_id").select("doc_id", "text", *names),
        "labelled",
    ), sample)
    vocabulary = chosen_features(known, names)
    chain = Chain(names, vocabulary, [])

    def listed(batch: pd.DataFrame) -> pd.DataFrame:
        out = batch.drop(columns="text")
        out["features"] = [sorted(chain.features(text)) for text in batch["text"]]
        return out

    kinds = ", ".join(f"{name} int" for name in names)
    rows = mapped(known.select("text", *names), listed, f"{kinds}, features array<int>")
    rows = rows.groupBy(*names, "features").agg(F.count("*").alias("n"))
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("features"), F.lit(FOLDS)).cast("int"))
    rows = rows.orderBy("features", *names).toArrow()
    # Only flat numbers are kept, once; a fold is left out by counting its rows as none.
    folds, times = rows["fold"].to_numpy(), rows["n"].to_numpy().astype(float)
    labelled = {name: rows[name].to_numpy().astype(float) for name in names}
    lists = rows["features"].combine_chunks()
    del rows
    matrix = SparseRows.flat(pc.list_value_length(lists).to_numpy(), lists.flatten().to_numpy(), len(vocabulary))
    del lists
    earlier = []
    for name in names:
        y, whole = labelled[name], matrix.with_dense(earlier)
        chain.weights.append(fit(whole, y, times))
        if name == names[-1]:
            break  # nothing after it needs its out-of-fold probabilities
        outside = np.zeros(len(y))
        for fold in range(FOLDS):
            out = folds == fold
            outside[out] = sigmoid(whole.scores(fit(whole, y, times * ~out)))[out]
        earlier = [*earlier, logit(outside)]
    return chain


NAMES = ["junk", "toxic", "abusive_junk"]


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Add p_junk, p_toxic, p_abusive_junk and toxic to each row of ``docs``.

    ``docs`` has doc_id and text, ``labels`` doc_id, quality and toxic. toxic is whether p_toxic is
    at least ``THRESHOLD``. A NULL or empty text has no word, and gets what the models say about
    that. Without labelled documents nothing is toxic. Repeated rows and NULL ids are scored like
    any other; in training, each repeated row counts. Other columns pass through, but for those
    named like the new ones, which are replaced.
    """
    chain = fit_chain(docs, categories(labels), NAMES, sample)
    kinds = ", ".join(f"p_{name} double" for name in NAMES)

    @F.pandas_udf(f"{kinds}, toxic boolean")
    def score(texts: pd.Series) -> pd.DataFrame:
        found = chain.probabilities(texts)
        out = pd.DataFrame({f"p_{name}": found[:, at] for at, name in enumerate(NAMES)})
        return out.assign(toxic=out["p_toxic"] >= THRESHOLD)

    new = [*(f"p_{name}" for name in NAMES), "toxic"]
    mine = [name for name in docs.columns if name not in new]
    free = "_".join(["_", *mine])
    scored = docs.select(*mine).withColumn(free, score(F.col("text").cast("string")))
    return scored.select(*mine, f"{free}.*")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the toxicity categories for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity(docs.select("doc_id", "text"), labels).drop("text")
