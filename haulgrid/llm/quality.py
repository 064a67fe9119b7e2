"""Quality scores by compression: dictionaries of good and of bad text, and which one helps more."""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import bounded, fold_of, mapped, stored, table

FOLDS = 4
HELD_OUT = 2
PREDICTED = 0.7

#: Labelled texts that the scorer is fitted on, at most about: one half makes the dictionaries, the
#: other half the calibration. Scoring covers all texts.
SAMPLE = 20_000
#: Bytes that are compressed at a time, so that a long text does not become its own dictionary.
PIECE = 1024
#: Pieces that make a dictionary, at most, and its bytes.
PIECES = 4000
DICTIONARY = 65_536
LEVEL = 3


def pieces_of(text: str | None) -> list[bytes]:
    """The whole text as pieces of equal size, but for the last."""
    data = (text or "").encode()
    return [data[at: at + PIECE] for at in range(0, len(data), PIECE)]


def dictionary(pieces: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary of the pieces; of few pieces, the pieces themselves."""
    total = sum(map(len, pieces))
    size = min(size, total // 8)
    if len(pieces) >= 64 and size >= 1024:
        try:
            return zstandard.train_dictionary(size, pieces, k=256, d=8).as_bytes()
        except zstandard.ZstdError:  # too much alike for the trainer
            pass
    return b"".join(pieces)[-DICTIONARY:]


class Scorer:
    """Two dictionaries and a calibration of the difference they make."""

    def __init__(self, good: bytes, bad: bytes, slope: float = 0.0, offset: float = 0.0):
        self.good, self.bad, self.slope, self.offset = good, bad, slope, offset
        self.made = None

    def _compressors(self):
        if self.made is None:
            self.made = [
                zstandard.ZstdCompressor(
                    level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                    **({"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}),
                ) for data in (self.good, self.bad)
            ]
        return self.made

    def __getstate__(self):
        return {**self.__dict__, "made": None}

    def difference(self, text: str | None) -> float:
        """How many bytes less the good dictionary leaves of each byte of the text."""
        good, bad = self._compressors()
        pieces = pieces_of(text)
        if not pieces:
            return 0.0
        saved = sum(len(bad.compress(piece)) - len(good.compress(piece)) for piece in pieces)
        return saved / sum(map(len, pieces))

    def score(self, differences: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * differences + self.offset, -50, 50)))


def calibrate(differences: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of least loss, by Newton steps with a little ridge."""
    scale = differences.std() or 1.0
    x = np.column_stack([differences / scale, np.ones(len(labels))])
    weights, ridge = np.zeros(2), np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        hessian = (x.T * (p * (1 - p))) @ x + ridge
        weights = weights + np.linalg.solve(hessian, x.T @ (labels - p) - ridge @ weights)
    return float(weights[0] / scale), float(weights[1])


def fit_scorer(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on documents (doc_id, text) with labels (doc_id, quality 0 or 1).

    Of more than ``sample`` labels, and of their rows, so many are drawn by hash, which bounds what
    is broadcast and what comes back to the driver; there repeated rows are one. A dictionary is
    made of ``PIECES`` pieces at most, those of least hash. Labels that are NULL do not count; of several for one document
    the lowest does.
    """
    labels = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    share = min(1.0, sample / max(labels.count(), 1))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    drawn = labels.where(draw < int(share * 1_000_000))
    known = bounded(stored(
        docs.select("doc_id", F.col("text").cast("string").alias("text"))
        .join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "quality"), "labelled",
    ), sample)

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        out = [
            (doc_id, quality, at, piece)
            for doc_id, text, quality in zip(batch["doc_id"], batch["text"], batch["quality"])
            for at, piece in enumerate(pieces_of(text))
        ]
        return pd.DataFrame(out, columns=["doc_id", "quality", "at", "piece"])

    first = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) == 0
    pieces = mapped(known.where(first), cut, "doc_id long, quality int, at int, piece binary")

    def chosen(quality: int) -> bytes:
        rows = pieces.where(F.col("quality") == quality).withColumn("h", F.xxhash64("doc_id", "at", "piece")).distinct()
        return dictionary([bytes(row["piece"]) for row in rows.orderBy("h").limit(PIECES).select("piece").collect()])

    scorer = Scorer(chosen(1), chosen(0))

    def differences(batch: pd.DataFrame) -> pd.DataFrame:
        return batch[["doc_id", "quality"]].assign(x=[scorer.difference(text) for text in batch["text"]])

    rest = mapped(known.where(~first), differences, "doc_id long, quality int, x double").distinct()
    rest = rest.orderBy("x", "quality").select("quality", "x").toPandas()
    if len(rest):
        scorer.slope, scorer.offset = calibrate(rest["x"].to_numpy(), rest["quality"].to_numpy(float))
    return scorer


def quality_scores(docs: DataFrame, learned: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Add score, 0 to 1, higher for better text, to each row of ``docs``; fitted on ``learned``.

    Both have doc_id and text; only the text is scored, all of it. A NULL or empty text makes no
    difference to the dictionaries, and gets what the calibration says about that; without labels
    every score is 0.5. Repeated rows and NULL ids are scored like any other. Other columns pass
    through, but for score, which is replaced.
    """
    scorer = fit_scorer(learned, labels, sample)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(scorer.score(np.array([scorer.difference(text) for text in texts], float)))

    return docs.withColumn("score", score(F.col("text").cast("string")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned without the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    scored = quality_scores(docs, docs.where(~held_out), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= PREDICTED).cast("int").alias("predicted")
    )
