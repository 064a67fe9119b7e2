"""Language identification by a convolutional network over bytes, trained and applied in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import fold_of, mapped, table

FOLDS = 3
HELD_OUT = 1
UNKNOWN = "und"

#: Texts that the network is trained on, at most about, and windows of each. Prediction covers all.
SAMPLE = 4000
WINDOWS = 2
#: Bytes of a window; widths of the filters and filters of each width.
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EPOCHS = 6
BATCH = 128
RATE = 0.02
#: Windows that are looked at together.
TOGETHER = 256


def windows_of(data: bytes) -> np.ndarray:
    """All bytes as windows, overlapping so that no filter misses a place; the last ends in zeros."""
    step = WINDOW - max(WIDTHS) + 1
    number = max(1, -(-(len(data) - WINDOW) // step) + 1)
    padded = np.zeros((number - 1) * step + WINDOW, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]


class Network:
    """Filters over one-hot bytes, the largest response of each in a window, and a softmax."""

    def __init__(self, languages: list[str], seed: int = 5):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.filters = [random.normal(0, 0.3, (width, 256, FILTERS)).astype("f4") for width in WIDTHS]
        pooled = FILTERS * len(WIDTHS)
        self.dense = random.normal(0, 0.3, (pooled, len(languages))).astype("f4")
        self.bias = np.zeros(len(languages), "f4")
        self.pairs = None

    def __getstate__(self):
        return {**self.__dict__, "pairs": None}

    def _responses(self, windows: np.ndarray, at: int) -> np.ndarray:
        """Responses of the filters of one width at every place of every window.

        Over one-hot bytes a filter's response is a sum of its weights, one for each byte; those of
        two bytes next to each other are summed beforehand for all pairs of bytes.
        """
        width, places = WIDTHS[at], WINDOW - WIDTHS[at] + 1
        pair = windows[:, :-1].astype(np.int64) * 256 + windows[:, 1:]
        out = 0
        for start, weights in self.pairs[at]:
            index = pair[:, start: start + places] if len(weights) > 256 else windows[:, start: start + places]
            out = out + np.take(weights, index, axis=0)
        return out

    def _prepare(self) -> None:
        if self.pairs is None:
            self.pairs = [
                [
                    (start, (filters[start][:, None] + filters[start + 1][None]).reshape(-1, FILTERS))
                    if start + 1 < len(filters) else (start, filters[start])
                    for start in range(0, len(filters), 2)
                ] for filters in self.filters
            ]

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        self._prepare()
        out = np.empty((len(windows), len(self.languages)), "f4")
        for at in range(0, len(windows), TOGETHER):
            some = windows[at: at + TOGETHER]
            pooled = [np.maximum(self._responses(some, i).max(axis=1), 0) for i in range(len(WIDTHS))]
            out[at: at + TOGETHER] = softmax(np.concatenate(pooled, axis=1) @ self.dense + self.bias)
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 6) -> None:
        """Adam steps on the cross entropy of shuffled batches."""
        random = np.random.default_rng(seed)
        weights = [*self.filters, self.dense, self.bias]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                chosen = order[at: at + BATCH]
                step += 1
                for w, g, (mean, square) in zip(weights, self._gradients(windows[chosen], labels[chosen]), moments):
                    mean += 0.1 * (g - mean)
                    square += 0.01 * (g * g - square)
                    w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        self.pairs = None
        self._prepare()
        pooled, where = [], []
        for i in range(len(WIDTHS)):
            responses = self._responses(windows, i)
            best = responses.argmax(axis=1)
            where.append(best)
            pooled.append(np.take_along_axis(responses, best[:, None], axis=1)[:, 0])
        values = np.concatenate(pooled, axis=1)
        active = np.maximum(values, 0)
        errors = softmax(active @ self.dense + self.bias)
        errors[np.arange(len(labels)), labels] -= 1
        errors /= len(labels)
        back = (errors @ self.dense.T) * (values > 0)
        gradients = []
        for i, width in enumerate(WIDTHS):
            g = np.zeros_like(self.filters[i])
            part = back[:, i * FILTERS: (i + 1) * FILTERS]
            for place in range(width):
                seen = np.take_along_axis(windows, where[i] + place, axis=1)
                np.add.at(g[place], (seen, np.arange(FILTERS)[None]), part)
            gradients.append(g)
        self.pairs = None
        return [*gradients, active.T @ errors, errors.sum(axis=0)]

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        """Language and score of each text: the mean of its windows' probabilities.

        Windows are looked at ``TOGETHER``, whichever texts they are of.
        """
        # str.isalpha stops at the first letter
        plain = [
            at for at, text in enumerate(texts)
            if self.languages and text is not None and next(filter(str.isalpha, text), None) is not None
        ]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        sums, numbers = np.zeros((len(texts), len(self.languages))), np.ones(len(texts))
        held, owners = [], []

        def look() -> None:
            if held:
                found = self.probabilities(np.concatenate(held))
                np.add.at(sums, np.repeat(owners, [len(part) for part in held]), found)
                held.clear()
                owners.clear()

        texts, waiting = list(texts), 0
        for at in plain:
            windows = windows_of(texts[at].encode())
            numbers[at] = len(windows)
            for first in range(0, len(windows), TOGETHER):
                held.append(windows[first: first + TOGETHER])
                owners.append(at)
                waiting += len(held[-1])
                if waiting >= TOGETHER:
                    look()
                    waiting = 0
        look()
        means = sums / numbers[:, None]
        for at in plain:
            names[at] = self.languages[int(means[at].argmax())]
            scores[at] = min(max(means[at].max(), 0.0), 1.0)
        return names, scores


def softmax(scores: np.ndarray) -> np.ndarray:
    power = np.exp(scores - scores.max(axis=1, keepdims=True))
    return power / power.sum(axis=1, keepdims=True)


def fit_network(docs: DataFrame, sample: int = SAMPLE) -> Network:
    """Train on documents (doc_id, text, lang) with a language and a letter.

    Of more than ``sample`` rows so many are drawn by hash, and of each text ``WINDOWS`` windows, some
    of them cut short, as texts may be; this bounds what comes back to the driver. Repeated rows
    are one there.
    """
    known = docs.where("lang is not null and text is not null and doc_id is not null")
    share = min(1.0, sample / max(known.count(), 1))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))

    def cut(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
            if next(filter(str.isalpha, text), None) is None:
                continue
            random = np.random.default_rng(doc_id & 0xFFFFFFFF)
            every = windows_of(text.encode())
            for _ in range(WINDOWS):
                window = every[random.integers(len(every))].copy()
                if random.random() < 0.3:
                    window[random.integers(8, WINDOW):] = 0
                out.append((doc_id, lang, window.tobytes()))
        return pd.DataFrame(out, columns=["doc_id", "lang", "window"])

    drawn = known.where(draw < int(share * 1_000_000)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    rows = mapped(drawn, cut, "doc_id long, lang string, window binary").distinct()
    rows = rows.orderBy("doc_id", "window", "lang").toPandas()
    languages = sorted(rows["lang"].unique())
    network = Network(languages)
    if len(languages) > 1:
        windows = np.frombuffer(b"".join(rows["window"]), np.uint8).reshape(-1, WINDOW)
        network.train(windows, rows["lang"].map(languages.index).to_numpy())
    return network


def languages(docs: DataFrame, learned: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Add lang_pred and score, 0 to 1, to each row of ``docs``; trained on ``learned``.

    ``learned`` has doc_id, text and lang; of ``docs`` only the text is looked at, all of it. A text
    that is NULL or has no letter is ``und`` with score 0, and so is every text if nothing could be
    learned; with one learned language every other text is of it. Repeated rows and NULL ids are
    predicted like any other. Other columns pass through, but for those two, which are replaced.
    """
    network = fit_network(learned, sample)

    @F.pandas_udf("lang_pred string, score double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        names, scores = network.predict(texts)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    mine = [name for name in docs.columns if name not in ("lang_pred", "score")]
    free = "_".join(["_", *mine])
    found = docs.select(*mine).withColumn(free, predicted(F.col("text").cast("string")))
    return found.select(*mine, f"{free}.*")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned without the held-out third."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    found = languages(docs.select("doc_id", "text"), docs.where(~held_out).select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
