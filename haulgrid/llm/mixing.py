"""Mixing sources to target weights: token weights raked to marginals, then a sample of documents.

Documents have a source and a language; their topic is found by clustering their words. Raking then
scales the tokens of each cell of source, language and topic by one factor per value, dimension
after dimension, until every value's share is its target. The sample's probabilities are raked in
the same way, but bounded by one: what a small cell cannot give, others of the same values do.
"""

from __future__ import annotations

import re
import string
import warnings
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from haulgrid.llm.common import stored, table

DIMENSIONS = ("source", "lang", "topic")
#: Clusters of texts; one topic more is for texts without a word.
TOPICS = 7
#: Places that words are hashed to; what stands between blanks of which a worker keeps the place, and its bytes at most.
PLACES = 1024
KEPT_WORDS = 100_000
KEPT_BYTES = 40
#: Bytes of short texts that are taken apart together, each text counting as at least a thousand more; a longer one is taken by itself.
TOGETHER = 1 << 18
STEPS = 20
#: Rows whose vectors a task spreads out at a time.
AT_ONCE = 500
#: Vectors whose products are taken at a time.
FEW = 32
#: Numbers are added up as whole multiples of one over this, so the order of the terms plays no part.
FIXED = float(1 << 24)
#: A vector that is no farther than this from its language's mean is at it.
AT_MEAN = 1e-3
#: Targets are shares raised to this power, which lifts what is rare.
TEMPERATURE = 0.5
ROUNDS = 50
CLOSE = 1e-6
#: For probabilities, which full cells keep from their goals for longer.
NEAR = 1e-4
#: Share of all tokens that the sample is to hold.
KEEP = 0.5
SEED = 7
#: What a value may be off its target, as a share of the sample, without a warning.
TOLERANCE = 0.01
#: Cells that are raked on the driver, at most; more are raked where they are.
HERE = 100_000

_WORD = re.compile(r"[^\W\d_]+")
#: ASCII marks and digits, which are in no word.
_MARKS = (string.punctuation + string.digits).encode()
#: What a byte of UTF-8 is, and its lower case. Letters are those of ASCII and of U+00C0 to U+00FF: 0xC3 and a byte from
#: 0x80 on, without the two signs among them; all else beyond ASCII is strange.
_BLANK, _MARK, _LETTER, _STRANGE = range(4)
_LATIN = bytes({0xC3, *range(0x80, 0xC0)} - {0x97, 0xB7})
_KINDS = bytes(
    _BLANK if byte in string.whitespace.encode() else _LETTER if byte in string.ascii_letters.encode() + _LATIN
    else _MARK if byte < 0x80 else _STRANGE for byte in range(256)
)
_LOWER = bytes(byte + 32 if byte in string.ascii_uppercase.encode() or 0x80 <= byte < 0x9F else byte for byte in range(256))
#: The crc32 of as many zeros, and what a byte adds to it (by exclusive or) if so many bytes begin with it.
_ZEROS = np.array([zlib.crc32(bytes(n)) % PLACES for n in range(KEPT_BYTES + 1)], np.uint16)
_ADDS = np.array([
    [(zlib.crc32(bytes([byte]) + bytes(n - 1)) ^ zlib.crc32(bytes(n))) % PLACES if n else 0 for byte in range(256)]
    for n in range(KEPT_BYTES + 1)
], np.uint16).ravel()


class Places(dict):
    """The place of the word in what stands between two blanks, ``PLACES`` if it has none.

    What has several words is not kept: it has none either, and their places are added to ``more``.
    """

    def __init__(self):
        super().__init__()
        self.more: list[int] = []

    def __missing__(self, token: bytes) -> int:
        word = token.strip(_MARKS)
        # Letters of ASCII alone are one word; no lower case reaches over a blank, so others are taken by themselves.
        words = [word.lower()] if word.isalpha() else [found.encode() for found in _WORD.findall(word.decode().lower())]
        places = [zlib.crc32(found) % PLACES for found in words]
        if len(places) > 1:
            self.more += places
            return PLACES
        place = places[0] if places else PLACES
        if len(token) <= KEPT_BYTES:
            self[token] = place
        return place

    def counted(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """How many tokens a text has, the places of its words, ascending, and how many words each has."""
        if len(self) > KEPT_WORDS:
            self.clear()
        tokens = text.encode().split()
        found = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        more, self.more = self.more, []
        times = np.bincount(np.append(found, more).astype(np.int64), minlength=PLACES + 1)[:PLACES]
        at = np.flatnonzero(times)
        return len(tokens), at, times[at]


def _counted_together(texts: list[bytes], places: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts what ``Places.counted`` finds of each: how many tokens and places each has, then the places and
    times of all. Words are found and placed together, but those of long tokens and of tokens with strange letters."""
    raw = b"\n".join([b"", *texts, b""])
    kinds, lower = (np.frombuffer(raw.translate(to), np.uint8) for to in (_KINDS, _LOWER))
    bounds = np.cumsum([1, *[len(text) + 1 for text in texts]])
    blank = kinds == _BLANK
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    begins, ends = edges[::2], edges[1::2]
    odd = ends - begins > KEPT_BYTES
    odd[np.searchsorted(begins, np.flatnonzero(kinds == _STRANGE), "right") - 1] = True

    letters, keys = kinds == _LETTER, []
    rows = np.searchsorted(bounds, begins[odd], "right") - 1
    for row, begin, end in zip((rows * PLACES).tolist(), begins[odd].tolist(), ends[odd].tolist()):
        letters[begin:end] = False
        place = places[raw[begin:end]]
        if place < PLACES:
            keys.append(row + place)
        elif places.more:
            keys += [row + one for one in places.more]
            places.more = []

    edges = np.flatnonzero(letters[1:] != letters[:-1]) + 1
    words, sizes = edges[::2], np.diff(edges)[::2]
    if len(words):
        # crc32 is linear: a word's is that of as many zeros, and what each byte adds by its distance from the end.
        upto = np.cumsum(sizes)
        left = np.repeat(upto, sizes) - np.arange(upto[-1])
        found = np.bitwise_xor.reduceat(_ADDS[left * 256 + lower[letters]], upto - sizes) ^ _ZEROS[sizes]
        rows = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(words, bounds)))
        keys = np.append(rows * PLACES + found, np.array(keys, np.int64))
    times = np.bincount(np.asarray(keys, np.int64), minlength=len(texts) * PLACES)
    at = np.flatnonzero(times)
    return np.diff(np.searchsorted(begins, bounds)), np.bincount(at // PLACES, minlength=len(texts)), at % PLACES, times[at]


def _counted(texts: list[bytes], places: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``_counted_together`` of any texts, a bounded part of them at a time."""
    parts, some, size = [], [], 0
    for text in [*texts, None]:
        if some and (text is None or size + len(text) + PLACES > TOGETHER):
            if len(places) > KEPT_WORDS:
                places.clear()
            if size <= TOGETHER:
                parts.append(_counted_together(some, places))
            else:
                tokens, at, times = places.counted(some[0].decode())
                parts.append((np.array([tokens]), np.array([len(at)]), at, times))
            some, size = [], 0
        if text is not None:
            some.append(text)
            size += len(text) + PLACES
    return tuple(np.concatenate(one) for one in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4


class Topics:
    """Clusters of texts by the words that set them apart from others in their language."""

    def __init__(self, languages: list[str | None], means: np.ndarray, rare: np.ndarray, centres: np.ndarray):
        self.number = {language: at for at, language in enumerate(languages)}
        self.means, self.rare, self.centres = means, rare, centres
        self.apart = means @ centres.T  # what a language's mean adds to each centre

    def of(self, at: pd.Series, n: pd.Series, languages: pd.Series) -> list[str]:
        """The number of each text's nearest centre, from 1 on; 0 of a text without a word."""
        found = []
        for begin in range(0, len(at), AT_ONCE):
            some = at.iloc[begin: begin + AT_ONCE]
            if len(self.centres):
                entries = _unit(pa.array(some, pa.binary()), pa.array(n.iloc[begin: begin + AT_ONCE], pa.binary()), self.rare)
                near = _near(*entries, len(some), self.centres)
                for row, language in enumerate(languages.iloc[begin: begin + AT_ONCE]):
                    number = self.number.get(None if pd.isna(language) else language)
                    if number is not None:
                        near[row] -= self.apart[number]
                nearest = _first_largest(near)
            else:
                nearest = np.zeros(len(some), np.int64)
            found += [str(1 + int(one)) if len(places) else "0" for places, one in zip(some, nearest)]
        return found


def with_words(docs: DataFrame, *carried: Column) -> DataFrame:
    """(doc_id, text_hash, source, lang, what is to be carried, tokens, at, n) of each row, stored.

    ``docs`` has doc_id, text, source and lang. Tokens are what blanks separate. ``at`` are the places
    that the words of the whole text are hashed to, ascending, as 16-bit numbers, and ``n`` how often words
    of each occur, damped, as 32-bit floats. Each text is read once; all that follows goes over these.
    """
    places = Places()

    @F.arrow_udf("tokens long, at binary, n binary")
    def counted(texts: pa.Array) -> pa.Array:
        tokens, sizes, at, times = _counted([text or b"" for text in texts.cast(pa.binary()).to_pylist()], places)
        cells = _cells(at.astype("<u2"), sizes), _cells(np.sqrt(times).astype("<f4"), sizes)
        return pa.StructArray.from_arrays([pa.array(tokens, pa.int64()), *cells], ["tokens", "at", "n"])

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), *carried,
        counted(text).alias("_counted"),
    )
    return stored(rows.select("*", "_counted.*").drop("_counted"), "words")


def _cells(numbers: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary cells that hold so many of the numbers each, one after the other."""
    ends = np.append(0, np.cumsum(sizes * numbers.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(numbers)])


def _joined(cells: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binary cells one after the other, and how many each has; none is NULL."""
    _, ends, data = cells.buffers()
    wide = np.int64 if pa.types.is_large_binary(cells.type) else np.int32
    ends = np.frombuffer(ends, wide)[cells.offset: cells.offset + len(cells) + 1] if len(cells) else np.zeros(1, wide)
    numbers = np.frombuffer(data or b"", np.uint8)[ends[0]: ends[-1]].view(kind)
    return numbers, np.diff(ends).astype(np.int64) // numbers.itemsize


def _spread(at: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of all entries of some vectors, read where Arrow holds them."""
    places, sizes = _joined(at, "<u2")
    return np.repeat(np.arange(len(at)), sizes), places.astype(np.int64), _joined(values, "<f4")[0].astype(np.float64)


def _unit(at: pa.Array, n: pa.Array, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of texts' vectors of length one, rare words weighing more."""
    rows, places, values = _spread(at, n)
    values = values * rare[places]
    sizes = np.sqrt(np.bincount(rows, values * values, len(at)))
    return rows, places, values / sizes[rows]


def _near(rows: np.ndarray, places: np.ndarray, values: np.ndarray, number: int, others: np.ndarray) -> np.ndarray:
    """The products of so many sparse vectors with others, few at a time: of larger products numpy
    makes several threads, whose waiting takes more of the processors than the product."""
    out = np.empty((number, len(others)))
    ends = np.searchsorted(rows, np.arange(0, number + FEW, FEW))
    for at, begin, end in zip(range(0, number, FEW), ends, ends[1:]):
        dense = np.zeros((min(FEW, number - at), PLACES))
        dense[rows[begin:end] - at, places[begin:end]] = values[begin:end]
        out[at: at + FEW] = dense @ others.T
    return out


def _first_largest(near: np.ndarray) -> np.ndarray:
    """The first place of the largest of each row; what differs by rounding alone is equal."""
    return np.round(near, 9).argmax(axis=1)


def _added(found: DataFrame, *by: str) -> pd.DataFrame:
    """Exact sums of whole numbers per group; the driver gets one row a place of each.

    Halves of 32 bits are added up apart, so no sum of as many rows as there can be overflows.
    """
    high, low = F.shiftright("n", 32), F.col("n").bitwiseAND(F.lit((1 << 32) - 1))
    sums = found.groupBy(*by).agg(F.sum(high).alias("high"), F.sum(low).alias("low")).toPandas()
    n = [(high << 32) + low for high, low in zip(sums["high"].tolist(), sums["low"].tolist())]
    return sums.drop(columns=["high", "low"]).assign(n=np.array(n, object))


def _over(
    rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Apply a function to each task's rows, given some at a time, so that what is spread out of them stays small."""
    kinds = T.StructType.fromDDL(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kinds)
        some = (batch.slice(at, AT_ONCE) for batch in batches for at in range(0, batch.num_rows, AT_ONCE))
        for out in function(some):
            yield from pa.Table.from_pandas(out, arrow, preserve_index=False).to_batches()

    return rows.mapInArrow(over, kinds)


def _sums(keys: list, sums: list[np.ndarray], name: str) -> pd.DataFrame:
    """Rows (key, place, n) of the sums that are not zero."""
    sums = np.stack(sums) if sums else np.zeros((0, PLACES))
    at, places = np.nonzero(sums)
    return pd.DataFrame({name: [keys[i] for i in at], "place": places, "n": sums[at, places].astype(np.int64)})


def _occurring(vectors: DataFrame) -> np.ndarray:
    """In how many vectors each place occurs."""
    def counted(frames: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(PLACES, np.int64)
        for frame in frames:
            sums += np.bincount(_spread(frame["at"], frame["n"])[1], minlength=PLACES)
        yield pd.DataFrame({"place": np.arange(PLACES), "n": sums})

    found = _added(_over(vectors, counted, "place int, n long"), "place")
    out = np.zeros(PLACES)
    out[found["place"].to_numpy(int)] = found["n"].astype(float)
    return out


def _language_means(vectors: DataFrame, rare: np.ndarray) -> tuple[list[str | None], np.ndarray]:
    """The languages, and the mean of the unit vectors of each."""
    def summed(frames: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        sums: dict[str | None, np.ndarray] = {}
        for frame in frames:
            rows, places, values = _unit(frame["at"], frame["n"], rare)
            names = frame["lang"].to_pylist()
            number = {name: at for at, name in enumerate(dict.fromkeys(names))}
            own = np.fromiter(map(number.get, names), np.int64, len(names))
            got = np.bincount(own[rows] * PLACES + places, np.rint(values * FIXED), len(number) * PLACES)
            for name, one in zip(number, got.reshape(-1, PLACES)):
                sums[name] = sums.get(name, 0) + one.astype(np.int64)
        yield _sums(list(sums), list(sums.values()), "lang")

    many = {row.lang: row["count"] for row in vectors.groupBy("lang").count().collect()}
    languages = sorted(many, key=lambda name: (name is not None, name))
    number = {name: at for at, name in enumerate(languages)}
    means = np.zeros((len(languages), PLACES))
    found = _added(_over(vectors, summed, "lang string, place int, n long"), "lang", "place")
    own = [number[None if pd.isna(name) else name] for name in found["lang"]]
    means[own, found["place"].to_numpy(int)] = found["n"].astype(float) / FIXED
    return languages, means / np.array([[many[name]] for name in languages])


def _units(vectors: DataFrame, languages: list[str | None], means: np.ndarray, rare: np.ndarray) -> DataFrame:
    """(own, at, value, size) of each vector: the number of its language, its entries at length one,
    and its distance from the language's mean."""
    number = {language: at for at, language in enumerate(languages)}
    lengths = (means * means).sum(axis=1)

    def of(frames: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, places, values = _unit(frame["at"], frame["n"], rare)
            values = values.astype("<f4")
            own = np.array([number[name] for name in frame["lang"].to_pylist()], np.int64)
            exact = values.astype(np.float64)
            square = np.bincount(rows, exact * (exact - 2 * means[own[rows], places]), frame.num_rows) + lengths[own]
            ends = np.cumsum(np.bincount(rows, minlength=frame.num_rows))
            yield pd.DataFrame({
                "own": own, "at": frame["at"].to_pylist(), "value": [values[i:j].tobytes() for i, j in zip([0, *ends[:-1]], ends)],
                "size": np.round(np.sqrt(np.maximum(square, 0)), 9),
            })

    return stored(_over(vectors, of, "own int, at binary, value binary, size double"), "units")


def _parted(frame: pa.RecordBatch, others: np.ndarray, apart: np.ndarray):
    """A batch's (row, place, value), languages, sizes, and products of what is left of each vector
    without its language's mean, at length one, with others. Of one at the mean nothing is left."""
    rows, places, values = _spread(frame["at"], frame["value"])
    own, size = frame["own"].to_numpy().astype(np.int64), frame["size"].to_numpy()
    left = np.where(size > AT_MEAN, 1 / np.maximum(size, AT_MEAN), 0.0)
    near = (_near(rows, places, values, frame.num_rows, others) - apart[own]) * left[:, None]
    return rows, places, values, own, left, near


def _farthest(units: DataFrame, means: np.ndarray, chosen: np.ndarray):
    """The vector whose nearest of those chosen is farthest: (own, at, value, size)."""
    apart = means @ chosen.T

    def best(frames: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        least = None
        for frame in frames:
            near = np.round(_parted(frame, chosen, apart)[-1].max(axis=1), 9)
            some = frame.filter(pa.array(near == near.min())).to_pylist()
            one = min((near.min(), row["own"], row["at"], row["value"], row["size"]) for row in some)
            least = one if least is None else min(least, one)
        if least is not None:
            yield pd.DataFrame([least], columns=["near", "own", "at", "value", "size"])

    found = _over(units, best, "near double, own int, at binary, value binary, size double")
    return found.orderBy("near", "own", "at", "value").first()


def _centres(units: DataFrame, means: np.ndarray, number: int) -> np.ndarray:
    """Spherical k-means over all units: a step is one job, which adds up exact whole numbers."""
    def point(row) -> np.ndarray:
        out = -means[row.own]
        _, places, values = _spread(pa.array([bytes(row.at)]), pa.array([bytes(row.value)]))
        out[places] += values
        return out / row.size if row.size > AT_MEAN else np.zeros(PLACES)

    chosen = [point(units.orderBy(F.desc("size"), "own", "at", "value").first())]
    for _ in range(number - 1):
        chosen.append(point(_farthest(units, means, np.stack(chosen))))
    centres = np.stack(chosen)
    languages = len(means)
    for _ in range(STEPS):
        apart = means @ centres.T

        def summed(frames: Iterator[pa.RecordBatch], centres=centres, apart=apart) -> Iterator[pd.DataFrame]:
            # Of each centre the sums of the vectors, and for each language what they lack of its mean.
            sums, shares = np.zeros(number * PLACES, np.int64), np.zeros(number * languages, np.int64)
            for frame in frames:
                rows, places, values, own, left, near = _parted(frame, centres, apart)
                to = _first_largest(near)
                got = np.bincount(to[rows] * PLACES + places, np.rint(values * left[rows] * FIXED), len(sums))
                sums += got.astype(np.int64)
                shares += np.bincount(to * languages + own, np.rint(left * FIXED), len(shares)).astype(np.int64)
            for kind, width, found in (("sum", PLACES, sums), ("share", languages, shares)):
                at = np.flatnonzero(found)
                yield pd.DataFrame({"kind": kind, "centre": at // width, "place": at % width, "n": found[at]})

        found = _added(_over(units, summed, "kind string, centre int, place int, n long"), "kind", "centre", "place")
        parts = {"sum": np.zeros((number, PLACES)), "share": np.zeros((number, languages))}
        for kind, into in parts.items():
            of = found[found["kind"] == kind]
            into[of["centre"].to_numpy(int), of["place"].to_numpy(int)] = of["n"].astype(float) / FIXED
        sums = parts["sum"] - parts["share"] @ means
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        before, centres = centres, np.where(length > 1e-6, sums / np.where(length > 1e-6, length, 1), centres)
        if np.array_equal(before, centres):
            break
    return centres


def _topics(words: DataFrame, topics: int) -> Topics:
    vectors = stored(words.where(F.length("at") > 0).select("lang", "at", "n").distinct(), "vectors")
    number = vectors.count()
    if not number:
        return Topics([], np.zeros((0, PLACES)), np.ones(PLACES), np.zeros((0, PLACES)))
    rare = np.log((1 + number) / (1 + _occurring(vectors))) + 0.1
    languages, means = _language_means(vectors, rare)
    units = _units(vectors, languages, means, rare)
    return Topics(languages, means, rare, _centres(units, means, min(topics, number)))


def fit_topics(docs: DataFrame, topics: int = TOPICS) -> Topics:
    """Cluster all distinct texts by spherical k-means.

    A text is the square roots of its word counts, times the logarithm of how rare they are, less
    the mean of its language, so that clusters are not the languages over again. The first centre is the
    text farthest from the mean, each next one that farthest from those before. Sums are of whole
    numbers, so the clusters do not depend on how rows are dealt to tasks.
    """
    return _topics(with_words(docs), topics)


def with_topics(docs: DataFrame, *carried: Column, topics: Topics | None = None) -> DataFrame:
    """(doc_id, text_hash, source, lang, what is to be carried, topic, tokens) of each row.

    ``docs`` has doc_id, text, source and lang. Tokens are the words, which are what blanks
    separate. Without ``topics`` they are fitted on the documents.
    """
    words = with_words(docs, *carried)
    topics = _topics(words, TOPICS) if topics is None else topics

    @F.pandas_udf("string")
    def found(at: pd.Series, n: pd.Series, languages: pd.Series) -> pd.Series:
        return pd.Series(topics.of(at, n, languages), dtype=object)

    rest = [F.col(c) for c in words.columns if c not in ("tokens", "at", "n")]
    return words.select(*rest, found("at", "n", "lang").alias("topic"), "tokens")


def tempered(cells: DataFrame, temperature: float = TEMPERATURE, dimensions=DIMENSIONS) -> DataFrame:
    """Targets (dimension, value, share): each value's share of the tokens, raised to a power."""
    found = []
    for name in dimensions:
        shares = cells.groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("n")).where("n > 0")
        found.append(shares.select(
            F.lit(name).alias("dimension"), "value", F.pow("n", F.lit(temperature)).alias("share")
        ))
    rows = reduce(DataFrame.union, found)
    total = rows.groupBy("dimension").agg(F.sum("share").alias("total"))
    return rows.join(total, "dimension").select(
        "dimension", "value", (F.col("share") / F.col("total")).alias("share")
    )


def goals(cells: DataFrame, targets: DataFrame, dimensions=DIMENSIONS) -> DataFrame:
    """(dimension, value, share, tokens) of the values that have tokens; shares of each add up to 1.

    A value without a target gets none; targets of values that no tokens have are spread over the
    dimension's others.
    """
    found = []
    for name in dimensions:
        here = cells.where("tokens > 0").groupBy(F.col(name).alias("value")).agg(F.sum("tokens").alias("tokens"))
        goal = targets.where(F.col("dimension") == name).select(F.col("value").alias("of"), "share")
        found.append(here.join(goal, here["value"].eqNullSafe(goal["of"]), "left").select(
            F.lit(name).alias("dimension"), "value", F.coalesce("share", F.lit(0.0)).alias("share"),
            F.col("tokens").cast("double").alias("tokens"),
        ))
    rows = stored(reduce(DataFrame.union, found), "goals")
    total = rows.groupBy("dimension").agg(F.sum("share").alias("total"))
    return stored(rows.join(total, "dimension").select(
        "dimension", "value", F.coalesce(F.try_divide("share", "total"), F.lit(0.0)).alias("share"), "tokens"
    ), "goals")


def within_tokens(found: DataFrame, keep: float, tries: int = 31, rounds: int = 6) -> DataFrame:
    """Goals (dimension, value, goal) for a sample of the share ``keep`` of the tokens.

    No value can give more than its tokens, so each dimension's goals are min(tokens, c share), with
    c such that they add up to the sample. The sum grows with c, so it is taken at several c in one
    pass, for all dimensions, and again between the two that hold the sample. The driver gets a few
    numbers for each dimension.
    """
    sums = found.groupBy("dimension").agg(F.sum("tokens").alias("all"), F.max(F.try_divide("tokens", "share")).alias("high"))
    bounds = {row.dimension: (0.0, row.high or 0.0, keep * row["all"]) for row in sums.collect()}
    if not bounds:
        return found.select("dimension", "value", F.lit(0.0).alias("goal"))

    def goal(at: dict[str, float]) -> Column:
        c = reduce(lambda rest, name: F.when(F.col("dimension") == name, F.lit(at[name])).otherwise(rest), at, F.lit(0.0))
        return F.least("tokens", c * F.col("share"))

    for _ in range(rounds):
        steps = [
            {name: low + (high - low) * step / (tries + 1) for name, (low, high, _) in bounds.items()} for step in range(1, tries + 1)
        ]
        got = found.groupBy("dimension").agg(*[F.sum(goal(at)).alias(f"c{i}") for i, at in enumerate(steps)]).collect()
        for row in got:
            low, high, sample = bounds[row.dimension]
            below = sum(row[f"c{i}"] < sample for i in range(tries))
            ends = [low, *[at[row.dimension] for at in steps], high]
            bounds[row.dimension] = (ends[below], ends[below + 1], sample)
    return found.select("dimension", "value", goal({name: high for name, (_, high, _) in bounds.items()}).alias("goal"))


def _scaled(
    cells: pd.DataFrame, wanted: pd.DataFrame, factors: dict[str, dict], dimensions, most: float | None, rounds: int, close: float,
) -> tuple[np.ndarray, dict[str, np.ndarray], dict[str, np.ndarray], dict[str, list]]:
    """The steps of ``raked`` in numpy: factors of the cells, and of each dimension's values their
    factors, sums and names."""
    tokens = cells["tokens"].fillna(0).to_numpy(float)
    names, places, goal, mine = {}, {}, {}, {}
    for name in dimensions:
        rows = wanted[wanted["dimension"] == name]
        names[name] = [None if pd.isna(value) else value for value in rows["value"]]
        number = {value: at for at, value in enumerate(names[name])}
        # A value without a goal has no tokens; it is dealt to one place more.
        places[name] = np.array([number.get(None if pd.isna(v) else v, len(number)) for v in cells[name]], np.int64)
        goal[name] = np.append(rows["goal"].to_numpy(float), 0.0)
        mine[name] = np.array([factors[name].get(value, 1.0) for value in names[name]] + [0.0])

    def weighed() -> np.ndarray:
        product = np.ones(len(cells))
        for name in dimensions:
            product = product * mine[name][places[name]]
        return product if most is None else np.minimum(product, most)

    def sums(name: str) -> np.ndarray:
        return np.bincount(places[name], tokens * weighed(), len(goal[name]))

    total = goal[dimensions[0]].sum() or 1.0
    for _ in range(rounds):
        off = 0.0
        for name in dimensions:
            got = sums(name)
            off = max(off, np.abs(got - goal[name]).max())
            mine[name] = np.where(got > 0, mine[name] * goal[name] / np.where(got > 0, got, 1), 0.0)
        if off < close * total:
            break
    return weighed(), {name: mine[name][:-1] for name in dimensions}, {name: sums(name)[:-1] for name in dimensions}, names


def _raked_here(
    cells: DataFrame, wanted: DataFrame, dimensions, most: float | None, rounds: int, close: float,
    start: dict[str, DataFrame] | None,
) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """``raked`` for a number of cells that was found to be small."""
    spark = cells.sparkSession
    rows, goal = cells.select(*dimensions, "tokens").toPandas(), wanted.select("dimension", "value", "goal").toPandas()
    known = {name: {} if start is None else {row.value: row.factor for row in start[name].collect()} for name in dimensions}
    product, factors, got, names = _scaled(rows, goal, known, dimensions, most, rounds, close)
    plain = [[None if pd.isna(v) else v for v in rows[name]] for name in dimensions]
    tokens = [None if pd.isna(n) else int(n) for n in rows["tokens"]]
    found = [
        (*values, n, float(x) if n else None) for *values, n, x in zip(*plain, tokens, product)
    ]
    kinds = ", ".join(f"{name} string" for name in dimensions)
    met = [
        (name, value, float(g), float(x)) for name in dimensions
        for value, g, x in zip(names[name], goal.loc[goal["dimension"] == name, "goal"], got[name])
    ]
    return (
        spark.createDataFrame(found, f"{kinds}, tokens long, factor double"),
        spark.createDataFrame(met, "dimension string, value string, goal double, got double"),
        {
            name: spark.createDataFrame(list(zip(names[name], map(float, factors[name]))), "value string, factor double")
            for name in dimensions
        },
    )


def raked(
    cells: DataFrame, wanted: DataFrame, dimensions=DIMENSIONS, most: float | None = None,
    rounds: int = ROUNDS, close: float = CLOSE, start: dict[str, DataFrame] | None = None, here: int = HERE,
) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """A factor for each cell so that tokens times factor add up to each value's goal.

    ``cells`` has the dimensions and tokens, ``wanted`` has dimension, value and goal. Iterative
    proportional fitting: a cell's factor is the product of one factor for each of its values,
    bounded by ``most``; each step scales those of one dimension by goal over sum. It ends when no
    value was off by ``close`` of the total, or after so many rounds, as goals that contradict each
    other are never met. The first result is the cells with their factor, the second (dimension,
    value, goal, got) says how far each value came, the third the values' factors, (value, factor)
    of each dimension, from which another fit may ``start``.

    Up to ``here`` cells, which are counts, are scaled in numpy: a round is then no job. Of more
    cells a step adds up the tokens per value, before they are shuffled, and writes one factor
    for each value; cells are never gathered by value, and the driver gets one number. Both ways take the
    same steps.
    """
    if cells.limit(here + 1).count() <= here:
        return _raked_here(cells, wanted, dimensions, most, rounds, close, start)
    factors = {}
    for name in dimensions:
        rows = wanted.where(F.col("dimension") == name).select("value", "goal")
        first = None if start is None else start[name].select(F.col("value").alias("of"), "factor")
        rows = rows.withColumn("factor", F.lit(1.0)) if first is None else (
            rows.join(first, rows["value"].eqNullSafe(first["of"]), "left").select("value", "goal", F.coalesce("factor", F.lit(1.0)).alias("factor"))
        )
        factors[name] = stored(rows, "factors")
    total = factors[dimensions[0]].agg(F.sum("goal")).first()[0] or 1.0

    def weighed() -> DataFrame:
        rows = cells
        for name in dimensions:
            one = factors[name].select("value", F.col("factor").alias(f"of_{name}"))
            rows = rows.join(one, rows[name].eqNullSafe(one["value"]), "left").drop("value")
        product = reduce(lambda a, b: a * b, [F.coalesce(f"of_{name}", F.lit(0.0)) for name in dimensions])
        product = F.when(F.col("tokens") > 0, product if most is None else F.least(F.lit(most), product))
        return rows.select(*dimensions, "tokens", product.alias("factor"))

    def sums(name: str) -> DataFrame:
        got = weighed().groupBy(F.col(name).alias("of")).agg(F.sum(F.col("tokens") * F.col("factor")).alias("got"))
        one = factors[name]
        return one.join(got, one["value"].eqNullSafe(got["of"]), "left").select(
            "value", "goal", "factor", F.coalesce("got", F.lit(0.0)).alias("got")
        )

    for _ in range(rounds):
        off = 0.0
        for name in dimensions:
            before = stored(sums(name), "sums")
            off = max(off, before.agg(F.max(F.abs(F.col("got") - F.col("goal")))).first()[0] or 0.0)
            scaled = F.when(F.col("got") > 0, F.col("factor") * F.col("goal") / F.col("got")).otherwise(0.0)
            factors[name] = before.select("value", "goal", scaled.alias("factor"))
        if off < close * total:
            break
    met = [sums(name).select(F.lit(name).alias("dimension"), "value", "goal", "got") for name in dimensions]
    return weighed(), reduce(DataFrame.union, met), {name: rows.select("value", "factor") for name, rows in factors.items()}


def uniform(*columns: str | Column) -> Column:
    """A number from 0 to 1 drawn by a hash of the columns: the same wherever and whenever drawn."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def fitted(
    cells: DataFrame, targets: DataFrame | None = None, keep: float = KEEP, dimensions=DIMENSIONS
) -> tuple[DataFrame, DataFrame]:
    """The cells with weight and probability; and (dimension, value, goal, got) of the sample.

    weight is the factor that rakes the tokens to the targets, which default to tempered shares.
    The probability is raked to the targets' share of the sample as well, bounded by one, so cells
    that are taken whole stay so while the others go on to the goals.
    """
    found = goals(cells, tempered(cells, dimensions=dimensions) if targets is None else targets, dimensions)
    every = cells.agg(F.sum("tokens").cast("double")).first()[0] or 0.0
    weights, _, factors = raked(cells, found.withColumn("goal", F.col("share") * every), dimensions)
    weights = weights.withColumnRenamed("factor", "weight")
    # Where no cell is full these are the weights, times the share that is kept.
    factors[dimensions[0]] = factors[dimensions[0]].withColumn("factor", F.col("factor") * keep)
    wanted = stored(within_tokens(found, keep), "wanted")
    chances, met, _ = raked(cells, wanted, dimensions, most=1.0, close=NEAR, start=factors)
    same = reduce(lambda a, b: a & b, [weights[name].eqNullSafe(chances[name]) for name in dimensions])
    return weights.join(chances, same).select(
        *[weights[name] for name in dimensions], weights["tokens"], "weight", F.col("factor").alias("probability")
    ), met


def mixture(
    rows: DataFrame, targets: DataFrame | None = None, keep: float = KEEP, seed: int = SEED,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Add weight, probability and kept to rows of doc_id, text_hash, source, lang, topic, tokens.

    Other columns pass through, but for those three, which are replaced. weight is the factor by
    which raking changed the tokens of the row's cell. probability is such that the expected sample
    has the share ``keep`` of all tokens, with the targets as its marginals; a value that has too few
    tokens for its target is taken whole, and the others of its dimension share the rest. If a
    value is off by more than ``tolerance`` of the sample, as targets can contradict each other, a
    warning names the worst. kept tells whether the row is in the sample, by a hash of seed, doc_id and
    text_hash, so a run again draws alike, and so do repeated rows. A NULL source or language is a
    value of its own. Rows without tokens have weight and probability 1.
    ``targets`` (dimension, value, share) default to tempered shares. An empty table stays empty.
    """
    rows = rows.drop("weight", "probability", "kept")
    cells = stored(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    found, met = fitted(cells, targets, keep)
    worst = met.orderBy(F.desc(F.abs(F.col("got") - F.col("goal")))).first()
    sample = keep * (cells.agg(F.sum("tokens")).first()[0] or 0)
    if worst and abs(worst.got - worst.goal) > tolerance * sample:
        warnings.warn(f"the sample holds {worst.got:g} of {worst.goal:g} tokens of {worst.dimension} {worst.value}", stacklevel=2)
    found = stored(found.select(
        *[F.col(name).alias(f"_{name}") for name in DIMENSIONS],
        F.coalesce("weight", F.lit(1.0)).alias("weight"), F.coalesce("probability", F.lit(1.0)).alias("probability"),
    ), "fitted")
    same = reduce(lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in DIMENSIONS])
    joined = rows.join(found, same).drop(*[f"_{name}" for name in DIMENSIONS])
    return joined.withColumn(
        "kept", uniform(F.lit(seed), "doc_id", "text_hash") < F.col("probability")
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling probability of every document under tempered source, language and topic shares."""
    rows = stored(with_topics(table(spark, sf_dir, "documents")), "topics")
    return mixture(rows).drop("text_hash")
