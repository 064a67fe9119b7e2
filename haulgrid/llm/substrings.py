"""Substring deduplication: word windows that an earlier document has, found in sharded FM-indexes.

Text is dealt to shards by its content. Each window of ``window`` words has an anchor, its k-gram of
least hash; a run of windows with one anchor is a segment, and two equal windows lie in segments
with equal anchors. So a window can only repeat within the segments of its anchor, and anchors seen
in one document alone need not be looked at. The distinct segments of the others are indexed in
shards of bounded size, each an FM-index in a wavelet matrix, through which they are streamed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from haulgrid.llm.common import mapped, partitions, stored, table
from haulgrid.llm.fmindex import WordIndex

WINDOW = 50
GRAM = 8
#: Words of a shard, about, and distinct segments of an anchor beyond which its windows are dealt
#: to shards one by one.
SHARD_WORDS = 250_000
CROWDED = 2000
#: Bytes whose words are hashed at a time.
CHUNK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    size = 0

    @classmethod
    def upto(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size > cls.size:
            cls.size = max(size, CHUNK // 8)
            for name, base in (("up", _BASE), ("down", cls.inverse)):
                powers = np.full(cls.size, base, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers))
        return cls.up, cls.down


def _hashed(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word."""
    joined = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    up, down = _Powers.upto(len(joined))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * up[: len(joined)], out=sums[1:])
    ends = np.flatnonzero(joined == 32)
    starts = np.concatenate(([0], ends[:-1] + 1))
    value = (sums[ends] - sums[starts]) * down[starts]
    value ^= value >> np.uint64(29)
    value *= _MIX
    return value ^ value >> np.uint64(32)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of all words, computed for some of them at a time, so that memory stays bounded."""
    sizes = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    parts, at = [], 0
    while at < len(words):
        upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + CHUNK, side="right"))
        upto = max(upto, at + 1)
        parts.append(_hashed(words[at:upto]))
        at = upto
    return np.concatenate(parts)


def anchors(words: list[bytes], window: int, gram: int):
    """(key, first, last): hash of each anchor's k-gram, first and last window that have the anchor."""
    hashes = word_hashes(words)
    keys = np.zeros(len(hashes) - gram + 1, np.uint64)
    for at in range(gram):
        keys = keys * _BASE + hashes[at: at + len(keys)]
    keys ^= keys >> np.uint64(31)
    keys *= _MIX
    run = window - gram + 1
    number = len(words) - window + 1
    least = np.empty(number, np.int64)
    for at in range(0, number, CHUNK // 16):
        upto = min(number, at + CHUNK // 16)
        view = np.lib.stride_tricks.sliding_window_view(keys[at: upto + run - 1], run)
        least[at:upto] = view.argmin(axis=1) + np.arange(at, upto)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], number) - 1
    return keys[least[first]].view(np.int64), first, last


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The segments of each text, without their words; a segment's id is a 128-bit hash of them."""
    def of(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [_split(text) for text in batch["text"]]
        long = np.array([len(words) >= window for words in texts], bool)
        keys, segments, firsts, lasts = [], [], [], []
        for words in (words for words, enough in zip(texts, long) if enough):
            key, first, last = anchors(words, window, gram)
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))
            spans = zip(starts[first].tolist(), ends[last + window - 1].tolist())
            segments += [xxhash.xxh3_128_digest(joined[i:j]) for i, j in spans]
            keys.append(key)
            firsts.append(first)
            lasts.append(last)
        many = [len(key) for key in keys]
        none = np.zeros(0, np.int64)
        return pd.DataFrame({
            "key": np.concatenate([none, *keys]), "segment": segments,
            "doc_id": np.repeat(batch["doc_id"].to_numpy()[long], many),
            "text_hash": np.repeat(batch["text_hash"].to_numpy()[long], many),
            "first": np.concatenate([none, *firsts]), "last": np.concatenate([none, *lasts]),
        })

    return mapped(
        docs.where("doc_id is not null"), of,
        "key long, segment binary, doc_id long, text_hash long, first int, last int",
    )


def _segment_rows(docs: DataFrame, window: int) -> DataFrame:
    """Cut the listed segments out of each text."""
    def of(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in batch.itertuples(index=False):
            words = _split(row.text)
            for key, segment, first, last in zip(row.key, row.segment, row.first, row.last):
                out.append((key, segment, row.doc_id, b" ".join(words[first: last + window]).decode()))
        return pd.DataFrame(out, columns=["key", "segment", "first_doc", "words"])

    return mapped(
        docs.select("doc_id", "text", "wanted.key", "wanted.segment", "wanted.first", "wanted.last"), of, "key long, segment binary, first_doc long, words string"
    )


def _window_rows(segments: DataFrame, window: int) -> DataFrame:
    """Each window of each segment as a segment of its own."""
    def of(batch: pd.DataFrame) -> pd.DataFrame:
        out = []
        for segment, first_doc, text in zip(batch["segment"], batch["first_doc"], batch["words"]):
            words = text.encode().split(b" ")
            for at in range(len(words) - window + 1):
                cut = b" ".join(words[at: at + window])
                out.append((segment, at, first_doc, xxhash.xxh3_128_digest(cut), cut.decode()))
        return pd.DataFrame(out, columns=["segment", "at", "first_doc", "cut", "words"])

    return mapped(
        segments.select("segment", "first_doc", "words"), of,
        "segment binary, at int, first_doc long, cut binary, words string",
    )


def _searched(segments: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(segment, least): by shard, the least document that has each window of each segment."""
    words = segments.agg(F.sum(F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) + 1))
    shards = max(partitions(segments.sparkSession), -(-(words.first()[0] or 0) // shard_words))

    def search(batch: pd.DataFrame) -> pd.DataFrame:
        index = WordIndex([text.encode() for text in batch["words"]], batch["first_doc"].to_numpy(), window)
        return pd.DataFrame({"segment": batch["segment"], "least": index.least_documents()})

    return (
        segments.withColumn("shard", F.pmod("deal", F.lit(shards)))
        .select("shard", "segment", "first_doc", "words")
        .groupBy("shard").applyInPandas(search, "segment binary, least array<long>")
    )


def repeated_windows(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM,
    shard_words: int = SHARD_WORDS, crowded: int = CROWDED,
) -> DataFrame:
    """(doc_id, text_hash, starts): places of the windows that a document with a smaller id has too.

    ``docs`` has doc_id, text and text_hash. Documents without such a window are left out.
    """
    gram = min(gram, window)
    found = stored(_anchor_rows(docs, window, gram), "anchors")
    shared = stored(
        found.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        .where("low < high").select("key"),
        "shared",
    )
    places = stored(found.join(shared, "key", "left_semi").distinct(), "places")
    # Copies of a segment are one segment; its words come from the least document that has it.
    holders = places.groupBy("segment").agg(
        F.min(F.struct("doc_id", "text_hash", "first", "last", "key")).alias("at")
    )
    wanted = holders.groupBy("at.doc_id", "at.text_hash").agg(
        F.collect_list(F.struct("segment", "at.key", "at.first", "at.last")).alias("wanted")
    )
    # Repeated rows once; Spark drops those of a scan task before the shuffle that the join needs.
    row = F.row_number().over(W.partitionBy("doc_id", "text_hash").orderBy("doc_id"))
    once = docs.withColumn("_row", row).where("_row = 1").drop("_row")
    distinct = stored(_segment_rows(once.join(wanted, ["doc_id", "text_hash"]), window), "segments")
    busy = stored(
        distinct.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowded).select("key"),
        "busy",
    )
    plain = distinct.withColumn("deal", F.xxhash64("key"))
    if busy.isEmpty():
        least = _searched(plain, window, shard_words)
    else:
        single = stored(_window_rows(distinct.join(busy, "key", "left_semi"), window), "windows")
        cuts = single.groupBy("cut", "words").agg(F.min("first_doc").alias("first_doc")).select(
            F.col("cut").alias("segment"), "words", "first_doc", F.xxhash64("cut").alias("deal")
        )
        rest = plain.join(busy, "key", "left_anti").select("segment", "words", "first_doc", "deal")
        every = stored(_searched(stored(rest.union(cuts), "dealt"), window, shard_words), "least")
        gathered = (
            single.select("segment", "at", "cut")
            .join(every.select(F.col("segment").alias("cut"), F.col("least")[0].alias("low")), "cut")
            .groupBy("segment")
            .agg(F.array_sort(F.collect_set(F.struct("at", "low"))).alias("all"))
            .select("segment", F.col("all.low").alias("least"))
        )
        least = every.join(rest.select("segment").distinct(), "segment", "left_semi").union(gathered)
    starts = places.join(stored(least, "found"), "segment").select(
        "doc_id", "text_hash",
        F.filter(
            F.transform("least", lambda low, at: F.when(low < F.col("doc_id"), F.col("first") + at)),
            lambda at: at.isNotNull(),
        ).alias("starts"),
    )
    return (
        starts.where(F.size("starts") > 0).groupBy("doc_id", "text_hash")
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """Add to each row of ``docs``: n_words, n_removed, spans (removed words from, to) and kept.

    ``docs`` has doc_id and text; its other columns pass through, whatever their names are, but
    those four are replaced. Words are what ASCII blanks separate. A word is removed if it lies in
    a window of ``window`` words that a document with a smaller doc_id has too, in the text as it
    came in. kept is the remaining words, joined by one space. A NULL or blank text has no words;
    shorter texts have no window. Rows with one doc_id do not remove from each other, and repeated
    rows come out alike. A row with a NULL doc_id is before and after no other, so it stays whole
    and removes nothing. An empty table stays empty.
    """
    mine = [name for name in docs.columns if name not in ("n_words", "n_removed", "spans", "kept")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    starts = stored(repeated_windows(rows, window, **options), "starts")
    # Names of the helper columns that no column of the table has.
    free = "_".join(["_", *mine])
    carried = docs.select(*mine).withColumns({
        f"{free}_id": F.col("doc_id").cast("long"), f"{free}_hash": F.xxhash64(F.col("text").cast("string"))
    })

    @F.pandas_udf("array<struct<from:int,to:int>>")
    def joined_windows(places: pd.Series) -> pd.Series:
        out = []
        for at in places:
            at = np.unique(at)
            apart = np.flatnonzero(np.diff(at) > window)
            begins, ends = at[np.append(0, apart + 1)], at[np.append(apart, len(at) - 1)] + window
            out.append([{"from": int(i), "to": int(j)} for i, j in zip(begins, ends)])
        return pd.Series(out)

    # Texts stay in Spark: only places go to Python, before they meet the texts.
    marked = starts.select(
        F.col("doc_id").alias(f"{free}_id"), F.col("text_hash").alias(f"{free}_hash"),
        joined_windows("starts").alias(f"{free}_spans"),
    )
    none = F.array().cast("array<struct<from:int,to:int>>")
    spans, words = F.col(f"{free}_spans"), F.col(f"{free}_words")
    rows = (
        carried.join(marked, [f"{free}_id", f"{free}_hash"], "left")
        .select(*mine, F.coalesce(spans, none).alias(f"{free}_spans"))
        .withColumn(f"{free}_words", _words(F.col("text").cast("string")))
    )
    return rows.select(
        *mine, F.size(words).cast("long").alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda sum_, span: sum_ + span["to"] - span["from"]).alias("n_removed"),
        spans.alias("spans"), F.array_join(_outside(words, spans), " ").alias("kept"),
    )


def _words(text: Column) -> Column:
    """What ASCII blanks separate, as ``_split`` has it; none if the text is NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def _outside(words: Column, spans: Column) -> Column:
    """The words that lie in none of the spans, which are in order and apart."""
    def between(at: Column) -> Column:
        begin = F.when(at == 0, 0).otherwise(F.get(spans, at - 1)["to"])
        end = F.when(at == F.size(spans), F.size(words)).otherwise(F.get(spans, at)["from"])
        return F.slice(words, begin + 1, end - begin)

    cut = F.flatten(F.transform(F.sequence(F.lit(0), F.size(spans)), between))
    return F.when(F.size(spans) > 0, cut).otherwise(words)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without the passages that an earlier document has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id,
    coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), w AS (
  SELECT row_id, doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS span
  FROM d, unnest(range(1, len(words) - {WINDOW} + 2)) AS t(i)
), f AS (
  SELECT span, min(doc_id) AS low FROM w GROUP BY span HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT row_id, p FROM w JOIN f USING (span), unnest(range(i, i + {WINDOW})) AS t(p) WHERE low < doc_id
), g AS (
  SELECT row_id, count(*) AS n_removed, list(p) AS places FROM gone GROUP BY row_id
), k AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d)
  ANTI JOIN gone USING (row_id, p) GROUP BY row_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (row_id) LEFT JOIN k USING (row_id)
"""
