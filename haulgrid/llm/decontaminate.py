"""Benchmark decontamination by winnowing, with DataFrame functions alone.

A text's fingerprints are the smallest k-gram hash of every run of consecutive k-grams that a
window covers, so any window that a document and an item share has the same fingerprint at the
same place in both. Fingerprints are a hash and a place, 16 bytes a row, and only these meet the
items' fingerprints. Only texts that have a match are split again, to extend each to the item's whole windows, word
for word; the union of these windows is the contaminated part of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.llm.common import ASCII_UPPER, lowered, stored, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5

#: A fingerprint packs 33 bits of a hash above 30 bits of place: a text of two gigabytes, the
#: most there is, has no more words. Equal hashes are only candidates, so 33 bits are enough.
PLACE_BITS = 30
HASH_BITS = 33


def words_of(text: str) -> Column:
    return F.regexp_extract_all(lowered(text), F.lit(WORD), F.lit(0))


def _grams(words: Column, number: Column, gram: int) -> Column:
    """Hash and place of every k-gram; as numbers, the least is the least hash, leftmost."""
    def packed(place: Column) -> Column:
        low = F.xxhash64(*[words[place + step] for step in range(gram)]).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
        return F.shiftleft(low, PLACE_BITS).bitwiseOR(place.cast("long"))

    none = F.array().cast("array<bigint>")
    return F.when(number >= gram, F.transform(F.sequence(F.lit(0), number - gram), packed)).otherwise(none)


def _least(grams: Column, run: int) -> Column:
    """The least of every ``run`` consecutive k-grams, each k-gram once."""
    if run == 1:
        return grams
    none = F.array().cast("array<bigint>")
    every = F.transform(
        F.sequence(F.lit(0), F.size(grams) - run), lambda at: F.least(*[grams[at + step] for step in range(run)])
    )
    return F.when(F.size(grams) >= run, F.array_distinct(every)).otherwise(none)


def _hash(print_: str) -> Column:
    return F.shiftrightunsigned(print_, PLACE_BITS)


def _place(print_: str) -> Column:
    return F.col(print_).bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def item_windows(items: DataFrame, window: int, gram: int) -> DataFrame:
    """(item_id, length, window, hash, offset): each window's words and its fingerprint.

    An item of fewer words than a window is one window of its own length, and its fingerprint is
    that of all its words. Items without an id or without words have none.
    """
    rows = items.where("item_id is not null").select("item_id", words_of("text").alias("words"))
    rows = rows.withColumn("number", F.size("words")).where("number > 0")
    rows = rows.withColumn("length", F.least("number", F.lit(window)))
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("number") - F.col("length") + 1)))
    rows = rows.select("item_id", "length", F.slice("words", F.col("at"), F.col("length")).alias("words"))
    full = rows.where(F.col("length") == window).select(
        "*", F.array_min(_grams(F.col("words"), F.col("length"), gram)).alias("print")
    )
    short = rows.where(F.col("length") < window).select(
        "*", F.shiftleft(F.xxhash64("words").bitwiseAND(F.lit((1 << HASH_BITS) - 1)), PLACE_BITS).alias("print")
    )
    return full.union(short).select(
        "item_id", "length", F.array_join("words", " ").alias("window"),
        _hash("print").alias("hash"), _place("print").alias("offset"),
    )


def prints(docs: DataFrame, lengths: list[int], window: int, gram: int) -> DataFrame:
    """(doc_id, text_hash, n_words, prints): fingerprints for windows of each length, one array each.

    This is the one place where all texts are split into words. The arrays are to be written before
    they are exploded: Spark would push a filter on an array that it explodes below the projection
    that makes it, and there split the text again for every k-gram.
    """
    rows = docs.select("doc_id", "text_hash", words_of("text").alias("words"))
    rows = rows.withColumn("number", F.greatest(F.size("words"), F.lit(0)))
    made = [gram if length == window else length for length in lengths]
    grams = rows.select(
        "doc_id", "text_hash", "number",
        *[_grams(F.col("words"), F.col("number"), size).alias(f"grams{length}") for length, size in zip(lengths, made)],
    )
    least = [_least(F.col(f"grams{length}"), length - size + 1) for length, size in zip(lengths, made)]
    return grams.select(
        "doc_id", "text_hash", F.col("number").cast("long").alias("n_words"),
        F.array(*least).cast("array<array<bigint>>").alias("prints"),
    )


def around(docs: DataFrame, matched: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, text_hash, number, places): the words around each match, as many as windows that
    hold it can have, in the documents that have one. To be written, so that number stays and the
    words, which it needs too, are split once."""
    before = window - gram
    # The keys alone may be few enough to be broadcast, and then no text is shuffled.
    keys = matched.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    docs = docs.join(keys, docs["doc_id"].eqNullSafe(keys["id"]) & (docs["text_hash"] == keys["hash"]), "left_semi")
    same = docs["doc_id"].eqNullSafe(matched["doc_id"]) & (docs["text_hash"] == matched["text_hash"])
    rows = docs.join(matched, same).select(docs["doc_id"], docs["text_hash"], words_of("text").alias("words"), "places")
    return rows.select(
        "doc_id", "text_hash", F.size("words").alias("number"),
        F.transform("places", lambda p: F.struct(
            p["length"].alias("length"), p["hash"].alias("hash"), p["at"].alias("at"),
            F.greatest(p["at"] - before, F.lit(0)).alias("first"),
            F.slice("words", F.greatest(p["at"] - before, F.lit(0)) + 1, before + window).alias("around"),
        )).alias("places"),
    )


def _union_length(spans: Column) -> Column:
    """Words covered by sorted spans, each a place and a length."""
    start = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto"))

    def add(so_far: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        new = F.greatest(F.lit(0), end - F.greatest(span["start"], so_far["upto"]))
        return F.struct(
            (so_far["covered"] + new).alias("covered"),
            F.greatest(so_far["upto"], end).alias("upto"),
        )

    return F.aggregate(spans, start, add)["covered"]


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, spans, item_ids) of each row of ``docs`` (doc_id, text).

    ``items`` has item_id and text. Spans are the places and lengths of all windows found, item_ids
    the sorted ids, as text, of the items with a window in the document. text_hash tells rows with
    one doc_id apart; rows alike in both have the same results, so each comes out once for every
    row that went in. A NULL or empty text has no words and no hit, a NULL doc_id is like any other
    value, items with a NULL id or no word take no part, repeated items count once. With no items
    nothing is hit. Other columns are not read.
    """
    if not 1 <= gram <= window:
        raise ValueError("a k-gram must fit into the window")
    docs = docs.select(
        F.col("doc_id"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash")
    )
    items = items.select("item_id", F.col("text").cast("string"))
    windows = stored(item_windows(items, window, gram).distinct(), "windows")
    # The lengths of items: one, and a number of them below it if there are shorter items.
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())
    wanted = stored(windows.select("length", "hash").distinct(), "wanted")

    rows = stored(prints(docs, lengths, window, gram), "prints")
    each = rows.select("doc_id", "text_hash", F.posexplode("prints").alias("kind", "some"))
    each = each.select("doc_id", "text_hash", F.array(*map(F.lit, lengths))[F.col("kind")].alias("length") if lengths
                       else F.lit(0).alias("length"), F.explode("some").alias("print"))
    matched = stored(
        each.withColumn("hash", _hash("print")).join(wanted, ["length", "hash"], "left_semi")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("length", "hash", _place("print").alias("at"))).alias("places")),
        "matched",
    )
    near = stored(around(docs, matched, window, gram), "around").select("doc_id", "text_hash", F.inline("places"))
    known = windows.select("length", "hash", "offset", "window").distinct()
    hits = near.join(known, ["length", "hash"]).withColumn("start", F.col("at") - F.col("offset")).where(
        (F.col("start") >= 0) & (F.col("window") == F.array_join(
            F.slice("around", F.greatest(F.col("start") - F.col("first"), F.lit(0)) + 1, F.col("length")), " "
        ))
    )
    per_doc = stored(
        hits.groupBy("doc_id", "text_hash").agg(
            F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
            F.array_sort(F.collect_set("window")).alias("windows"),
        ).withColumn("n_hit", _union_length(F.col("spans")).cast("long")),
        "hits",
    )
    # Copies have the same windows, so the items are looked up once for each set of windows.
    sets = per_doc.select("windows").distinct().withColumn("window", F.explode("windows"))
    listed = (
        sets.join(windows.select("window", "item_id").distinct(), "window")
        .groupBy("windows")
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    per_doc = per_doc.join(listed, "windows").select("doc_id", "text_hash", "spans", "n_hit", "item_ids")
    same = rows["doc_id"].eqNullSafe(per_doc["doc_id"]) & (rows["text_hash"] == per_doc["text_hash"])
    return rows.join(per_doc, same, "left").select(
        rows["doc_id"], rows["text_hash"], "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items, and the items concerned."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id, coalesce(regexp_extract_all(
    translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '{WORD}'), []) AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}'), '{WORD}') AS words
  FROM benchmark WHERE item_id IS NOT NULL
), bl AS (
  SELECT item_id, words, least(len(words), {WINDOW}) AS size FROM b WHERE len(words) > 0
), bw AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS span
  FROM bl, unnest(range(1, len(words) - size + 2)) AS t(i)
), dw AS (
  SELECT row_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS span
  FROM d, (SELECT DISTINCT size FROM bw), unnest(range(1, len(words) - size + 2)) AS t(i)
), hit AS (
  SELECT row_id, i, dw.size AS size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.span = bw.span
), covered AS (
  SELECT row_id, count(DISTINCT w) AS n_hit FROM hit, unnest(range(i, i + size)) AS t(w) GROUP BY row_id
), items AS (
  SELECT row_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY row_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (row_id) LEFT JOIN items USING (row_id)
"""
