"""Row-by-row lookups by keys that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Counters that a sketch keeps for each partition, so that a count is off by less than a quarter of
#: a fair share: a sketch of m counters over n rows is off by at most 3.5 n / m.
COUNTERS = 16
#: The most that the sketch takes.
MOST_COUNTERS = 1_000_000


def busy_keys_of(rows: DataFrame, keys: list[str]) -> dict[str, DataFrame]:
    """For each key column (_busy, _salts): the values with more rows than a partition's fair
    share, and how many shares.

    One scan counts all columns: each task keeps the frequent values of each in a sketch of bounded
    size, and the sketches are merged. There are fewer such values than partitions, whatever the
    data. Counts may be off a little, which moves rows between salts but changes no result.
    """
    partitions, spark = _partitions(rows), rows.sparkSession
    counters = min(max(COUNTERS * partitions, 1024), MOST_COUNTERS)
    top = min(partitions + 1, counters)  # a missing value may be one of them
    sketches = rows.agg(*[
        column for at, key in enumerate(keys) for column in (
            F.call_function("approx_top_k", F.col(key), F.lit(top), F.lit(counters)).alias(f"top{at}"),
            F.count(key).alias(f"rows{at}"),
        )
    ])

    def hot(at: int) -> Column:
        """(value, shares) of the values that hold more than one share."""
        held = F.filter(f"top{at}", lambda e: e["item"].isNotNull() & (e["count"] * partitions > F.col(f"rows{at}")))
        return F.transform(held, lambda e: F.struct(
            e["item"], F.ceil(e["count"] * partitions / F.col(f"rows{at}")).cast("int")
        ))

    # Fewer entries than partitions for each key come to the driver.
    found = sketches.select(*map(hot, range(len(keys)))).first()
    return {
        key: spark.createDataFrame(entries, T.StructType([
            T.StructField("_busy", rows.schema[key].dataType), T.StructField("_salts", T.IntegerType()),
        ]))
        for key, entries in zip(keys, found)
    }


def busy_keys(rows: DataFrame, key: str) -> DataFrame:
    """(_busy, _salts) of one key column."""
    return busy_keys_of(rows, [key])[key]


def with_salt(rows: DataFrame, key: str, row_id: str, busy: DataFrame, salt: str) -> DataFrame:
    """Add a salt drawn by a hash of the row's id: one of the key's salts, 0 for other keys.

    A missing key finds nothing, so its rows are spread over all partitions.
    """
    # Fewer rows than partitions, see busy_keys_of.
    marked = rows.join(F.broadcast(busy), F.col(key) == F.col("_busy"), "left")
    salts = F.when(F.col(key).isNull(), F.lit(_partitions(rows))).otherwise(F.coalesce("_salts", F.lit(1)))
    return marked.withColumn(salt, F.pmod(F.xxhash64(row_id), salts).cast("int")).drop("_busy", "_salts")


def over_salts(lookup: DataFrame, key: str, busy: DataFrame, salt: str) -> DataFrame:
    """Lookup rows for a salted join: those of busy keys once per salt, all others once."""
    marked = lookup.join(F.broadcast(busy), F.col(key) == F.col("_busy"), "left")
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return marked.withColumn(salt, F.explode(every)).drop("_busy", "_salts")


def looked_up(rows: DataFrame, row_id: str, *lookups: tuple[str, DataFrame, str]) -> DataFrame:
    """Join rows to one lookup after the other; each is (key, lookup, join type).

    The plan is the same at every size: rows of keys that hold more than a partition's share are
    spread over as many salts as they hold shares, and the lookup rows of those keys are repeated;
    the result is that of the plain join. Whether a lookup is broadcast is up to Spark, which knows
    its bytes. All keys are counted by one scan of the rows. Adaptive execution alone would not do: it finds hot partitions by their bytes, and
    copies or similar rows compress well.
    """
    busy = busy_keys_of(rows, [key for key, *_ in lookups])
    for key, found in busy.items():
        rows = with_salt(rows, key, row_id, found, f"_salt_{key}")
    for key, lookup, how in lookups:
        salt = f"_salt_{key}"
        rows = rows.join(over_salts(lookup, key, busy[key], salt), [key, salt], how).drop(salt)
    return rows
