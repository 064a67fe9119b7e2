"""Keeping one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from haulgrid.sources.landing import quoted
from haulgrid.sources.scratch import written

#: Keys that are broadcast, at most; more are hashed where the rows are shuffled to, without a sort.
SMALL = 1_000_000


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """(_key) the values, the missing one included, that more than one row has, for ``with_keys``.

    Of a row only the key is shuffled. The values are written, so both ways of using them know them.
    """
    counts = rows.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_rows"))
    found = written(counts.where(F.col("_rows") > 1).select("_key"), "repeated")
    return found.hint("broadcast" if found.count() <= SMALL else "shuffle_hash")


def with_keys(rows: DataFrame, key: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows that have one of the keys, or with ``left_anti`` the others."""
    return rows.join(keys, rows[key].eqNullSafe(keys["_key"]), how)


def first_copy(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, compared as stored, missing values last.

    Rows equal in all of ``order`` are told apart by a hash of the whole row, so that the
    outcome does not depend on how the rows were read. Only rows whose key occurs more than once are
    sorted; all others stay where they are. Each task keeps one row per key before the
    shuffle, so a key with very many copies does not land in one task.
    """
    repeated = repeated_keys(rows, key)
    whole_row = F.xxhash64(*[quoted(c) for c in rows.columns])
    ranking = W.partitionBy(key).orderBy(*[F.asc_nulls_last(c) for c in order], whole_row)
    ranked = with_keys(rows, key, repeated).withColumn("_rank", F.row_number().over(ranking))
    return with_keys(rows, key, repeated, "left_anti").unionByName(ranked.where(F.col("_rank") == 1).drop("_rank"))
