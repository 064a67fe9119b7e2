"""Profiling of raw and staged loads. Every count over one table comes from one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrid.functions.cleaning import LANE_SHAPE
from haulgrid.operators.dedupe import repeated_keys, with_keys
from haulgrid.sources.landing import quoted


def shape(raw: DataFrame) -> DataFrame:
    return raw.agg(
        F.count("*").alias("row_count"), F.lit(len(raw.columns)).alias("column_count")
    )


def duplicates(raw: DataFrame, key: str) -> DataFrame:
    """Ids that occur more than once, and rows that repeat another row in full.

    Of most rows only the id is shuffled; of those whose id occurs again also 128 bits of hash. The
    hashes pass over missing values, so they also take which ones are missing. Copies are counted
    before the shuffle.
    """
    columns = [quoted(c) for c in raw.columns]
    missing = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    copies = with_keys(raw, key, repeated_keys(raw, key)).groupBy(
        key, F.xxhash64(missing, *columns).alias("_one"), F.xxhash64(F.lit(1), *columns, missing).alias("_two")
    ).agg(F.count("*").alias("_copies"))
    ids = copies.groupBy(key).agg(F.sum("_copies").alias("_rows"), F.count("*").alias("_kinds"))
    return ids.where(F.col("_rows") > 1).agg(
        F.count("*").alias("duplicated_ids"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_kinds")), F.lit(0)).alias("duplicate_rows"),
    )


def constant_columns(raw: DataFrame) -> DataFrame:
    """Per column: does every row hold one and the same value? Counts in one pass the rows that
    differ from any one row, instead of counting distinct values of each column."""
    names = [c.replace(".", "_") for c in raw.columns]
    plain = raw.toDF(*names)
    sample = plain.limit(1).select(F.struct(*names).alias("row")).scalar()
    differs = plain.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~F.col(c).eqNullSafe(sample.getField(c))).alias(c) for c in names],
        sample.alias("_sample"),
    )
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            ((F.col("_rows") > 0) & (F.col(c) == 0)
             & F.col("_sample").getField(c).isNotNull()).alias("is_constant"),
        )
        for c in names
    ])
    return differs.select(F.explode(entries).alias("r")).select("r.*")


def null_counts(rows: DataFrame) -> DataFrame:
    """Missing values of every column."""
    found = rows.agg(*[
        F.struct(
            F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("null_count")
        ).alias(f"c{i}")
        for i, c in enumerate(rows.columns)
    ])
    entries = F.array(*[f"c{i}" for i in range(len(rows.columns))])
    return found.select(F.explode(entries).alias("r")).select("r.*")


def rating_range(staged: DataFrame) -> DataFrame:
    return staged.agg(
        F.min("carrier_rating").alias("min_rating"), F.max("carrier_rating").alias("max_rating")
    )


def value_counts(staged: DataFrame) -> DataFrame:
    """Cancelled loads; zero and negative prices; negative P&L."""
    book, source = F.col("book_price"), F.col("source_price")
    return staged.agg(
        F.count_if(F.col("load_was_cancelled")).alias("cancelled"),
        F.count_if(book == 0).alias("zero_book_price"),
        F.count_if(source == 0).alias("zero_source_price"),
        F.count_if(book < 0).alias("negative_book_price"),
        F.count_if(source < 0).alias("negative_source_price"),
        F.count_if(F.col("pnl") < 0).alias("negative_pnl"),
    )


def order_violations(staged: DataFrame) -> DataFrame:
    """Lifecycle steps out of order, over all loads."""
    delivered, pickup, booked = F.col("delivered_at"), F.col("pickup_at"), F.col("booked_at")
    return staged.agg(
        F.count_if(delivered < pickup).alias("delivery_before_pickup"),
        F.count_if(pickup < booked).alias("pickup_before_book"),
        F.count_if(delivered < booked).alias("delivery_before_book"),
    )


def cancelled_by_delivered(staged: DataFrame) -> DataFrame:
    def zeroes(column: str):
        return F.sum(F.when(F.col(column) == 0, 1).otherwise(0))

    return (
        staged.groupBy("load_was_cancelled", "is_delivered")
        .agg(
            F.count("*").alias("loads"),
            zeroes("book_price").alias("zero_book_price"),
            zeroes("source_price").alias("zero_source_price"),
        )
        .orderBy(F.asc_nulls_last("load_was_cancelled"), F.asc_nulls_last("is_delivered"))
    )


def lane_conformity(staged: DataFrame) -> DataFrame:
    fits = F.col("lane").rlike(LANE_SHAPE)
    return staged.agg(
        F.count_if(fits).alias("well_formed"), F.count_if(~fits).alias("malformed"),
        F.count_if(F.col("lane").isNull()).alias("missing"),
    )
