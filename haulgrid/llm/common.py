"""Helpers that several operators share."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from haulgrid.session import shared_folder

# Functions of this subpackage are sent to executors whole, as they may not have it installed.
cloudpickle.register_pickle_by_value(sys.modules["haulgrid.llm"])

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written as Parquet to the shared folder and read from there.

    This cuts the lineage, survives lost executors and tells Spark the true size of the table.
    """
    path = f"{shared_folder(rows.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows that a function is given at a time, so that what it makes of them stays small.
AT_ONCE = 500


def mapped(
    rows: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: str, at_once: int = AT_ONCE
) -> DataFrame:
    """Apply a function to some rows after the others.

    Only the rows that the function is given are Python objects, not a whole batch of Spark's.
    """
    kinds = T.StructType.fromDDL(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kinds)
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                some = batch.slice(at, at_once).to_pandas(integer_object_nulls=True)
                yield from pa.Table.from_pandas(function(some), arrow, preserve_index=False).to_batches()

    return rows.mapInArrow(over, kinds)


def bounded(known: DataFrame, sample: int) -> DataFrame:
    """Rows (doc_id, text, ...) to fit a model on: all, or if an id has so many rows that there are
    a quarter more than ``sample``, a draw of about so many by hash of id and text."""
    number = known.count()
    if number <= sample * 5 // 4:
        return known
    return known.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(sample / number * 1_000_000))


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Add ``number``, the row's place in the order, from 0; written to the shared folder.

    Rows are dealt in ranges and sorted there. Equal ones are told apart by where they came from,
    so copies do not meet in one range. The window counts ranges, of which there are at most as
    many as shuffle partitions.
    """
    apart = rows.withColumn("copy", F.monotonically_increasing_id())
    dealt = apart.repartitionByRange(*order, "copy").sortWithinPartitions(*order, "copy").drop("copy")
    dealt = stored(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    range_ = F.shiftrightunsigned("at", 33)
    counts = dealt.groupBy(range_.alias("range")).agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.orderBy("range"))
    starts = counts.select("range", (upto - F.col("rows")).alias("start"))
    number = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.join(F.broadcast(starts), range_ == F.col("range")).withColumn("number", number).drop("range", "start", "at")


def lowered(text: str | Column) -> Column:
    """Lower-case A to Z alone. Where all characters are ASCII that is ``lower``, which is faster."""
    text = F.col(text) if isinstance(text, str) else text
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )


def fold_of(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds))
