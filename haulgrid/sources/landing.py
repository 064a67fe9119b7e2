"""Landing of the raw load file: declared column types, no business change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 31 raw columns and their landed types. Dates stay text because the
# duplicate rule ranks by that text. The last column repeats another one under a dotted name.
RAW_COLUMNS = {
    "load_id": "bigint",
    "lane": "string",
    "quote_date": "string",
    "book_date": "string",
    "source_date": "string",
    "pickup_date": "string",
    "delivery_date": "string",
    "book_price": "double",
    "source_price": "double",
    "pnl": "double",
    "mileage": "double",
    "equipment_type": "string",
    "carrier_rating": "double",
    "sourcing_channel": "string",
    "vip_carrier": "boolean",
    "carrier_dropped_us_count": "double",
    "carrier_name": "string",
    "shipper_name": "string",
    "carrier_on_time_to_pickup": "boolean",
    "carrier_on_time_to_delivery": "boolean",
    "carrier_on_time_overall": "boolean",
    "pickup_appointment_time": "string",
    "delivery_appointment_time": "string",
    "has_mobile_app_tracking": "boolean",
    "has_macropoint_tracking": "boolean",
    "has_edi_tracking": "boolean",
    "contracted_load": "boolean",
    "load_booked_autonomously": "boolean",
    "load_sourced_autonomously": "boolean",
    "load_was_cancelled": "boolean",
    "has_mobile_app_tracking.1": "boolean",
}

# Quotes inside quoted fields are doubled, and blanks at the ends of fields are kept.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def quoted(name: str) -> F.Column:
    """Column by its literal name, also when the name holds a dot."""
    return F.col(f"`{name}`")


def read_loads_csv(
    spark: SparkSession, path: str, id_column: str = "load_id", multi_line: bool = False
) -> DataFrame:
    """Read headered load files as the raw table, in the declared column order.

    The header decides which column is where (only its line is read for that); ``id_column``
    is the header's name for the load id. A value that does not fit its type fails the read.
    ``multi_line`` allows line breaks inside quoted fields, at the price of unsplittable files.
    """
    source = spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line)
    header = source.csv(path).columns
    types = {(id_column if name == "load_id" else name): t for name, t in RAW_COLUMNS.items()}
    missing = [name for name in types if name not in header]
    if missing:
        raise ValueError(f"columns missing from the header: {missing}")
    schema = T.StructType(
        [T.StructField(n, T.DataType.fromDDL(types.get(n, "string"))) for n in header]
    )
    rows = (
        source.schema(schema)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    return rows.select(
        quoted(id_column).alias("load_id"), *[quoted(n) for n in types if n != id_column]
    )


def write_loads_csv(raw: DataFrame, path: str) -> None:
    """Write raw loads as headered CSV files."""
    raw.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
