"""Raw loads and generated responses derived from the given tables.

The load file itself is not public, so every order becomes one load: the customer is the
shipper and its nation the pickup side, the supplier of the order's line items is the carrier
and its nation the delivery side. All orders are used. The remainders below only decide which
*values* a load carries (blank carrier, bad date, zero price and so on), never whether it is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.operators.skew import looked_up
from haulgrid.sources.landing import RAW_COLUMNS, quoted


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stamp_text(moment: Column) -> Column:
    """Timestamp as ``M/D/YYYY H:MM``, from its own fields so that no time zone plays a part."""
    return F.concat(
        F.month(moment), F.lit("/"), F.dayofmonth(moment), F.lit("/"), F.year(moment),
        F.lit(" "), F.hour(moment), F.lit(":"), F.lpad(F.minute(moment).cast("string"), 2, "0"),
    )


def parties(spark: SparkSession, folder: str, name: str, side: str) -> DataFrame:
    """Customers or suppliers with key, name, nation key, city and state, under a prefix."""
    letter = name[0]
    places = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    keys = [f"{letter}_{name[:4]}key", f"{letter}_name", f"{letter}_nationkey"]
    return (
        table(spark, folder, name)
        .join(places, F.col(keys[2]) == F.col("n_nationkey"), "left")
        .select(*keys, "n_name", F.substring("r_name", 1, 2))
        .toDF(*[f"{side}_{c}" for c in ("key", "name", "nation", "city", "state")])
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order over its line items: carrier, first and last shipment, top price."""
    items = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("carrier_key"),
        F.min("l_shipdate").alias("first"),
        F.max("l_shipdate").alias("last"),
        F.max("l_extendedprice").alias("max_price"),
    )
    carriers = parties(spark, folder, "supplier", "carrier")
    return looked_up(items, "l_orderkey", ("carrier_key", carriers, "left")).drop("carrier_key")


def derive_raw_loads(spark: SparkSession, folder: str, items: DataFrame) -> DataFrame:
    """The 31-column raw table, with its exact duplicates, from orders and their parties.

    ``items`` is ``order_items``, whose order key is that of the orders, each once. Places are part
    of the looked-up parties, so that the loads themselves are joined twice only.
    """
    shippers = parties(spark, folder, "customer", "shipper")
    loads = looked_up(
        table(spark, folder, "orders"), "o_orderkey",
        ("o_custkey", shippers.withColumnRenamed("shipper_key", "o_custkey"), "inner"),
    ).join(items.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
    carried = F.col("carrier_nation").isNotNull()
    pickup = {c: F.col(f"shipper_{c}") for c in ("nation", "city", "state")}
    delivery = {c: F.when(carried, F.col(f"carrier_{c}")).otherwise(pickup[c]) for c in pickup}
    loads = loads.where(pickup["city"].isNotNull() & delivery["city"].isNotNull())

    k = F.col("o_orderkey")
    first, last, ordered = F.col("first"), F.col("last"), F.col("o_orderdate")
    max_price = F.coalesce("max_price", F.lit(0.0)).cast("double")
    on_pickup = F.when(k % 4 != 0, k % 5 != 0)
    on_delivery = F.when(k % 4 != 0, k % 6 != 0)
    values = {
        "load_id": k,
        "lane": F.when(k % 2500 == 7, F.lit("BADLANE")).otherwise(
            F.concat(
                F.lit(" "), pickup["city"], F.lit(","), pickup["state"], F.lit(" -> "),
                delivery["city"], F.lit(","), F.lower(delivery["state"]), F.lit(" "),
            )
        ),
        "quote_date": stamp_text(ordered - F.expr("INTERVAL 2 DAYS")),
        "book_date": stamp_text(ordered),
        "source_date": stamp_text(first - F.expr("INTERVAL 90 MINUTES")),
        "pickup_date": stamp_text(first),
        "delivery_date": F.when(k % 101 == 50, F.lit("not a date"))
        .when(k % 19 == 0, stamp_text(first - F.expr("INTERVAL 1 DAY")))
        .otherwise(stamp_text(last)),
        "book_price": F.when(k % 10 == 0, F.lit(0.0)).otherwise(F.col("o_totalprice")),
        "source_price": F.when(k % 3001 == 5, F.lit(-1.0))
        .when(k % 11 == 0, F.lit(0.0))
        .otherwise(max_price),
        "pnl": F.round(F.col("o_totalprice") - max_price * 3, 2),
        "mileage": F.when(k % 29 == 0, F.lit(0)).otherwise(
            F.abs(pickup["nation"] - delivery["nation"]) * 100
        ),
        "equipment_type": F.concat(F.lit(" "), F.lower("o_orderpriority"), F.lit(" ")),
        "carrier_rating": F.when(k % 7 == 0, k % 6),
        "sourcing_channel": F.when(k % 20 == 0, F.lit("api")).otherwise(F.lit("  ")),
        "vip_carrier": k % 3 == 0,
        "carrier_dropped_us_count": k % 4,
        "carrier_name": F.when(k % 13 == 0, F.lit(" ")).otherwise(F.col("carrier_name")),
        "shipper_name": F.col("shipper_name"),
        "carrier_on_time_to_pickup": on_pickup,
        "carrier_on_time_to_delivery": on_delivery,
        "carrier_on_time_overall": on_pickup & on_delivery,
        "pickup_appointment_time": stamp_text(first + F.expr("INTERVAL 3 HOURS")),
        "delivery_appointment_time": stamp_text(last + F.expr("INTERVAL 5 HOURS")),
        "has_mobile_app_tracking": k % 2 == 0,
        "has_macropoint_tracking": k % 3 == 1,
        "has_edi_tracking": k % 5 == 2,
        "contracted_load": k % 8 == 0,
        "load_booked_autonomously": k % 9 == 0,
        "load_sourced_autonomously": k % 10 == 1,
        "load_was_cancelled": k % 17 == 0,
        "has_mobile_app_tracking.1": F.lit(False),
    }
    once = loads.select(
        *[values[name].cast(kind).alias(name) for name, kind in RAW_COLUMNS.items()]
    )
    copies = F.when(F.col("load_id") % 1000 == 0, F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return once.withColumn("_copy", F.explode(copies)).select(*[quoted(n) for n in RAW_COLUMNS])


def derive_responses(spark: SparkSession, folder: str) -> DataFrame:
    """Generated answers to classify: every conversation turn, worded in one of eight ways."""
    text = F.col("text")
    case = (F.col("conv_id") + F.col("turn")) % 8
    worded = (
        F.when(case == 0, F.concat(F.lit("UNSUPPORTED: "), text))
        .when(case == 1, F.concat(F.lit("SELECT count(*) from t where x = "), "turn"))
        .when(case == 2, F.lit("```sql\nwith a as (select 1) select * from a;\n```"))
        .when(case == 3, F.lit("select 1; select 2"))
        .when(case == 4, F.lit("select load_count from t; "))
        .when(case == 5, F.lit("SELECT * from t where k = 'Drop'"))
        .when(case == 6, F.concat(F.lit("  "), text))
        .otherwise(F.lit("selection of loads"))
    )
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", worded.alias("response")
    )
