"""The models: staged loads, four dimensions and the load fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrid.functions import cleaning as C
from haulgrid.operators.dedupe import first_copy
from haulgrid.operators.skew import looked_up
from haulgrid.sources.landing import quoted

# Raw text column -> staged timestamp.
STAMPS = {
    "quote_date": "quote_at",
    "book_date": "booked_at",
    "source_date": "sourced_at",
    "pickup_date": "pickup_at",
    "delivery_date": "delivered_at",
    "pickup_appointment_time": "pickup_appointment_at",
    "delivery_appointment_time": "delivery_appointment_at",
}

# Lifecycle timestamp -> date of the fact; each is a role of the calendar.
ROLES = {
    "quote_at": "quote_date",
    "booked_at": "booked_date",
    "sourced_at": "sourced_date",
    "pickup_at": "pickup_date",
    "delivered_at": "delivery_date",
}

FLAGS = [
    "carrier_on_time_to_pickup",
    "carrier_on_time_to_delivery",
    "carrier_on_time_overall",
    "has_mobile_app_tracking",
    "has_macropoint_tracking",
    "has_edi_tracking",
    "contracted_load",
    "load_booked_autonomously",
    "load_sourced_autonomously",
    "load_was_cancelled",
    "vip_carrier",
]

AMOUNTS = ["book_price", "source_price", "pnl", "mileage", "carrier_rating"]

LANE_COLUMNS = ["pickup_city", "pickup_state", "delivery_city", "delivery_state"]

# The columns of the staged table and of the fact.
STAGED_COLUMNS = [
    "load_id", "lane", *LANE_COLUMNS, *ROLES,
    "book_price", "source_price", "pnl", "mileage",
    "equipment_type", "carrier_rating", "sourcing_channel", "vip_carrier",
    "carrier_dropped_us_count", "carrier_name", "shipper_name",
    "carrier_on_time_to_pickup", "carrier_on_time_to_delivery", "carrier_on_time_overall",
    "pickup_appointment_at", "delivery_appointment_at",
    "has_mobile_app_tracking", "has_macropoint_tracking", "has_edi_tracking",
    "contracted_load", "load_booked_autonomously", "load_sourced_autonomously",
    "load_was_cancelled", "is_delivered", "haul_type",
]

FACT_COLUMNS = [
    "load_id", "shipper_key", "carrier_key", "lane_key", *ROLES.values(),
    *[c for c in STAGED_COLUMNS
      if c not in ("load_id", "lane", "carrier_name", "shipper_name", *LANE_COLUMNS)],
]


def normalized(raw: DataFrame) -> DataFrame:
    """Typed and renamed columns; the repeated dotted column is left behind."""
    return raw.select(
        F.col("load_id").cast("long").alias("load_id"),
        F.trim("lane").alias("lane"),
        *[C.stamp(F.col(text)).alias(to) for text, to in STAMPS.items()],
        *[F.col(c).cast("double").alias(c) for c in AMOUNTS],
        F.upper(F.trim("equipment_type")).alias("equipment_type"),
        *[C.blank_to_null(F.col(c)).alias(c)
          for c in ("sourcing_channel", "carrier_name", "shipper_name")],
        C.whole_number(F.col("carrier_dropped_us_count")).alias("carrier_dropped_us_count"),
        *[F.col(c).cast("boolean").alias(c) for c in FLAGS],
    )


def staged_loads(raw: DataFrame) -> DataFrame:
    """One typed row per load id with lane geography, delivery flag and haul type.

    The copy that is kept is the first by the *text* of its quote and book dates.
    """
    typed = normalized(first_copy(raw, "load_id", ["quote_date", "book_date"]))
    return (
        typed.withColumns(C.lane_columns(F.col("lane")))
        .withColumns({
            "is_delivered": ~F.col("load_was_cancelled") & F.col("delivered_at").isNotNull(),
            "haul_type": C.haul_type(F.col("pickup_state"), F.col("delivery_state")),
        })
        .select(*STAGED_COLUMNS)
    )


def named_members(staged: DataFrame, name: str, key: str) -> DataFrame:
    """Shipper or carrier dimension: one row per distinct name, the missing one included.

    Names are made distinct before they are hashed: each is hashed once, not once per load.
    """
    return staged.select(name).distinct().select(C.member_key(F.col(name)).alias(key), name)


def shipper_dimension(staged: DataFrame) -> DataFrame:
    return named_members(staged, "shipper_name", "shipper_key")


def carrier_dimension(staged: DataFrame) -> DataFrame:
    return named_members(staged, "carrier_name", "carrier_key")


def lane_dimension(staged: DataFrame) -> DataFrame:
    """One row per distinct lane. The other columns follow from the lane, so it alone is grouped."""
    lanes = staged.select("lane").distinct().withColumns(C.lane_columns(F.col("lane")))
    return lanes.select(
        C.lane_key(F.col("lane")).alias("lane_key"), "lane", *LANE_COLUMNS,
        C.haul_type(F.col("pickup_state"), F.col("delivery_state")).alias("haul_type"),
    )


def lifecycle_bounds(staged: DataFrame) -> DataFrame:
    """Earliest and latest lifecycle date in one row, from one scan."""
    moments = [F.col(c) for c in ROLES]
    return staged.agg(
        F.min(F.least(*moments)).cast("date").alias("first_day"),
        F.max(F.greatest(*moments)).cast("date").alias("last_day"),
    )


def calendar_dimension(staged: DataFrame) -> DataFrame:
    """Every day between the bounds, also those without any load; no rows without bounds."""
    days = lifecycle_bounds(staged).select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
    day = F.col("date_day")
    return days.select(
        day,
        C.month_of(day).alias("month_start_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def with_dates(staged: DataFrame) -> DataFrame:
    """Staged loads with the date of each lifecycle timestamp."""
    return staged.withColumns({date: F.col(moment).cast("date") for moment, date in ROLES.items()})


def with_keys(loads: DataFrame) -> DataFrame:
    """The columns of the fact, of loads with their dates. The keys are hashes, which do not
    compress: loads are moved without them."""
    return loads.withColumns({
        "shipper_key": C.member_key(F.col("shipper_name")),
        "carrier_key": C.member_key(F.col("carrier_name")),
        "lane_key": C.lane_key(F.col("lane")),
    }).select(*FACT_COLUMNS, *[c for c in loads.columns if c not in (*STAGED_COLUMNS, *ROLES.values())])


def load_facts(staged: DataFrame) -> DataFrame:
    """One row per load. Keys are computed from the row itself instead of joined: every
    dimension is built from these rows with the same key, and the relationship checks prove it.
    """
    return with_keys(with_dates(staged)).select(*FACT_COLUMNS)


def facts_by_lookup(
    staged: DataFrame, shippers: DataFrame, carriers: DataFrame, lanes: DataFrame
) -> DataFrame:
    """Keys of each load by left joins to the dimensions on the computed key."""

    def found(dimension: DataFrame, key: str) -> DataFrame:
        return dimension.select(key, F.col(key).alias(f"_{key}"))

    keys = ("shipper_key", "carrier_key", "lane_key")
    loads = load_facts(staged).select("load_id", *keys)
    dimensions = zip(keys, (shippers, carriers, lanes))
    return looked_up(loads, "load_id", *[(k, found(d, k), "left") for k, d in dimensions]).select(
        "load_id", *[F.col(f"_{k}").alias(k) for k in keys]
    )


def raw_columns(raw: DataFrame) -> list:
    """All raw columns under names without dots."""
    return [quoted(c).alias(c.replace(".", "_")) for c in raw.columns]
