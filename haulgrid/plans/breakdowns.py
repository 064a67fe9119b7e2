"""Report breakdowns: measures by dimension attributes, and measures by date role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulgrid.operators.measures import dense_rank_by, measured
from haulgrid.sources.mart import LoadMart

KPIS = [
    "total_loads", "delivered_loads", "delivery_rate", "total_book_price", "total_pnl",
    "pnl_margin", "avg_book_price",
]

ON_TIME = ["on_time_pickup", "on_time_delivery", "on_time_overall"]

# Breakdown -> (measures, attributes).
BREAKDOWNS = {
    "kpis": (KPIS, []),
    "monthly_trend": (["delivered_loads", "pnl_margin"], ["year_month"]),
    "delivered_by_haul_type": (["delivered_loads"], ["haul_type"]),
    "delivered_by_lane": (["delivered_loads"], ["lane"]),
    "delivered_by_pickup_state": (["delivered_loads"], ["pickup_state"]),
    "delivered_by_delivery_state": (["delivered_loads"], ["delivery_state"]),
    "delivered_by_pickup_city": (["delivered_loads"], ["pickup_city"]),
    "delivered_by_delivery_city": (["delivered_loads"], ["delivery_city"]),
    "haul_type_comparison": (KPIS, ["haul_type"]),
    "loads_by_carrier": (["total_loads"], ["carrier_name"]),
    "rating_by_carrier": (["avg_carrier_rating"], ["carrier_name"]),
    "on_time_by_carrier": (ON_TIME, ["carrier_name"]),
    "delivered_pnl_by_carrier": (["delivered_pnl"], ["carrier_name"]),
}


def breakdown(mart: LoadMart, name: str) -> DataFrame:
    measures, by = BREAKDOWNS[name]
    return measured(mart, measures, by)


def top_shippers(mart: LoadMart, k: int = 10) -> DataFrame:
    """Shippers with the highest total book price."""
    groups = measured(mart, ["total_book_price"], ["shipper_name"])
    return groups.orderBy(
        F.desc_nulls_last("total_book_price"), F.asc_nulls_last("shipper_name")
    ).limit(k)


def loads_by_role(mart: LoadMart, role: str, by: str, measure: str = "total_loads") -> DataFrame:
    """A measure by a calendar attribute, with the calendar joined on the given fact date."""
    return measured(mart, [measure], [by], role=role)


def loads_by_roles(mart: LoadMart, roles: list[str], by: str) -> DataFrame:
    """Loads by a calendar attribute for several date roles, from one scan of the fact."""
    dates = F.array(*[F.struct(F.lit(r).alias("date_role"), F.col(r).alias("day")) for r in roles])
    counts = (
        mart.facts.select(F.inline(dates)).groupBy("date_role", "day")
        .agg(F.count("*").alias("total_loads"))
    )
    days = mart.calendar.select(F.col("date_day").alias("day"), by)
    return counts.join(days, "day", "left").groupBy("date_role", by).agg(
        F.sum("total_loads").alias("total_loads")
    )


def carrier_ranks(mart: LoadMart) -> DataFrame:
    """Carriers with their dense rank by delivered loads, highest first."""
    groups = measured(mart, ["delivered_loads"], ["carrier_name"])
    return dense_rank_by(groups, "delivered_loads", "delivered_loads_rank").select(
        "carrier_name", "delivered_loads", "delivered_loads_rank"
    )
