"""The business questions, with parameters in place of fixed months, states and thresholds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrid.functions.cleaning import month_of
from haulgrid.operators.measures import measured
from haulgrid.sources.mart import FACT_PARTITION, LoadMart


def delivered() -> Column:
    return F.col("is_delivered")


def delivered_between(first: Column, end: Column) -> Column:
    """Delivery date in [first, end), worded so that both year folders and pages are skipped."""
    date, year = F.col("delivery_date"), F.col(FACT_PARTITION)
    return (date >= first) & (date < end) & year.between(F.year(first), F.year(end))


def with_delivery_year(facts: DataFrame) -> DataFrame:
    """The loads with a delivery date, told by their folder: those of the others have no bounds of
    the date in their footers."""
    return facts.where(F.col(FACT_PARTITION).isNotNull())


def last_full_month(facts: DataFrame) -> DataFrame:
    """One row: first day of the last complete delivery month.

    The month of the latest delivery counts only when that delivery is on its last day.
    """
    latest = facts.agg(F.max("delivery_date").alias("latest"))
    day = F.col("latest")
    complete = day == F.last_day(day)
    return latest.select(
        F.when(complete, month_of(day)).otherwise(F.add_months(month_of(day), -1)).alias("month")
    )


def latest_month(facts: DataFrame) -> DataFrame:
    """One row: latest delivery month, even if incomplete, and latest delivery date, all loads."""
    return facts.agg(F.max("delivery_date").alias("latest_delivery_date")).select(
        month_of(F.col("latest_delivery_date")).alias("latest_available_month"),
        "latest_delivery_date",
    )


def delivered_in_last_full_month(
    mart: LoadMart, first: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Q1. Without dates the month is found in the data; it may hold no loads at all."""
    if first is not None and end is not None:
        period = delivered_between(F.lit(first), F.lit(end))
    else:
        # Each bound is a value of its own to the scan, which skips by it.
        month = last_full_month(mart.facts)
        end = month.select(F.add_months("month", 1))
        period = delivered_between(month.scalar(), end.scalar())
    return mart.facts.where(delivered() & period).agg(F.count("*").alias("delivered_loads"))


def top_shippers_by_book_price(mart: LoadMart, k: int = 1) -> DataFrame:
    """Q2. All loads, delivered or not."""
    groups = measured(mart, ["total_book_price"], ["shipper_name"], how="inner")
    return groups.orderBy(
        F.desc_nulls_last("total_book_price"), F.asc_nulls_last("shipper_name")
    ).limit(k)


def book_price_by_pickup_state(mart: LoadMart) -> DataFrame:
    """Q3. All loads."""
    return (
        measured(mart, ["avg_book_price", "total_loads"], ["pickup_state"], how="inner")
        .withColumnRenamed("total_loads", "load_count")
        .orderBy(F.asc_nulls_last("pickup_state"))
    )


def top_lanes(mart: LoadMart, k: int = 5) -> DataFrame:
    """Q4. Delivered loads."""
    groups = measured(mart, ["delivered_loads"], ["lane"], loads=delivered(), how="inner")
    return groups.orderBy(F.desc("delivered_loads"), F.asc_nulls_last("lane")).limit(k)


def top_carriers_into(mart: LoadMart, state: str = "TX", k: int = 1) -> DataFrame:
    """Q5. Delivered loads into a state; loads without a named carrier compete as one."""
    groups = measured(
        mart, ["delivered_loads"], ["carrier_name"], loads=delivered(),
        members=F.col("delivery_state") == state, members_use=["delivery_state"], how="inner",
    )
    return groups.orderBy(F.desc("delivered_loads"), F.asc_nulls_last("carrier_name")).limit(k)


def book_price_by_haul_type(mart: LoadMart) -> DataFrame:
    """Q6. All loads."""
    return (
        measured(mart, ["avg_book_price", "total_loads"], ["haul_type"])
        .withColumnRenamed("total_loads", "load_count")
        .orderBy(F.asc_nulls_last("haul_type"))
    )


def months_between(
    calendar: DataFrame, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Months whose first day is in the calendar, bounds included."""
    months = calendar.where(F.col("date_day") == F.col("month_start_date"))
    if first is not None and last is not None:
        months = months.where(F.col("month_start_date").between(F.lit(first), F.lit(last)))
    return months.select(F.col("month_start_date").alias("delivery_month"))


def zero_filled(spine: DataFrame, counts: DataFrame, on: str, value: str) -> DataFrame:
    """Every row of the spine with its count, 0 where there is none."""
    return spine.join(counts, on, "left").select(on, F.coalesce(value, F.lit(0)).alias(value))


def busiest_shipper_by_month(
    mart: LoadMart, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """Q7. The winner's key reaches the second scan as a pushed filter, so only its loads count."""
    done = mart.facts.where(delivered())
    winner = (
        done.groupBy("shipper_key")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc_nulls_last("shipper_key"))
        .limit(1)
        .select("shipper_key")
    )
    volume = (
        done.where(F.col("shipper_key") == winner.scalar())
        .groupBy(month_of(F.col("delivery_date")).alias("delivery_month"))
        .agg(F.count("*").alias("delivered_loads"))
    )
    months = months_between(mart.calendar, first, last)
    return zero_filled(months, volume, "delivery_month", "delivered_loads").orderBy(
        "delivery_month"
    )


def dearest_lanes(mart: LoadMart, at_least: int = 10, k: int = 1) -> DataFrame:
    """Q8. Average price of delivered loads, lanes with enough of them."""
    groups = measured(
        mart, ["delivered_loads", "avg_book_price"], ["lane"], loads=delivered(), how="inner"
    )
    return (
        groups.where(F.col("delivered_loads") >= at_least)
        .orderBy(F.desc_nulls_last("avg_book_price"), F.desc("delivered_loads"),
                 F.asc_nulls_last("lane"))
        .limit(k)
    )


def lanes_by_pnl_ratio(mart: LoadMart, k: int = 10) -> DataFrame:
    """Q9. All loads; lanes whose prices add up to zero are out."""
    groups = measured(
        mart, ["total_pnl", "total_book_price", "pnl_margin", "total_loads"], ["lane"],
        how="inner",
    )
    return (
        groups.where(F.col("total_book_price") != 0)
        .withColumnsRenamed({"pnl_margin": "pnl_ratio", "total_loads": "load_count"})
        .orderBy(F.desc_nulls_last("pnl_ratio"), F.asc_nulls_last("lane"))
        .limit(k)
    )


def low_rated_carriers(mart: LoadMart, below: float = 3.0) -> DataFrame:
    """Q10. Rated loads of all kinds."""
    groups = measured(
        mart, ["avg_carrier_rating", "rating_count"], ["carrier_name"],
        loads=F.col("carrier_rating").isNotNull(), how="inner",
    )
    return (
        groups.where(F.col("avg_carrier_rating") < below)
        .withColumnRenamed("avg_carrier_rating", "average_rating")
        .orderBy(F.desc("average_rating"), F.desc("rating_count"),
                 F.asc_nulls_last("carrier_name"))
    )
