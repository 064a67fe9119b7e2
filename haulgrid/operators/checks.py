"""Data-quality checks. Each has a severity; none removes rows.

``violations`` gives the offending rows of one check. ``suite`` gives one row per check and
reads each table once for all its row rules together, however many there are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulgrid.functions.cleaning import LANE_SHAPE
from haulgrid.plans.models import ROLES
from haulgrid.sources.mart import LoadMart

HAUL_TYPES = ("intrastate", "interstate")

# The checked tables and columns.
NOT_NULL = {
    "stg_loads": [
        "load_id", "lane", "pickup_city", "pickup_state", "delivery_city", "delivery_state",
        "book_price", "load_was_cancelled", "is_delivered",
    ],
    "dim_shipper": ["shipper_key"],
    "dim_carrier": ["carrier_key"],
    "dim_lane": ["lane_key", "lane", "pickup_state", "delivery_state", "haul_type"],
    "dim_date": ["date_day", "month_start_date", "year_month"],
    "fct_loads": [
        "load_id", "shipper_key", "carrier_key", "lane_key",
        "quote_date", "booked_date", "pickup_date", "delivery_date",
        "book_price", "source_price", "pnl", "mileage", "equipment_type", "vip_carrier",
        "load_was_cancelled", "is_delivered", "haul_type",
    ],
}

UNIQUE = {
    "stg_loads": "load_id",
    "dim_shipper": "shipper_key",
    "dim_carrier": "carrier_key",
    "dim_lane": "lane_key",
    "dim_date": "date_day",
    "fct_loads": "load_id",
}

# Fact column -> (dimension, its key).
RELATIONSHIPS = {
    "shipper_key": ("dim_shipper", "shipper_key"),
    "carrier_key": ("dim_carrier", "carrier_key"),
    "lane_key": ("dim_lane", "lane_key"),
    **{date: ("dim_date", "date_day") for date in ROLES.values()},
}

ACCEPTED = {"dim_lane": "haul_type", "fct_loads": "haul_type"}


@dataclass(frozen=True)
class RowRule:
    """A check whose violations can be told from the row alone."""

    name: str
    model: str
    column: str
    severity: str
    broken: Column


def row_rules() -> list[RowRule]:
    col = F.col
    rules = [
        RowRule("not_null", model, c, "error", col(c).isNull())
        for model, columns in NOT_NULL.items()
        for c in columns
    ]
    rules += [
        RowRule("accepted_values", model, c, "error", ~col(c).isin(*HAUL_TYPES))
        for model, c in ACCEPTED.items()
    ]
    delivered = col("is_delivered")
    rules += [
        RowRule("lane_format", "stg_loads", "lane", "error", ~col("lane").rlike(LANE_SHAPE)),
        RowRule("negative_prices", "stg_loads", "book_price", "error",
                (col("book_price") < 0) | (col("source_price") < 0)),
        RowRule("delivered_definition", "fct_loads", "is_delivered", "error",
                delivered != (~col("load_was_cancelled") & col("delivered_at").isNotNull())),
        RowRule("delivered_before_booked", "stg_loads", "delivered_at", "warn",
                (col("delivered_at") < col("booked_at")) & delivered),
        RowRule("delivered_before_pickup", "stg_loads", "delivered_at", "warn",
                (col("delivered_at") < col("pickup_at")) & delivered),
        RowRule("zero_book_price", "stg_loads", "book_price", "warn",
                (col("book_price") == 0) & delivered),
        RowRule("zero_source_price", "stg_loads", "source_price", "warn",
                (col("source_price") == 0) & delivered),
        RowRule("zero_mileage", "stg_loads", "mileage", "warn",
                (col("mileage") == 0)
                & (F.lower(F.trim("pickup_city")) != F.lower(F.trim("delivery_city")))),
    ]
    return rules


def breaking(rows: DataFrame, name: str, column: str | None = None) -> DataFrame:
    """Rows that break a row rule, found by its name (and column, where several share one)."""
    rule = next(
        r for r in row_rules() if r.name == name and (column is None or r.column == column)
    )
    return rows.where(rule.broken)


def duplicated(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; missing values are no duplicates."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign key values without a parent, and their rows. Values are counted before the join,
    so a value held by many rows is one row in it; missing values pass."""
    values = child.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count("*").alias("row_count"))
    keys = parent.select(F.col(key).alias("_key"))
    return values.join(keys, F.col(fk) == F.col("_key"), "left_anti")


def date_orphans(facts: DataFrame, calendar: DataFrame) -> DataFrame:
    """Orphaned dates of all calendar roles from one scan: (role, day, row_count)."""
    roles = F.array(*[
        F.struct(F.lit(d).alias("role"), F.col(d).alias("day")) for d in ROLES.values()
    ])
    pairs = facts.select(F.explode(roles).alias("p")).select("p.role", "p.day")
    counts = (
        pairs.where(F.col("day").isNotNull())
        .groupBy("role", "day")
        .agg(F.count("*").alias("row_count"))
    )
    days = calendar.select(F.col("date_day").alias("_day"))
    return counts.join(days, F.col("day") == F.col("_day"), "left_anti")


def haul_type_mismatches(facts: DataFrame, lanes: DataFrame) -> DataFrame:
    """Loads per lane and haul type whose lane says otherwise, counted before the join."""
    told = facts.groupBy("lane_key", "haul_type").agg(F.count("*").alias("row_count"))
    said = lanes.select(F.col("lane_key"), F.col("haul_type").alias("lane_haul_type"))
    return told.join(said, "lane_key").where(F.col("haul_type") != F.col("lane_haul_type"))


def haul_type_mismatch_loads(facts: DataFrame, lanes: DataFrame) -> DataFrame:
    """The loads themselves whose haul type differs from their lane's.

    The pairs of lane and haul type that differ are found first, as a rule none; only loads of
    these pairs are then looked at.
    """
    wrong = haul_type_mismatches(facts, lanes).select("lane_key", "haul_type", "lane_haul_type")
    return facts.select("load_id", "lane_key", "haul_type").join(wrong, ["lane_key", "haul_type"])


def _as_rows(counted: DataFrame, checks: list[tuple[str, str, str, str]]) -> DataFrame:
    """One row per check from a one-row frame with columns c0, c1, ... in the checks' order."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"), F.lit(model).alias("model"),
            F.lit(column).alias("column_name"), F.lit(severity).alias("severity"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("failing_rows"),
        )
        for i, (name, model, column, severity) in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def row_rule_counts(mart: LoadMart, name: str | None = None) -> DataFrame:
    """Failing rows of every row rule, or of those of one name: one aggregate per table."""
    tables, results = mart.tables(), []
    for model, rows in tables.items():
        rules = [r for r in row_rules() if r.model == model and name in (None, r.name)]
        if not rules:
            continue
        counted = rows.agg(*[F.count_if(r.broken).alias(f"c{i}") for i, r in enumerate(rules)])
        results.append(
            _as_rows(counted, [(r.name, r.model, r.column, r.severity) for r in rules])
        )
    return reduce(DataFrame.unionByName, results)


def unique_counts(mart: LoadMart) -> DataFrame:
    """Duplicated values of every key column. The staged id counts for two checks at once."""
    tables, results = mart.tables(), []
    for model, column in UNIQUE.items():
        names = ["unique", "one_row_per_load"] if model == "stg_loads" else ["unique"]
        counted = duplicated(tables[model], column).agg(F.count("*").alias("n")).select(
            *[F.col("n").alias(f"c{i}") for i in range(len(names))]
        )
        results.append(_as_rows(counted, [(n, model, column, "error") for n in names]))
    return reduce(DataFrame.unionByName, results)


def key_counts(mart: LoadMart) -> DataFrame:
    """Fact rows without a parent, per foreign key, and rows whose haul type is not their lane's.

    All keys are counted in one scan of the fact, before they meet their parents in one join.
    """
    tables = mart.tables()
    kinds = {fk: "date_day" if fk in ROLES.values() else fk for fk in RELATIONSHIPS}
    none = F.lit(None).cast("string")
    keys = F.array(*[
        F.struct(
            F.lit(fk).alias("role"), F.lit(kind).alias("kind"), F.col(fk).cast("string").alias("value"),
            (F.col("haul_type") if fk == "lane_key" else none).alias("told"),
        )
        for fk, kind in kinds.items()
    ])
    counts = (
        tables["fct_loads"].select(F.inline(keys)).where(F.col("value").isNotNull())
        .groupBy("role", "kind", "value", "told").agg(F.count("*").alias("n"))
    )
    parents = reduce(DataFrame.union, [
        tables[parent].select(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("value"),
            (F.col("haul_type") if kind == "lane_key" else none).alias("said"), F.lit(True).alias("known"),
        )
        for kind, (parent, key) in {kinds[fk]: found for fk, found in RELATIONSHIPS.items()}.items()
    ])
    both = counts.join(parents, ["kind", "value"], "left")
    orphan = F.col("known").isNull()
    counted = both.agg(
        *[F.sum(F.when(orphan & (F.col("role") == fk), F.col("n"))).alias(f"c{i}") for i, fk in enumerate(kinds)],
        F.sum(F.when(F.col("told") != F.col("said"), F.col("n"))).alias(f"c{len(kinds)}"),
    )
    return _as_rows(
        counted,
        [("relationships", "fct_loads", fk, "error") for fk in kinds]
        + [("lane_consistency", "fct_loads", "haul_type", "error")],
    )


def relationship_counts(mart: LoadMart) -> DataFrame:
    """Fact rows without a parent, per foreign key."""
    return key_counts(mart).where(F.col("check_name") == "relationships")


def suite(mart: LoadMart) -> DataFrame:
    """One row per check with its failing rows and status: pass, warn or fail.

    The fact is scanned three times: for the row rules, its ids and its keys.
    """
    checks = row_rule_counts(mart).unionByName(unique_counts(mart)).unionByName(key_counts(mart))
    status = (
        F.when(F.col("failing_rows") == 0, F.lit("pass"))
        .when(F.col("severity") == "warn", F.lit("warn"))
        .otherwise(F.lit("fail"))
    )
    return checks.withColumn("status", status)


def suite_status(mart: LoadMart) -> DataFrame:
    """Roll-up of the suite: checks and failing rows by severity and status. The build passes
    when no error check failed."""
    return suite(mart).groupBy("severity", "status").agg(
        F.count("*").alias("checks"), F.sum("failing_rows").alias("failing_rows")
    )
