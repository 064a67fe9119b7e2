"""Each check with a passing and a violating fixture."""

import pytest
from pyspark.sql import functions as F

from haulgrid.operators import checks, profile
from tests.helpers import mart_of, raw_rows


def outcome(m):
    return {
        (r.check_name, r.model, r.column_name): (r.failing_rows, r.status)
        for r in checks.suite(m).collect()
    }


def test_a_plain_load_passes_all_62_checks(spark, tmp_path):
    found = outcome(mart_of(spark, tmp_path, {}))
    assert len(found) == 62
    assert set(found.values()) == {(0, "pass")}


VIOLATIONS = [
    ({"lane": None}, ("not_null", "stg_loads", "lane"), "fail"),
    ({"book_price": None}, ("not_null", "fct_loads", "book_price"), "fail"),
    ({"load_was_cancelled": None}, ("not_null", "stg_loads", "is_delivered"), "fail"),
    ({"lane": "X"}, ("lane_format", "stg_loads", "lane"), "fail"),
    ({"lane": "A,TX -> B,CA\n"}, ("lane_format", "stg_loads", "lane"), "fail"),
    ({"source_price": -1.0}, ("negative_prices", "stg_loads", "book_price"), "fail"),
    ({"delivery_date": "1/1/2024 0:00"},
     ("delivered_before_booked", "stg_loads", "delivered_at"), "warn"),
    ({"delivery_date": "1/4/2024 7:59"},
     ("delivered_before_pickup", "stg_loads", "delivered_at"), "warn"),
    ({"book_price": 0.0}, ("zero_book_price", "stg_loads", "book_price"), "warn"),
    ({"source_price": 0.0}, ("zero_source_price", "stg_loads", "source_price"), "warn"),
    ({"mileage": 0.0}, ("zero_mileage", "stg_loads", "mileage"), "warn"),
]


@pytest.mark.parametrize("change, check, status", VIOLATIONS)
def test_one_violation(spark, tmp_path, change, check, status):
    assert outcome(mart_of(spark, tmp_path, {}, change))[check] == (1, status)


NO_VIOLATION = [
    ({"lane": "A,TX -> B,tx"}, ("lane_format", "stg_loads", "lane")),
    ({"lane": None}, ("lane_format", "stg_loads", "lane")),
    ({"book_price": 0.0, "load_was_cancelled": True},
     ("zero_book_price", "stg_loads", "book_price")),
    ({"mileage": 0.0, "lane": "a,TX -> A,NV"}, ("zero_mileage", "stg_loads", "mileage")),
    ({"source_date": None}, ("relationships", "fct_loads", "sourced_date")),
]


@pytest.mark.parametrize("change, check", NO_VIOLATION)
def test_no_violation(spark, tmp_path, change, check):
    assert outcome(mart_of(spark, tmp_path, {}, change))[check] == (0, "pass")


def test_duplicated_values(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert checks.duplicated(rows, "k").collect() == [(1, 2)]


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",)], "key string")
    assert checks.orphans(child, "fk", parent, "key").collect() == [("b", 2)]


def test_date_orphans(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"source_date": None}, {})
    days = m.calendar.where(F.col("date_day") != "2024-01-04")
    assert checks.date_orphans(m.facts, days).select("role", "row_count").collect() == [
        ("pickup_date", 2)
    ]


def test_lane_consistency_and_accepted_values(spark, tmp_path):
    m = mart_of(spark, tmp_path, {}, {})
    wrong = m.facts.withColumn(
        "haul_type", F.when(F.col("load_id") == 1, "local").otherwise(F.col("haul_type"))
    )
    assert checks.haul_type_mismatches(wrong, m.lanes).select("row_count").collect() == [(1,)]
    assert [r.load_id for r in checks.haul_type_mismatch_loads(wrong, m.lanes).collect()] == [1]
    assert [r.load_id for r in checks.breaking(wrong, "accepted_values").collect()] == [1]


def test_delivered_definition(spark, tmp_path):
    m = mart_of(spark, tmp_path, {}, {"load_was_cancelled": None})
    wrong = m.facts.withColumn("is_delivered", F.lit(False))
    broken = checks.breaking(wrong, "delivered_definition").collect()
    assert [r.load_id for r in broken] == [1]


def test_duplicate_rows(spark):
    raw = raw_rows(
        spark, {"load_id": 1}, {"load_id": 1}, {"load_id": 1, "pnl": 3.0}, {"load_id": 2},
        {"load_id": 3}, {"load_id": 3}, {"load_id": None}, {"load_id": None},
    )
    found = profile.duplicates(raw, "load_id").first()
    assert tuple(found) == (3, 3)


def test_constant_columns(spark):
    raw = raw_rows(spark, {"pnl": 1.0, "carrier_name": None}, {"pnl": 2.0})
    flags = {r.column_name: r.is_constant for r in profile.constant_columns(raw).collect()}
    assert flags["has_mobile_app_tracking_1"] and not flags["pnl"]
    assert not flags["carrier_name"] and flags["shipper_name"]
    assert len(flags) == 31
    empty = profile.constant_columns(raw.where("load_id < 0")).collect()
    assert len(empty) == 31 and not any(r.is_constant for r in empty)
    none = profile.constant_columns(raw_rows(spark, *[{"carrier_name": None}] * 3)).collect()
    assert {r.column_name for r in none if not r.is_constant} == {"load_id", "carrier_name"}


class Tampered:
    """A mart with one table replaced."""

    def __init__(self, mart, **tables):
        self._tables = {**mart.tables(), **tables}
        self.facts, self.lanes = self._tables["fct_loads"], self._tables["dim_lane"]

    def tables(self):
        return self._tables


def failing(mart):
    return {(r.check_name, r.model, r.column_name): r.failing_rows
            for r in checks.suite(mart).where("failing_rows > 0").collect()}


def test_suite_counts_what_fails(spark, mart):
    tables = mart.tables()
    clean = failing(mart)
    facts, shippers = tables["fct_loads"], tables["dim_shipper"]
    most = facts.groupBy("shipper_key").count().orderBy(F.desc("count")).first()
    found = failing(Tampered(mart, dim_shipper=shippers.where(F.col("shipper_key") != most.shipper_key)))
    assert found == {**clean, ("relationships", "fct_loads", "shipper_key"): most["count"]}

    day = facts.where("delivery_date is not null").groupBy("delivery_date").count().orderBy(F.desc("count")).first()
    calendar = tables["dim_date"].where(F.col("date_day") != day.delivery_date)
    found = failing(Tampered(mart, dim_date=calendar))
    assert found["relationships", "fct_loads", "delivery_date"] == day["count"]

    twice = facts.where("load_id % 10 = 1")
    found = failing(Tampered(mart, fct_loads=facts.union(twice)))
    assert found["unique", "fct_loads", "load_id"] == twice.count()

    odd = F.when(F.col("load_id") % 7 == 0, F.lit("sideways")).otherwise(F.col("haul_type"))
    found = failing(Tampered(mart, fct_loads=facts.withColumn("haul_type", odd)))
    number = facts.where("load_id % 7 = 0").count()
    assert found["accepted_values", "fct_loads", "haul_type"] == number
    assert found["lane_consistency", "fct_loads", "haul_type"] == number


def test_suite_scans_the_fact_three_times(mart):
    plan = checks.suite(mart)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("booked_date") and sum("load_id" in line and "Relation" in line and "lane_key" in line
                                             for line in plan.splitlines()) == 3


def test_no_check_is_without_a_finding_on_the_seeded_tables(mart):
    from haulgrid.plans.seeded import seeded

    found = {(r.check_name, r.model, r.column_name): r.failing_rows for r in checks.suite(seeded(mart)).collect()}
    for name in ("unique", "relationships", "accepted_values", "one_row_per_load", "delivered_definition", "lane_consistency"):
        mine = {key: rows for key, rows in found.items() if key[0] == name}
        assert mine and all(rows > 0 for rows in mine.values()), mine
