import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from haulgrid.functions import cleaning as C
from haulgrid.operators.dedupe import first_copy
from haulgrid.plans import models as M
from tests.helpers import mart_of, raw_rows


def staged(spark, *changes):
    return {r.load_id: r for r in M.staged_loads(raw_rows(spark, *changes)).collect()}


def test_missing_and_blank_names_share_the_reserved_key(spark):
    rows = M.staged_loads(raw_rows(spark, {"carrier_name": None}, {"carrier_name": "  "}))
    keys = {(r.carrier_key, r.load_id) for r in M.load_facts(rows).collect()}
    reserved = hashlib.md5(b"__unknown__").hexdigest()
    assert keys == {(reserved, 1), (reserved, 2)}
    member = M.carrier_dimension(rows).collect()
    assert [(m.carrier_key, m.carrier_name) for m in member] == [(reserved, None)]


DUPLICATES = [
    {"load_id": 7, "quote_date": "10/1/2024 0:00", "book_price": 1.0},
    {"load_id": 7, "quote_date": "9/1/2024 0:00", "book_price": 2.0},
    {"load_id": 8, "quote_date": None, "book_price": 3.0},
    {"load_id": 8, "quote_date": "9/1/2024 0:00", "book_price": 4.0},
    {"load_id": 9},
]


def test_first_copy_is_by_text_with_missing_last(spark):
    raw = raw_rows(spark, *DUPLICATES)
    rows = first_copy(raw, "load_id", ["quote_date", "book_date"]).collect()
    assert {(r.load_id, r.book_price) for r in rows} == {(7, 1.0), (8, 4.0), (9, 100.0)}


def test_missing_ids_are_one_group(spark):
    raw = raw_rows(spark, {"load_id": None}, {"load_id": None, "quote_date": "0"}, {})
    rows = first_copy(raw, "load_id", ["quote_date", "book_date"]).collect()
    assert sorted((r.load_id or 0, r.quote_date) for r in rows) == [(0, "0"), (3, "1/1/2024 8:00")]


def test_an_id_with_a_third_of_all_rows_is_cut_down_before_the_shuffle(spark):
    raw = raw_rows(spark, *[{"load_id": 1 if i % 3 == 0 else i, "quote_date": str(i)} for i in range(300)])
    kept = first_copy(raw.repartition(8), "load_id", ["quote_date", "book_date"])
    assert kept.count() == 200 and kept.where("load_id = 1").first().quote_date == "0"
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_rows_equal_in_order_columns_have_one_stable_winner(spark):
    changes = [{"load_id": 5, "book_price": float(i)} for i in range(20)]
    winners = {
        M.staged_loads(raw_rows(spark, *order).repartition(n)).first().book_price
        for order, n in ((changes, 1), (changes[::-1], 7), (changes[5:] + changes[:5], 3))
    }
    assert len(winners) == 1


STAMPS = [
    ("1/2/2024 3:04", dt.datetime(2024, 1, 2, 3, 4)),
    ("01/02/2024 03:04", dt.datetime(2024, 1, 2, 3, 4)),
    (" 1/2/2024  3:04 ", dt.datetime(2024, 1, 2, 3, 4)),
    ("1/2/2024\t3:04", dt.datetime(2024, 1, 2, 3, 4)),
    ("1/2/2024 3:4", dt.datetime(2024, 1, 2, 3, 4)),
    ("2/29/2000 23:59", dt.datetime(2000, 2, 29, 23, 59)),
    ("3/10/2024 2:30", dt.datetime(2024, 3, 10, 2, 30)),
    ("11/3/2024 1:30", dt.datetime(2024, 11, 3, 1, 30)),
    ("1/2/24 3:04", dt.datetime(24, 1, 2, 3, 4)),
    *[(bad, None) for bad in (
        "2/30/2024 3:04", "2/29/1900 1:01", "13/1/2024 0:00", "1/2/2024 24:00",
        "1/2/2024 3:60", "1/2/2024", "1/2/2024 3:04:05", "001/2/2024 3:04", "1/2/12024 3:04",
        "1/ 2/2024 3:04", "not a date", "", None,
    )],
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stamps_are_read_alike_in_every_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(STAMPS)], "i int, t string")
        rows = texts.select("i", C.stamp(F.col("t")).cast("string").alias("at")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    got = [r.at for r in sorted(rows)]
    assert got == [None if at is None else at.isoformat(sep=" ") for _, at in STAMPS]


def test_delivered_flag_is_three_valued(spark):
    rows = staged(
        spark,
        {}, {"delivery_date": "2/30/2024 3:04"}, {"load_was_cancelled": True},
        {"load_was_cancelled": None}, {"load_was_cancelled": None, "delivery_date": None},
    )
    assert [rows[i].is_delivered for i in range(1, 6)] == [True, False, False, None, False]


def test_lanes(spark):
    rows = staged(
        spark,
        {"lane": "A,TX -> B,tx"}, {"lane": "X"}, {"lane": None}, {"lane": "  A , ca ->  B , NV "},
        {"lane": "A,TX -> B,CA -> C,NV"},
    )

    def parts(i):
        r = rows[i]
        return (r.pickup_city, r.pickup_state, r.delivery_city, r.delivery_state, r.haul_type)

    assert parts(1) == ("A", "TX", "B", "TX", "intrastate")
    assert parts(2) == ("X", "", "", "", "intrastate")
    assert parts(3) == (None, None, None, None, "interstate")
    assert parts(4) == ("A", "CA", "B", "NV", "interstate")
    assert parts(5) == ("A", "TX", "B", "CA", "interstate")


def test_text_and_numbers(spark):
    raw = raw_rows(spark, {"sourcing_channel": "  ", "carrier_dropped_us_count": 2.5},
                   {"sourcing_channel": " x ", "carrier_dropped_us_count": 3.5})
    rows = {r.load_id: r for r in M.staged_loads(raw).collect()}
    assert (rows[1].sourcing_channel, rows[2].sourcing_channel) == (None, "x")
    assert (rows[1].carrier_dropped_us_count, rows[2].carrier_dropped_us_count) == (2, 4)
    assert rows[1].equipment_type == "VAN"
    assert "has_mobile_app_tracking.1" not in M.staged_loads(raw).columns


def test_missing_lane_has_no_key(spark):
    rows = M.staged_loads(raw_rows(spark, {"lane": None}))
    assert M.load_facts(rows).first().lane_key is None
    assert M.lane_dimension(rows).first().haul_type == "interstate"


def test_calendar_without_dates_is_empty(spark):
    rows = M.staged_loads(raw_rows(spark, {c: None for c in M.STAMPS}))
    assert M.calendar_dimension(rows).count() == 0


def test_calendar_has_no_gaps(spark):
    rows = M.staged_loads(raw_rows(spark, {"quote_date": "12/30/2023 1:00"}))
    days = M.calendar_dimension(rows).orderBy("date_day").collect()
    assert [d.date_day for d in days] == [
        dt.date(2023, 12, 30) + dt.timedelta(n) for n in range(8)
    ]
    sunday = days[1]
    assert (sunday.day_of_week, sunday.day_name, sunday.year_month) == (0, "Sunday", "2023-12")
    assert (sunday.month_start_date, sunday.quarter) == (dt.date(2023, 12, 1), 4)


def test_joined_and_computed_keys_agree(mart):
    joined = M.facts_by_lookup(mart.staged, mart.shippers, mart.carriers, mart.lanes)
    computed = mart.facts.select("load_id", "shipper_key", "carrier_key", "lane_key")
    assert joined.exceptAll(computed).count() == 0
    assert joined.count() == computed.count()


@pytest.mark.parametrize("small", [0, 1_000_000])
def test_only_rows_of_repeated_ids_are_moved(spark, monkeypatch, small):
    from haulgrid.operators import dedupe, profile

    monkeypatch.setattr(dedupe, "SMALL", small)
    once = [{"load_id": i} for i in range(10, 400)]
    raw = raw_rows(spark, *DUPLICATES, {"load_id": None}, {"load_id": None}, {"load_id": None, "quote_date": "0"}, *once).repartition(4)
    kept = first_copy(raw, "load_id", ["quote_date", "book_date"])
    found = [(r.load_id, r.quote_date, r.book_price) for r in kept.collect()]
    assert len(found) == 394 and len({i for i, *_ in found}) == 394
    assert {r for r in found if r[0] in (None, 7, 8)} == {
        (None, "0", 100.0), (7, "10/1/2024 0:00", 1.0), (8, "9/1/2024 0:00", 4.0)}
    assert profile.duplicates(raw, "load_id").collect() == [(3, 1)]
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # The window sees what the join with the repeated ids leaves, and nothing else is sorted.
    assert plan.startswith("Union") and "LeftSemi" in plan and "LeftAnti" in plan


def test_facts_are_moved_without_their_keys(spark, tmp_path):
    m = mart_of(spark, tmp_path, {}, {"delivery_date": None})
    rows = m._builders()["fct_loads"]()
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    moved = plan[plan.index("RepartitionByExpression"):]
    assert "md5" in plan and "md5" not in moved
    assert rows.columns == [*M.FACT_COLUMNS, "delivery_year"]
    assert m.facts.drop("delivery_year").exceptAll(M.load_facts(m.staged)).count() == 0
