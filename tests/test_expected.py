"""Known figures of the tables at scale 0.01."""

import pytest
from pyspark.sql import functions as F

from haulgrid.functions.responses import classified
from haulgrid.operators import checks, profile
from haulgrid.plans import export as X
from haulgrid.plans import questions as Q
from haulgrid.sources.mart import mart_for
from haulgrid.sources.tables import derive_responses

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def m(spark):
    return mart_for(spark, FOLDER)


def test_table_sizes(m):
    sizes = [t.count() for t in
             (m.raw, m.staged, m.shippers, m.carriers, m.lanes, m.calendar, m.facts)]
    assert sizes == [15015, 15000, 1500, 101, 620, 2502, 15000]


def test_profile_and_checks(m):
    found = {r.check_name: r.failing_rows for r in checks.suite(m).collect()
             if r.severity == "warn"}
    assert found["delivered_before_booked"] == 3308
    assert (found["zero_mileage"], found["zero_book_price"]) == (486, 1370)
    assert profile.value_counts(m.staged).first().cancelled == 883
    assert profile.value_counts(m.staged).first().negative_pnl == 7141
    assert profile.order_violations(m.staged).first().delivery_before_pickup == 772
    nulls = {r.column_name: r.null_count for r in profile.null_counts(m.staged).collect()}
    assert (nulls["sourcing_channel"], nulls["delivered_at"], nulls["carrier_name"]) == (
        14250, 405, 1385,
    )
    assert profile.lane_conformity(m.staged).first().malformed == 6
    assert m.facts.where("is_delivered").count() == 13733


def test_answers(m):
    assert Q.delivered_in_last_full_month(m).first().delivered_loads == 628
    shipper = Q.top_shippers_by_book_price(m).first()
    assert (shipper.shipper_name, round(shipper.total_book_price, 2)) == (
        "Customer#000001052", 6207673.94,
    )
    assert Q.book_price_by_pickup_state(m).count() == 6
    assert Q.top_lanes(m).first() == ("NATION_11,AM -> NATION_18,eu", 70)
    assert Q.top_carriers_into(m, "AS").first() == ("Supplier#000000006", 418)
    haul = {r.haul_type: (round(r.avg_book_price, 4), r.load_count)
            for r in Q.book_price_by_haul_type(m).collect()}
    assert haul == {"interstate": (225413.7915, 11824), "intrastate": (226466.5696, 3176)}
    assert Q.busiest_shipper_by_month(m).count() == 83
    lane = Q.dearest_lanes(m).first()
    assert (lane.lane, lane.delivered_loads, round(lane.avg_book_price, 4)) == (
        "NATION_11,AM -> NATION_10,af", 11, 331801.9036,
    )
    ratio = Q.lanes_by_pnl_ratio(m).first()
    assert (ratio.lane, round(ratio.pnl_ratio, 6), ratio.load_count) == (
        "NATION_14,MI -> NATION_24,mi", 1.706392, 3,
    )
    assert Q.low_rated_carriers(m).count() == 78
    assert X.latest_month_loads(m).count() == 82


def test_verdicts(spark):
    rows = classified(derive_responses(spark, FOLDER), "response")
    counts = {r.verdict: r.n for r in rows.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    assert counts == {"accepted": 204, "not_select": 131, "unsupported": 71,
                      "multi_statement": 68, "not_read_only": 62}
