import datetime as dt

import pytest
from pyspark.sql import functions as F

from haulgrid.operators.measures import MEASURES, measured
from haulgrid.plans import breakdowns as B
from haulgrid.plans import export as X
from haulgrid.plans import questions as Q
from haulgrid.plans import suite as K
from tests.helpers import mart_of


def test_last_full_month(spark, tmp_path):
    m = mart_of(
        spark, tmp_path,
        {"delivery_date": "1/31/2024 5:00"}, {"delivery_date": "3/15/2024 5:00"},
    )
    assert Q.delivered_in_last_full_month(m).first().delivered_loads == 0
    given = Q.delivered_in_last_full_month(m, dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert given.first().delivered_loads == 1


def test_a_month_that_ends_with_the_data_is_full(spark, tmp_path):
    m = mart_of(
        spark, tmp_path,
        {"delivery_date": "2/1/2024 5:00"}, {"delivery_date": "2/29/2024 23:59"},
    )
    assert Q.delivered_in_last_full_month(m).first().delivered_loads == 2


def test_last_full_month_over_a_year_end(spark, tmp_path):
    m = mart_of(
        spark, tmp_path,
        {"delivery_date": "12/31/2023 5:00"}, {"delivery_date": "1/2/2024 23:59"},
    )
    assert Q.delivered_in_last_full_month(m).first().delivered_loads == 1


def test_questions_without_any_delivery(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"delivery_date": None}, {"load_was_cancelled": True,
                                                         "delivery_date": "x"})
    assert Q.delivered_in_last_full_month(m).first().delivered_loads == 0
    assert Q.top_lanes(m).count() == 0
    assert {r.delivered_loads for r in Q.busiest_shipper_by_month(m).collect()} == {0}
    assert X.latest_month_loads(m).count() == 0
    with pytest.raises(ValueError, match="no delivery dates"):
        X.check_export(m)


def test_unnamed_carriers_compete_as_one(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"carrier_name": None}, {"carrier_name": " "}, {})
    assert Q.top_carriers_into(m, "NV").collect() == [(None, 2)]


def test_ties_go_to_the_first_name(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"shipper_name": "B"}, {"shipper_name": "A"},
                {"shipper_name": None})
    assert Q.top_shippers_by_book_price(m).first().shipper_name == "A"
    assert [r.shipper_name for r in Q.top_shippers_by_book_price(m, 3).collect()] == [
        "A", "B", None,
    ]


def test_lanes_without_price(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"book_price": 0.0, "lane": "Z,AA -> Z,AA"}, {})
    assert [r.lane for r in Q.lanes_by_pnl_ratio(m).collect()] == ["Austin,TX -> Reno,NV"]
    margin = {r.lane: r.pnl_margin for r in measured(m, ["pnl_margin"], ["lane"]).collect()}
    assert margin == {"Z,AA -> Z,AA": None, "Austin,TX -> Reno,NV": 0.2}


def test_dearest_lane_needs_enough_loads(spark, tmp_path):
    cheap = [{"lane": "A,TX -> B,NV", "book_price": 10.0}] * 3
    m = mart_of(spark, tmp_path, *cheap, {"lane": "C,TX -> D,NV", "book_price": 99.0})
    assert Q.dearest_lanes(m, at_least=3).collect() == [("A,TX -> B,NV", 3, 10.0)]


def test_low_rating_counts_rated_loads_only(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"carrier_rating": 2.0}, {"carrier_rating": None},
                {"carrier_name": "B", "carrier_rating": 3.0})
    assert Q.low_rated_carriers(m).collect() == [("Carrier A", 2.0, 1)]


def test_zero_months_stay(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"delivery_date": "2/10/2024 5:00"},
                {"delivery_date": "4/10/2024 5:00"}, {"quote_date": "12/15/2023 0:00"})
    months = [tuple(r) for r in Q.busiest_shipper_by_month(m).collect()]
    assert months == [
        (dt.date(2024, 1, 1), 1), (dt.date(2024, 2, 1), 1), (dt.date(2024, 3, 1), 0),
        (dt.date(2024, 4, 1), 1),
    ]


def test_every_measure_alone_and_grouped(mart):
    names = list(MEASURES)
    total = measured(mart, names).first()
    by_state = measured(mart, ["total_loads", "delivered_loads"], ["pickup_state"]).collect()
    assert sum(r.total_loads for r in by_state) == total.total_loads == mart.facts.count()
    assert sum(r.delivered_loads for r in by_state) == total.delivered_loads


def test_measures_of_no_loads(spark, tmp_path):
    m = mart_of(spark, tmp_path, {})
    row = measured(m, ["total_loads", "delivery_rate", "total_pnl"],
                   loads=F.col("load_id") < 0).first()
    assert tuple(row) == (0, None, None)
    row = measured(m, ["total_loads", "avg_book_price"], how="inner",
                   members=F.col("lane") == "none", members_use=["lane"]).first()
    assert tuple(row) == (0, None)


def test_dense_rank(spark, tmp_path):
    names = ["A", "A", "B", "B", "C", None]
    m = mart_of(spark, tmp_path, *[{"carrier_name": n} for n in names])
    ranks = {r.carrier_name: r.delivered_loads_rank for r in B.carrier_ranks(m).collect()}
    assert ranks == {"A": 1, "B": 1, "C": 2, None: 2}


def test_roles_of_the_calendar(spark, tmp_path):
    m = mart_of(spark, tmp_path, {"book_date": "5/1/2023 0:00", "delivery_date": None})
    assert B.loads_by_role(m, "booked_date", "year").collect() == [(2023, 1)]
    assert B.loads_by_role(m, "delivery_date", "year").collect() == [(None, 1)]


def test_export_round_trip(spark, tmp_path):
    m = mart_of(
        spark, tmp_path,
        {"carrier_name": None, "shipper_name": 'Quote " and, comma'},
        {"delivery_date": "1/5/2024 8:00"}, {"delivery_date": "12/30/2023 8:00"},
        {"delivery_date": "1/9/2024 8:00", "load_was_cancelled": True},
    )
    folder = str(tmp_path / "export")
    rows = X.export_latest_month(m, folder, id_column="id").orderBy("delivery_date").collect()
    assert [(r.load_id, r.shipper_name, r.carrier_name) for r in rows] == [
        (2, "Shipper A", "Carrier A"), (1, 'Quote " and, comma', None),
    ]
    written = spark.read.option("header", True).csv(folder)
    assert written.columns == ["id", *X.EXPORT_COLUMNS[1:]]
    check = X.read_back_check(X.latest_month_loads(m).withColumnRenamed("load_id", "id"), folder)
    assert tuple(check.first()) == (True, 2, True)
    check = X.read_back_check(X.latest_month_loads(m), folder)
    assert check.first().columns_equal is False


def test_export_takes_the_month_from_all_loads(spark, tmp_path):
    m = mart_of(spark, tmp_path, {}, {"delivery_date": "2/3/2024 1:00",
                                     "load_was_cancelled": True})
    assert X.latest_month_loads(m).count() == 0
    with pytest.raises(ValueError, match="no delivered loads"):
        X.check_export(m)


def test_a_failing_question_does_not_stop_the_others(spark, tmp_path):
    m = mart_of(spark, tmp_path, {})
    bad = K.Question("bad", "?", lambda mart: mart.facts.select("nowhere"), True, "", "")
    log = K.run_questions(m, str(tmp_path / "run"), [K.QUESTIONS[0], bad, K.QUESTIONS[5]])
    entries = {r.id: r for r in log.collect()}
    assert entries["bad"].status == "sql_error" and "nowhere" in entries["bad"].error_message
    assert entries["q1"].answer == '[{"delivered_loads":0}]'
    assert entries["q6"].answer_rows == 1
    counts = {r.status: r.runs for r in K.status_counts(log).collect()}
    assert counts == {"sql_error": 1, "success": 2}


def test_a_question_run_again_replaces_its_entry(spark, tmp_path):
    folder = str(tmp_path / "run")
    K.run_questions(mart_of(spark, tmp_path / "a", {}), folder, [K.QUESTIONS[1]])
    unnamed = mart_of(spark, tmp_path / "b", {"shipper_name": None, "book_price": 5.0})
    log = K.run_questions(unnamed, folder, [K.QUESTIONS[1]]).collect()
    assert [r.answer for r in log] == ['[{"shipper_name":null,"total_book_price":5.0}]']


def test_no_loads_at_all(spark, tmp_path):
    from haulgrid.operators import checks
    from haulgrid.sources.mart import LoadMart
    from tests.helpers import raw_rows

    m = LoadMart(spark, lambda: raw_rows(spark, {}).where("load_id < 0"), str(tmp_path / "m"))
    assert {t.count() for t in m.tables().values()} == {0}
    assert {r.status for r in checks.suite(m).collect()} == {"pass"}
    answers = {i.id: i.build(m).collect() for i in K.QUESTIONS if i.build}
    assert answers.pop("q1") == [(0,)]
    assert all(rows == [] for rows in answers.values())
    for name in B.BREAKDOWNS:
        assert B.breakdown(m, name).count() == (1 if name == "kpis" else 0)
    assert B.breakdown(m, "kpis").first().total_loads == 0
    assert X.export_validation(m).first().row_count == 0
    assert B.carrier_ranks(m).count() == 0
    m.publish(str(tmp_path / "published"))
    assert m.facts.columns[-1] == "delivery_year"


def test_filter_on_a_dimension_comes_before_the_grouping(mart):
    plan = Q.top_carriers_into(mart, "AS")._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert grouped and not any("lane_key" in line.split("]")[0] for line in grouped)


def test_a_month_is_in_few_files(spark, tmp_path):
    from haulgrid.sources.mart import LoadMart
    from tests.helpers import raw_rows

    days = [{"load_id": i, "delivery_date": f"{1 + i % 12}/{1 + i % 28}/2024 6:00"} for i in range(600)]
    m = LoadMart(spark, lambda: raw_rows(spark, *days), str(tmp_path / "mart"))
    files = m.facts.groupBy(F.input_file_name().alias("f")).agg(
        F.min("delivery_date").alias("a"), F.max("delivery_date").alias("b")
    ).orderBy("a", "b").collect()
    assert all(one.b <= two.a for one, two in zip(files, files[1:]))


def test_answers_keep_their_order_in_several_files(spark, tmp_path):
    import json

    from haulgrid.plans import suite as K

    class Any:
        pass

    here = Any()
    here.spark = spark
    numbers = lambda m: spark.range(0, 90, numPartitions=9).orderBy(F.desc("id"))
    item = K.Question("n", "Numbers, highest first", numbers, True, "order", "none")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        row = K.run_questions(here, str(tmp_path / "log"), [item]).first()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "log/answers/n").glob("part-*"))) > 1
    assert row.status == "success" and row.answer_rows == 90
    assert [r["id"] for r in json.loads(row.answer)] == list(range(89, -1, -1))


def test_a_question_without_end_is_stopped(spark, tmp_path):
    import time

    from haulgrid.plans import suite as K

    class Any:
        pass

    here = Any()
    here.spark = spark
    endless = lambda m: spark.range(1 << 55).agg(F.sum(F.xxhash64("id") % 7).alias("n"))
    short = lambda m: spark.range(5)
    items = [K.Question(name, name, build, True, "", "") for name, build in (("one", short), ("never", endless), ("two", short))]
    log = {r.id: r for r in K.run_questions(here, str(tmp_path / "log"), items, seconds=20).collect()}
    assert {name: r.status for name, r in log.items()} == {"one": "success", "never": "error", "two": "success"}
    assert log["never"].error == "OutOfTime" and "20 seconds" in log["never"].error_message
    # Nothing of it is left running.
    deadline = time.monotonic() + 60
    while spark.sparkContext.statusTracker().getActiveStageIds() and time.monotonic() < deadline:
        time.sleep(0.5)
    assert not spark.sparkContext.statusTracker().getActiveStageIds()
