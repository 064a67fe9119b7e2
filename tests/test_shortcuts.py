"""Figures that need no scan of the loads: footers, stored parts, sketches, ranks by range."""

import pytest
from pyspark.sql import functions as F

from haulgrid.operators.measures import dense_rank_by, measured
from haulgrid.operators.skew import busy_keys_of, looked_up
from haulgrid.plans import breakdowns as B
from haulgrid.plans import export as X
from haulgrid.plans import models as M
from haulgrid.plans import questions as Q
from haulgrid.plans import registry
from tests.conftest import SMALL
from tests.helpers import mart_of


def explained(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, pushed", [
    ("a1_row_count", "COUNT(*)"), ("n1_shape", "COUNT(*)"), ("a8_delivery_bounds", "MIN(delivery_date), MAX(delivery_date)"),
    ("e1_latest_month", "MAX(delivery_date)"),
])
def test_footers_answer(spark, name, pushed):
    plan = explained(registry.queries()[name](spark, SMALL))
    assert "PushedAggregation: [" + pushed in plan


@pytest.mark.parametrize("loads", [
    [{}, {"delivery_date": None}, {"delivery_date": "2/3/2024 1:00"}], [{"delivery_date": None}] * 2, [],
])
def test_footers_equal_scans(spark, tmp_path, loads):
    m = mart_of(spark, tmp_path, *loads)
    bounds = [F.min("delivery_date").alias("a"), F.max("delivery_date").alias("b")]
    assert Q.with_delivery_year(m.footers("fct_loads")).agg(*bounds).collect() == m.facts.agg(*bounds).collect()
    assert m.footers("fct_loads").agg(F.count("*")).collect() == m.facts.agg(F.count("*")).collect()
    assert m.footers("raw_loads").agg(F.count("*")).first()[0] == len(loads)
    found = Q.latest_month(Q.with_delivery_year(m.footers("fct_loads")))
    assert found.collect() == Q.latest_month(m.facts).collect()


REPORTS = [*registry.MEASURE_QUERIES, *registry.BREAKDOWN_QUERIES, "v4_top_shippers", "b18_carrier_ranks"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_no_facts(spark, mart, name):
    mart.parts  # noqa: B018
    files = registry.queries()[name](spark, SMALL).inputFiles()
    assert files and not any("fct_loads" in file or "stg_loads" in file for file in files)


def test_stored_parts_equal_the_loads(spark, mart):
    for by, role in (("pickup_state", "delivery_date"), ("year", "booked_date"), ("haul_type", "delivery_date"),
                     ("carrier_name", "delivery_date"), (None, "delivery_date")):
        some = ["total_loads", "delivered_loads", "avg_carrier_rating", "total_pnl"]
        places = {"avg_carrier_rating": 6, "total_pnl": 2}
        stored = registry.rounded(measured(mart, some, [by] if by else [], role=role), places)
        loads = registry.rounded(measured(mart, some, [by] if by else [], role=role, loads=F.lit(True)), places)
        assert any("fct_loads" in file for file in loads.inputFiles())
        assert sorted(map(str, stored.collect())) == sorted(map(str, loads.collect()))


def test_several_keys_fall_back_to_the_loads(mart):
    rows = measured(mart, ["total_loads"], ["carrier_name", "pickup_state"])
    assert any("fct_loads" in file for file in rows.inputFiles())


def test_ranks_by_range(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select("id", F.when(F.col("id") % 50 > 0, F.col("id") % 700).alias("n"))
        found = dense_rank_by(rows, "n", "rank")
        assert "Window" not in explained(found)
        levels = {n: at for at, n in enumerate(sorted({i % 700 for i in range(3000) if i % 50}, reverse=True), 1)}
        assert {(r.id, r["rank"]) for r in found.collect()} == {(i, levels[i % 700]) for i in range(3000) if i % 50}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_ranks_read_the_groups_once(mart):
    files = B.carrier_ranks(mart).inputFiles()
    assert files and all("step-" in file for file in files)


def hot(spark):
    """A third of the rows on one value of each of three keys."""
    row = F.col("id")
    return spark.range(9000).select(
        "id", F.when(row % 3 == 0, "a").otherwise(F.concat(F.lit("s"), row % 1000)).alias("x"),
        F.when(row % 3 == 1, -1).otherwise(row % 800).alias("y"),
        F.when(row % 3 == 2, "z").when(row % 7 > 0, F.concat(F.lit("l"), row % 300)).alias("z"),
    )


def test_one_scan_finds_the_hot_values_of_all_keys(spark, tmp_path):
    hot(spark).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    busy = busy_keys_of(rows, ["x", "y", "z"])
    assert {key: [r["_busy"] for r in found.collect()] for key, found in busy.items()} == {"x": ["a"], "y": [-1], "z": ["z"]}
    assert all(found.first()["_salts"] >= partitions // 3 for found in busy.values())

    lookups = [
        (key, rows.select(key, F.concat(F.lit("of "), key).alias(f"{key}_name")).where(F.col(key).isNotNull()).distinct(), "left")
        for key in ("x", "y", "z")
    ]
    found = looked_up(rows, "id", *lookups)
    assert found.where("x_name = concat('of ', x) and y_name = concat('of ', y)").count() == 9000
    assert found.where("z is null and z_name is null or z_name = concat('of ', z)").count() == 9000


@pytest.mark.parametrize("build", [
    lambda m: X.with_members(m, m.facts), lambda m: M.facts_by_lookup(m.staged, m.shippers, m.carriers, m.lanes),
    X.latest_month_loads,
])
def test_lookups_scan_the_loads_twice(spark, mart, build):
    """Once to count the hot values of all three keys, and once to look them up."""
    mart.tables()
    counted, plain = [], type(mart.facts).agg

    def agg(self, *columns):
        if any("approx_top_k" in str(column) for column in columns):
            counted.append(len(columns))
        return plain(self, *columns)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(mart.facts), "agg", agg)
        rows = build(mart)
    assert counted == [6]  # a sketch and a count of each key
    scans = [line for line in explained(rows).splitlines() if "FileScan" in line and "load_id" in line and "lane" in line]
    assert len(scans) == 1
