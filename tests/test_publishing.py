"""Versions, their one pointer, and the checks before it moves."""

import threading

import pytest
from pyspark.sql import functions as F

from haulgrid.plans.publishing import ChecksFailed, check_results, publish
from haulgrid.plans.questions import top_lanes
from haulgrid.sources.mart import LoadMart
from haulgrid.sources.snapshots import Snapshots
from tests.helpers import mart_of


def reopened(spark, folder):
    return LoadMart.reopen(spark, folder).facts.agg(F.count("*"), F.sum("book_price")).first()


def test_a_failed_write_leaves_the_whole_old_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "out")
    first = mart_of(spark, tmp_path / "a", {}, {})
    publish(first, folder)
    reader = LoadMart.reopen(spark, folder)
    second = mart_of(spark, tmp_path / "b", *[{"book_price": 7.0}] * 5)
    second.tables(), second.parts  # noqa: B018

    written = []

    def failing(self, name, rows, path, plain=LoadMart.write):
        written.append(name)
        if len(written) == 3:
            raise OSError("disk full")
        plain(self, name, rows, path)

    monkeypatch.setattr(LoadMart, "write", failing)
    with pytest.raises(OSError, match="disk full"):
        publish(second, folder)
    monkeypatch.undo()
    assert len(written) == 3 and Snapshots(spark, folder).numbers() == [1]
    assert tuple(reopened(spark, folder)) == (2, 200.0)

    publish(second, folder)
    assert tuple(reopened(spark, folder)) == (5, 35.0)
    assert reader.facts.count() == 2  # who read the old version goes on with it
    assert LoadMart.reopen(spark, folder, 1).facts.count() == 2


def test_an_orphan_refuses_the_version(spark, tmp_path):
    folder = str(tmp_path / "out")
    publish(mart_of(spark, tmp_path / "a", {}), folder)
    broken = mart_of(spark, tmp_path / "b", {}, {"shipper_name": "Shipper B"})
    kept = broken.shippers.where("shipper_name <> 'Shipper B'").collect()
    broken._frames["dim_shipper"] = spark.createDataFrame(kept, broken.shippers.schema)
    with pytest.raises(ChecksFailed) as refusal:
        publish(broken, folder)
    assert refusal.value.failing == {("relationships", "fct_loads", "shipper_key"): 1}
    results = spark.read.parquet(f"{refusal.value.path}/checks")
    assert results.where("status = 'fail'").count() == 1 and results.count() == 62
    assert Snapshots(spark, folder).numbers() == [1] and reopened(spark, folder)[0] == 1


def test_a_warning_is_recorded_and_goes_out(spark, tmp_path):
    folder = str(tmp_path / "out")
    made = publish(mart_of(spark, tmp_path / "a", {}, {"mileage": 0.0}), folder)
    assert made.warned == {"zero_mileage.stg_loads.mileage": 1} and not made.waived
    assert Snapshots(spark, folder).current() == made
    assert check_results(spark, folder).where("status = 'warn'").count() == 1


def test_waived_failures_are_recorded(spark, tmp_path):
    folder = str(tmp_path / "out")
    m = mart_of(spark, tmp_path / "a", {}, {"lane": "X"})
    with pytest.raises(ChecksFailed):
        publish(m, folder)
    assert Snapshots(spark, folder).current() is None
    with pytest.raises(ValueError, match="nothing is published"):
        LoadMart.reopen(spark, folder)
    made = publish(m, folder, waived=["lane_format"])
    assert made.number == 1 and list(made.waived) == ["lane_format.stg_loads.lane"]


def test_publishers_at_a_time_get_numbers_of_their_own(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "out"))
    schema = spark.range(1).schema
    threads = [threading.Thread(target=lambda i=i: store.commit(f"v{i}", {"t": schema})) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert store.numbers() == list(range(1, 9))
    assert {store.manifest(n).path for n in store.numbers()} == {f"v{i}" for i in range(8)}


def test_old_versions_expire(spark, tmp_path):
    folder = str(tmp_path / "out")
    m = mart_of(spark, tmp_path / "a", {}, {})
    made = [publish(m, folder) for _ in range(3)]
    assert Snapshots(spark, folder).expire(keep=1) == [1, 2]
    assert not (tmp_path / "out/versions" / made[0].path.rsplit("/", 1)[1]).exists()
    assert top_lanes(LoadMart.reopen(spark, folder)).count() == 1
