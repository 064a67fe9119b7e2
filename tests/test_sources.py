import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haulgrid.operators.skew import busy_keys, looked_up, with_salt
from haulgrid.sources.landing import RAW_COLUMNS, read_loads_csv, write_loads_csv
from haulgrid.plans.questions import top_lanes
from haulgrid.sources.mart import LoadMart
from tests.helpers import mart_of, raw_rows


def test_csv_round_trip(spark, tmp_path):
    raw = raw_rows(
        spark, {}, {"carrier_name": " ", "sourcing_channel": None},
        {"shipper_name": 'A "quoted", name', "lane": " A,TX -> B,ca "},
    )
    write_loads_csv(raw, str(tmp_path / "csv"))
    back = read_loads_csv(spark, str(tmp_path / "csv"))
    assert back.columns == list(RAW_COLUMNS)
    assert back.dtypes == raw.dtypes
    assert sorted(back.collect(), key=lambda r: r[0]) == raw.orderBy("load_id").collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    raw = raw_rows(spark, {"load_id": 42}).withColumnRenamed("load_id", "shipment")
    shuffled = raw.select("lane", "shipment", *[f"`{c}`" for c in raw.columns[:1:-1]],
                          F.lit("x").alias("extra"))
    shuffled.write.option("header", True).csv(str(tmp_path / "csv"))
    row = read_loads_csv(spark, str(tmp_path / "csv"), id_column="shipment").first()
    assert (row.load_id, row.lane) == (42, "Austin,TX -> Reno,NV")
    with pytest.raises(ValueError, match="load_id"):
        read_loads_csv(spark, str(tmp_path / "csv"))


def test_csv_with_a_bad_number_fails(spark, tmp_path):
    raw = raw_rows(spark, {}).withColumn("pnl", F.lit("abc"))
    write_loads_csv(raw, str(tmp_path / "csv"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_loads_csv(spark, str(tmp_path / "csv")).collect()


def test_published_tables_are_reopened(spark, tmp_path):
    m = mart_of(spark, tmp_path, {}, {"delivery_date": None})
    m.publish(str(tmp_path / "out"), waived=["not_null"])
    again = LoadMart.reopen(spark, str(tmp_path / "out"))
    assert again.facts.count() == 2
    assert sorted(again.facts.dtypes) == sorted(m.facts.dtypes)
    assert top_lanes(again).collect() == top_lanes(m).collect()
    with pytest.raises(ValueError, match="not among"):
        again.staged  # noqa: B018


def test_mart_over_files(spark, tmp_path):
    write_loads_csv(raw_rows(spark, {}, {"load_id": 1}, {}), str(tmp_path / "csv"))
    m = LoadMart.from_csv(spark, str(tmp_path / "csv"), str(tmp_path / "mart"))
    assert (m.raw.count(), m.facts.count()) == (3, 2)


def test_a_hot_year_is_written_by_many_tasks(spark, tmp_path):
    # The rows are few and alike, so Spark would merge their partitions up to its least size.
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = raw_rows(spark, {}).withColumn("load_id", F.explode(F.sequence(F.lit(1), F.lit(30000))))
        cold = raw_rows(spark, {"load_id": 0, "delivery_date": "5/1/2020 0:00"})
        LoadMart(spark, lambda: hot.repartition(8).union(cold), str(tmp_path / "m")).facts.count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = {y: len(list((tmp_path / "m/fct_loads" / f"delivery_year={y}").glob("*.parquet")))
             for y in (2020, 2024)}
    assert files[2020] == 1 and files[2024] > 3


def test_tables_are_built_once(spark, tmp_path):
    m = mart_of(spark, tmp_path, {})
    assert m.facts.count() == 1
    m._raw = None
    assert m.staged.count() == m.shippers.count() == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookups_equal_plain_joins(spark, how):
    rows = spark.range(5000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("k"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 90).alias("j"),
    )
    first = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    first = first.union(first.where("k = 7"))
    second = spark.range(60).select(F.col("id").alias("j"), (-F.col("id")).alias("w"))
    second = second.union(spark.sql("SELECT CAST(NULL AS BIGINT), 1L"))
    columns = ["id", "k", "j", "v", "w"]
    salted = looked_up(rows, "id", ("k", first, how), ("j", second, "left")).select(*columns)
    plain = rows.join(first, "k", how).join(second, "j", "left").select(*columns)
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


@pytest.mark.parametrize("keys", [1, 2, 65, 1000])
def test_no_key_and_salt_holds_more_than_twice_the_fair_share(spark, keys):
    rows = spark.range(20_000).select("id", (F.col("id") % keys).alias("k"))
    salted = with_salt(rows, "k", "id", busy_keys(rows, "k"), "s")
    fair = 20_000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert salted.groupBy("k", "s").count().agg(F.max("count")).first()[0] <= 2 * fair


def test_missing_keys_are_spread(spark):
    rows = spark.range(8000).select("id", F.lit(None).cast("int").alias("k"))
    salted = with_salt(rows, "k", "id", busy_keys(rows, "k"), "s")
    assert salted.groupBy("s").count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_threads_share_one_build(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    builds = []

    def source():
        builds.append(1)
        return raw_rows(spark, {}, {})

    m = LoadMart(spark, source, str(tmp_path / "m"))
    with ThreadPoolExecutor(4) as pool:
        counts = list(pool.map(lambda _: (m.facts.count(), m.lanes.count()), range(4)))
    assert counts == [(2, 1)] * 4 and len(builds) == 1


def test_settings_for_a_cluster_are_settings(spark):
    from haulgrid.session import CLUSTER_CONF

    here = spark.newSession()
    for key, value in CLUSTER_CONF.items():
        here.conf.set(key, value)
        assert here.conf.get(key) == value
