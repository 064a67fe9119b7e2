"""Built tables: each is written once as Parquet in a shared folder and read from there.

Writing cuts the lineage: a lost executor costs the running tasks, not a rebuild from raw.
It also gives Spark the true size of every table, which decides what it may broadcast.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulgrid.plans import models
from haulgrid.session import shared_folder
from haulgrid.sources.landing import read_loads_csv
from haulgrid.sources.snapshots import Manifest, Snapshots
from haulgrid.sources.tables import derive_raw_loads, order_items

# Facts are laid out by delivery year and sorted by delivery date inside each file, so a
# date range reads one directory and skips the pages outside the range.
FACT_PARTITION = "delivery_year"

# One table is built at a time: each build has the whole cluster, and no thread reads a table
# that another has half written.
_BUILDING = threading.RLock()


class LoadMart:
    """Raw, staged and modeled tables over one source of raw loads, built on first use."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[], DataFrame],
        root: str | None = None,
        built: dict[str, T.StructType] | None = None,
    ):
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/mart-{uuid.uuid4().hex}"
        self._raw = raw
        self._built = {} if built is None else built
        self._frames: dict[str, DataFrame] = {}

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table, built if need be. Its frame is kept, and with it the list of its files."""
        path = f"{self.root}/{name}"
        with _BUILDING:
            if name not in self._built:
                rows = build()
                self.write(name, rows, path, laid_out=True)
                self._built[name] = rows.schema
            if name not in self._frames:
                self._frames[name] = self.spark.read.schema(self._built[name]).parquet(path)
            return self._frames[name]

    @staticmethod
    def _laid_out(loads: DataFrame) -> DataFrame:
        """Loads with the year of their delivery, in ranges of date and id: files do not overlap in
        dates but at their edges, and a day with most loads, or loads without a date, are split by id."""
        loads = loads.withColumn(FACT_PARTITION, F.year("delivery_date"))
        return loads.repartitionByRange("delivery_date", "load_id").sortWithinPartitions(FACT_PARTITION, "delivery_date")

    def write(self, name: str, rows: DataFrame, path: str, laid_out: bool = False) -> None:
        """Write a table in its layout; rows of the fact may have it."""
        if name == "fct_loads" and not laid_out:
            rows = self._laid_out(rows)
        writer = rows.write.mode("overwrite")
        if name == "fct_loads":
            writer = writer.partitionBy(FACT_PARTITION)
        if name == "load_parts":
            writer = writer.partitionBy("kind")
        writer.parquet(path)

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "raw_loads": self._raw,
            "stg_loads": lambda: models.staged_loads(self.raw),
            "dim_shipper": lambda: models.shipper_dimension(self.staged),
            "dim_carrier": lambda: models.carrier_dimension(self.staged),
            "dim_lane": lambda: models.lane_dimension(self.staged),
            "dim_date": lambda: models.calendar_dimension(self.staged),
            # The keys are added once the loads are where they stay.
            "fct_loads": lambda: models.with_keys(self._laid_out(models.with_dates(self.staged))),
        }

    @property
    def raw(self) -> DataFrame:
        return self._table("raw_loads", self._raw)

    @property
    def staged(self) -> DataFrame:
        return self._table("stg_loads", self._builders()["stg_loads"])

    @property
    def shippers(self) -> DataFrame:
        return self._table("dim_shipper", self._builders()["dim_shipper"])

    @property
    def carriers(self) -> DataFrame:
        return self._table("dim_carrier", self._builders()["dim_carrier"])

    @property
    def lanes(self) -> DataFrame:
        return self._table("dim_lane", self._builders()["dim_lane"])

    @property
    def calendar(self) -> DataFrame:
        return self._table("dim_date", self._builders()["dim_date"])

    @property
    def facts(self) -> DataFrame:
        return self._table("fct_loads", self._builders()["fct_loads"])

    @property
    def parts(self) -> DataFrame:
        """The counts and sums that measures are made of, per value of each key of the fact."""
        from haulgrid.operators.measures import part_rows

        return self._table("load_parts", lambda: part_rows(self.facts))

    def footers(self, name: str) -> DataFrame:
        """A table for figures that its files' footers hold: counts, and least and greatest values.

        It is read in a sibling session whose Parquet reader answers such aggregates without
        reading rows, if no column but the partition's is filtered by. A file without any value
        of a column has no bounds in its footer, so for these keep such files out. An empty table
        is read as ever: over no file at all the pushed count would be NULL.
        """
        rows = self._table(name, self._builders()[name])
        if rows.isEmpty():
            return rows
        session = self.spark.newSession()
        session.conf.set("spark.sql.session.timeZone", self.spark.conf.get("spark.sql.session.timeZone"))
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        return session.read.schema(self._built[name]).parquet(f"{self.root}/{name}")

    def published(self) -> dict[str, DataFrame]:
        """The five modeled tables by name."""
        return {
            "dim_date": self.calendar,
            "dim_shipper": self.shippers,
            "dim_carrier": self.carriers,
            "dim_lane": self.lanes,
            "fct_loads": self.facts,
        }

    def tables(self) -> dict[str, DataFrame]:
        """The staged table and the modeled ones, by name."""
        return {"stg_loads": self.staged, **self.published()}

    def publish(self, folder: str, waived: Iterable[str] = ()) -> Manifest:
        """Write the five modeled tables as a new version under a folder of the caller's, check
        them, and make the version current; see ``haulgrid.plans.publishing``."""
        from haulgrid.plans.publishing import publish

        return publish(self, folder, waived)

    @classmethod
    def from_csv(
        cls, spark: SparkSession, path: str, root: str | None = None, id_column: str = "load_id"
    ) -> LoadMart:
        """A mart over headered load files; tables are built under ``root`` when first used."""
        return cls(spark, lambda: read_loads_csv(spark, path, id_column), root)

    @classmethod
    def reopen(cls, spark: SparkSession, folder: str, number: int | None = None) -> LoadMart:
        """A mart over the published tables, for all that needs only the modeled ones.

        It reads the version that is current now, or that of a number, whatever is published later.
        """

        def unavailable() -> DataFrame:
            raise ValueError(f"raw and staged loads are not among the tables in {folder}")

        store = Snapshots(spark, folder)
        version = store.current() if number is None else store.manifest(number)
        if version is None:
            raise ValueError(f"nothing is published in {folder}")
        return cls(spark, unavailable, version.path, {name: version.schema(name) for name in version.schemas})


class DerivedMart(LoadMart):
    """The mart over raw loads that are derived from the given tables."""

    def __init__(self, spark: SparkSession, source: str, root: str, built: dict):
        super().__init__(spark, self.derived_raw, root, built)
        self.source = source

    def derived_raw(self) -> DataFrame:
        return derive_raw_loads(self.spark, self.source, order_items(self.spark, self.source))


# (application, source folder) -> the mart last used there
_MARTS: dict[tuple[str, str], DerivedMart] = {}


def mart_for(spark: SparkSession, folder: str) -> DerivedMart:
    """The mart over the given tables in ``folder``, shared by all queries of an application.
    Another session of the application reads the same built tables through a mart of its own."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    with _BUILDING:
        known = _MARTS.get(key)
        if known is None:
            root = f"{shared_folder(spark)}/mart-{uuid.uuid4().hex}"
            _MARTS[key] = DerivedMart(spark, key[1], root, {})
        elif known.spark is not spark:
            _MARTS[key] = DerivedMart(spark, key[1], known.root, known._built)
        return _MARTS[key]
