"""Write, audit, publish: no version becomes current before the checks have passed on its files.

A failing error check refuses the version: it stays where it was written, with the checks' results
beside it, and readers go on with the last one. A warning is recorded and the version goes out.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulgrid.operators import checks
from haulgrid.sources.mart import LoadMart
from haulgrid.sources.snapshots import Manifest, Snapshots

#: The table of check results beside a version's tables.
RESULTS = "checks"


class ChecksFailed(ValueError):
    """A version was refused. ``failing`` counts rows by check, model and column."""

    def __init__(self, path: str, failing: dict[tuple[str, str, str], int]):
        self.path, self.failing = path, failing
        told = ", ".join(f"{'.'.join(check)}: {rows}" for check, rows in failing.items())
        super().__init__(f"not published, as error checks failed on {path}: {told}")


class WrittenTables:
    """What the checks read: the staged loads, and the tables of a version from its files."""

    def __init__(self, staged: DataFrame, tables: dict[str, DataFrame]):
        self._tables = {"stg_loads": staged, **tables}

    def tables(self) -> dict[str, DataFrame]:
        return self._tables


def publish(mart: LoadMart, folder: str, waived: Iterable[str] = ()) -> Manifest:
    """Write the five modeled tables as a new version, check it, and make it current.

    ``waived`` names error checks whose failures are known and accepted; they are recorded. Any
    other failing error check raises ``ChecksFailed``, and the current version stays what it was,
    as it does if writing or checking fails half way.
    """
    spark, store = mart.spark, Snapshots(mart.spark, folder)
    path, schemas = store.new_version(), {}
    # The parts of measures go along, so that readers of the version need not build them.
    for name, rows in {**mart.published(), "load_parts": mart.parts}.items():
        mart.write(name, rows, f"{path}/{name}")
        schemas[name] = rows.schema
    written = {name: spark.read.schema(schema).parquet(f"{path}/{name}") for name, schema in schemas.items()}
    results = checks.suite(WrittenTables(mart.staged, {name: written[name] for name in mart.published()}))
    results.write.parquet(f"{path}/{RESULTS}")
    # One row for each of the checks.
    found = spark.read.schema(results.schema).parquet(f"{path}/{RESULTS}").where("failing_rows > 0").collect()
    names, waived = {(r.check_name, r.model, r.column_name): r for r in found}, set(waived)
    failing = {name: r.failing_rows for name, r in names.items() if r.status == "fail" and r.check_name not in waived}
    if failing:
        raise ChecksFailed(path, failing)
    told = {status: {".".join(name): r.failing_rows for name, r in names.items() if r.status == status}
            for status in ("warn", "fail")}
    return store.commit(path, schemas, warned=told["warn"], waived=told["fail"])


def check_results(spark: SparkSession, folder: str) -> DataFrame:
    """What the checks found on the current version."""
    return spark.read.parquet(f"{Snapshots(spark, folder).current().path}/{RESULTS}")


def outcomes(mart: LoadMart, folder: str, waived: Iterable[str]) -> DataFrame:
    """One row for each of two attempts, with the checks waived and without: was it published, how
    many error checks stood against it or were waived, how many warned, and which version is current.
    """
    spark, rows = mart.spark, []
    for attempt, accepted in (("waived", tuple(waived)), ("strict", ())):
        before = Snapshots(spark, folder).current()
        start = before.number if before else 0
        try:
            made, failing = publish(mart, folder, accepted), 0
        except ChecksFailed as refusal:
            made, failing = None, len(refusal.failing)
        now = Snapshots(spark, folder).current()
        rows.append((
            attempt, made is not None, failing, len(made.waived) if made else 0,
            (now.number if now else 0) - start,
        ))
    entries = [F.struct(F.lit(a).alias("attempt"), F.lit(p).alias("published"), F.lit(f).cast("long").alias("failing_checks"),
                        F.lit(w).cast("long").alias("waived_checks"), F.lit(s).cast("long").alias("new_versions"))
               for a, p, f, w, s in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))
