"""Session settings and the shared folder that built tables are written to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings for a large cluster and some 100 TB of raw loads. Only deriving loads and laying out
# the fact shuffle whole rows: about 1 to 3 GB for each of the partitions, which spill to disk.
# Everything else shuffles sums, and adaptive execution merges what is small. Large scan
# splits keep the number of shuffle blocks (scan tasks times partitions) in bounds.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "32000",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.session.timeZone": "UTC",
    # The JVM leaves methods of more than 8000 bytes to its interpreter, so Spark is told to split
    # what would generate a larger one, as the wide projections here do.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings that only a new application takes. Questions that run side by side share the cluster,
# see plans/suite.py.
START_CONF = {"spark.scheduler.mode": "FAIR"}


def cluster_session(app: str = "haulgrid", **conf: str) -> SparkSession:
    """A session with the settings for a large cluster; others, and the master, come from outside."""
    builder = SparkSession.builder.appName(app).config(map={**CLUSTER_CONF, **START_CONF})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "haulgrid", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A one-machine session, as used by the tests and the benchmark."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config(map=START_CONF)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


_LOCAL_SCRATCH: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder for built tables: ``spark.checkpoint.dir`` of the session.

    Only a local session may leave it unset; it then gets a folder of its own. On a cluster
    a machine-local folder would be lost with its machine, so there the setting is required.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = context.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="haulgrid-")
    return _LOCAL_SCRATCH[app]
