"""Steps between queries that are written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from haulgrid.session import shared_folder


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows as Parquet in the shared folder: they are computed once, and a lost executor does
    not compute them again."""
    path = f"{shared_folder(rows.sparkSession)}/step-{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
