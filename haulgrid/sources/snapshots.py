"""Versions of published tables, and the small file that says which one is current.

A version's tables are written under a folder of their own, where nobody looks for them yet. A
manifest, one small file with the next number, then makes them current: it is written under
another name and moved to its own, which fails if another publisher was there first. Readers take
the manifest of the highest number and read the version it names, so they see all of one version,
and go on seeing it while the next one is written or after its writing failed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Manifest:
    """A published version: its folder, its tables' schemas, and what the checks found."""

    number: int
    path: str
    schemas: dict[str, str]
    warned: dict[str, int] = field(default_factory=dict)
    waived: dict[str, int] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.schema(self.schema(name)).parquet(f"{self.path}/{name}")

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schemas[name]))


class Snapshots:
    """The versions under one folder, of whatever file system Spark reads it from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._files = self._path(self.folder).getFileSystem(self._conf)

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def _name(self, number: int) -> str:
        return f"{self.folder}/manifests/{number:012d}.json"

    def numbers(self) -> list[int]:
        """Numbers of the published versions, ascending."""
        folder = self._path(f"{self.folder}/manifests")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit())

    def manifest(self, number: int) -> Manifest:
        text = self.spark.read.text(self._name(number), wholetext=True).first()[0]
        return Manifest(**json.loads(text))

    def current(self) -> Manifest | None:
        numbers = self.numbers()
        return self.manifest(numbers[-1]) if numbers else None

    def new_version(self) -> str:
        """A folder for the tables of a version that is not yet published."""
        return f"{self.folder}/versions/{uuid.uuid4().hex}"

    def commit(
        self, path: str, schemas: dict[str, T.StructType], warned: dict[str, int] | None = None,
        waived: dict[str, int] | None = None,
    ) -> Manifest:
        """Make a version current. Of several publishers at a time each gets a number of its own."""
        described = {name: schema.json() for name, schema in schemas.items()}
        while True:
            number = max(self.numbers(), default=0) + 1
            found = Manifest(number, path, described, warned or {}, waived or {})
            if self._write_absent(self._name(number), json.dumps(asdict(found))):
                return found

    def _write_absent(self, name: str, text: str) -> bool:
        """Write a file unless there is one of this name; nobody sees half of it."""
        draft = self._path(f"{self.folder}/drafts/{uuid.uuid4().hex}")
        out = self._files.create(draft, False)
        out.write(text.encode())
        out.close()
        target = self._path(name)
        self._files.mkdirs(target.getParent())
        context = self._hadoop.FileContext.getFileContext(self._files.getUri(), self._conf)
        # Without an option a move never replaces a file.
        options = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(target), options)
        except Py4JJavaError as failure:
            if "AlreadyExists" not in failure.java_exception.getClass().getName():
                raise
            self._files.delete(draft, False)
            return False
        return True

    def expire(self, keep: int = 2) -> list[int]:
        """Delete all but the last published versions, manifests first; returns their numbers.

        Versions that were never published stay: another publisher may be writing them.
        """
        old = [self.manifest(number) for number in self.numbers()[:-max(keep, 1)]]
        for manifest in old:
            self._files.delete(self._path(self._name(manifest.number)), False)
            self._files.delete(self._path(manifest.path), True)
        return [manifest.number for manifest in old]
