"""Stored state: snapshots of a table, replaced by compare-and-swap."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakegate.errors import StateConflictError

KEPT = 2  # snapshots behind the current one that readers may still be using


@dataclass(frozen=True)
class StateTable:
    """A small versioned table below one folder.

    Snapshot n is a Parquet folder; a marker file ``_versions/n`` names it and makes it current. Markers are created
    without overwriting, so of two writers that started from the same version one creates the marker and the other gets
    :class:`StateConflictError`. (On an object store this needs a connector that refuses to replace an existing object.)
    Readers hold on to their snapshot; the last ``KEPT`` ones stay.
    """

    spark: SparkSession
    folder: str
    schema: T.StructType

    def _path(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _versions(self) -> list[int]:
        fs, path = self._path("_versions")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(path)) if fs.exists(path) else []

    def _named(self, version: int) -> str:
        fs, path = self._path(f"_versions/{version}")
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self) -> tuple[DataFrame, int]:
        """The current snapshot and its version; before the first one, no rows and version 0."""
        versions = self._versions()
        if not versions:
            return self.spark.createDataFrame([], self.schema), 0
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/{self._named(versions[-1])}"), versions[-1]

    def swap(self, rows: DataFrame, expected: int) -> int:
        """Make ``rows`` the snapshot after ``expected``; raises if another writer has replaced that one."""
        name = f"snapshot-{expected + 1}-{uuid.uuid4().hex}"
        if (self._versions() or [0])[-1] != expected:
            raise StateConflictError(f"version {expected} is not the current one any more")
        rows.select(*self.schema.names).write.parquet(f"{self.folder}/{name}")
        fs, marker = self._path(f"_versions/{expected + 1}")
        try:
            stream = fs.create(marker, False)
        except Exception as problem:
            fs.delete(self._path(name)[1], True)
            if "already exists" not in str(problem):
                raise
            raise StateConflictError(f"version {expected} was replaced by another writer") from problem
        stream.write(name.encode())
        stream.close()
        for old in self._versions()[: -KEPT - 1]:
            fs.delete(self._path(self._named(old))[1], True)
            fs.delete(self._path(f"_versions/{old}")[1], False)
        return expected + 1
