"""Small JSON documents beside a table, read and written through Hadoop's file system without a Spark job."""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


class Notes:
    """Documents under ``<folder>/_<kind>/<version>.json``; the newest version of a kind counts.

    A version appears under its name when all of it is written. Folders that start with an underscore are not
    part of a table for Spark's readers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark._jvm, folder
        self.fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        """What a folder holds, by name; nothing if there is no such folder."""
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def runs(self, column: str) -> list[str]:
        """Values of the partition ``column`` that the table's folder holds."""
        prefix = f"{column}="
        return [unquote(n[len(prefix) :]) for n in self.names(self.folder) if n.startswith(prefix)]

    def _versions(self, kind: str) -> list[str]:
        return [n for n in self.names(f"{self.folder}/_{kind}") if n.endswith(".json")]

    def read(self, kind: str) -> dict | None:
        versions = self._versions(kind)
        if not versions:
            return None
        stream = self.fs.open(self._path(f"{self.folder}/_{kind}/{versions[-1]}"))
        try:
            return json.loads(bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def write(self, kind: str, value: dict) -> None:
        """Make ``value`` the newest version; the one before is kept for readers at work."""
        versions, place = self._versions(kind), f"{self.folder}/_{kind}"
        number = int(versions[-1][: -len(".json")]) + 1 if versions else 1
        draft = self._path(f"{place}/.draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        try:
            stream.write(json.dumps(value).encode())
        finally:
            stream.close()
        if not self.fs.rename(draft, self._path(f"{place}/{number:012d}.json")):
            raise OSError(f"version {number} of {place} is there already: two jobs write this table")
        for old in versions[:-1]:
            self.fs.delete(self._path(f"{place}/{old}"), False)

    def move_runs(self, column: str, source: str, runs: list[str]) -> None:
        """Move folders of the partition ``column`` from the folder ``source`` into the table; they replace their like."""
        there = {unquote(n): n for n in self.names(source)}
        for run in runs:
            if (name := there.get(f"{column}={run}")) is None:
                continue
            target = self._path(f"{self.folder}/{name}")
            self.fs.delete(target, True)
            if not self.fs.rename(self._path(f"{source}/{name}"), target):
                raise OSError(f"{source}/{name} could not be moved into the table")

    def drop_runs(self, column: str, kept: set[str]) -> None:
        """Delete the folders of all values of the partition ``column`` but those kept."""
        for run in self.runs(column):
            if run not in kept:
                self.fs.delete(self._path(f"{self.folder}/{column}={run}"), True)
