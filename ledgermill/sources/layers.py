"""Layer folders: bronze, staging, silver, gold and the error log.

A table lies in a version folder of its own. A manifest names the version of every table; the manifest
with the highest number holds. Tables of one load become visible together, when their manifest is put
down, and a load that fails leaves every table as it was. Nothing is renamed.
"""

from __future__ import annotations

import json
import os
import threading
import time
import uuid
from collections.abc import Callable, Collection, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ledgermill.session import CODEC, tune

LAYERS = ("bronze", "staging", "silver", "gold", "error_log")
MANIFESTS = "_manifests"
VERSION_MARK = ".v-"
TRIES = 20

_commits: dict[str, threading.Lock] = {}


class Lake:
    """Tables as Parquet folders under one root, one sub-folder per layer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        tune(spark)

    def home(self, layer: str, table: str) -> str:
        """The folder of a table that has no versions, such as a log."""
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return os.path.join(self.root, layer, table)

    def path(self, layer: str, table: str) -> str:
        """The folder that holds the table now."""
        home = self.home(layer, table)
        entry = self.entry(layer, table)
        return os.path.join(self.root, entry["path"]) if entry else home

    def entry(self, layer: str, table: str) -> dict | None:
        """What the manifest says of a table: its path, and what the load that wrote it added."""
        return self.manifest()[1].get(f"{layer}/{table}")

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table))

    def write(self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
        """Full load of one table. A load that fails leaves the old table as it was."""
        with self.load() as load:
            load.write(df, layer, table, partition_by)
        return self.read(layer, table)

    @contextmanager
    def load(self, kept: Callable[[], Collection[str]] = tuple) -> Iterator[Load]:
        """Tables written inside become visible together at the end; after a failure none does.

        A failed load removes the versions it wrote, but for those ``kept`` then names.
        """
        load = Load(self, kept)
        try:
            yield load
            load.commit()
        except BaseException:
            load.abandon()
            raise

    def publish(self, layer: str, tables: list[str]) -> None:
        """Make the present versions of tables of a layer readable in SQL as ``layer.table``."""
        location = os.path.join(self.root, layer)
        self.spark.sql(f"create database if not exists {layer} location '{location}'")
        for table in tables:
            self.spark.sql(f"drop table if exists {layer}.{table}")
            self.spark.sql(f"create table {layer}.{table} using parquet location '{self.path(layer, table)}'")

    # --- manifests: <number> holds the name of a file that was complete before -------------------

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def put(self, path: str, text: str) -> None:
        """A new file; fails if there is one of this name."""
        files, place = self._files(path)
        out = files.create(place, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def get(self, path: str) -> str:
        files, place = self._files(path)
        source = files.open(place)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def remove(self, path: str) -> None:
        files, place = self._files(path)
        files.delete(place, True)

    def exists(self, path: str) -> bool:
        files, place = self._files(path)
        return files.exists(place)

    def names(self, folder: str) -> list[str]:
        """Names of what lies in a folder; none if there is no such folder."""
        files, place = self._files(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def state_of(self, path: str) -> str:
        """Length and time of change of a file."""
        files, place = self._files(path)
        status = files.getFileStatus(place)
        return f"{status.getLen()} {status.getModificationTime()}"

    def manifest(self) -> tuple[int, dict[str, dict]]:
        """The number of the newest manifest and its tables; 0 and none before the first load."""
        folder = os.path.join(self.root, MANIFESTS)
        files, place = self._files(folder)
        if not files.exists(place):
            return 0, {}
        numbers = [int(s.getPath().getName()) for s in files.listStatus(place) if s.getPath().getName().isdigit()]
        for number in sorted(numbers, reverse=True):
            name = self.get(os.path.join(folder, f"{number:010d}"))
            if name.endswith("\n"):  # else a writer is still about to put it down
                return number, json.loads(self.get(os.path.join(folder, name.strip())))
        return 0, {}

    def _commit(self, changes: Mapping[str, dict | None]) -> None:
        """Puts down the next manifest: the newest one with the changes (none: the table goes).

        Another load that commits at the same time takes the number first; then its manifest is the base.
        """
        folder = os.path.join(self.root, MANIFESTS)
        with _commits.setdefault(self.root, threading.Lock()):
            for trial in range(TRIES):
                number, tables = self.manifest()
                stale = []
                for table, entry in changes.items():
                    old = tables.pop(table, None)
                    if old and entry and old["path"] == entry["path"]:  # taken over by a run that goes on
                        tables[table] = {**old, **entry}
                        continue
                    stale += [old["previous"]] if old and old.get("previous") else []
                    if entry is not None:
                        # The version before stays readable for who has opened it.
                        tables[table] = {**entry, "previous": old["path"] if old else None}
                    elif old:
                        stale.append(old["path"])
                name = f"{uuid.uuid4().hex}.json"
                self.put(os.path.join(folder, name), json.dumps(tables, sort_keys=True))
                try:
                    self.put(os.path.join(folder, f"{number + 1:010d}"), f"{name}\n")
                except Exception as taken:
                    self.remove(os.path.join(folder, name))
                    if trial == TRIES - 1 or "AlreadyExists" not in str(taken) and "already exists" not in str(taken):
                        raise
                    time.sleep(0.1 * (trial + 1))
                    continue
                for path in stale:
                    self.remove(os.path.join(self.root, path))
                return


class Load:
    """Tables that become visible together. Several threads may write into one load."""

    def __init__(self, lake: Lake, kept: Callable[[], Collection[str]] = tuple):
        self.lake = lake
        self._kept = kept
        self._changes: dict[str, dict | None] = {}
        self._written: list[str] = []
        self._guard = threading.Lock()

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: list[str] | None = None, **facts: str | int | None
    ) -> DataFrame:
        """Writes a version that only this load sees; ``facts`` are kept in the manifest."""
        home = self.lake.home(layer, table)
        path = f"{os.path.relpath(home, self.lake.root)}{VERSION_MARK}{uuid.uuid4().hex}"
        place = os.path.join(self.lake.root, path)
        with self._guard:
            self._written.append(path)
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(place, compression=CODEC)
        with self._guard:
            self._changes[f"{layer}/{table}"] = {"path": path, **facts}
        return self.lake.spark.read.parquet(place)

    def adopt(self, layer: str, table: str, path: str) -> DataFrame:
        """Takes over a complete version that an earlier, failed load of the same run has left."""
        with self._guard:
            self._changes[f"{layer}/{table}"] = {"path": path}
        return self.lake.spark.read.parquet(os.path.join(self.lake.root, path))

    def version(self, layer: str, table: str) -> str:
        """The path of a table of this load, below the root."""
        return self._changes[f"{layer}/{table}"]["path"]

    def note(self, layer: str, table: str, **facts: str | int | list | None) -> None:
        """Adds facts to a table of this load."""
        with self._guard:
            self._changes[f"{layer}/{table}"].update(facts)

    def drop(self, layer: str, table: str) -> None:
        with self._guard:
            self._changes[f"{layer}/{table}"] = None

    def commit(self) -> None:
        if self._changes:
            self.lake._commit(self._changes)

    def abandon(self) -> None:
        """Removes what was written; a file system that refuses must not hide why the load failed."""
        try:
            kept = set(self._kept())
        except PySparkException:
            return
        for path in set(self._written) - kept:
            try:
                self.lake.remove(os.path.join(self.lake.root, path))
            except PySparkException:
                continue
