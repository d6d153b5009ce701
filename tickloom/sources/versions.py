"""Tables that are saved as a whole, or grow by batches, without ever losing what was stored before.

Data goes to new folders; a manifest names those in force. A manifest is a file for each version that
is created once, so of two writers of one version one fails. Only names pass through the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from datetime import date
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources.raw import path_exists, remove_path

BATCH, DATE, PART = "batch_id", "dt", "part"


class Conflict(RuntimeError):
    """Another writer saved the version first; what it saved is in force."""


class Manifest:
    """A small JSON value with versions 1, 2, ...: compare-and-set over the files of a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/_manifest"

    def _where(self, name: str = ""):
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        where = hadoop.Path(f"{self.path}/{name}" if name else self.path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        where, system = self._where()
        if not system.exists(where):
            return []
        names = [s.getPath().getName() for s in system.listStatus(where)]
        return sorted(int(n) for n in names if n.isdigit())

    def read(self, version: int | None = None) -> tuple[int, Any]:
        """The version and its value; the newest one by default, (0, None) if there is none."""
        known = self.versions()
        if version is None:
            version = known[-1] if known else 0
        if version not in known:
            if version:
                raise KeyError(f"no version {version} of {self.path}")
            return 0, None
        where, system = self._where(f"{version:012d}")
        stream = system.open(where)
        try:
            return version, json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, version: int, value: Any) -> int:
        """Save ``value`` as the version after ``version``; Conflict if that exists."""
        jvm = self.spark.sparkContext._jvm
        new, system = self._where(f"{version + 1:012d}")
        draft, _ = self._where(f"draft-{uuid.uuid4().hex}")
        stream = system.create(draft, False)
        try:
            stream.write(json.dumps(value).encode())
        finally:
            stream.close()
        # Whole files only become versions, and a version never changes.
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(draft, new, none)
        except Py4JJavaError as error:
            system.delete(draft, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise Conflict(f"version {version + 1} of {self.path} was saved by another writer") from None
            raise
        return version + 1

    def forget(self, before: int) -> None:
        for old in self.versions():
            if old < before:
                where, system = self._where(f"{old:012d}")
                system.delete(where, False)


class VersionedTable:
    """A table that is read, changed and saved as a whole, such as the rule table.

    Each version has a folder of its own, and is in force once its manifest is written. A save that
    fails leaves the version before it; of two saves over the same version the second one is a
    ``Conflict``. The last ``keep`` versions can be read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int = 10):
        self.spark, self.path, self.schema, self.keep = spark, path.rstrip("/"), schema, keep
        self.manifest = Manifest(spark, path)

    def version(self) -> int:
        return self.manifest.read()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; no rows if nothing was saved yet."""
        _, folder = self.manifest.read(version)
        if folder is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).json(f"{self.path}/{folder}")

    def save(self, df: DataFrame, expected: int | None = None) -> int:
        """Save all rows as the version after ``expected`` (the newest by default); the new version."""
        before = self.version() if expected is None else expected
        folder = f"v{before + 1}-{uuid.uuid4().hex}"
        names = self.schema.fieldNames()
        df.select(*names).write.option("ignoreNullFields", "false").json(f"{self.path}/{folder}")
        try:
            saved = self.manifest.commit(before, folder)
        except Conflict:
            remove_path(self.spark, f"{self.path}/{folder}")
            raise
        for old in self.manifest.versions():
            if old <= saved - self.keep:
                remove_path(self.spark, f"{self.path}/{self.manifest.read(old)[1]}")
        self.manifest.forget(saved - self.keep + 1)
        return saved

    def update(self, change: Callable[[DataFrame], DataFrame], tries: int = 10) -> int:
        """Read, change and save; again over what another writer has saved meanwhile."""
        for attempt in range(tries):
            version = self.version()
            try:
                return self.save(change(self.read(version or None)), version)
            except Conflict:
                if attempt == tries - 1:
                    raise
        raise AssertionError("unreachable")


class MergeStore:
    """Rows by key that batches add to, as a log-structured table.

    A batch writes one folder. When ``fanout`` folders of a level have come together they are merged
    into one of the next level, so the folders, and how often a row is written, grow with the
    logarithm of the batches. ``merge`` makes one row of the rows of a key; the column ``batch_id`` of
    its input tells which is newer, and it has to give the column too. Reading merges the few folders
    in force.

    The folder of the last batch is not merged before the next one comes, so a repeated batch replaces
    its own rows; earlier batches are refused. ``date_of`` names a time column by whose dates the
    folders are partitioned, so that a range of it is a choice of folders.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame],
        fanout: int = 8, date_of: str | None = None,
    ):
        self.spark, self.path, self.schema, self.merge = spark, path.rstrip("/"), schema, merge
        self.fanout, self.date_of = fanout, date_of
        self.manifest = Manifest(spark, path)

    def folders(self) -> list[dict]:
        """Folders in force, oldest first: name, level, and the last batch in it."""
        return (self.manifest.read()[1] or {"live": []})["live"]

    def _write(self, rows: DataFrame, level: int, batch_id: int) -> dict:
        name = f"{batch_id:012d}-{level}-{uuid.uuid4().hex[:12]}"
        if self.date_of:
            rows = rows.withColumn(DATE, F.to_date(self.date_of)).hint("rebalance", DATE)
        writer = rows.write.partitionBy(DATE) if self.date_of else rows.write
        writer.parquet(f"{self.path}/{PART}={name}")
        return {"name": name, "level": level, "last": batch_id}

    def _rows(self, folders: Sequence[dict]) -> DataFrame:
        fields = [*self.schema.fields, T.StructField(BATCH, T.LongType(), True)]
        if not folders:
            return self.spark.createDataFrame([], T.StructType(fields))
        reader = self.spark.read.schema(T.StructType([*fields, T.StructField(PART, T.StringType(), True)]))
        if self.date_of:
            reader = self.spark.read.schema(T.StructType([*fields, T.StructField(PART, T.StringType(), True), T.StructField(DATE, T.DateType(), True)]))
        return reader.option("basePath", self.path).parquet(*(f"{self.path}/{PART}={f['name']}" for f in folders))

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch; those of a repeated batch replace what it has written."""
        version, value = self.manifest.read()
        live, gone = (value["live"], value["gone"]) if value else ([], [])
        own = [f for f in live if f["last"] == batch_id and f["level"] == 0]
        if any(f["last"] >= batch_id for f in live if f not in own):
            raise ValueError(f"batch {batch_id} is older than what is stored")
        dropped = [f["name"] for f in own]
        live = [f for f in live if f not in own]
        while len(tail := live[-self.fanout :]) == self.fanout and len({f["level"] for f in tail}) == 1:
            merged = self.merge(self._rows(tail)).select(*self.schema.fieldNames(), BATCH)
            live[-self.fanout :] = [self._write(merged, tail[-1]["level"] + 1, tail[-1]["last"])]
            dropped += [f["name"] for f in tail]
        fresh = rows.select(*self.schema.fieldNames()).withColumn(BATCH, F.lit(batch_id).cast("long"))
        live = [*live, self._write(fresh, 0, batch_id)]
        self.manifest.commit(version, {"live": live, "gone": dropped})
        # What the version before this one has replaced: its readers have had a whole batch's time.
        for name in gone:
            remove_path(self.spark, f"{self.path}/{PART}={name}")
        self.manifest.forget(version)

    def read(self, dates: tuple[date | None, date | None] = (None, None), where: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """One row for each key. ``dates`` opens only the folders from one date up to another, both
        included; ``where`` may cut the rows down before they are merged."""
        rows = self._rows(self.folders())
        for bound, compare in zip(dates, ("__ge__", "__le__"), strict=True):
            if bound is not None and DATE in rows.columns:
                rows = rows.where(getattr(F.col(DATE), compare)(F.lit(bound)))
        return self.merge(where(rows)).select(*self.schema.fieldNames())


def stored(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/_manifest")
