"""Versioned Parquet tables.

A table is a folder with data segments and a log of versions.  A version is a
JSON file that lists the segments it consists of, created only if absent, so
two writers can't both make version n and readers never see half a write.  An
append adds one segment, whatever the table's size; a replacement lists new
segments alone.  The log keeps the ranges of each segment's whole-number
columns, so a merge by log coordinates looks only into segments that its
offsets can be in; a merge by other keys reads the key columns alone.  Where
segments become many, the smaller half of them is written as one, so a row is
rewritten a logarithmic number of times and a version's list stays short.
Paths go through Hadoop's file system, as Spark's do.
"""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import StoreError
from ..operators import merge


class Files:
    """The few file-system calls that the store and the batch sources need."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def fs(self, path: str):
        return self.path(path).getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        return self.fs(path).exists(self.path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs(path).listStatus(self.path(path))) if self.exists(path) else []

    def sizes(self, path: str) -> list[int]:
        return [s.getLen() for s in self.fs(path).listStatus(self.path(path)) if s.isFile() and not s.getPath().getName().startswith(("_", "."))]

    def read(self, path: str) -> str:
        stream = self.fs(path).open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put_if_absent(self, path: str, text: str) -> None:
        """Makes the file whole or not at all; StoreError if it exists."""
        if self.exists(path):
            raise StoreError(f"{path} exists")
        part = f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}.tmp"
        stream = self.fs(part).create(self.path(part), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(path).toUri(), self.conf)
        none = SparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.path(part), self.path(path), none)  # fails if another writer was first
        except Exception as e:
            self.delete(part)
            raise StoreError(f"another writer made {path}") from e

    def delete(self, path: str) -> None:
        self.fs(path).delete(self.path(path), True)


#: Segments beyond which the smaller half is written as one; bytes of a file that is written so, about.
MOST_SEGMENTS, FILE_BYTES = 64, 128 << 20


class Table:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: T.StructType):
        if not name.isidentifier():
            raise StoreError(f"{name!r} is no table name")
        self.spark, self.name, self.schema = spark, name, schema
        self.home = f"{root.rstrip('/')}/{name}"
        self.files = Files(spark)

    def _versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(f"{self.home}/_log") if n.endswith(".json") and not n.startswith("_")]

    @property
    def version(self) -> int:
        """The current version; 0 before the first write."""
        return max(self._versions(), default=0)

    def _state(self, version: int) -> dict:
        """{"segments": names in order, "ranges": {segment: {column: [least, greatest]}}}"""
        return json.loads(self.files.read(self._entry(version))) if version else {"segments": [], "ranges": {}}

    def _segments(self, version: int) -> list[str]:
        return self._state(version)["segments"]

    def _entry(self, version: int) -> str:
        return f"{self.home}/_log/{version:020d}.json"

    def read(self, version: int | None = None) -> DataFrame:
        """The table now, or as it was in an earlier version."""
        return self._read(self._segments(self.version if version is None else version))

    def _read(self, segments: list[str]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.home}/{s}" for s in segments])

    def _ranges(self, rows: DataFrame) -> dict[str, list[int]]:
        """Least and greatest value of each whole-number column; Parquet's own statistics answer it."""
        columns = [f.name for f in self.schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType)) and f.name in rows.columns]
        if not columns:
            return {}
        found = rows.agg(*[F.struct(F.min(c).alias("a"), F.max(c).alias("b")).alias(c) for c in columns]).first()
        return {c: [found[c]["a"], found[c]["b"]] for c in columns if found[c]["a"] is not None}

    def _overlapping(self, state: dict, incoming: DataFrame, key: list[str]) -> list[str]:
        """Segments that may hold a key of ``incoming``."""
        own = self._ranges(incoming.select(*key)) if any(state["ranges"].values()) else {}

        def may(segment: str) -> bool:
            there = state["ranges"].get(segment, {})
            return all(there[c][0] <= own[c][1] and own[c][0] <= there[c][1] for c in own.keys() & there.keys())

        return [s for s in state["segments"] if may(s)]

    def _publish(self, rows: DataFrame, operation: str, keep: list[str], base: int) -> int:
        segment = f"data/{uuid.uuid4().hex}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).write.parquet(f"{self.home}/{segment}")
        known = self._state(base)["ranges"] if keep else {}
        ranges = {s: known[s] for s in keep if s in known} | {segment: self._ranges(self._read([segment]))}
        entry = {"version": base + 1, "timestamp": datetime.now(UTC).isoformat(), "operation": operation, "segments": [*keep, segment], "ranges": ranges}
        try:
            self.files.put_if_absent(self._entry(base + 1), json.dumps(entry))
        except StoreError:
            self.files.delete(f"{self.home}/{segment}")
            raise
        return base + 1

    def append(self, rows: DataFrame) -> int:
        base = self.version
        return self._tidy(self._publish(rows, "append", self._segments(base), base))

    def replace(self, rows: DataFrame, operation: str = "replace") -> int:
        """Makes ``rows`` the whole table; they may derive from the table itself."""
        return self._publish(rows, operation, [], self.version)

    def insert_new(self, incoming: DataFrame, key: list[str]) -> int:
        """Insert-only merge: appends the rows whose key the table hasn't; no version if there are none.

        The incoming rows are written aside first: what they derive from is
        computed once, however often the merge looks at them.
        """
        base = self.version
        state = self._state(base)
        aside = f"{self.home}/_aside/{uuid.uuid4().hex}"
        try:
            incoming.write.parquet(aside)
            incoming = self.spark.read.schema(incoming.schema).parquet(aside)
            there = self._read(self._overlapping(state, incoming, key))
            new = merge.new_rows(there, merge.require_unique(incoming, key), key)
            if new.isEmpty():
                return base
            return self._tidy(self._publish(new, "merge", state["segments"], base))
        finally:
            self.files.delete(aside)

    def _tidy(self, version: int) -> int:
        """Writes the smaller half of the segments as one if there are too many; another writer's version goes first."""
        segments = self._segments(version)
        if len(segments) <= MOST_SEGMENTS:
            return version
        size = {s: sum(self.files.sizes(f"{self.home}/{s}")) for s in segments}
        small = set(sorted(segments, key=lambda s: (size[s], s))[: len(segments) // 2])
        rows = self._read([s for s in segments if s in small]).coalesce(max(1, -(-sum(size[s] for s in small) // FILE_BYTES)))
        try:
            return self._publish(rows, "compact", [s for s in segments if s not in small], version)
        except StoreError:
            return version

    def compact(self, files: int = 1) -> int:
        return self.replace(self.read().coalesce(files), "compact")

    def history(self) -> DataFrame:
        """(version, timestamp, operation, segments), the latest first."""
        kind = "version long, timestamp string, operation string, segments array<string>"
        if not self.version:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).json(f"{self.home}/_log/*.json").orderBy(F.desc("version"))

    def detail(self) -> DataFrame:
        """One row: name, location, version, number of files, their bytes."""
        sizes = [n for s in self._segments(self.version) for n in self.files.sizes(f"{self.home}/{s}")]
        row = (self.name, self.home, self.version, len(sizes), sum(sizes))
        return self.spark.createDataFrame([row], "name string, location string, version long, num_files long, size_bytes long")


class Store:
    """A folder of tables with known schemas; tables exist once they are first used."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None):
        from ..schemas import TABLES

        self.spark, self.root = spark, root
        self.schemas = TABLES if schemas is None else schemas

    def __getitem__(self, name: str) -> Table:
        if name not in self.schemas:
            raise StoreError(f"unknown table {name!r}")
        return Table(self.spark, self.root, name, self.schemas[name])

    def drop(self, name: str) -> None:
        """Removes a table if it exists."""
        table = self[name]
        if table.files.exists(table.home):
            table.files.delete(table.home)
