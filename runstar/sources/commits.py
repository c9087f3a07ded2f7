"""A log of numbered commits on shared storage: one small file each, created by exactly one writer.

A commit takes the number after the last one that its writer has read. Its file is created exclusively; who comes second reads what
was committed and tries again. There is nothing else to it: no locks, no compaction, and control data only.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = ("action: string, table_name: string, run_id: bigint, agency: string, version: string, load_id: bigint, "
                "last_ids: map<string, bigint>, row_counts: map<string, bigint>")
COMMIT_SCHEMA = f"commit_no bigint, at string, events array<struct<{EVENT_SCHEMA}>>"
#: Seconds that a file may take from its creation to its last byte; one that takes longer was left by a writer that died.
PATIENCE = 10.0


class Storage:
    """The few file operations that go beside Spark's readers and writers."""

    def __init__(self, spark: SparkSession, folder: str):
        self._context = spark.sparkContext
        self.folder = folder
        self._fs = self._path("").getFileSystem(self._context._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def exists(self) -> bool:
        return self._fs.exists(self._path(""))

    def make(self) -> None:
        self._fs.mkdirs(self._path(""))

    def read(self, name: str) -> bytes | None:
        """The bytes of a file; None if there is none."""
        if not self._fs.exists(self._path(name)):
            return None
        stream = self._fs.open(self._path(name))
        try:
            return bytes(self._context._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, name: str, data: bytes, overwrite: bool = False) -> None:
        stream = self._fs.create(self._path(name), overwrite)
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()

    def create(self, name: str, data: bytes) -> bool:
        """Write a file that must not exist yet; False if it does. Of several callers one succeeds."""
        self.make()
        if self._fs.getUri().getScheme() == "file":
            # a local file system only looks first whether the file exists; creating it by itself decides
            path = self._fs.makeQualified(self._path(name)).toUri().getPath()
            if not self._context._jvm.java.io.File(path).createNewFile():
                return False
            self.write(name, data, overwrite=True)
            return True
        try:
            self.write(name, data)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception.toString()):
                return False
            raise
        return True

    def put(self, name: str, data: bytes) -> None:
        """Write a file that readers of the folder see whole or not at all."""
        self.make()
        self.write(f"_{name}", data)  # names with an underscore are hidden from Spark
        self._fs.rename(self._path(f"_{name}"), self._path(name))


class CommitLog:
    """Reads new commits and appends one."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._storage = Storage(spark, folder)
        #: The last commit that was read.
        self.number = 0

    @staticmethod
    def _name(number: int) -> str:
        return f"commit-{number:012d}.json"

    def table(self) -> DataFrame:
        """All events as a table."""
        if self._storage.read(self._name(1)) is None:
            rows = self.spark.createDataFrame([], T.StructType.fromDDL(COMMIT_SCHEMA))
        else:
            rows = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.folder}/commit-*.json")
        return rows.select("commit_no", F.col("at").cast("timestamp").alias("at"), F.inline("events"))

    def news(self) -> list[dict]:
        """The commits since the last call, in order: number, time, events."""
        out: list[dict] = []
        if not self.number and self._storage.read(self._name(1)) is not None:
            # the first look reads the whole log in one job
            rows = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.folder}/commit-*.json").where("commit_no is not null")
            found = {r["commit_no"]: r.asDict(recursive=True) for r in rows.collect()}  # control data
            while self.number + 1 in found:
                self.number += 1
                out.append(found[self.number])
        while (commit := self._read(self.number + 1)) is not None:
            self.number += 1
            out.append(commit)
        return [c | {"at": datetime.fromisoformat(c["at"])} for c in out if c["events"]]

    def _read(self, number: int) -> dict | None:
        """A commit; None if it isn't there, one without events if its writer died over it."""
        end = time.monotonic() + PATIENCE
        while (data := self._storage.read(self._name(number))) is not None:
            try:
                return json.loads(data)
            except ValueError:  # not written to its end
                if time.monotonic() > end:
                    return {"commit_no": number, "at": None, "events": []}
                time.sleep(0.05)
        return None

    def append(self, make: Callable[[], list[dict]], learn: Callable[[], None]) -> list[dict]:
        """Commit what ``make`` gives after ``learn`` has read the log; both again as often as another writer is first."""
        while True:
            learn()
            events = make()
            if not events:
                return events
            number = self.number + 1
            commit = {"commit_no": number, "at": datetime.now(UTC).isoformat(), "events": events}
            if self._storage.create(self._name(number), json.dumps(commit).encode()):
                learn()
                return events
