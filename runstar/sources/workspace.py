"""Folders for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="runstar-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def control_table(spark: SparkSession, rows: Iterable[Sequence], schema: str | T.StructType) -> DataFrame:
    """A few rows known to the driver (runs, tables, events) as a local relation, without Python workers."""
    typed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = typed.names
    values = [dict(zip(names, map(_aware, r), strict=True)) for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(values, schema=to_arrow_schema(typed)), typed)


def _aware(value: object) -> object:
    """Collected timestamps are local time without a zone; Arrow wants the zone."""
    return value.astimezone(UTC) if isinstance(value, datetime) else value


#: Spark's name for the tasks that an exchange begins with; adaptive execution joins those that got little.
EXCHANGE_TASKS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Rows that an exchange should bring to a task at most: nested and sorted they fit a task's memory, more of them spill.
ROWS_PER_TASK = 1_250_000


def exchange_tasks(spark: SparkSession) -> int:
    """The tasks that an exchange begins with."""
    return int(spark.conf.get(EXCHANGE_TASKS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def size_exchanges(spark: SparkSession, rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """Let exchanges begin with enough tasks for ``rows``: with a fixed number the rows of a task grow with the input, and so
    do the times that a row is spilled and read again. The number only rises, and stays in the session."""
    tasks = max(exchange_tasks(spark), -(-rows // rows_per_task))
    if tasks > exchange_tasks(spark):
        spark.conf.set(EXCHANGE_TASKS, str(tasks))
    return tasks


#: Spark's name for removing the files of an exchange when the query that made them ends, not when the driver's memory fills up.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The codec of written tables: what is written is read a few times at most, and takes up disk until the end of the job.
CODEC = "zstd"


def free_exchanges(spark: SparkSession) -> None:
    """Let exchanges go with their query: tables are read back from what was written, so none is read again. The setting stays in
    the session; a session that sets its own keeps it."""
    if CLEANUP not in spark.conf.getAll:  # which has what was set, not what Spark would take otherwise
        spark.conf.set(CLEANUP, "true")


class Workspace:
    """Written tables of one job. Reading them back cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        free_exchanges(spark)
        self.spark = spark
        self.root = root or f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, name: str, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` and return it as read back. A file holds rows of one value of ``by``, numbers without null, so that a
        reader of one value reads its rows only."""
        df.write.mode("errorifexists").option("compression", CODEC).partitionBy(*by).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(*df.columns)
