"""Staging and CSV sinks, and a preview of one kind."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from runstar.sources.workspace import CODEC

#: Adds to rows on their way into a table what is to be observed of them.
Watch = Callable[[DataFrame], DataFrame]
#: Files that a writing task may hold open: each has buffers of its own.
RUNS_AT_A_TIME = 3
#: Rows of a file that is worth opening.
ROWS_OF_A_FILE = 10_000


def without_arrays(df: DataFrame) -> DataFrame:
    """The encoded columns only."""
    return df.select(*[f"`{n}`" for n, t in df.dtypes if not t.startswith(("array", "struct", "map"))])


def write_csv(kinds: Mapping[str, DataFrame], folder: str, compression: str = "gzip") -> None:
    """One CSV folder with header per kind.

    Files are compressed: the texts of a record come again in each of its rows, and a file whose texts may hold line breaks
    is read by one task anyway.
    """
    for name, df in kinds.items():
        (without_arrays(df).write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("compression", compression).csv(f"{folder.rstrip('/')}/{name}"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_csv`` wrote of one kind. Texts may hold line breaks; an empty text is quoted, null is nothing at all."""
    reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.option("nullValue", "\0").csv(path)


def preview(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The chosen columns of a kind, or all of them; ``.dtypes`` of the result tells their types."""
    return df.select(*columns) if columns else df


def write_by_run(df: DataFrame, path: str, partitions: Sequence[str], watch: Watch | None = None, dealt: bool = False) -> None:
    """Append a table partitioned by run.

    Every task writes one file per run it holds, so rows are first brought together by run, in pieces that Spark sizes
    (it also splits the run that holds most rows): files stay few and large, whatever the number of runs. Rows read from files
    that hold one run each are ``dealt`` by run already and stay where they are; so may those of ``few_large`` files. ``watch`` sees them after that, in the tasks that
    write, whose figures count once even if a task runs again.
    """
    rows = df if dealt else df.hint("rebalance", *partitions)
    open_several(df.sparkSession)
    (watch(rows) if watch else rows).write.mode("append").option("compression", CODEC).partitionBy(*partitions).parquet(path)


def few_large(rows: int, runs: int, tasks: int) -> bool:
    """Whether tasks that hold equal parts of all runs can write them side by side, into files that are worth opening."""
    return runs <= RUNS_AT_A_TIME and rows >= ROWS_OF_A_FILE * runs * tasks


def open_several(spark: SparkSession) -> None:
    """Let a task that holds few runs write them side by side: sorting by run would only spill its rows. From the next run on
    Spark sorts as ever. A session that sets another number keeps it."""
    if spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0":
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(RUNS_AT_A_TIME))
