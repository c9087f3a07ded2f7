"""Surrogate keys, dimensions and canonical rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runstar.sources.workspace import exchange_tasks

# Copies of one row that a single task writes out: every group of copies is cut into ranges of that many ids.
COPIES_PER_CHUNK = 100_000


def dense_id(rows: DataFrame, id_col: str = "id", start: int = 0, copies: str | None = None,
             copies_per_chunk: int | None = COPIES_PER_CHUNK) -> DataFrame:
    """Number distinct rows ``start + 1, start + 2, ...`` without a global sort.

    Rows fall into buckets by the hash of all their columns, so a bucket cannot be hot. Each bucket is numbered
    on its own and shifted by the rows in the buckets before it. The order inside a bucket is total, so a task
    that runs again gives the same ids. ``copies`` names a column that says how often a row stands for itself:
    the row comes out that many times, each with its own id, and the column is dropped. Many copies are dealt out in chunks; with
    ``copies_per_chunk=None``, for rows that have few, they come out where their row is.
    """
    cols = [c for c in rows.columns if c != copies]
    tasks = exchange_tasks(rows.sparkSession)
    weight = F.col(copies) if copies else F.lit(1).cast("bigint")
    # Rows are dealt by bucket once; the sizes and the numbering both read that exchange, so what is below runs once. Only the
    # rows travel: hash and bucket, which no codec makes smaller, are computed again where they arrive.
    # The bucket is never null, and declared so: else Spark filters nulls on one side only and computes the rows twice.
    hashed = F.xxhash64(*cols)
    bucket = F.coalesce(F.pmod(hashed, F.lit(32 * tasks)), F.lit(0).cast("bigint"))
    dealt = (rows.select(*cols, *([copies] if copies else [])).repartition(tasks, bucket)
                 .select(*cols, weight.alias("_n"), hashed.alias("_hash"), bucket.alias("_bucket")))

    # At most 32 rows a task: the only window without a partition, and a broadcast of known size. The sizes read a hash of
    # all columns, or else Spark would drop the columns for them and deal the rows out a second time.
    sizes = dealt.groupBy("_bucket").agg(F.sum("_n").alias("_size"), F.bit_xor(F.xxhash64("_hash", *cols)).alias("_all"))
    before = F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")
    offsets = sizes.select("_bucket", before.alias("_offset"), "_all").where(F.col("_all").isNotNull())
    offsets = F.broadcast(offsets.drop("_all"))

    order = Window.partitionBy("_bucket").orderBy("_hash", *cols)
    last = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)) if copies else F.row_number().over(order)
    numbered = dealt.withColumn("_last", last).join(offsets, "_bucket")
    last_id = (F.col("_offset") + F.col("_last") + F.lit(start)).cast("bigint")
    if not copies:
        return numbered.select(last_id.alias(id_col), *cols)

    first_id = (last_id - F.col("_n") + 1).cast("bigint")
    if copies_per_chunk is None:
        return numbered.select(F.explode(F.sequence(first_id, last_id)).alias(id_col), *cols)
    ranges = F.sequence("_first", "_end", F.lit(copies_per_chunk).cast("bigint"))
    size = F.least(F.lit(copies_per_chunk).cast("bigint"), F.col("_end") - F.col("_from") + 1)
    # a range travels as its first id and its size, which is nearly always small
    ranged = (numbered.select(*cols, first_id.alias("_first"), last_id.alias("_end"))
                      .select(*cols, "_end", F.explode(ranges).alias("_from"))
                      .select(*cols, "_from", size.alias("_size"))
                      .repartition(tasks, "_from"))
    return ranged.select(F.explode(F.sequence("_from", F.col("_from") + F.col("_size") - 1)).alias(id_col), *cols)


#: A monotonically increasing id holds the place of a row in its task in so many bits.
_PLACE = (1 << 33) - 1


def dense_id_in_place(rows: DataFrame, id_col: str = "id", start: int = 0) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the tasks that hold them, without an exchange.

    The last exchange of ``rows`` must have been dealt to a given number of tasks, which adaptive execution neither joins nor
    splits (``bridge`` with ``within``). Rows of a task are sorted by all columns, and the place of a row is shifted by the
    rows of the tasks before; a task that runs again gives the same ids. What comes after that exchange runs twice, for sizes and for
    numbers. Should the two runs deal differently, some task has more rows than was counted: that is an error. Equal rows have ids
    of their own.
    """
    cols = rows.columns
    hashed = F.xxhash64(*cols)
    # The sizes read a hash of all columns, or else Spark would drop the columns for them and deal the rows out a second time.
    sizes = (rows.select(F.spark_partition_id().alias("_task"), hashed.alias("_hash")).groupBy("_task")
                 .agg(F.count(F.lit(1)).alias("_size"), F.bit_xor("_hash").alias("_all")))
    before = F.sum("_size").over(Window.orderBy("_task")) - F.col("_size")  # a row a task
    offsets = sizes.select("_task", "_size", before.alias("_offset"), "_all").where(F.col("_all").isNotNull()).drop("_all")
    placed = rows.sortWithinPartitions(hashed, *cols).select(
        *cols, F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("_place"))
    numbered = placed.join(F.broadcast(offsets), "_task", "left")
    number = (F.col("_offset") + F.col("_place") + F.lit(start + 1)).cast("bigint")
    counted = F.coalesce(F.col("_place") < F.col("_size"), F.lit(False))
    checked = F.when(counted, number).otherwise(F.raise_error(F.lit("rows were dealt differently when they were counted")))
    return numbered.select(checked.cast("bigint").alias(id_col), *cols)


def dimension(df: DataFrame, columns: dict[str, Column], with_null: bool = True) -> DataFrame:
    """Distinct combinations of ``columns``; null is a value of its own. Pre-aggregated before the shuffle."""
    rows = df.select(*[c.alias(n) for n, c in columns.items()])
    if not with_null:
        rows = rows.dropna(how="any")
    return rows.distinct()


def canonical_pick(df: DataFrame, key: Iterable[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order``; null keys form one group.

    The rank filter lets Spark cut every map task to one row per key before the shuffle, so a hot key does not
    travel whole. ``order`` should end in a tie-break that makes it total.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def collate(df: DataFrame, collation: str | None, columns: Iterable[str] | None = None) -> DataFrame:
    """Give text columns a collation, so that DISTINCT and joins on them follow it (``UTF8_LCASE`` ignores case)."""
    if not collation:
        return df
    chosen = set(columns) if columns is not None else {n for n, t in df.dtypes if t == "string"}
    return df.select(*[F.collate(c, collation).alias(c) if c in chosen else F.col(c) for c in df.columns])
