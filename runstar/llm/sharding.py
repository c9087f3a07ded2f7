"""A uniform shuffle into shards of exact size: communication matrix, permute, exchange, permute again.

The rows are first written with the input partition that held them and their place in it. For each partition the
numbers of rows that go to each shard are drawn from the multivariate hypergeometric law that a uniform shuffle of all
rows would give (the communication matrix); its row and column sums are the partition sizes and the shard sizes, which
differ by one at most. Rows are permuted in their partition, the first go to shard 0, the next to shard 1 and so on, and
each shard is permuted again.

Both permutations order rows by a seeded hash of (partition, place). The leading bits of the hash cut a partition or
shard into slices, each numbered on its own and shifted by the sizes of the slices before it, so no task sorts a whole
shard. Everything on rows is a DataFrame expression; the driver handles one count for each partition and shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runstar.sources.workspace import Workspace, control_table

#: Rows of one slice of a permutation, on average.
SLICE = 100_000


def _hypergeometric(random: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` rows are good, exactly at any size: inversion over all values with a mass above 1e-30."""
    low, high, n = max(0, draws - bad), min(good, draws), good + bad
    mean = draws * good / n
    spread = 12 * (mean * (bad / n) * ((n - draws) / max(n - 1, 1))) ** 0.5 + 60
    x = np.arange(max(low, int(mean - spread)), min(high, int(mean + spread)) + 1, dtype=np.float64)
    step = np.log((good - x[:-1]) * (draws - x[:-1])) - np.log((x[:-1] + 1) * (bad - draws + x[:-1] + 1))
    log = np.concatenate(([0.0], np.cumsum(step)))
    mass = np.cumsum(np.exp(log - log.max()))
    return int(x[min(np.searchsorted(mass, random.random() * mass[-1], "right"), len(x) - 1)])


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows from each partition (first axis) to each shard, as a uniform shuffle of all rows would deal them."""
    total = sum(sizes)
    left = np.array([total // shards + (s < total % shards) for s in range(shards)], np.int64)
    random, out = np.random.default_rng(seed), np.zeros((len(sizes), shards), np.int64)
    for p, n in enumerate(sizes):
        rest, want = int(left.sum()), n
        for s in range(shards):  # one hypergeometric draw for each entry, given the entries before it
            rest -= int(left[s])
            out[p, s] = _hypergeometric(random, int(left[s]), rest, want) if left[s] and want else 0
            want -= int(out[p, s])
        left -= out[p]
    return out


def _permuted(rows: DataFrame, group: str, place: str, slices: int, key: Column) -> DataFrame:
    """Add ``place``: the position from 0 of each row in a pseudo-random order of its group."""
    rows = rows.withColumn("__hash", key).withColumn("__slice", F.pmod("__hash", F.lit(slices)))
    sizes = rows.groupBy(group, "__slice").count()
    before = sizes.select(group, "__slice", (F.sum("count").over(Window.partitionBy(group).orderBy("__slice")) - F.col(
        "count")).alias("__before"))
    number = F.row_number().over(Window.partitionBy(group, "__slice").orderBy("__hash", "__part", "__at"))
    return (rows.withColumn("__number", number).join(before, [group, "__slice"])
            .withColumn(place, F.col("__before") + F.col("__number") - 1)
            .drop("__hash", "__slice", "__before", "__number"))


def shuffle_into_shards(rows: DataFrame, shards: int = 24, seed: int = 17, work: Workspace | None = None) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (its place there, gapless from 0).

    Shard sizes differ by one row at most, whatever the rows hold: nulls, repeated rows and empty texts are rows like any
    other. An empty input gives an empty result. Columns named ``shard`` or ``slot`` are replaced; names that begin with ``__`` are
    taken. The result is uniform over orders of rows, not of groups: equal rows go their own ways.
    """
    spark = rows.sparkSession
    work = work or Workspace(spark)
    held = work.keep("shard-input", rows.drop("shard", "slot").withColumn("__part", F.spark_partition_id()).withColumn(
        "__at", F.monotonically_increasing_id()))
    sizes = held.groupBy("__part").count().orderBy("__part").collect()  # a count for each input partition
    total = sum(r["count"] for r in sizes)
    matrix = communication_matrix([r["count"] for r in sizes], shards, seed)
    upto = matrix.cumsum(axis=1)
    # the first place of a partition that goes to a shard, and the next shard's
    ranges = control_table(spark, [(r["__part"], s, int(upto[p, s] - matrix[p, s]), int(upto[p, s]))
                                   for p, r in enumerate(sizes) for s in range(shards) if matrix[p, s]],
                           "__part int, shard int, __low long, __high long")
    largest = max((r["count"] for r in sizes), default=0)
    local = _permuted(held, "__part", "__local", largest // SLICE + 1, F.xxhash64(F.lit(seed), "__part", "__at"))
    dealt = local.join(ranges, (local["__part"] == ranges["__part"]) & (F.col("__local") >= F.col("__low"))
                       & (F.col("__local") < F.col("__high"))).drop(ranges["__part"]).drop("__local", "__low", "__high")
    slices = max(total // shards // SLICE + 1, min(64, total // shards // 64 + 1))
    out = _permuted(dealt, "shard", "slot", slices, F.xxhash64(F.lit(seed + 1), "__part", "__at"))
    return out.drop("__part", "__at")
