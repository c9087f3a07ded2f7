"""Approximate nearest neighbours by collision counting over single projections.

Unit vectors of a shard are projected on ``PROJECTIONS`` random directions; each projection is a sorted array. A query opens a
window around its own value in every array and widens all windows by a factor (virtual rehashing). A vector that
lies in at least ``THRESHOLD`` of the windows is verified: its cosine is computed in double precision on the original
components. The search of a shard ends when as many verified vectors as wanted are within ``FACTOR`` times the radius that the
windows stand for, however many had to be verified; windows that span all arrays end it too. The best of all shards are kept.

Shards and blocks of queries have bounded size; every pair of both is one group of rows in one task, which builds the shard's
index once and lets the block's queries pass it, some at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runstar.llm.workers import ship

#: Vectors of a shard, queries of a block, and queries that pass an index together.
SHARD, BLOCK, TOGETHER = 8192, 8192, 1024
PROJECTIONS, THRESHOLD, WIDTH, FACTOR = 96, 0.65, 2.7, 1.4
#: The smallest radius, a distance of unit vectors.
RADIUS = 0.2


def usable(vector: str) -> Column:
    """Whether a vector has components, all of them finite, and not all zero; never null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class Index:
    """Sorted projections of a shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 5):
        self.ids, self.vectors = ids, _unit(vectors)
        self.directions = np.random.default_rng(seed).standard_normal((vectors.shape[1], PROJECTIONS))
        values = (self.vectors @ self.directions).T
        self.order = np.argsort(values, axis=1).astype(np.int32)
        self.values = np.take_along_axis(values, self.order, axis=1)

    def search(self, own: np.ndarray, queries: np.ndarray, wanted: int) -> list[list[tuple[int, float]]]:
        """For each query (id, cosine) of the nearest found, nearest first, ties to the smaller id.

        Rows with a query's own id don't count. All queries widen their windows together, until each has ended.
        """
        n, queries = len(self.ids), _unit(queries)
        centres = queries @ self.directions
        collisions = np.zeros((len(own), n), np.int16)
        seen = self.ids[None, :] == own[:, None]
        low = np.array([np.searchsorted(v, c) for v, c in zip(self.values, centres.T, strict=True)])
        high = low
        found = [np.zeros(0, np.int64)] * len(own)
        near = [np.zeros(0)] * len(own)
        need, radius, active = int(np.ceil(THRESHOLD * PROJECTIONS)), RADIUS, list(range(len(own)))
        while active:
            half = WIDTH * radius / 2
            lower, upper = low.copy(), high.copy()
            for k, v in enumerate(self.values):
                lower[k, active] = np.searchsorted(v, centres[active, k] - half)
                upper[k, active] = np.searchsorted(v, centres[active, k] + half, "right")
            still = []
            for q in active:
                # only what the windows gain
                gained = [o[a:b] for o, a, b in zip(self.order, lower[:, q].tolist(), low[:, q].tolist(), strict=True)]
                gained += [o[a:b] for o, a, b in zip(self.order, high[:, q].tolist(), upper[:, q].tolist(), strict=True)]
                collisions[q] += np.bincount(np.concatenate(gained), minlength=n).astype(np.int16)
                fresh = np.flatnonzero((collisions[q] >= need) & ~seen[q])
                seen[q, fresh] = True
                found[q] = np.concatenate((found[q], fresh))
                near[q] = np.concatenate((near[q], self.vectors[fresh] @ queries[q]))
                within = int((near[q] >= 1 - (FACTOR * radius) ** 2 / 2).sum())
                whole = bool((lower[:, q] == 0).all() and (upper[:, q] == n).all())
                if within < wanted and not whole:
                    still.append(q)
            low, high, active, radius = lower, upper, still, radius * FACTOR
        best = [np.lexsort((self.ids[f], -c))[:wanted] for f, c in zip(found, near, strict=True)]
        return [[(int(self.ids[f[i]]), float(c[i])) for i in b] for f, c, b in zip(found, near, best, strict=True)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _group(wanted: int):
    def run(shard: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, float]] = []
        if shard.num_rows and queries.num_rows:
            index = Index(shard["id"].to_numpy(), _matrix(shard["vector"]))
            for low in range(0, queries.num_rows, TOGETHER):
                some = queries.slice(low, TOGETHER)
                own, asker = some["id"].to_numpy(), some["asker"].to_pylist()
                found = index.search(own, _matrix(some["vector"]), wanted)
                out += [(a, q, k, x) for a, q, best in zip(asker, own.tolist(), found, strict=True) for k, x in best]
        columns = list(zip(*out, strict=True)) or [()] * 4
        return pa.table({"asker": pa.array(columns[0], pa.int64()), "query_id": pa.array(columns[1], pa.int64()),
                         "vec_id": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.float64())})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, wanted: int = 5, key: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``wanted`` vectors of largest cosine found for each query, nearest first.

    Vectors that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without an id. Rows with a
    query's own id are not its neighbours; of other repeated rows each is one. A query that is repeated is answered once; one id with
    several vectors is as many queries, ranked each. Only vectors of the same length are
    compared. A query with fewer candidates gets all of them; without any, no row.
    """
    ship(vectors.sparkSession)
    def clean(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
        return rows.where(usable("vector") & F.col("id").isNotNull()).withColumn("length", F.size("vector"))

    held, asked = clean(vectors), clean(queries).dropDuplicates(["id", "vector"]).withColumn("asker", F.xxhash64("vector"))
    shards = -(-held.count() // SHARD) or 1
    blocks = -(-asked.count() // BLOCK) or 1
    left = held.select("*", F.pmod(F.xxhash64("vector", "id"), F.lit(shards)).alias("shard"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = asked.select("*", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("block"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    pair = ["length", "shard", "block"]
    found = left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(
        _group(wanted), "asker long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id", "asker").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)
            .select("query_id", "rank", "vec_id", "score"))
