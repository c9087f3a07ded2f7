from __future__ import annotations

import numpy as np
import pytest

from runstar.llm import neighbours
from tests.conftest import SF_DIR

SCHEMA = "vec_id long, embedding array<float>, label int, id string, shard int"


def _brute(ids, vectors, own, query, wanted):
    score = {}
    for i, v in zip(ids, vectors, strict=True):
        if i != own:
            a, b = np.array(v, np.float32).astype(float), np.array(query, np.float32).astype(float)
            score[i] = float(a @ b / np.sqrt((a @ a) * (b @ b)))
    return sorted(score.items(), key=lambda x: (-x[1], x[0]))[:wanted]


@pytest.mark.parametrize("shard", [8192, 100])
def test_recall_against_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD", shard)
    rows = [r for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in zip(ids, vectors, strict=True)], SCHEMA)
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for i, v in zip(ids, vectors, strict=True):
        if i % 20 == 0:
            want, found = _brute(ids, vectors, i, v, 5), sorted(got[i])
            assert [k for k, _, _ in found] == [1, 2, 3, 4, 5]
            assert [(x, s) for _, x, s in found] == sorted(((x, s) for _, x, s in found), key=lambda y: (-y[1], y[0]))
            hits, total = hits + len({x for x, _ in want} & {x for _, x, _ in found}), total + 5
            exact = dict(_brute(ids, vectors, i, v, len(ids)))
            assert all(abs(exact[x] - s) < 1e-12 for _, x, s in found)
    assert hits / total >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.0]), (5, None), (6, []), (7, [0.0, 0.0]),
            (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (None, [1.0, 0.0]), (12, [1.0, 0.0, 0.0]), (13, [3e38, 3e38]), (14, [1e-40, 0.0])]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in neighbours.nearest(df, df.where("vec_id in (0, 5, 7, 12)"), 5).collect()]
    assert sorted(got) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 14, 1.0), (0, 4, 13, 0.707107), (0, 5, 3, 0.0)]
    few = neighbours.nearest(df.where("vec_id in (0, 3, 4)"), df.where("vec_id = 0"), 5).collect()
    assert [(r["rank"], r.vec_id) for r in few] == [(1, 3), (2, 4)]


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0, "x", 1)] * 2 + [(1, [1.0, 1.0], 0, "x", 1)] * 2, SCHEMA)
    got = [(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(df, df.where("vec_id = 0"), 5).collect()]
    assert got == [(0, 1, 1), (0, 2, 1)]
    # a repeated query hides none of its neighbours
    rows = [(0, [1.0, 0.0])] * 2 + [(i, [1.0, i / 10]) for i in range(1, 9)]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    got = [(r["rank"], r.vec_id) for r in neighbours.nearest(df, df.where("vec_id = 0"), 5).orderBy("rank").collect()]
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    # one id, two vectors: two queries
    both = df.where("vec_id = 8").withColumn("vec_id", neighbours.F.lit(0).cast("long")).unionByName(df)
    got = sorted((r["rank"], r.vec_id) for r in neighbours.nearest(df, both.where("vec_id = 0"), 2).collect())
    assert got == [(1, 1), (1, 8), (2, 2), (2, 7)]
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0


def test_recall_on_one_dense_cluster_over_many_shards(spark, monkeypatch):
    """All vectors within a narrow cone, at nearly the same distance from each other."""
    monkeypatch.setattr(neighbours, "SHARD", 300)
    rng = np.random.default_rng(3)
    vectors = (np.ones(32) + 0.15 * rng.standard_normal((3000, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0, "x", 1) for i, v in enumerate(vectors)], SCHEMA)
    got = {}
    for r in neighbours.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 3000, 50):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(got[q] & set(np.argsort(-near)[:5].tolist()))
    assert hits / 300 >= 0.9
