from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from runstar.llm import queries, sharding
from tests.llm.conftest import ODD, prose


def test_query(spark, table, tmp_path):
    rows = [*ODD, *((100 + i, prose(i, i)) for i in range(300)), (900, "long " * 100_000)] + [(50, "same")] * 200
    table(rows).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op6_shards(spark, str(tmp_path)).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and {(r.law, r.grown_shard) for r in got} == {("rows", None)}


@pytest.mark.parametrize("n", [0, 1, 23, 24])
def test_few_rows_and_extra_columns(table, n):
    out = sharding.shuffle_into_shards(table((i, str(i)) for i in range(n)), 24)
    assert out.count() == n and {"count", "row", "key", "shard", "slot"} <= set(out.columns)


def test_matrix_has_the_law_of_a_uniform_shuffle():
    draws = np.array([sharding.communication_matrix([30, 50, 40], 3, s) for s in range(3000)])
    assert (draws.sum(axis=2) == [30, 50, 40]).all() and (draws.sum(axis=1) == 40).all()
    assert np.allclose(draws.mean(axis=0), np.outer([30, 50, 40], [1 / 3] * 3), atol=0.15)
    variance = 30 * (1 / 3) * (2 / 3) * (90 / 119)
    assert abs(draws[:, 0, 0].var() - variance) < 0.1 * variance


def test_draws_of_any_size():
    rng = np.random.default_rng(1)
    assert sharding._hypergeometric(rng, 5, 0, 3) == 3
    assert abs(sharding._hypergeometric(rng, 10**12, 10**13, 10**10) - 10**10 / 11) < 1e6


def test_orders_are_spread(table):
    got = sharding.shuffle_into_shards(table((i, "x") for i in range(2400)), 24).collect()
    low = [r.slot for r in got if r.doc_id < 1200]
    assert 45 < np.mean(low) < 54
    assert 800 < sum(r.doc_id < 1200 for r in got if r.shard % 2) < 1000 or 500 < sum(r.doc_id < 1200 for r in got if r.shard % 2) < 700
