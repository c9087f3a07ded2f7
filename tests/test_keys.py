from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from checks.adapter import nest
from runstar.operators.joins import Lookup, bridge, lookup
from runstar.operators.keys import canonical_pick, collate, dense_id, dense_id_in_place, dimension
from runstar.sources.workspace import EXCHANGE_TASKS, exchange_tasks, size_exchanges


@pytest.mark.parametrize("start", [0, 500])
def test_dense_ids(spark, start):
    ids = sorted(r[0] for r in dense_id(spark.range(1000).withColumnRenamed("id", "k"), start=start).select("id").collect())
    assert ids == list(range(start + 1, start + 1001))


def test_ids_do_not_depend_on_input_order(spark):
    df = spark.range(300).select((F.col("id") % 100).alias("k"), F.concat(F.lit("x"), "id").alias("t"))
    first = {tuple(r) for r in dense_id(df).collect()}
    assert {tuple(r) for r in dense_id(df.orderBy(F.rand(3)).repartition(7)).collect()} == first


def test_ids_with_nulls(spark):
    df = spark.sql("select * from values (1, null), (null, 'a'), (null, null), (1, 'a') as t(a, b)")
    assert sorted(r["id"] for r in dense_id(df).collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("chunk", [2, 7, 1000])
def test_copies_get_their_own_ids(spark, chunk):
    df = spark.sql("select * from values ('a', 5L), ('b', 1L), ('hot', 40L) as t(k, n)")
    got = dense_id(df, copies="n", copies_per_chunk=chunk).collect()
    assert sorted(r["id"] for r in got) == list(range(1, 47))
    assert {k: sum(r["k"] == k for r in got) for k in ("a", "b", "hot")} == {"a": 5, "b": 1, "hot": 40}
    assert got[0].asDict().keys() == {"id", "k"}


def test_few_copies_come_out_where_their_row_is(spark):
    df = spark.sql("select * from values ('a', 5L), ('b', 1L), ('c', 4L) as t(k, n)")
    rows = dense_id(df, start=3, copies="n", copies_per_chunk=None)
    text = rows._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["id"], r["k"]) for r in rows.collect()) == sorted((r["id"], r["k"]) for r in dense_id(df, start=3, copies="n").collect())
    assert text.count("REPARTITION_BY_NUM") == 2  # one for the sizes


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_rows_are_numbered_in_their_tasks(spark, tasks):
    """Dense over uneven and empty tasks, with nulls and equal rows; the same again, whatever the order of the rows."""
    def rows(seed):
        df = spark.range(500).select((F.col("id") % 9 * (F.col("id") % 2)).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 50).alias("v"))
        return df.orderBy(F.rand(seed)).repartition(tasks, "k")

    numbered = dense_id_in_place(rows(1), start=7)
    first = sorted(map(str, (tuple(r) for r in numbered.collect())))
    assert sorted(r["id"] for r in numbered.collect()) == list(range(8, 508))
    assert sorted(map(str, (tuple(r) for r in dense_id_in_place(rows(2), start=7).collect()))) == first
    text = dense_id_in_place(bridge(rows(1), ["k", "v"], [], within=["k"]))._jdf.queryExecution().executedPlan().toString()
    assert text.count("REPARTITION_BY_NUM") == 2  # one for the sizes, which is the same
    assert dense_id_in_place(rows(1).where("k < 0")).count() == 0


def test_empty_input(spark):
    df = spark.range(0).withColumnRenamed("id", "k")
    assert dense_id(df).count() == 0
    assert dense_id(df.withColumn("n", F.lit(1)), copies="n").count() == 0


def test_dimension_keeps_one_null_row(spark):
    df = spark.sql("select * from values ('a'), ('a'), (null), (null) as t(x)")
    assert sorted(map(str, (r[0] for r in dimension(df, {"name": F.col("x")}).collect()))) == ["None", "a"]
    assert dimension(df, {"name": F.col("x")}, with_null=False).count() == 1


def test_canonical_pick_is_total_and_keeps_null_group(spark):
    df = spark.sql("select * from values (1, 'ab'), (1, 'abc'), (1, 'abd'), (null, 'z'), (null, null) as t(k, s)")
    got = {tuple(r) for r in canonical_pick(df, ["k"], [F.length("s").desc_nulls_last(), F.col("s").asc()]).collect()}
    assert got == {(1, "abc"), (None, "z")}


def test_canonical_pick_limits_before_the_shuffle(spark):
    df = canonical_pick(spark.range(100).withColumn("k", F.col("id") % 3), ["k"], [F.col("id").asc()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_left_lookup_keeps_null_keys(spark):
    left = spark.sql("select * from values (1, 'x'), (2, 'y'), (null, 'z') as t(k, v)")
    right = spark.sql("select * from values (10, 1), (20, null) as t(id, k)")
    got = {tuple(r) for r in lookup(left, Lookup(right, on={"k": "k"}, take={"id": "pid"}, how="left")).collect()}
    assert got == {(1, "x", 10), (2, "y", None), (None, "z", None)}


def test_left_lookup_spreads_null_keys(spark):
    """The spread is a key of the shuffled join, so one task does not get all rows without a key."""
    left = spark.range(1000).select(F.lit(None).cast("bigint").alias("k"), "id").unionByName(
        spark.range(5).select(F.col("id").alias("k"), "id"))
    right = spark.range(5).select(F.col("id").alias("pid"), F.when(F.col("id") > 0, F.col("id")).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = lookup(left, Lookup(right, on={"k": "k"}, take={"pid": "pid"}, how="left"))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 1005
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(k#" in plan and "_spread#" in plan.split("hashpartitioning(k#")[1].split(")")[0]


def test_null_safe_lookup_does_not_mix_null_and_sentinel(spark):
    left = spark.sql("select * from values (-1, 'm'), (null, 'm') as t(alias_id, mention)")
    right = spark.sql("select * from values (1, -1, 'm'), (2, null, 'm') as t(id, alias_id, mention)")
    got = {tuple(r) for r in bridge(left, ["alias_id", "mention"], [Lookup(
        right, on={"mention": "mention"}, null_safe={"alias_id": "alias_id"}, take={"id": "pid"})]).collect()}
    assert got == {(-1, "m", 1), (None, "m", 2)}


def test_bridge_counts_copies(spark):
    df = spark.sql("select * from values (1), (1), (2), (3) as t(k)")
    parent = spark.sql("select * from values (7, 1), (8, 2) as t(id, k)")
    got = {tuple(r) for r in bridge(df, ["k"], [Lookup(parent, on={"k": "k"}, take={"id": "pid"})], distinct=False).collect()}
    assert got == {(1, 2, 7), (2, 1, 8)}


def test_collation_merges_case(spark):
    df = spark.sql("select * from values ('Springer'), ('SPRINGER'), ('Elsewhere') as t(name)")
    assert dimension(df, {"name": F.col("name")}).count() == 3
    assert dimension(collate(df, "UTF8_LCASE"), {"name": F.col("name")}).count() == 2


def test_an_order_is_one_record_of_any_size(spark):
    df = spark.range(50_010).select(F.when(F.col("id") < 50_000, 0).otherwise(F.col("id")).alias("k"), "id")
    nested = nest(df, "k", F.struct("id"), "xs")
    assert {r["k"]: r["n"] for r in nested.select("k", F.size("xs").alias("n")).collect()} == {
        0: 50_000, **{k: 1 for k in range(50_000, 50_010)}}
    parts = nest(df, "k", F.struct("id"), "xs", F.floor(F.col("id") / 1000).alias("part"))
    assert parts.where("k = 0").count() == 50 and parts.select(F.max(F.size("xs"))).first()[0] == 1000


def test_exchanges_begin_with_tasks_for_the_rows(spark):
    """The rows of a task do not grow with the input: records, their children and numbered rows."""
    rows = spark.range(90).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    try:
        assert size_exchanges(spark, 90, rows_per_task=10) == size_exchanges(spark, 20, rows_per_task=10) == exchange_tasks(spark) == 9
        built = [dense_id(rows), nest(rows, "k", F.struct("v"), "vs"), bridge(rows, rows.columns, [], within=["k"])]
        for df in built:
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert re.search(r"hashpartitioning\(.*, 9\), REPARTITION_BY_NUM", plan) and df.count() == 90
        assert sorted(r["id"] for r in built[0].collect()) == list(range(1, 91))
    finally:
        spark.conf.unset(EXCHANGE_TASKS)
    assert exchange_tasks(spark) == 2


def test_children_are_gathered_where_they_were_dealt(spark):
    nested = nest(spark.range(10).withColumn("k", F.col("id") % 3), "k", F.struct("id"), "xs")
    lines = nested._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(lines) if "Exchange" in line]
    assert len(dealt) == 1 and max(i for i, line in enumerate(lines) if "Aggregate" in line) < dealt[0]
