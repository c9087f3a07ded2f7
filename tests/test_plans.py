"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from runstar.operators.analytics import ordered_agg, validated_dyads
from runstar.operators.joins import Lookup, lookup
from runstar.operators.keys import dense_id
from runstar.operators.validate import run_verdict
from runstar.plans import staging, star
from runstar.sources.workspace import Workspace
from tests.feeds import aliases, frame, record


@pytest.fixture(scope="module")
def feed(spark):
    return Workspace(spark).keep("feed", frame(spark, *[record(f"e{i}") for i in range(5)]))


def plan(df, final=False):
    execution = df._jdf.queryExecution()
    if final:
        execution.toRdd().count()
    return execution.executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("kind", list(staging.FEED_KINDS))
def test_kinds_do_not_shuffle(feed, kind):
    assert "Exchange" not in plan(staging.FEED_KINDS[kind](feed))


def test_kinds_read_their_own_fields(feed):
    read = re.search(r"ReadSchema: (.*)", plan(staging.ufcs(feed).select("eid", "concept_id"))).group(1)
    assert "concept_id" in read and "authors" not in read and "doi" not in read


def test_numbering_gathers_bucket_sizes_only(spark):
    text = plan(dense_id(spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("payload"))))
    lines = text.splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(singles) == 1
    below = lines[singles[0] + 1]
    assert "HashAggregate" in below and "_bucket" in below and "payload" not in below


@pytest.fixture(scope="module")
def built(spark, feed):
    space = Workspace(spark)
    kinds = staging.all_kinds(feed, space.keep("aliases", aliases(spark)))
    load = star.StarLoad(spark, kinds, lambda n, df: space.keep(n, df))
    return kinds, load.all()


@pytest.mark.parametrize("table", ["dyad", "dyad_model", "publication_asjc", "author_affiliation"])
def test_bridges_run_each_lookup_once(spark, built, table):
    """As many joins run as the builder has lookups, and one that adds the offsets of the buckets."""
    kinds, tables = built
    build, own, parents = star.BUILDERS[table]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = build(*[kinds[k] for k in own], *[tables[p] for p in parents], start=0)
        logical = df._jdf.queryExecution().optimizedPlan().toString()
        text = plan(df, final=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ran = len(re.findall(r"(SortMergeJoin|ShuffledHashJoin)", text))
    # the logical plan has every lookup twice, for the numbering and for the sizes
    planned = (len(re.findall(r"Join (Inner|LeftOuter|LeftSemi)", logical)) - 1) // 2
    assert ran == planned > 0 and "ReusedExchange" in text


@pytest.mark.parametrize("table, kind", [("topic", "topics"), ("publisher", "publications"), ("asjc", "asjcs"),
                                         ("dataset_alias", "datasets")])
def test_numbering_reuses_the_distinct_exchange(spark, feed, table, kind):
    kinds = staging.all_kinds(feed, Workspace(spark).keep("aliases", aliases(spark)))
    assert "ReusedExchange" in plan(star.BUILDERS[table][0](kinds[kind]), final=True)


def test_verdict_reads_the_feed_once(spark):
    space = Workspace(spark)
    records = space.keep("records", spark.range(100).select(
        F.lit("a").alias("agency"), F.lit("v").alias("version"), F.col("id").cast("string").alias("eid"),
        (F.col("id") % 5).cast("int").alias("publication_year"), F.lit(None).cast("string").alias("corrupt")))
    stated = space.keep("stated", records.groupBy("agency", "version", "publication_year").agg(F.count(F.lit(1)).alias("expected")))
    verdict = run_verdict(records, stated, corrupt="corrupt")
    assert verdict.first().asDict() == {"agency": "a", "version": "v", "counts_ok": True, "unique_ok": True, "bad_lines": 0, "valid": True}
    scans = re.findall(r"FileScan parquet.*Location: \S+ paths\)\[([^]]*)", plan(verdict))
    assert len(scans) == 2 and sum("records" in s for s in scans) == 1


def test_verdict_view_counts_without_expand(spark, built):
    _, tables = built
    runs = spark.createDataFrame([(1, "a", "v")], "id bigint, agency string, version string")
    verdicts = tables["dyad"].select("run_id", F.col("id").alias("dyad_id"), F.lit(1).cast("smallint").alias("agency_dataset_identified"))
    view = validated_dyads(runs, tables["dataset_alias"], tables["dyad"], verdicts)
    assert "Expand" not in plan(view)
    row = view.first()
    assert (row["num_identified"], row["num_distinct_alias"], row["num_distinct_mention"]) == (5, 1, 1) or view.count() == 5


def test_ordered_text_and_flags_come_from_one_scan(spark):
    turns = Workspace(spark).keep("turns", spark.range(50).select((F.col("id") % 3).alias("k"), "id", F.col("id").cast("string").alias("v")))
    found = ordered_agg(turns, ["k"], "v", "id", {"n": ("count_if", F.col("id") > 3)}, chunk=F.floor(F.col("id") / 10))
    text = plan(found)
    assert text.count("FileScan") == 1 and "Join" not in text


def _subtree(lines, at):
    """The lines below a plan's line."""
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    out = []
    for line in lines[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        out.append(line)
    return out


@pytest.mark.parametrize("table", ["dyad", "publication_topic", "publication_ufc", "publication_asjc", "publication_author",
                                   "publication_affiliation"])
def test_children_of_a_record_are_dealt_once(spark, built, table):
    """Their duplicates go and their publication is found where one exchange by run and eid has put them."""
    kinds, tables = built
    build, own, parents = star.BUILDERS[table]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        lines = plan(build(*[kinds[k] for k in own], *[tables[p] for p in parents], start=0)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [i for i, line in enumerate(lines) if re.search(r"SortMergeJoin \[run_id#\d+L, eid#\d+\]", line)]
    assert joins
    for at in joins:
        below = _subtree(lines, at)
        parent = next(i for i, line in enumerate(below) if "_p_external_id" in line and "Exchange" in line)
        child = [line for line in below[:parent] if "Exchange" in line]
        assert len(child) == 1 and re.search(r"hashpartitioning\(run_id#\d+L, eid#\d+", child[0])
        assert any("HashAggregate" in line for line in below[:parent])


@pytest.mark.parametrize("table", ["dyad_model", "author_affiliation"])
def test_links_of_a_record_are_dealt_once(spark, built, table):
    test_children_of_a_record_are_dealt_once(spark, built, table)


def test_hashes_do_not_travel(spark):
    """Neither the hash and bucket of a numbered row nor the hash of a join's keys is written to an exchange."""
    rows = spark.range(100).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        numbered = plan(dense_id(rows)).splitlines()
        joined = plan(lookup(rows, Lookup(rows.withColumnRenamed("k", "id"), on={"t": "t"}, take={"id": "pid"})))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = next(i for i, line in enumerate(numbered) if "REPARTITION_BY_NUM" in line)
    assert not any(name in line for line in _subtree(numbered, dealt) for name in ("_hash", "_bucket"))
    assert "hashpartitioning(xxhash64(t#" in joined and " AS _key" not in joined
