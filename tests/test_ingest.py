from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from runstar.operators.analytics import validated_dyads
from runstar.plans import staging
from runstar.plans.ingest import SPARK_ERRORS, LoadOptions, ingest, load_runs
from runstar.plans.star import BUILDERS, OF_RECORDS
from runstar.schemas import INPUT_TABLES, TABLES
from runstar.sources import commits, discover, sinks
from runstar.sources import feed as source
from runstar.sources.sinks import few_large, write_by_run
from runstar.sources.warehouse import ConstraintViolated, Warehouse
from runstar.sources.workspace import CLEANUP, Workspace, control_table, shared_folder
from runstar.streaming.watch import ingest_stream
from tests.feeds import record, write_metadata, write_run

RECORDS = [record(f"e{i}", publication_year=2019 + i % 2, journal_title=f"J{i % 2}") for i in range(4)]


@pytest.fixture
def base(tmp_path):
    return tmp_path / "feed"


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def outcome(df):
    return {(r["agency"], r["version"]): (r["status"], r["reason"]) for r in df.collect()}


def contents(w, run_id):
    """Rows of a run without ids and times, per table."""
    found = {}
    for name in BUILDERS:
        df = w.table(name).where(F.col("run_id") == run_id)
        cols = [c for c in df.columns if c not in ("id", "last_updated_date") and not c.endswith("_id")]
        found[name] = sorted(map(str, df.select(*cols).collect()))
    return found


def test_read_run_names_and_errors(spark, base):
    write_run(base, "my agency", "v 1", RECORDS, files=2)
    feed, meta = source.read_run(spark, str(base / "my agency" / "v 1"))
    assert {(r["agency"], r["version"]) for r in feed.select("agency", "version").collect()} == {("my agency", "v 1")}
    assert feed.count() == 4 and feed.select("src_file").distinct().count() == 2
    feed, meta = source.read_run(spark, str(base), "my agency", "v 1")
    assert source.expected_years(meta).agg(F.sum("expected")).first()[0] == 4
    assert source.metadata_aliases(meta).count() == 2
    with pytest.raises(ValueError):
        source.read_run(spark, str(base), version="v 1")
    with pytest.raises(ValueError):
        source.read_run(spark, str(base), agency="my agency")
    with pytest.raises(source.RunNotFound, match="publication data"):
        source.read_run(spark, str(base / "nowhere" / "v"))
    (base / "my agency" / "v 1" / "stat" / "export_metadata.json").unlink()
    with pytest.raises(source.RunNotFound, match="export metadata"):
        source.read_run(spark, str(base), "my agency", "v 1")


def test_bad_lines_stop_a_strict_scan_and_are_kept_otherwise(spark, base):
    write_run(base, "a", "v", [record("x"), record("y", publication_year="2020")])
    path = f"{base}/a/v/{source.PUBLICATION_FILES}"
    with pytest.raises(SPARK_ERRORS, match="FAILED_READ_FILE|MALFORMED"):
        source.read_feed(spark, path).collect()
    kept = source.read_feed(spark, path, keep_corrupt=True).collect()  # all columns: a narrower scan parses less
    assert sum(r[source.CORRUPT] is not None for r in kept) == 1


def test_schema_can_be_inferred(spark, base):
    write_run(base, "a", "v", [record("x", extra_field=1)])
    assert "extra_field" in source.read_feed(spark, f"{base}/a/v/{source.PUBLICATION_FILES}", schema=None).columns


def test_discovery(spark, base):
    write_run(base, "a", "v1", RECORDS)
    write_run(base, "b", "v1", RECORDS)
    (base / "stray.txt").write_text("x")
    (base / "a" / "loose.txt").write_text("x")
    listing = discover.list_objects(spark, str(base))
    assert {r["key"] for r in listing.collect()} >= {"stray.txt", "a/v1/stat/export_metadata.json"}
    names = lambda df: {(r["agency"], r["version"]) for r in df.collect()}
    assert names(discover.changed_runs(listing)) == {("a", "v1"), ("b", "v1")}
    ledger = listing.where(F.col("key").startswith("a/"))
    assert names(discover.changed_runs(discover.new_objects(listing, ledger))) == {("b", "v1")}
    assert names(discover.changed_runs(discover.new_objects(listing, listing))) == set()
    assert len(names(discover.changed_runs(discover.new_objects(listing, listing, overwrite=True)))) == 2
    flagged = control_table(spark, [("a", "v1"), ("c", "v9")], "agency string, version string")
    work = discover.work_list(discover.changed_runs(discover.new_objects(listing, ledger)), flagged)
    assert {(r["agency"], r["force"]) for r in work.collect()} == {("a", True), ("b", False), ("c", True)}


def test_ingest_isolates_failing_runs(spark, base, warehouse):
    write_run(base, "good one", "v1", RECORDS, files=2)
    write_run(base, "years", "v1", RECORDS, years={2019: 2, 2020: 2, 3000: 1})
    write_run(base, "twice", "v1", [*RECORDS, RECORDS[0]], years={2019: 2, 2020: 2})
    write_run(base, "type", "v1", [record("x", citation_count="many")])
    write_run(base, "long", "v1", [record("x", publication_title="t" * 401)])
    write_run(base, "nometa", "v1", RECORDS)
    (base / "nometa" / "v1" / "stat" / "export_metadata.json").unlink()
    write_run(base, "badmeta", "v1", RECORDS)
    (base / "badmeta" / "v1" / "stat" / "export_metadata.json").write_text("{ not json")
    (base / "nofeed" / "v1" / "stat").mkdir(parents=True)
    write_metadata(base / "nofeed" / "v1", {})
    got = outcome(ingest(spark, str(base), warehouse, options=LoadOptions(references=True)))
    assert got == {
        ("good one", "v1"): ("loaded", None),
        ("years", "v1"): ("failed", "input validation failed: documents per year"),
        ("twice", "v1"): ("failed", "input validation failed: repeated eid"),
        ("type", "v1"): ("failed", "malformed feed line"),
        ("long", "v1"): ("failed", "constraint violated: publication max_length:title"),
        ("nometa", "v1"): ("failed", "no export metadata found"),
        ("badmeta", "v1"): ("failed", "malformed metadata"),
        ("nofeed", "v1"): ("failed", "no publication data found")}
    assert warehouse.table("publication").count() == 4
    assert warehouse.load_log().count() == 8
    # Failed runs are tried again, the loaded one is known.
    assert ("good one", "v1") not in outcome(ingest(spark, str(base), warehouse))


def test_unreadable_file_fails_its_run_only(spark, base, warehouse):
    for name in ("a", "b"):
        write_run(base, name, "v1", RECORDS)
    broken = base / "b" / "v1" / "json" / "publications" / "publication_0.json.gz"
    broken.write_bytes(broken.read_bytes()[:60])
    got = outcome(ingest(spark, str(base), warehouse))
    assert got[("a", "v1")] == ("loaded", None)
    assert got[("b", "v1")][0] == "failed" and "FAILED_READ_FILE" in got[("b", "v1")][1]
    assert warehouse.table("publication").count() == 4


def test_only_the_scan_is_repeated(spark, base, warehouse):
    for name in "abc":
        write_run(base, name, "v1", RECORDS)
    broken = base / "b" / "v1" / "json" / "publications" / "publication_0.json.gz"
    whole = broken.read_bytes()
    broken.write_bytes(whole[:60])
    ingest(spark, str(base), warehouse)
    assert warehouse.log().where("action = 'start'").count() == 1
    assert {r["version"] for r in warehouse.load_log().collect()} == {"v1"} and warehouse.failed_runs().count() == 1
    broken.write_bytes(whole)
    assert outcome(ingest(spark, str(base), warehouse)) == {("b", "v1"): ("loaded", None)}
    assert warehouse.failed_runs().count() == 0


def test_one_scan_more_than_unreadable_runs(spark, base, warehouse, monkeypatch):
    for i in range(20):
        write_run(base, f"agency {i}", "v 1", RECORDS[:1 + i % 3])
    for i in (3, 11):
        broken = base / f"agency {i}" / "v 1" / "json" / "publications" / "publication_0.json.gz"
        broken.write_bytes(broken.read_bytes()[:60])
    scans, write_raw = [], Warehouse.write_raw
    monkeypatch.setattr(Warehouse, "write_raw", lambda self, *a: scans.append(1) or write_raw(self, *a))
    got = outcome(ingest(spark, str(base), warehouse))
    assert len(scans) == 3
    assert {a for (a, _), (status, _) in got.items() if status == "failed"} == {"agency 3", "agency 11"}
    assert all("FAILED_READ_FILE" in got[(f"agency {i}", "v 1")][1] for i in (3, 11))
    assert warehouse.table("publication").count() == sum(1 + i % 3 for i in range(20) if i not in (3, 11))


def test_nothing_but_unreadable_runs(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    broken = base / "a" / "v1" / "json" / "publications" / "publication_0.json.gz"
    broken.write_bytes(broken.read_bytes()[:60])
    got = outcome(ingest(spark, str(base), warehouse))
    assert got[("a", "v1")][0] == "failed" and warehouse.table("publication").count() == 0


def test_two_writers_by_turns(spark, base, tmp_path):
    """Each sees at once what the other has done: loads, flags and deletes."""
    first, second = (Warehouse(spark, str(tmp_path / "warehouse")) for _ in range(2))
    write_run(base, "a", "v1", RECORDS)
    assert outcome(ingest(spark, str(base), first)) == {("a", "v1"): ("loaded", None)}
    write_run(base, "b", "v1", RECORDS[:2])
    second.request_reload("a", "v1")
    assert outcome(ingest(spark, str(base), second)) == {(n, "v1"): ("loaded", None) for n in "ab"}
    write_run(base, "c", "v1", RECORDS[:3])
    assert outcome(ingest(spark, str(base), first)) == {("c", "v1"): ("loaded", None)}
    for w in (first, second):
        names = {r["id"]: r["agency"] for r in w.runs().collect()}
        counts = {names[r["run_id"]]: r["count"] for r in w.table("publication").groupBy("run_id").count().collect()}
        assert counts == {"a": 4, "b": 2, "c": 3}
        ids = [r["id"] for r in w.table("publication").select("id").collect()]
        assert len(set(ids)) == len(ids)
    # an idle poll, then a flag set elsewhere
    assert outcome(ingest(spark, str(base), first)) == {}
    second.request_reload("b", "v1")
    assert outcome(ingest(spark, str(base), first)) == {("b", "v1"): ("loaded", None)}
    assert second.reload_requests().count() == 0
    first.delete_run("c", "v1")
    assert second.run_id("c", "v1") is None and not second.delete_run("c", "v1")


def test_ids_taken_meanwhile_are_a_conflict(spark, base, tmp_path, monkeypatch):
    first, second = (Warehouse(spark, str(tmp_path / "warehouse")) for _ in range(2))
    write_run(base, "a", "v1", RECORDS)
    write_run(base, "b", "v1", RECORDS)
    only_b = control_table(spark, [("b", "v1", False)], "agency string, version string, force boolean")
    publish, between = Warehouse.publish, []

    def late(self, *args):
        if self is first and not between:
            between.append(outcome(load_runs(spark, str(base), second, only_b)))
        return publish(self, *args)

    monkeypatch.setattr(Warehouse, "publish", late)
    only_a = control_table(spark, [("a", "v1", False)], "agency string, version string, force boolean")
    assert outcome(load_runs(spark, str(base), first, only_a)) == {("a", "v1"): ("loaded", None)}
    assert between == [{("b", "v1"): ("loaded", None)}]
    ids = [r["id"] for r in second.table("publication").select("id").collect()]
    assert len(ids) == 8 == len(set(ids)) and second.table("publication").select("run_id").distinct().count() == 2
    # inputs as well
    place = control_table(spark, [("q", "Kiel")], "q string, city string")
    start = Warehouse.start_load

    def slow(self):
        if self is first and len(between) < 2:
            between.append(second.add_input("affiliation_geo", place))
        return start(self)

    monkeypatch.setattr(Warehouse, "start_load", slow)
    first.add_input("affiliation_geo", place)
    assert sorted(r["id"] for r in second.table("affiliation_geo").collect()) == [1, 2]


def test_commits_are_made_once(spark, tmp_path):
    """Many writers at the same time: every event is there, none twice, and every load id is another."""
    root = str(tmp_path / "warehouse")
    with ThreadPoolExecutor(8) as pool:
        ids = list(pool.map(lambda _: Warehouse(spark, root).start_load(), range(24)))
    assert sorted(ids) == list(range(1, 25))
    log = Warehouse(spark, root).log()
    assert log.count() == 24 and log.select("commit_no").distinct().count() == 24
    # a commit that its writer did not finish is passed over
    (tmp_path / "warehouse" / "log" / "commit-000000000025.json").write_text('{"commit_no": 25, "at"')
    w = Warehouse(spark, root)
    commits_patience, commits.PATIENCE = commits.PATIENCE, 0.2
    try:
        assert w.start_load() == 25 and Warehouse(spark, root).position() == 26
    finally:
        commits.PATIENCE = commits_patience


def test_views_of_the_user_stay(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    spark.range(3).createOrReplaceTempView("publication")
    try:
        found = warehouse.query("select p.title from publication p join agency_run r on r.id = p.run_id")
        assert spark.table("publication").count() == 3 and found.count() == 4
        assert not spark.catalog.tableExists("agency_run")
        with pytest.raises(SPARK_ERRORS):
            warehouse.query("select nothing from publication")
        assert spark.table("publication").columns == ["id"]
    finally:
        spark.catalog.dropTempView("publication")


def test_a_broken_rule_is_named_with_all_others(spark, base, warehouse):
    write_run(base, "a", "v1", [record("x", publication_title="t" * 401, doi="d" * 81)])
    write_run(base, "b", "v1", RECORDS)
    got = outcome(ingest(spark, str(base), warehouse))
    assert got[("a", "v1")][1] == "constraint violated: publication max_length:doi, publication max_length:title"
    assert got[("b", "v1")] == ("loaded", None)


def test_figures_of_a_load_are_gathered_while_it_is_written(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    event = warehouse.log().where("action = 'publish'").first()
    assert event["row_counts"] == {n: warehouse.table(n).count() for n in event["row_counts"]} and len(event["row_counts"]) == 16
    assert event["last_ids"] == {n: warehouse.table(n).agg(F.max("id")).first()[0] for n, k in event["row_counts"].items() if k}


def test_one_stamp_a_load(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    write_run(base, "b", "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    stamps = {r[0] for n in BUILDERS if "last_updated_date" in warehouse.table(n).columns
              for r in warehouse.table(n).select("last_updated_date").distinct().collect()}
    assert len(stamps) == 1


def test_own_faults_are_not_a_runs_fault(spark, base, warehouse, monkeypatch):
    write_run(base, "a", "v1", RECORDS)
    monkeypatch.setattr(staging, "all_kinds", lambda *a, **k: spark.range(1).select("no_such_column"))
    with pytest.raises(SPARK_ERRORS, match="no_such_column"):
        ingest(spark, str(base), warehouse)


def test_a_run_without_records_fails(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    write_run(base, "b", "v1", [], years={})
    got = outcome(ingest(spark, str(base), warehouse))
    assert got[("a", "v1")] == ("loaded", None) and got[("b", "v1")][0] == "failed"


def test_load_needs_a_schema():
    with pytest.raises(ValueError, match="schema"):
        LoadOptions(schema=None)


def test_collation_of_a_load(spark, base, warehouse):
    write_run(base, "a", "v1", [record("x", journal_title="Nature"), record("y", journal_title="NATURE")])
    ingest(spark, str(base), warehouse, options=LoadOptions(collation="UTF8_LCASE"))
    assert warehouse.table("journal").count() == 1 and warehouse.table("publication").count() == 2


def test_load_report(spark, base, warehouse):
    write_run(base, "a", "v1", [record("x"), record("y", journal_scopus_source_id=None)])
    ingest(spark, str(base), warehouse)
    dyads = warehouse.table("dyad").select("run_id", F.col("id").alias("dyad_id"), F.lit(1).cast("bigint").alias("reviewer_id"))
    warehouse.add_input("snippet_validation", dyads)
    n = dyads.count()
    warehouse.request_reload("a", "v1")
    assert outcome(ingest(spark, str(base), warehouse)) == {("a", "v1"): ("loaded", None)}
    log = [(r["publications_dropped"], r["publications_repeated"], r["stale_verdicts"]) for r in warehouse.load_log().orderBy("at").collect()]
    assert n > 0 and log == [(1, 0, 0), (1, 0, n)]


def files(warehouse, pattern):
    return sorted(str(p.relative_to(warehouse.root)) for p in Path(warehouse.root).glob(pattern))


def test_delete_drop_and_unseen_files(spark, base, warehouse):
    for name in ("a", "b c", "x=y"):
        write_run(base, name, "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    assert len(files(warehouse, "staging/_raw/load_id=*/agency=*/version=*")) == 3
    warehouse.delete_run("x=y", "v1")
    assert not [f for f in files(warehouse, "staging/*/load_id=*/agency=*") if "x%3Dy" in f and list(Path(warehouse.root, f).iterdir())]
    assert len(files(warehouse, "staging/_metadata/load_id=*/agency=*/version=*")) == 2
    # a replaced load and one that failed
    warehouse.request_reload("b c", "v1")
    broken = base / "a" / "v1" / "stat" / "export_metadata.json"
    broken.write_text("{ no json")
    ingest(spark, str(base), warehouse, overwrite=True)
    before = contents(warehouse, warehouse.run_id("a", "v1")), contents(warehouse, warehouse.run_id("b c", "v1"))
    assert len(files(warehouse, "staging/_raw/load_id=*/agency=*/version=*")) > 2
    warehouse.remove_unseen()
    assert before == (contents(warehouse, warehouse.run_id("a", "v1")), contents(warehouse, warehouse.run_id("b c", "v1")))
    left = files(warehouse, "staging/_raw/load_id=*/agency=*/version=*")
    assert len(left) == warehouse.runs().count() and len(files(warehouse, "tables/publication/load_id=*/run_id=*")) == len(left)
    warehouse.drop_tables()
    assert files(warehouse, "staging/*") == [] == files(warehouse, "tables/*")


def test_inputs_are_checked(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    one = warehouse.table("dyad").limit(1).select("run_id", F.col("id").alias("dyad_id"), F.lit(1).cast("bigint").alias("reviewer_id"))
    warehouse.add_input("snippet_validation", one)
    for wrong in (one, one.withColumn("dyad_id", F.lit(10**9)), one.withColumn("reviewer_id", F.lit(None).cast("bigint"))):
        with pytest.raises(ConstraintViolated, match="unique|reference:dyad_id|not_null:reviewer_id"):
            warehouse.add_input("snippet_validation", wrong)
    assert warehouse.table("snippet_validation").count() == 1
    warehouse.add_input("affiliation_geocoding", control_table(spark, [("q", "Kiel")], "q string, city string"))
    assert warehouse.table("affiliation_geocoding").count() == 1
    pair = warehouse.table("publication_affiliation").limit(1).select("run_id", F.col("id").alias("publication_affiliation_id"))
    warehouse.add_input("publication_affiliation_geocoding", pair.withColumn("affiliation_geocoding_id", F.lit(1).cast("bigint")))
    with pytest.raises(ConstraintViolated, match="affiliation_geocoding_id"):
        warehouse.add_input("publication_affiliation_geocoding", pair.withColumn("affiliation_geocoding_id", F.lit(2).cast("bigint")))


@pytest.mark.parametrize("prefix, path, key", [
    ("s3a://feed", "s3a://feed/newsfeed/2024/json/publications/x.json.gz", "newsfeed/2024/json/publications/x.json.gz"),
    ("s3a://bucket/feed/", "s3a://bucket/feed/feed/feed/x", "feed/feed/x"), ("/data/feed", "file:/data/feed/a/v/x", "a/v/x"),
    ("file:///data/feed", "file:/data/feed/a/v/x", "a/v/x"), ("file:/data/feed/", "file:///data/feed/a/v/x", "a/v/x"),
    ("/data/feed", "file:/data/feedback/a/v/x", None), ("/", "file:/a/v/x", "a/v/x")])
def test_keys_below_a_prefix(spark, prefix, path, key):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(discover.relative_key(F.col("p"), prefix)).first()[0] == key


def test_load_replace_delete(spark, base, warehouse):
    write_run(base, "a", "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    before, last = contents(warehouse, 1), warehouse.last_ids()
    assert warehouse.run_id("a", "v1") == 1 and warehouse.run_id("no", "v1") is None

    # Verdicts of the run are seen until it is loaded again; geocoder answers belong to no run.
    dyads = warehouse.table("dyad").select("run_id", F.col("id").alias("dyad_id"), F.lit(1).alias("reviewer_id").cast("bigint"),
                                           F.lit(1).cast("smallint").alias("agency_dataset_identified"))
    warehouse.add_input("snippet_validation", dyads)
    warehouse.add_input("snippet_validation", dyads.withColumn("reviewer_id", F.lit(2).cast("bigint")))
    warehouse.add_input("affiliation_geo", control_table(spark, [("q", "Kiel")], "q string, city string"))
    verdicts = warehouse.table("snippet_validation")
    n = dyads.count()
    assert sorted(r["id"] for r in verdicts.collect()) == list(range(1, 2 * n + 1))
    view = validated_dyads(warehouse.table("agency_run"), warehouse.table("dataset_alias"), warehouse.table("dyad"), verdicts)
    assert view.agg(F.sum("num_identified")).first()[0] == 2 * n

    # Nothing new: nothing to do. A request and a new run: both, the first with the same content and new ids.
    assert outcome(ingest(spark, str(base), warehouse)) == {}
    warehouse.request_reload("a", "v1")
    write_run(base, "b", "v1", RECORDS[:2])
    assert outcome(ingest(spark, str(base), warehouse)) == {(n, "v1"): ("loaded", None) for n in "ab"}
    assert contents(warehouse, 1) == before
    assert warehouse.table("publication").where("run_id = 1").agg(F.min("id")).first()[0] > last["publication"]
    assert warehouse.reload_requests().count() == 0
    assert warehouse.table("snippet_validation").count() == 0 and warehouse.table("affiliation_geo").count() == 1
    # A new file without topics: old topic rows are gone although nothing replaces them.
    write_run(base, "b", "v1", [{**r, "topic": None, "authors": []} for r in RECORDS[:2]])
    folder = base / "b" / "v1" / "json" / "publications"
    (folder / "publication_0.json.gz").rename(folder / "publication_9.json.gz")
    assert outcome(ingest(spark, str(base), warehouse)) == {("b", "v1"): ("loaded", None)}
    assert {n: warehouse.table(n).where("run_id = 2").count() for n in ("topic", "publication_author", "publication")} == {
        "topic": 0, "publication_author": 0, "publication": 2}
    # Fail mode refuses what exists.
    assert outcome(ingest(spark, str(base), warehouse, overwrite=True, options=LoadOptions(if_exists="fail"))) == {
        ("a", "v1"): ("failed", "run exists"), ("b", "v1"): ("failed", "run exists")}
    with pytest.raises(ValueError):
        ingest(spark, str(base), warehouse, options=LoadOptions(if_exists="append"))
    # Delete, in every table; deleting again does nothing. Delete, then load: as loaded once, under a new run id.
    assert warehouse.delete_run("b", "v1") and not warehouse.delete_run("b", "v1")
    assert {t.where("run_id = 2").count() for t in warehouse.tables().values() if "run_id" in t.columns} == {0}
    assert not list(Path(warehouse.root).glob("tables/*/load_id=*/run_id=2"))
    warehouse.delete_run("a", "v1")
    warehouse.request_reload("a", "v1")
    ingest(spark, str(base), warehouse)
    assert warehouse.run_id("a", "v1") == 3 and contents(warehouse, 3) == before
    # Another object on the same folder sees what is published.
    assert Warehouse(spark, warehouse.root).table("publication").count() == 4
    sql = warehouse.query("select count(*) n, max(r.agency) a from publication p join agency_run r on r.id = p.run_id")
    assert tuple(sql.first()) == (4, "a")
    # Empty, then drop, all tables but some.
    for clear in (warehouse.empty_tables, warehouse.drop_tables):
        clear(keep=["publisher", "model"])
        left = {n: t.count() for n, t in warehouse.tables().items()}
        assert left.pop("publisher") == 1 and left.pop("model") == 4 and set(left.values()) == {0}
    assert {p.name for p in Path(warehouse.root, "tables").iterdir()} == {"publisher"}
    warehouse.add_input("affiliation_geo", control_table(spark, [("q2", "Rom")], "q string, city string"))
    assert [(r["id"], r["q"]) for r in warehouse.table("affiliation_geo").collect()] == [(2, "q2")]


def test_redacted_run(spark, base, tmp_path):
    long = record("x", identified_datasets=[{**record()["identified_datasets"][0], "snippets": ["0123456789abc"]}])
    write_run(base, "a", "v1", [long, record("y", publication_year=2021)], years={1999: 5})
    source.redact_run(spark, str(base), str(tmp_path / "sample"), "a", "v1")
    feed, meta = source.read_run(spark, str(tmp_path / "sample"), "a", "v1")
    snippets = {r["eid"]: r["identified_datasets"][0]["snippets"] for r in feed.collect()}
    assert snippets == {"x": ["0123456789"], "y": ["uses Data "]}
    assert {(r["publication_year"], r["expected"]) for r in source.expected_years(meta).collect()} == {(2020, 1), (2021, 1)}
    assert source.metadata_aliases(meta).count() == 2


def test_names_of_runs_are_cut_from_the_path(spark, base):
    """Not found by a pattern, record by record; odd names and other folders come out as before."""
    write_run(base / "json" / "x", "a b+c%41", "v 1", [record("x")])
    feed = source.read_feed(spark, f"{base}/json/x/*/*/{source.PUBLICATION_FILES}")
    assert feed.select("agency", "version").collect() == [("a b+c%41", "v 1")]
    assert "regexp" not in feed._jdf.queryExecution().optimizedPlan().toString()
    paths = spark.createDataFrame([("s3a://b/a/v/json/publications/x/json/publications/y.json.gz",), ("/elsewhere/y.json.gz",)], "p string")
    names = paths.select(*source._run_columns(F.col("p"), "json/publications/")).collect()
    assert names == [("a", "v"), ("", "")]


def test_redaction_counts_stated_years_as_it_writes(spark, base, tmp_path, monkeypatch):
    """Records without a year too; they are read again only if the metadata leaves out a year."""
    records = [record("x"), record("y", publication_year=2021), record("z", publication_year=2021), record("n", publication_year=None)]
    scans, count = [], source.year_counts
    monkeypatch.setattr(source, "year_counts", lambda *a: scans.append(1) or count(*a))
    for version, years, again in (("v1", {2020: 1, 2021: 9, 1999: 5}, 0), ("v2", {2020: 1}, 1)):
        write_run(base, "a", version, records, files=2, years=years)
        source.redact_run(spark, str(base), str(tmp_path / "sample"), "a", version)
        _, meta = source.read_run(spark, str(tmp_path / "sample"), "a", version)
        assert {(r["publication_year"], r["expected"]) for r in source.expected_years(meta).collect()} == {(2020, 1), (2021, 2), (None, 1)}
        assert len(scans) == again


def test_feed_without_metadata_has_no_aliases(spark):
    assert staging.datasets(source.no_aliases(spark)).columns == ["run_id", "alias", "alias_id", "parent_alias_id", "alias_type"]


def test_create_tables_on_nothing(warehouse):
    tables = warehouse.create_tables()
    assert {n: t.count() for n, t in tables.items() if n != "model"} == dict.fromkeys(
        ["agency_run", *BUILDERS, *INPUT_TABLES], 0)
    assert tables["dyad"].columns == ["id", "run_id", "publication_id", "dataset_alias_id", "alias_id", "mention_candidate",
                                      "snippet", "is_fuzzy", "fuzzy_score", "last_updated_date"]


def test_stream_loads_only_new_runs(spark, base, warehouse, tmp_path):
    write_run(base, "a", "v1", RECORDS)
    checkpoint = str(tmp_path / "checkpoint")
    for _ in range(2):
        ingest_stream(spark, str(base), warehouse, checkpoint).awaitTermination()
        assert warehouse.load_log().count() == 1
    write_run(base, "b", "v1", RECORDS[:2])
    ingest_stream(spark, str(base), warehouse, checkpoint).awaitTermination()
    assert warehouse.load_log().count() == 2 and warehouse.table("publication").count() == 6


def test_stream_retries_and_reloads_without_new_objects(spark, base, warehouse, tmp_path):
    write_run(base, "a", "v1", RECORDS)
    write_run(base, "b", "v1", RECORDS)
    broken = base / "b" / "v1" / "json" / "publications" / "publication_0.json.gz"
    whole, checkpoint = broken.read_bytes(), str(tmp_path / "checkpoint")
    broken.write_bytes(whole[:60])

    def run():
        ingest_stream(spark, str(base), warehouse, checkpoint).awaitTermination()
        return [(r["agency"], r["status"]) for r in warehouse.load_log().orderBy("at", "agency").collect()]

    assert run() == [("a", "loaded"), ("b", "failed")]
    broken.write_bytes(whole)  # the same object: no batch will name it
    assert run()[2:] == [("b", "loaded")]
    warehouse.request_reload("a", "v1")
    assert run()[3:] == [("a", "loaded")] and warehouse.reload_requests().count() == 0
    assert len(run()) == 4 and warehouse.table("publication").count() == 8


def test_a_flag_alone_makes_a_batch_of_a_running_stream(spark, base, warehouse, tmp_path):
    write_run(base, "a", "v1", RECORDS)
    query = ingest_stream(spark, str(base), warehouse, str(tmp_path / "checkpoint"), every="1 second")
    try:
        def loads(n):
            end = time.monotonic() + 90
            while warehouse.load_log().count() < n and time.monotonic() < end:
                time.sleep(0.5)
            return warehouse.load_log().count()

        assert loads(1) == 1
        Warehouse(spark, warehouse.root).request_reload("a", "v1")
        assert loads(2) == 2
    finally:
        query.stop()
    assert warehouse.reload_requests().count() == 0 and warehouse.table("publication").count() == 4


def test_staging_and_csv_sinks(spark, base, warehouse, tmp_path):
    write_run(base, "a b", "v1", RECORDS)
    ingest(spark, str(base), warehouse)
    feed, meta = source.read_run(spark, str(base), "a b", "v1")
    aliases = source.metadata_aliases(meta)
    kinds = staging.all_kinds(feed.withColumn("run_id", F.lit(1).cast("bigint")), aliases.withColumn("run_id", F.lit(1).cast("bigint")),
                              keys=("run_id", "agency", "version", "eid"))
    for name, df in kinds.items():
        assert sorted(map(str, warehouse.staging(name, df.schema).collect())) == sorted(map(str, df.collect())), name
    sinks.write_csv(kinds, str(tmp_path / "csv"))
    for name, df in kinds.items():
        flat = sinks.without_arrays(df)
        back = sinks.read_csv(spark, str(tmp_path / "csv" / name), flat.schema)
        assert sorted(map(str, back.collect())) == sorted(map(str, flat.collect())), name
    hard = spark.createDataFrame([(1, "", " a"), (2, None, "b "), (3, 'x "q", \\ \n y', ""), (4, " ", None), (5, '"', "\\"),
                                  (6, "\r\n", ",")], "i int, s string, t string")
    sinks.write_csv({"hard": hard}, str(tmp_path / "csv"))
    back = sinks.read_csv(spark, str(tmp_path / "csv" / "hard"), hard.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, hard.collect()))
    assert sinks.preview(kinds["topics"], ["eid", "keywords"]).columns == ["eid", "keywords"]
    assert sinks.preview(kinds["topics"]).columns == kinds["topics"].columns


def test_many_runs_in_one_load(spark, base, warehouse):
    for i in range(10):
        write_run(base, f"agency{i}", "v1", RECORDS[: 1 + i % 4])
    got = outcome(ingest(spark, str(base), warehouse))
    assert set(got.values()) == {("loaded", None)} and len(got) == 10
    assert warehouse.table("publication").count() == sum(1 + i % 4 for i in range(10))


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or shared_folder(spark) == folder.rstrip("/")


def test_csv_files_are_compressed(spark, tmp_path):
    sinks.write_csv({"long": spark.range(1000).select("id", F.lit("x" * 500).alias("t"))}, str(tmp_path))
    files = list((tmp_path / "long").glob("part-*"))
    assert files and all(f.name.endswith(".csv.gz") for f in files) and sum(f.stat().st_size for f in files) < 100_000


def test_rows_that_lie_by_run_are_written_where_they_are(spark, tmp_path):
    """One file for each task and run, and no sort by run."""
    rows = spark.range(0, 30, 1, 3).select(F.lit("a").alias("agency"), F.spark_partition_id().cast("string").alias("version"),
                                           (-F.col("id")).alias("n"))
    sinks.write_by_run(rows.unionByName(rows), str(tmp_path / "t"), ["agency", "version"], dealt=True)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 6
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == str(sinks.RUNS_AT_A_TIME)
    many = spark.range(0, 200, 1, 1).select(F.lit("a").alias("agency"), (F.col("id") % 20).cast("string").alias("version"), "id")
    sinks.write_by_run(many, str(tmp_path / "m"), ["agency", "version"], dealt=True)  # more runs in a task than files it opens
    back = spark.read.parquet(str(tmp_path / "m")).select("id", F.col("version").cast("bigint").alias("v")).collect()
    assert sorted(r["id"] for r in back) == list(range(200)) and all(r["v"] == r["id"] % 20 for r in back)


def test_exchanges_go_with_their_query(spark, tmp_path):
    """What is read back from a written table needs no exchange any more; a session that keeps them does."""
    def exchanges():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    space, rows = Workspace(spark), spark.range(1000).repartition(5, "id")
    before = exchanges()
    assert space.keep("kept", rows).count() == 1000
    until = time.time() + 20
    while exchanges() - before and time.time() < until:
        time.sleep(0.2)
    assert not exchanges() - before
    spark.conf.set(CLEANUP, "false")
    try:
        before = exchanges()
        assert Workspace(spark).keep("kept", rows).count() == 1000
        assert spark.conf.get(CLEANUP) == "false" and exchanges() - before
    finally:
        spark.conf.unset(CLEANUP)


def test_written_tables_are_small(spark, tmp_path):
    space = Workspace(spark, str(tmp_path / "job"))
    space.keep("kept", spark.range(10))
    write_by_run(spark.range(10).withColumn("run_id", F.lit(1)), str(tmp_path / "runs"), ["run_id"])
    files = [f.name for f in tmp_path.rglob("*.parquet") if f.is_file()]
    assert len(files) > 1 and all(f.endswith(".zstd.parquet") for f in files)


def test_large_tables_of_few_runs_are_written_where_they_are(spark, base, warehouse, monkeypatch):
    """Without an exchange by run, and with the same rows; small ones, and those of many runs, go into few files."""
    assert few_large(600_000, 3, 20) and not few_large(599_999, 3, 20) and not few_large(10**9, 4, 20)
    seen, write = [], sinks.write_by_run

    def spy(df, path, partitions, watch=None, dealt=False):
        seen.append((path.split("/")[-2], dealt))  # tables/NAME/load_id=N
        write(df, path, partitions, watch, dealt)

    monkeypatch.setattr("runstar.sources.warehouse.write_by_run", spy)
    for version in ("v1", "v2"):
        write_run(base, "ag", version, RECORDS)
    ingest(spark, str(base), warehouse)
    assert not any(dealt for name, dealt in seen if name in TABLES)
    rows = {n: warehouse.table(n).drop("id", "last_updated_date").count() for n in TABLES}
    seen.clear()
    monkeypatch.setattr(sinks, "ROWS_OF_A_FILE", 0)
    ingest(spark, str(base), warehouse, overwrite=True)
    assert {name for name, dealt in seen if dealt and name in TABLES} == set(OF_RECORDS)
    assert rows == {n: warehouse.table(n).count() for n in TABLES}
    for n in OF_RECORDS:
        ids = [r["id"] for r in warehouse.table(n).select("id").collect()]
        assert len(ids) == len(set(ids))
