from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from runstar.operators.analytics import geo_append, geo_backlog, geo_match, ordered_agg, stale_verdicts, validated_dyads
from runstar.operators.validate import audit_constraints
from runstar.plans import staging
from runstar.plans.star import BUILDERS, StarLoad, load_losses
from runstar.schemas import TABLES
from runstar.sources.workspace import Workspace, control_table
from tests.feeds import aliases, frame, record


def star(spark, *records, feed=None, alias_rows=None, last_ids=None):
    feed = feed if feed is not None else frame(spark, *records)
    kinds = staging.all_kinds(feed, alias_rows if alias_rows is not None else aliases(spark))
    space = Workspace(spark)
    return StarLoad(spark, {k: space.keep(f"stage_{k}", df) for k, df in kinds.items()}, space.keep, last_ids)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def mention(**fields):
    return {**record()["identified_datasets"][0], **fields}


def author(**fields):
    return {**record()["authors"][0], **fields}


def affiliation(**fields):
    return {**record()["affiliations"][0], **fields}


def test_one_record_through_all_tables(spark):
    tables = star(spark, record()).all()
    assert {n: t.count() for n, t in tables.items()} == {
        "model": 4, "dataset_alias": 2, "publisher": 1, "journal": 1, "issn": 2, "publication": 1, "dyad": 1,
        "dyad_model": 2, "topic": 1, "publication_topic": 1, "publication_ufc": 1, "asjc": 1, "publication_asjc": 1,
        "author": 1, "publication_author": 1, "publication_affiliation": 1, "author_affiliation": 1}
    for name, df in tables.items():
        extra = [] if TABLES[name].stamped and name != "model" else ["last_updated_date"]
        assert dict(df.dtypes) == {f.name: f.dataType.simpleString() for f in TABLES[name].schema if f.name not in extra}
    broken = audit_constraints(tables, TABLES).where("violations > 0").count()
    assert broken == 0


def test_null_publisher_is_a_row_but_no_reference(spark):
    load = star(spark, record("a", journal_publishername=None), record("b"))
    assert rows(load.table("publisher"), "name") == [("Springer",), (None,)]
    journals = rows(load.table("journal"), "publisher_id", "title")
    assert len(journals) == 2 and (None, "Journal") in journals
    by_eid = {r["external_id"]: r["journal_id"] for r in load.table("publication").collect()}
    null_journal = load.table("journal").where("publisher_id is null").first()["id"]
    assert by_eid["a"] == null_journal and by_eid["b"] != null_journal


def test_scores_that_round_alike_repeat_the_publication(spark):
    load = star(spark, record("a", journal_citescore={"citescore_value": 1.233}),
                record("b", journal_citescore={"citescore_value": 1.234}))
    assert rows(load.table("journal"), "cite_score") == [(Decimal("1.23"),)] * 2
    assert rows(load.table("publication"), "external_id") == [("a",), ("a",), ("b",), ("b",)]
    assert rows(load.table("issn"), "issn") == [("1234",), ("1234",), ("5678",), ("5678",)]


@pytest.mark.parametrize("field", ["journal_scopus_source_id"])
def test_publication_without_source_is_dropped(spark, field):
    load = star(spark, record("a", **{field: None}), record("b"))
    assert rows(load.table("publication"), "external_id") == [("b",)]
    assert load.table("dyad").count() == 1


def test_losses_are_counted(spark):
    feed = frame(spark, record("a", journal_scopus_source_id=None), record("b", asjcs=[{"asjc": "0100", "label": "x"}]))
    load = star(spark, feed=feed)
    kinds = staging.all_kinds(feed, aliases(spark))
    tables = {n: load.table(n) for n in ("publication", "asjc")}
    assert rows(load_losses(kinds, tables), "publications_dropped", "publications_repeated", "asjc_rows_lost") == [(1, 0, 1)]


def test_blank_issn_is_no_issn(spark):
    load = star(spark, record("a", journal_issn_isbn=["", " ", "1"]), record("b", journal_issn_isbn=None))
    assert rows(load.table("issn"), "issn") == [("1",)]


def test_dyad_with_null_alias_and_null_snippet_finds_its_scores(spark):
    load = star(spark, record(identified_datasets=[mention(linked_alias=None, snippets=[])]))
    assert rows(load.table("dyad"), "alias_id", "dataset_alias_id", "snippet") == [(None, None, None)]
    assert load.table("dyad_model").count() == 2


def test_alias_minus_one_is_not_null(spark):
    alias = record()["identified_datasets"][0]["linked_alias"]
    load = star(spark, record(identified_datasets=[
        mention(linked_alias={**alias, "alias_id": -1}, models=[{"model": "model1", "score": 0.1}]),
        mention(linked_alias=None, models=[{"model": "model2", "score": 0.2}])]))
    models = load.table("model").select(F.col("id").alias("model_id"), "name")
    joined = (load.table("dyad_model").join(load.table("dyad").select(F.col("id").alias("dyad_id"), "alias_id"), "dyad_id")
              .join(models, "model_id"))
    assert rows(joined, "alias_id", "name") == [(-1, "model1"), (None, "model2")]


def test_dyads_that_differ_in_fuzzy_fields_share_scores(spark):
    alias = record()["identified_datasets"][0]["linked_alias"]
    load = star(spark, record(identified_datasets=[
        mention(models=[{"model": "model1", "score": 0.1}]),
        mention(models=[{"model": "model1", "score": 0.1}], linked_alias={**alias, "fuzzy_score": 0.5})]))
    assert load.table("dyad").count() == 2 and load.table("dyad_model").count() == 2


def test_unknown_model_is_dropped(spark):
    load = star(spark, record(identified_datasets=[mention(models=[{"model": "other", "score": 1.0}])]))
    assert load.table("dyad").count() == 1 and load.table("dyad_model").count() == 0


def test_alias_without_dataset_keeps_its_dyad(spark):
    alias = record()["identified_datasets"][0]["linked_alias"]
    load = star(spark, record(identified_datasets=[mention(linked_alias={**alias, "alias_id": 12345})]))
    assert rows(load.table("dyad"), "alias_id", "dataset_alias_id") == [(12345, None)]


def test_repeated_alias_rows_are_kept(spark):
    both = aliases(spark).unionByName(aliases(spark))
    assert star(spark, record(), alias_rows=both).table("dataset_alias").count() == 4


def test_topic_with_two_keyword_sets(spark):
    topic = record()["topic"]
    load = star(spark, record("a"), record("b", topic={**topic, "keywords": ["k3"]}))
    assert load.table("topic").count() == 2 and load.table("publication_topic").count() == 4


def test_asjc_repeats_and_leading_zeros(spark):
    econ = {"asjc": "2000", "label": "Economics"}
    load = star(spark, record("a", asjcs=[econ, econ, {"asjc": "0100", "label": "Lost"}]),
                record("b", asjcs=[{"asjc": "2000", "label": "Econ."}]))
    assert rows(load.table("asjc"), "code") == [(100,), (2000,), (2000,)]
    assert load.table("publication_asjc").count() == 2 * 2 + 1 * 2


def test_asjc_that_is_no_number_is_reported(spark):
    load = star(spark, record(asjcs=[{"asjc": "x", "label": "?"}]))
    report = audit_constraints({"asjc": load.table("asjc")}, TABLES).where("violations > 0")
    assert rows(report, "table_name", "rule") == [("asjc", "not_null:code")]


def test_author_with_the_longest_name(spark):
    load = star(spark, record(authors=[
        author(), author(pn_given_name="Anna"), author(pn_given_name="Anne"), author(pn_given_name=None),
        author(author_id=None, pn_given_name="Bo", pn_family_name="X"),
        author(author_id=None, pn_given_name="Bob", pn_family_name="X"),
        author(author_id=None, pn_given_name=None, pn_family_name=None)]))
    assert rows(load.table("author"), "external_id", "given_name", "family_name") == [
        ("501", "Anna", "Miller"), (None, "Bob", "X")]


def test_links_need_the_canonical_name(spark):
    load = star(spark, record(authors=[author(affiliation_sequences=[1, 2]),
                                       author(pn_given_name="An", given_name="An", affiliation_sequences=[2])],
                              affiliations=[affiliation(), affiliation(affiliation_sequence=2)]))
    assert load.table("publication_author").count() == 2
    linked = (load.table("author_affiliation")
              .join(load.table("publication_author").select(F.col("id").alias("publication_author_id"), "given_name"),
                    "publication_author_id"))
    assert rows(linked, "given_name") == [("A.",), ("A.",)]


def test_authors_without_id_get_no_link(spark):
    load = star(spark, record(authors=[author(author_id=None)]))
    assert rows(load.table("publication_author"), "author_id", "family_name") == [(None, "Miller")]
    assert load.table("author_affiliation").count() == 0


def test_blank_and_missing_names_link(spark):
    load = star(spark, record(authors=[author(pn_given_name=None, given_name=None),
                                       author(pn_given_name=None, given_name="", author_position=2)]))
    assert load.table("author_affiliation").count() == 2


def test_long_affiliation_text_is_cut_after_distinct(spark):
    long = "x" * 800
    text = record()["affiliations"][0]["affiliation_text"]
    load = star(spark, record(affiliations=[
        affiliation(affiliation_text={**text, "affiliation_organization": [long + "a"]}),
        affiliation(affiliation_text={**text, "affiliation_organization": [long + "b"]}),
        affiliation(affiliation_sequence=99999)]))
    df = load.table("publication_affiliation")
    assert rows(df, F.length("institution_name")) == [(750,), (750,), (9,)]
    assert sorted(map(str, (r["sequence_number"] for r in df.collect()))) == ["1", "1", "None"]


def test_runs_do_not_mix(spark):
    feed = frame(spark, record("a")).unionByName(frame(spark, record("a"), run_id=2))
    both = aliases(spark).unionByName(aliases(spark, run_id=2))
    load = star(spark, feed=feed, alias_rows=both)
    for name in BUILDERS:
        counts = {r["run_id"]: r["count"] for r in load.table(name).groupBy("run_id").count().collect()}
        assert counts[1] == counts[2], name
    one = star(spark, record("a"))
    assert load.table("dyad_model").count() == 2 * one.table("dyad_model").count()


def test_ids_go_on_from_the_last_load(spark):
    load = star(spark, record(), last_ids={"publication": 41, "dyad": 7})
    assert rows(load.table("publication"), "id") == [(42,)]
    assert rows(load.table("dyad"), "id", "publication_id") == [(8, 42)]


def test_splitting_and_reordering_input_changes_nothing(spark):
    records = [record(f"e{i}", journal_title=f"J{i % 2}") for i in range(6)]
    first, second = star(spark, *records), star(spark, feed=frame(spark, *records[::-1]).repartition(3))
    for name in BUILDERS:
        assert sorted(map(str, first.table(name).drop("last_updated_date").collect())) == \
            sorted(map(str, second.table(name).drop("last_updated_date").collect())), name


def test_collation_of_the_whole_star(spark):
    records = [record("a"), record("b", journal_publishername="SPRINGER", journal_title="JOURNAL")]
    assert star(spark, *records).table("journal").count() == 2
    kinds = staging.all_kinds(frame(spark, *records), aliases(spark))
    load = StarLoad(spark, kinds, Workspace(spark).keep, collation="UTF8_LCASE")
    assert load.table("publisher").count() == load.table("journal").count() == 1
    assert rows(load.table("publication"), "external_id") == [("a",), ("b",)]
    assert load.table("dyad_model").count() == 4 and load.table("author_affiliation").count() == 2
    assert dict(load.table("publisher").dtypes)["name"] == "string"


def verdict_tables(spark):
    run = control_table(spark, [(1, "ag", "v")], "id bigint, agency string, version string")
    alias = control_table(spark, [(10, 1, 1, 1, "Data"), (11, 1, 2, 1, "D."), (12, 1, 3, 3, "Other")],
                          "id bigint, run_id bigint, alias_id bigint, parent_alias_id bigint, alias string")
    dyad = control_table(spark, [(100, 1, 5, 10, "Data"), (101, 1, 5, 11, "D."), (102, 1, 5, 11, "d"), (103, 1, 6, 12, "o"),
                                 (104, 1, 5, None, "n"), (105, 1, 5, 11, "unreviewed")],
                         "id bigint, run_id bigint, publication_id bigint, dataset_alias_id bigint, mention_candidate string")
    verdicts = control_table(spark, [(1, 1, 100, 1), (1, 2, 100, -1), (1, 1, 101, 0), (1, 1, 102, None), (1, 1, 103, 1),
                                     (1, 1, 104, 1)],
                             "run_id bigint, reviewer_id bigint, dyad_id bigint, agency_dataset_identified smallint")
    return run, alias, dyad, verdicts


def test_stale_verdicts(spark):
    _, _, dyad, verdicts = verdict_tables(spark)
    reloaded = dyad.withColumn("id", F.col("id") + 2)
    assert rows(stale_verdicts(verdicts, reloaded), "run_id", "n_verdicts") == [(1, 3)]
    assert stale_verdicts(verdicts, dyad).count() == 0


def test_validated_dyads(spark):
    got = rows(validated_dyads(*verdict_tables(spark)), "agency", "dataset", "publication_id", "num_identified",
               "num_rejected", "num_uncertain", "num_tbd", "num_distinct_alias", "num_distinct_mention")
    assert got == [("ag", "Data", 5, 1, 1, 1, 1, 2, 3), ("ag", "Other", 6, 1, 0, 0, 0, 1, 1)]


GEO = "q string, address string, city string, state string, country_code string, q_final string"
PLACE = "run_id bigint, id bigint, address string, city string, state string, country_code string"


def test_geo_match_and_backlog(spark):
    geo = geo_append(control_table(spark, [("a", "S 1", "Kiel", None, "de", "x"), ("b", "S 2", "Kiel", "", "de", None),
                                           ("a", "S 1", "Kiel", None, "de", "x")], GEO))
    assert sorted(r["id"] for r in geo.collect()) == [1, 2, 3]
    places = control_table(spark, [(1, 1, "S 1", "Kiel", "", "de"), (1, 2, "S|2", "Kiel", None, "de"),
                                   (1, 3, "S|2", "Kiel", "", "de"), (1, 4, None, "Rom", None, "xx")], PLACE)
    none = control_table(spark, [], "publication_affiliation_id bigint, affiliation_geo_id bigint")
    pairs = geo_match(places, geo, none)
    assert [r["publication_affiliation_id"] for r in pairs.collect()] == [1, 1]
    known = pairs.limit(1).drop("run_id")
    assert geo_match(places, geo, Workspace(spark).keep("known", known)).count() == 1
    countries = control_table(spark, [("de", "Germany")], "country_code string, country_name string")
    assert rows(geo_backlog(places, countries, geo), "address", "q") == [("S|2", "S,2,Kiel,Germany"), (None, "Rom")]


def test_geo_match_splits_a_repeated_address(spark):
    """Blank addresses on both sides: all their pairs, in tasks of about a cell each."""
    blank = [F.lit("" if c == "city" else None).cast("string").alias(c) for c in ("address", "city", "state", "country_code")]
    places = spark.range(20_000).select(F.lit(1).alias("run_id"), "id", *blank)
    named = spark.range(20_000, 20_100).select(F.lit(1).alias("run_id"), "id", F.concat(F.lit("S "), "id").alias("address"), *blank[1:])
    geo = spark.range(3_000).select("id", F.lit("q").alias("q_final"), *blank)
    geo = geo.unionByName(named.select("id", F.lit("q").alias("q_final"), "address", "city", "state", "country_code"))
    none = control_table(spark, [], "publication_affiliation_id bigint, affiliation_geo_id bigint")
    pairs = geo_match(places.unionByName(named), geo, none)
    assert pairs.count() == 20_000 * 3_000 + 100
    known = spark.range(20_000).crossJoin(spark.range(2).withColumnRenamed("id", "affiliation_geo_id")).select(
        F.col("id").alias("publication_affiliation_id"), "affiliation_geo_id")
    assert geo_match(places.where("id < 3000"), geo, known).count() == 3_000 * 2_998


def test_ordered_agg(spark):
    df = spark.range(2500).select((F.col("id") % 2).alias("k"), "id", F.col("id").cast("string").alias("v"))
    flags = {"n": ("count_if", F.col("id") > 10), "last": ("max", F.col("id")), "first": ("min", F.col("id")),
             "all": ("bool_and", F.col("id") >= 0), "some": ("bool_or", F.col("id") == 700), "sum": ("sum", F.col("id"))}
    whole = ordered_agg(df, ["k"], "v", "id", flags)
    chunked = ordered_agg(df, ["k"], "v", "id", flags, chunk=F.floor(F.col("id") / 100))
    assert rows(whole, "k", "joined", *flags) == rows(chunked, "k", "joined", *flags)
    assert whole.where("k = 0").first()["joined"].startswith("0,2,4,")


def test_ordered_agg_keeps_null_keys(spark):
    df = spark.range(600).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), F.lit(None).cast("int").alias("j"), "id",
                                 F.col("id").cast("string").alias("v"))
    flags = {"n": ("count_if", F.col("id") > 10)}
    whole = ordered_agg(df, ["k", "j"], "v", "id", flags)
    chunked = ordered_agg(df, ["k", "j"], "v", "id", flags, chunk=F.floor(F.col("id") / 100))
    assert chunked.columns == whole.columns and chunked.count() == 3
    assert sorted(map(str, whole.collect())) == sorted(map(str, chunked.collect()))
