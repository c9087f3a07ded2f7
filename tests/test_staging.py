from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from checks import queries
from runstar.functions import address_query, run_prefix
from runstar.operators.nested import explode_normalize, redact_snippets, struct_normalize
from runstar.plans import staging
from runstar.schemas import STAGING_KINDS
from runstar.sources.warehouse import Warehouse
from runstar.sources.workspace import Workspace
from tests.conftest import SF_DIR
from tests.feeds import aliases, frame, record


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_every_kind_builds(spark):
    kinds = staging.all_kinds(frame(spark, record()), aliases(spark))
    assert set(kinds) == set(STAGING_KINDS)
    assert {name: df.count() for name, df in kinds.items()} == {
        "publications": 1, "dyads": 2, "authors": 1, "affiliations": 1, "topics": 1, "topicclusters": 1, "asjcs": 1,
        "ufcs": 1, "datasets": 2}


@pytest.mark.parametrize("value", [None, [], [None]])
def test_missing_arrays_give_no_rows(spark, value):
    feed = frame(spark, record(authors=value, asjcs=value, unified_fingerprint_concepts=value))
    for build in (staging.authors, staging.asjcs, staging.ufcs):
        assert build(feed).count() == 0


def test_leaves_are_dotted_at_every_depth(spark):
    df = spark.sql("select 'k' as eid, array(named_struct('a', 1, 'b', named_struct('c', named_struct('d', 2)))) as x")
    flat = explode_normalize(df, "x")
    assert flat.columns == ["eid", "a", "b.c.d"]
    assert flat.collect()[0] == ("k", 1, 2)


def test_null_structs_are_dropped(spark):
    feed = frame(spark, record("a", topic=None), record("b"))
    assert rows(staging.topics(feed), "eid", "keywords") == [("b", "k1|k2")]
    assert struct_normalize(feed, "topic").count() == 1


def test_publication_encodings(spark):
    feed = frame(spark, record("a"), record("b", journal_issn_isbn=None, expressions=None, journal_citescore=None))
    got = rows(staging.publications(feed), "eid", "journal_issn_isbn", "tested_expressions", "journal_citescore_value")
    assert got == [("a", "1234|5678", '["a b"]', 2.5), ("b", None, None, None)]


def test_feed_without_expressions(spark):
    got = staging.publications(frame(spark, record()).drop("expressions"))
    assert rows(got, "tested_expressions") == [(None,)]


def test_citescore_leaves_pass_through(spark):
    feed = frame(spark, record()).withColumn("journal_citescore", F.expr("named_struct('citescore_value', 1D, 'extra', 'x')"))
    assert rows(staging.publications(feed), "journal_citescore_value", "journal_extra") == [(1.0, "x")]


def mention(**fields):
    return {**record()["identified_datasets"][0], **fields}


def test_mentions_times_snippets_times_models(spark):
    feed = frame(spark, record(identified_datasets=[mention(snippets=["x", "y"])]))
    got = rows(staging.dyads(feed), "alias", "alias_id", "fuzzy_score", "is_fuzzy", "snippet", "model", "score")
    assert got == [("Data A", 11, 0.75, False, s, m, v) for s in "xy" for m, v in (("model1", 0.5), ("model2", 0.25))]


def test_empty_snippets_keep_their_models(spark):
    feed = frame(spark, record(identified_datasets=[mention(snippets=[])]))
    assert rows(staging.dyads(feed), "snippet", "model") == [(None, "model1"), (None, "model2")]


def test_blank_snippets_become_null(spark):
    feed = frame(spark, record(identified_datasets=[mention(snippets=["", "Not Available", " "], models=[])]))
    assert rows(staging.dyads(feed), "snippet", "model") == [(" ", None), (None, None), (None, None)]


def test_missing_models_and_alias(spark):
    feed = frame(spark, record(identified_datasets=[mention(models=None, linked_alias=None)]))
    assert rows(staging.dyads(feed), "alias_id", "is_fuzzy", "model", "score") == [(None, None, None, None)]


def test_extra_mention_leaves_pass_through(spark):
    feed = frame(spark, record()).withColumn(
        "identified_datasets", F.transform("identified_datasets", lambda d: d.withField("extra", F.lit(1))))
    assert "extra" in staging.dyads(feed).columns and "linked_alias.alias" not in staging.dyads(feed).columns


def test_author_without_any_field_is_dropped(spark):
    empty = dict.fromkeys(record()["authors"][0])
    feed = frame(spark, record(authors=[empty, record()["authors"][0]]))
    assert rows(staging.authors(feed), "author_id", "affiliation_sequences") == [(501, "[1]")]


def test_affiliation_encodings(spark):
    full = record()["affiliations"][0]
    feed = frame(spark, record(affiliations=[full, {**full, "affiliation_sequence": 2, "affiliation_ids": []},
                                             {**full, "affiliation_sequence": 3, "affiliation_ids": None}]))
    got = rows(staging.affiliations(feed), "affiliation_sequence", "affiliation_id", "affiliation_ids",
               "affiliation_organization", "affiliation_normalized", "country_code")
    assert got == [(1, 9, "9|8", "Uni, Dept", '["Uni"]', "de"), (2, None, "", "Uni, Dept", '["Uni"]', "de"),
                   (3, None, None, "Uni, Dept", '["Uni"]', "de")]


def test_json_text_keeps_nulls(spark):
    df = spark.sql("select named_struct('a', 1, 'b', cast(null as string)) as s")
    from runstar.functions import json_text
    assert json.loads(df.select(json_text("s")).first()[0]) == {"a": 1, "b": None}


def test_redaction_stays_nested(spark):
    long = "0123456789abc"
    feed = redact_snippets(frame(spark, record(identified_datasets=[mention(snippets=[long, None, "x"])])))
    mentions = feed.first()["identified_datasets"]
    assert mentions[0]["snippets"] == ["0123456789", None, "x"] and mentions[0]["models"][0]["model"] == "model1"
    assert redact_snippets(frame(spark, record(identified_datasets=None))).first()["identified_datasets"] is None


def test_text_functions(spark):
    df = spark.sql("select 'A|B' as a, 'Kiel' as c, cast(null as string) as s, 'Germany' as n, ' two words ' as agency")
    assert df.select(address_query(F.col("a"), F.col("c"), F.col("s"), F.col("n"))).first()[0] == "A,B,Kiel,Germany"
    assert df.select(run_prefix(F.col("agency"), F.lit("v1"))).first()[0] == "two_words_v1_"


def test_a_kept_file_holds_one_run(spark):
    space = Workspace(spark)
    df = spark.range(60).select((F.col("id") % 3).alias("run_id"), F.concat(F.lit("e"), "id").alias("eid"))
    kept = space.keep("feed", df, by=["run_id"])
    assert kept.dtypes == df.dtypes and sorted(kept.collect()) == sorted(df.collect())
    files = kept.select("run_id", F.input_file_name().alias("file")).distinct().collect()
    assert len({r["run_id"] for r in files}) == 3 and len({r["file"] for r in files}) == len(files)


def test_dealt_kinds_are_staged_without_a_shuffle(spark, monkeypatch):
    """Those of the feed: its files hold one run each."""
    seen = {}
    monkeypatch.setattr(Warehouse, "write_staging", lambda self, load_id, kind, rows, dealt=False: seen.update({kind: dealt}))
    monkeypatch.setattr(Warehouse, "staging", lambda self, kind, schema: spark.createDataFrame([], schema))
    queries.staging_sink(spark, SF_DIR)
    assert seen == dict.fromkeys(STAGING_KINDS, True) | {"datasets": False}
