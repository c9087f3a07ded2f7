from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from runstar.operators import validate
from runstar.schemas import TABLES

RUNS = ["agency", "version"]


def feed(spark, *rows):
    return spark.createDataFrame([("a", "v", *r) for r in rows] or [], "agency string, version string, eid string, publication_year int")


def stated(spark, years):
    return spark.createDataFrame([("a", "v", y, n) for y, n in years.items()],
                                 "agency string, version string, publication_year int, expected bigint")


def verdict(spark, rows, years):
    got = validate.run_verdict(feed(spark, *rows), stated(spark, years)).collect()
    return [(r["counts_ok"], r["unique_ok"], r["valid"]) for r in got]


TWO = [("e1", 2020), ("e2", 2021)]


@pytest.mark.parametrize("rows, years, expected", [
    (TWO, {2020: 1, 2021: 1}, (True, True, True)),
    (TWO, {2020: 1, 2021: 1, 3000: 1}, (False, True, False)),  # a stated year without data
    ([*TWO, ("e3", 3000)], {2020: 1, 2021: 1}, (False, True, False)),  # data of a year not stated
    (TWO, {2020: 1, 2021: 1, 3000: 0}, (True, True, True)),  # no documents stated, none there
    ([*TWO, ("e1", 2020)], {2020: 1, 2021: 1}, (True, False, False)),  # a record twice
    ([*TWO, ("e1", 2021)], {2020: 1, 2021: 2}, (True, False, False)),  # twice, in different years
    ([], {2020: 0}, (True, False, False)),  # nothing at all
    ([*TWO, ("e3", None)], {2020: 1, 2021: 1}, (True, True, True)),  # a missing year is not counted
    ([*TWO, (None, 2020)], {2020: 1, 2021: 1}, (True, True, True)),  # a missing id neither
])
def test_verdicts(spark, rows, years, expected):
    assert verdict(spark, rows, years) == [expected]


def test_runs_are_judged_apart(spark):
    data = feed(spark, *TWO).unionByName(feed(spark, *TWO).withColumn("version", F.lit("w")))
    years = stated(spark, {2020: 1, 2021: 1})
    got = {r["version"]: r["valid"] for r in validate.run_verdict(data, years).collect()}
    assert got == {"v": True, "w": False}


def test_require_valid(spark):
    bad = validate.run_verdict(feed(spark, *TWO), stated(spark, {2020: 5}))
    with pytest.raises(validate.ValidationError, match="a_v"):
        validate.require_valid(bad)
    assert validate.require_valid(bad, raise_on_fail=False) is False
    assert validate.require_valid(validate.run_verdict(feed(spark, *TWO), stated(spark, {2020: 1, 2021: 1})))


def test_repeated_keys(spark):
    df = spark.sql("select * from values (1, 'a'), (1, 'a'), (2, 'b'), (null, 'c'), (null, 'c') as t(k, v)")
    assert [tuple(r) for r in validate.repeated_keys(df, ["k", "v"]).collect()] == [(1, "a", 2)]
    once = validate.check_unique(spark.range(3), ["id"]).first()
    assert once["unique_ok"] and not validate.check_unique(spark.range(0), ["id"]).first()["unique_ok"]


def report(df):
    return {(r["table_name"], r["rule"]): r["violations"] for r in df.collect() if r["violations"]}


def test_audit_finds_each_kind_of_violation(spark):
    spec = TABLES
    publisher = spark.createDataFrame([(1, 1, None, "P"), (2, 1, None, "P"), (3, 2, None, "P"), (4, 1, None, None)],
                                      "id bigint, run_id bigint, external_id string, name string")
    journal = spark.createDataFrame([(1, 1, 1, None, None), (2, 1, 99, "x", "T"), (3, 1, None, None, "t" * 1029)],
                                    "id bigint, run_id bigint, publisher_id bigint, external_id string, title string")
    got = report(validate.audit_constraints({"publisher": publisher, "journal": journal}, spec))
    assert got == {("publisher", "unique:run_id,name"): 1, ("journal", "not_null:title"): 1,
                   ("journal", "max_length:title"): 1, ("journal", "reference:publisher_id"): 1}


def test_long_title_is_a_violation(spark):
    df = spark.createDataFrame([(1, 1, "x" * 401)], "id bigint, run_id bigint, title string")
    full = df.select("*", *[F.lit(None).cast(c.type).alias(c.name) for c in TABLES["publication"].columns if c.name != "title"])
    assert report(validate.audit_table("publication", TABLES["publication"], {"publication": full})) == {
        ("publication", "max_length:title"): 1}


def test_audit_of_a_table_with_references_only(spark):
    rows = spark.sql("select 1L id, 1L run_id, 5L publication_author_id, 6L publication_affiliation_id, current_timestamp() last_updated_date")
    none = spark.sql("select 0L id").where("id > 0")
    tables = {"author_affiliation": rows, "publication_author": none, "publication_affiliation": none}
    report = validate.audit_constraints({"author_affiliation": rows, **{k: v.withColumn("run_id", F.lit(1)) for k, v in tables.items() if k not in (
        "author_affiliation",)}}, {"author_affiliation": TABLES["author_affiliation"]})
    assert {(r["rule"], r["violations"]) for r in report.collect()} == {
        ("reference:publication_author_id", 1), ("reference:publication_affiliation_id", 1)}
    assert validate.checked_rules("author_affiliation", TABLES["author_affiliation"], tables) == [
        "reference:publication_author_id", "reference:publication_affiliation_id"]


def test_all_failing_runs_are_named(spark):
    verdict = spark.range(30).select(F.col("id").cast("string").alias("agency"), F.lit("v").alias("version"), F.lit(False).alias("valid"))
    with pytest.raises(validate.ValidationError) as error:
        validate.require_valid(verdict)
    assert str(error.value).count("_v") == 30
