"""Registered queries: every operator on the driver's tables, natural keys instead of surrogate ids in the output."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from checks import adapter
from checks.adapter import AGENCY, table, turn_records
from runstar.operators import analytics, keys, nested, validate
from runstar.operators.keys import dense_id
from runstar.operators.validate import Watched
from runstar.plans import ingest as ingest_plan
from runstar.plans import staging
from runstar.plans.star import BUILDERS, JOBS_AT_A_TIME, StarLoad, load_losses
from runstar.schemas import INPUT_TABLES, TABLES, Column as SpecColumn, Table
from runstar.sources import discover, feed as feed_source, sinks
from runstar.sources.commits import Storage
from runstar.sources.warehouse import Warehouse
from runstar.sources.workspace import Workspace, control_table, size_exchanges
from runstar.streaming.watch import ingest_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@dataclass
class Job:
    """The nested feed of one test folder, written once per Spark application, and the star built from it."""

    space: Workspace
    runs: DataFrame
    feed: DataFrame
    kinds: dict[str, DataFrame]
    star: StarLoad


_JOBS: dict[tuple[str, str], Job] = {}


def job(spark: SparkSession, sf_dir: str) -> Job:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _JOBS:
        space = Workspace(spark)
        size_exchanges(spark, table(spark, sf_dir, "lineitem").count() + table(spark, sf_dir, "orders").count())
        runs = space.keep("runs", adapter.run_keys(spark, sf_dir))
        sinks.open_several(spark)
        feed = space.keep("feed", adapter.nested_feed(spark, sf_dir).join(F.broadcast(runs), ["agency", "version"]), by=["run_id"])
        kinds = staging.all_kinds(feed, adapter.alias_list(spark, sf_dir))
        _JOBS[key] = Job(space, runs, feed, kinds, StarLoad(spark, kinds, lambda n, df: space.keep(f"star_{n}", df)))
    return _JOBS[key]


def _run(df: DataFrame, j: Job, *columns: str | Column) -> DataFrame:
    """Put the run's name in place of its id."""
    named = df.join(j.runs.select("run_id", "version"), "run_id")
    return named.select("version", *columns)


def _double(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


# -- staging ------------------------------------------------------------------------------------------------------

def _staged(kind: str, rows: Callable[[Job], DataFrame], *columns: str) -> None:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return staging.FEED_KINDS[kind](rows(job(spark, sf_dir)), ("version", "eid")).select("version", "eid", *columns)

    build.__name__ = f"stage_{kind}"
    query(build)


_staged("publications", lambda j: j.feed, *staging.PUBLICATION_COLUMNS, "journal_issn_isbn", "tested_expressions",
        "journal_citescore_value")
_staged("dyads", lambda j: j.feed, "alias", "snippet", "alias_id", "fuzzy_score", "is_fuzzy", "model", "score")
_staged("authors", lambda j: j.feed, "author_id", "author_position", "given_name", "family_name", "pn_given_name",
        "pn_family_name", "affiliation_sequences")
_staged("affiliations", lambda j: j.feed, "affiliation_sequence", "affiliation_id", "affiliation_ids",
        "affiliation_normalized", "affiliation_organization", "affiliation_address_part", "country_code",
        "affiliation_state", "affiliation_city", "affiliation_postal_code")
_staged("asjcs", lambda j: j.feed, "asjc", "label")
_staged("ufcs", lambda j: j.feed, "concept_id", "concept_name", "rank", "a_freq")
_staged("topics", lambda j: j.feed, "topic_id", "keywords", "prominence")
_staged("topicclusters", lambda j: j.feed, "keywords", "cluster_id")


@query
def stage_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.datasets(adapter.alias_list(spark, sf_dir), ("version",))


@query
def nested_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations nested per id and flattened again."""
    records = turn_records(spark, sf_dir, F.struct("turn", F.struct("role", "text").alias("message")), "turns")
    rows = nested.explode_normalize(records, "turns", ("conv_id",))
    return rows.select("conv_id", "turn", F.col("`message.role`").alias("role"), F.col("`message.text`").alias("text"))


@query
def struct_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text parsed to a struct, null structs dropped, leaves as columns."""
    events = table(spark, sf_dir, "events")
    props = F.when(F.col("event_type") != "error", F.from_json("props", "k bigint"))
    return nested.struct_normalize(events.withColumn("props", props), "props", ("event_id", "event_type"))


# -- validation ---------------------------------------------------------------------------------------------------

@query
def reconcile_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated and observed documents; one stated year is off by one, and a year without documents is stated."""
    off = (F.col("version") == "F") & (F.col("publication_year") == 1997)
    stated = adapter.stated_years(spark, sf_dir)
    stated = stated.withColumn("expected", F.when(off, F.col("expected") + 1).otherwise(F.col("expected")))
    runs = ["agency", "version"]
    observed = validate.observed_counts(_order_records(spark, sf_dir), "publication_year", "eid", runs)
    return validate.reconcile_counts(stated, observed, [*runs, "publication_year"])


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.lit(AGENCY).alias("agency"), F.col("o_orderstatus").alias("version"),
                         F.year("o_orderdate").alias("publication_year"), F.col("o_orderkey").alias("eid"),
                         "o_orderpriority", "o_totalprice")


@query
def unique_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check_unique(table(spark, sf_dir, "orders"), ["o_orderkey"])


@query
def unique_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def run_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: F is valid, O misstates a year, P has every record of the lowest priority twice."""
    stated = adapter.stated_years(spark, sf_dir)
    off = (F.col("version") == "O") & (F.col("publication_year") == 1998)
    stated = stated.withColumn("expected", F.when(off, F.col("expected") + 1).otherwise(F.col("expected")))
    records = _order_records(spark, sf_dir)
    twice = records.unionByName(records.where("version = 'P' and o_orderpriority = '5-LOW'"))
    return validate.run_verdict(twice, stated)


ORDER_TABLES = {
    "orders": Table((SpecColumn("o_orderkey", "bigint", None, True), SpecColumn("o_orderpriority", "string", 8),
                     SpecColumn("o_orderstatus", "string", 1)), unique=("o_orderkey",), run_scoped=False),
    "lineitem": Table((SpecColumn("l_orderkey", "bigint", None, True), SpecColumn("l_returnflag", "string", 1, True)),
                      {"l_orderkey": "orders"}, unique=("l_orderkey", "l_linenumber"), run_scoped=False)}


@query
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of two flat tables; lines of cancelled-looking orders (status P) have lost their parent."""
    orders = table(spark, sf_dir, "orders").withColumn("id", F.col("o_orderkey"))
    tables = {"orders": orders.where("o_orderstatus <> 'P'"), "lineitem": table(spark, sf_dir, "lineitem")}
    return validate.audit_constraints(tables, ORDER_TABLES, by_run=False)


def _checked(tables: dict[str, DataFrame], specs: dict[str, Table]) -> DataFrame:
    """Every rule that the audit checks, with its violations."""
    spark = next(iter(tables.values())).sparkSession
    rules = control_table(spark, [(n, r) for n in tables for r in validate.checked_rules(n, specs[n], tables)],
                          "table_name string, rule string")
    found = validate.audit_constraints(tables, specs).groupBy("table_name", "rule").agg(F.sum("violations").alias("violations"))
    return rules.join(found, ["table_name", "rule"], "left").na.fill(0, ["violations"])


@query
def star_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked rules and violations of every table of the built star: none are broken."""
    rules = _checked(job(spark, sf_dir).star.all(), TABLES)
    return rules.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_rules"), F.sum("violations").alias("violations"))


@query
def star_audit_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A star with planted faults of all four kinds: null titles, long titles, publishers twice, lost affiliations."""
    star = job(spark, sf_dir).star
    journal = star.table("journal")
    tables = {"publisher": star.table("publisher"), "journal": journal, "publication": star.table("publication"),
              "publication_author": star.table("publication_author"), "author": star.table("author"),
              "publication_affiliation": star.table("publication_affiliation"), "author_affiliation": star.table("author_affiliation")}
    tables["publisher"] = tables["publisher"].unionByName(tables["publisher"].withColumn("id", F.col("id") + 1_000_000))
    tables["journal"] = journal.withColumn("title", F.when(F.col("title") != "MACHINERY", F.col("title")))
    low = F.col("title").startswith("5-LOW")
    tables["publication"] = tables["publication"].withColumn("title", F.when(low, F.repeat("title", 100)).otherwise(F.col("title")))
    tables["publication_affiliation"] = tables["publication_affiliation"].where("sequence_number % 2 = 0")
    return _checked(tables, TABLES).where("violations > 0")


# -- star ---------------------------------------------------------------------------------------------------------

@query
def dim_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(j.star.table("dataset_alias"), j, "alias_id", "parent_alias_id", "alias", "alias_type")


@query
def dim_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seeded models and the number of staged scores of each."""
    j = job(spark, sf_dir)
    used = j.kinds["dyads"].groupBy(F.col("model").alias("name")).agg(F.count("score").alias("n_scores"))
    return j.star.table("model").join(used, "name", "left").select("name", F.coalesce("n_scores", F.lit(0)).alias("n_scores"))


@query
def dim_publisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(j.star.table("publisher"), j, "name", "external_id")


def _journals(j: Job) -> DataFrame:
    publisher = j.star.table("publisher").select(F.col("id").alias("publisher_id"), F.col("name").alias("publisher"))
    return j.star.table("journal").join(publisher, "publisher_id", "left")


@query
def dim_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(_journals(j), j, "publisher", "title", "external_id", "cite_score")


@query
def bridge_issn(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    journals = _journals(j).withColumnRenamed("id", "journal_id").drop("run_id")
    return _run(j.star.table("issn").join(journals, "journal_id"), j, "publisher", "title", "cite_score", "issn")


@query
def fact_publication(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    journals = _journals(j).select(F.col("id").alias("journal_id"), "publisher", F.col("title").alias("journal"), "cite_score")
    return _run(j.star.table("publication").join(journals, "journal_id"), j, F.col("external_id").alias("eid"), "title",
                "doi", "year", "month", "pub_type", "citation_count", "fw_citation_impact", "tested_expressions",
                "journal", "publisher", "cite_score")


def _with_eid(j: Job, name: str) -> DataFrame:
    eids = j.star.table("publication").select(F.col("id").alias("publication_id"), F.col("external_id").alias("eid"))
    return j.star.table(name).join(eids, "publication_id")


@query
def fact_dyad(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    alias = j.star.table("dataset_alias").select(F.col("id").alias("dataset_alias_id"), F.col("alias").alias("dataset"))
    rows = _with_eid(j, "dyad").join(alias, "dataset_alias_id", "left")
    return _run(rows, j, "eid", "dataset", "alias_id", "mention_candidate", "snippet", "is_fuzzy", _double("fuzzy_score"))


@query
def fact_dyad_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    model = j.star.table("model").select(F.col("id").alias("model_id"), F.col("name").alias("model"))
    dyad = _with_eid(j, "dyad").select(F.col("id").alias("dyad_id"), "eid", "alias_id", "mention_candidate", "snippet",
                                       "is_fuzzy")
    rows = j.star.table("dyad_model").join(dyad, "dyad_id").join(model, "model_id")
    return _run(rows, j, "eid", "alias_id", "mention_candidate", "snippet", "is_fuzzy", "model", _double("score"))


@query
def dim_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(j.star.table("topic"), j, "keywords", "external_topic_id", _double("prominence"))


@query
def bridge_pub_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    topic = j.star.table("topic").select(F.col("id").alias("topic_id"), "external_topic_id", "keywords")
    rows = _with_eid(j, "publication_topic").join(topic, "topic_id")
    return _run(rows, j, "eid", "external_topic_id", "keywords", _double("score"))


@query
def bridge_pub_ufc(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(_with_eid(j, "publication_ufc"), j, "eid", "concept_id", "concept_name", "rank", "a_freq")


@query
def dim_asjc(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(j.star.table("asjc"), j, "code", "label")


@query
def bridge_pub_asjc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats kept: the number of equal rows is part of the result."""
    j = job(spark, sf_dir)
    asjc = j.star.table("asjc").select(F.col("id").alias("asjc_id"), "code", "label")
    rows = _run(_with_eid(j, "publication_asjc").join(asjc, "asjc_id"), j, "eid", "code", "label")
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def dim_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(j.star.table("author"), j, "external_id", "given_name", "family_name")


def _authors(j: Job) -> DataFrame:
    author = j.star.table("author").select(F.col("id").alias("author_id"), F.col("external_id").alias("author"))
    return _with_eid(j, "publication_author").join(author, "author_id", "left")


@query
def bridge_pub_author(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    return _run(_authors(j), j, "eid", "author", "given_name", "family_name", "author_position")


@query
def bridge_pub_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    sequence = F.col("sequence_number").cast("int").alias("sequence_number")
    return _run(_with_eid(j, "publication_affiliation"), j, "eid", sequence, "external_id", "institution_name",
                "address", "city", "state", "country_code", "postal_code")


@query
def bridge_author_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = job(spark, sf_dir)
    author = _authors(j).select(F.col("id").alias("publication_author_id"), "eid", "author", "given_name", "author_position")
    affiliation = j.star.table("publication_affiliation").select(
        F.col("id").alias("publication_affiliation_id"), F.col("external_id").alias("affiliation"),
        F.col("sequence_number").cast("int").alias("sequence_number"))
    rows = (j.star.table("author_affiliation").join(author, "publication_author_id")
             .join(affiliation, "publication_affiliation_id"))
    return _run(rows, j, "eid", "author", "given_name", "author_position", "affiliation", "sequence_number")


@query
def star_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the join rules dropped or repeated."""
    j = job(spark, sf_dir)
    tables = {name: j.star.table(name) for name in ("publication", "asjc")}
    return _run(load_losses(j.kinds, tables), j, "publications_dropped", "publications_repeated", "asjc_rows_lost")


@query
def star_id_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct ids, lowest and highest id of every built table."""
    tables = job(spark, sf_dir).star.all()
    rows = None
    for name in BUILDERS:
        stats = _id_stats(tables[name], name)
        rows = stats if rows is None else rows.unionByName(stats)
    return rows


def _id_stats(df: DataFrame, name: str) -> DataFrame:
    ids = df.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(F.lit(name).alias("table_name"), F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids"),
                   F.min("id").alias("first_id"), F.max("id").alias("last_id"))


@query
def canonical_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest text per language and source; the texts themselves do not travel."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", F.length(F.rtrim("text")).alias("length"))
    return keys.canonical_pick(docs, ["lang", "source"], [F.col("length").desc_nulls_last(), F.col("doc_id").asc()])


@query
def id_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _id_stats(dense_id(table(spark, sf_dir, "part").distinct()), "part")


@query
def id_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids for rows that repeat: every copy of a (flag, status) pair has its own."""
    pairs = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("copies"))
    rows = dense_id(pairs, copies="copies")
    return (rows.groupBy("l_returnflag", "l_linestatus")
                .agg(F.count(F.lit(1)).alias("n_rows"), (F.max("id") - F.min("id") + 1).alias("id_span")))


# -- run and table lifecycle --------------------------------------------------------------------------------------

def _order_publications(orders: DataFrame, runs: DataFrame, start: int) -> DataFrame:
    rows = orders.select(
        F.col("o_orderstatus").alias("version"), F.col("o_orderkey").cast("string").alias("external_id"),
        F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("title"),
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    rows = rows.join(runs.select("run_id", "version"), "version").drop("version")
    numbered = dense_id(rows, start=start)
    spec = TABLES["publication"]
    return numbered.select(*[F.col(c) if c in numbered.columns else F.lit(None).alias(c) for c in spec.schema.names]
                           ).to(spec.schema)


def _load_orders(w: Warehouse, orders: DataFrame, if_exists: str = "replace") -> DataFrame:
    """Publications of the runs in ``orders``; returns the admitted and refused runs."""
    spark = w.spark
    wanted = orders.select(F.lit(AGENCY).alias("agency"), F.col("o_orderstatus").alias("version"), F.lit(False).alias("force")).distinct()
    admitted = ingest_plan.admit_runs(w, wanted, if_exists)
    decided = control_table(spark, admitted.collect(), admitted.schema)  # one row per run
    runs = w.register(decided.where("reason is null"))
    load_id, since = w.start_load(), w.position()
    watch = Watched("publication", TABLES["publication"])
    w.write_table(load_id, "publication", _order_publications(orders, runs, w.last_ids().get("publication", 0)), watch)
    w.publish(load_id, runs, {"publication": watch.rows}, {"publication": watch.last_id}, since)
    return decided


def _warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, Workspace(spark).path("warehouse"))


def _run_years(w: Warehouse) -> DataFrame:
    runs = w.runs().select(F.col("id").alias("run_id"), "version")
    rows = w.table("publication").join(runs, "run_id")
    return rows.groupBy("version", "year").agg(F.count(F.lit(1)).alias("documents"), F.count_distinct("id").alias("n_ids"))


@query
def run_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs, then run O again with its dear orders only, then all of run F again."""
    orders, w = table(spark, sf_dir, "orders"), _warehouse(spark)
    _load_orders(w, orders)
    _load_orders(w, orders.where("o_orderstatus = 'O' and o_totalprice > 100000"))
    _load_orders(w, orders.where("o_orderstatus = 'F'"))
    return _run_years(w)


@query
def ingest_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two writers on one warehouse by turns: one loads F, the other O and F again, the first P and O's dear orders, the other
    deletes P, the first loads it again."""
    orders, w = table(spark, sf_dir, "orders"), _warehouse(spark)
    other = Warehouse(spark, w.root)
    _load_orders(w, orders.where("o_orderstatus = 'F'"))
    _load_orders(other, orders.where("o_orderstatus in ('F', 'O')"))
    _load_orders(w, orders.where("o_orderstatus = 'P' or (o_orderstatus = 'O' and o_totalprice > 100000)"))
    other.delete_run(AGENCY, "P")
    _load_orders(w, orders.where("o_orderstatus = 'P'"))
    return _run_years(other)


@query
def run_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs, run P deleted, an unknown run deleted, run F deleted and loaded again."""
    orders, w = table(spark, sf_dir, "orders"), _warehouse(spark)
    _load_orders(w, orders)
    w.delete_run(AGENCY, "P")
    w.delete_run(AGENCY, "no such run")
    w.delete_run(AGENCY, "F")
    _load_orders(w, orders.where("o_orderstatus = 'F'"))
    return _run_years(w)


@query
def run_fail_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs F and O exist; loading everything in fail mode adds run P only."""
    orders, w = table(spark, sf_dir, "orders"), _warehouse(spark)
    _load_orders(w, orders.where("o_orderstatus <> 'P'"))
    outcome = _load_orders(w, orders.withColumn("o_totalprice", F.lit(0.0)), if_exists="fail")
    counts = _run_years(w).groupBy("version").agg(F.sum("documents").alias("documents"))
    return outcome.join(counts, "version", "left").select("version", "reason", "documents")


@query
def tables_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table: created, loaded, all but the publications emptied, all emptied, loaded again, dropped."""
    orders, w = table(spark, sf_dir, "orders"), _warehouse(spark)
    w.create_tables()
    steps = [_table_rows(w, "created")]
    _load_orders(w, orders)
    w.add_input("affiliation_geocoding", table(spark, sf_dir, "nation").select(F.col("n_name").alias("q")))
    steps.append(_table_rows(w, "loaded"))
    w.empty_tables(keep=["publication", "model"])
    steps.append(_table_rows(w, "kept"))
    w.empty_tables()
    steps.append(_table_rows(w, "emptied"))
    _load_orders(w, orders)
    steps.append(_table_rows(w, "again"))
    steps = [control_table(spark, s.collect(), s.schema) for s in steps]  # one row per table: their files go next
    w.drop_tables()
    steps.append(_table_rows(w, "dropped"))
    return reduce(DataFrame.unionByName, steps)


def _table_rows(w: Warehouse, step: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(step).alias("step"), F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, df in w.tables().items()])


# -- discovery, sources, sinks ------------------------------------------------------------------------------------

def _page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses as object keys: host, language and number."""
    path = F.regexp_extract("url", "^https?://([^/]+/[^/]+/[0-9]+)", 1)
    return table(spark, sf_dir, "pages").select(path.alias("key"), F.length("html").alias("length"))


@query
def discover_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing against a ledger that knows the secure pages; runs on example.org hosts in English are flagged."""
    listing = _page_listing(spark, sf_dir)
    known = table(spark, sf_dir, "pages").where(F.col("url").startswith("https:"))
    ledger = known.select(F.regexp_extract("url", "^https?://([^/]+/[^/]+/[0-9]+)", 1).alias("key"))
    updated = discover.changed_runs(discover.new_objects(listing, ledger))
    flagged = discover.changed_runs(listing).where(F.col("agency").endswith("example.org") & (F.col("version") == "en"))
    return discover.work_list(updated, flagged)


@query
def discover_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs below a prefix whose text comes again in agency names and in folders below the run."""
    name = F.regexp_extract("url", "^https?://([^/]+/[^/]+)/[0-9]+", 1)
    path = F.concat(F.lit("s3a://pages.net/net/"), name, F.lit("/net/"), F.col("page_id").cast("string"))
    listing = table(spark, sf_dir, "pages").where(name != "").select(discover.relative_key(path, "s3a://pages.net/net/").alias("key"))
    return discover.changed_runs(listing)


@query
def discover_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With overwrite every run is changed, whatever the ledger knows."""
    listing = _page_listing(spark, sf_dir)
    return discover.changed_runs(discover.new_objects(listing, listing, overwrite=True))


@query
def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing of a written feed: runs with the number of publication files and metadata files."""
    base = written_feed(spark, sf_dir)
    keys_seen = discover.list_objects(spark, base)
    found = ingest_plan.presence(keys_seen)
    return found.select("agency", "version", "has_feed", "has_metadata")


def written_feed(spark: SparkSession, sf_dir: str, versions: tuple[str, ...] = ()) -> str:
    """The nested feed in the run layout, gzip JSON lines and metadata, written once per application."""
    j = job(spark, sf_dir)
    base = j.space.path("layout")
    written = _LAYOUTS.setdefault(base, set())
    aliases = adapter.alias_list(spark, sf_dir)
    years = adapter.stated_years(spark, sf_dir).withColumnRenamed("expected", "documents")
    missing = [r for r in j.runs.collect() if r["version"] not in written]  # one row per run

    def write(run: Row) -> None:
        here, version = F.col("version") == run["version"], run["version"]
        feed = j.feed.where(F.col("run_id") == run["run_id"])  # the files of this run
        feed_source.write_run(feed, aliases.where(here), years.where(here), base, AGENCY, version)
        written.add(version)

    with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
        list(pool.map(write, missing))
    return base


_LAYOUTS: dict[str, set[str]] = {}


@query
def scan_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzip JSON lines of all runs read back, agency and version from the path."""
    base = written_feed(spark, sf_dir)
    feed = feed_source.read_feed(spark, f"{base}/*/*/{feed_source.PUBLICATION_FILES}")
    lines = F.greatest(F.coalesce(F.size("authors"), F.lit(0)), F.lit(0))
    record = ["agency", "version", "eid", "doi", "publication_year", "field_weighted_citation_impact"]
    return feed.groupBy(*record).agg(F.sum(lines).alias("n_lines"))


@query
def scan_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stated years of all runs read back from their metadata documents."""
    base = written_feed(spark, sf_dir)
    metadata = feed_source.read_metadata(spark, f"{base}/*/*/{feed_source.METADATA_FILE}")
    return feed_source.expected_years(metadata)


def _warehouse_counts(w: Warehouse) -> DataFrame:
    runs = w.runs().select(F.col("id").alias("run_id"), "version")
    rows = None
    for name in BUILDERS:
        counts = w.table(name).groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"))
        counts = counts.select("run_id", F.lit(name).alias("table_name"), "n_rows")
        rows = counts if rows is None else rows.unionByName(counts)
    return rows.join(runs, "run_id").select("version", "table_name", "n_rows")


@dataclass
class Loaded:
    """A warehouse with all runs of one test folder, loaded once per Spark application."""

    warehouse: Warehouse
    outcome: DataFrame


_LOADED: dict[tuple[str, str], Loaded] = {}


def loaded(spark: SparkSession, sf_dir: str) -> Loaded:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        w = _warehouse(spark)
        _LOADED[key] = Loaded(w, ingest_plan.ingest(spark, written_feed(spark, sf_dir), w))
    return _LOADED[key]


@query
def ingest_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from gzip files to visible tables, three runs in one load: rows per run and table."""
    return _warehouse_counts(loaded(spark, sf_dir).warehouse)


@query
def ingest_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publications of that load with their journals."""
    w = loaded(spark, sf_dir).warehouse
    runs = w.runs().select(F.col("id").alias("run_id"), "version")
    publisher = w.table("publisher").select(F.col("id").alias("publisher_id"), F.col("name").alias("publisher"))
    journals = w.table("journal").join(publisher, "publisher_id", "left").select(
        F.col("id").alias("journal_id"), "publisher", F.col("title").alias("journal"), "cite_score")
    return (w.table("publication").join(runs, "run_id").join(journals, "journal_id").select(
        "version", F.col("external_id").alias("eid"), "title", "doi", "year", "month", "pub_type", "citation_count",
        "fw_citation_impact", "tested_expressions", "journal", "publisher", "cite_score"))


@query
def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load log says of each run: outcome, publications dropped and repeated, codes lost."""
    log = loaded(spark, sf_dir).warehouse.load_log()
    return log.select("version", "status", "reason", "publications_dropped", "publications_repeated", "asjc_rows_lost",
                      "stale_verdicts")


@query
def ingest_streamed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load driven by a file stream."""
    base = written_feed(spark, sf_dir)
    space = Workspace(spark)
    w = Warehouse(spark, space.path("warehouse"))
    ingest_stream(spark, base, w, space.path("checkpoint")).awaitTermination()
    return _warehouse_counts(w)


def _truncated_run(spark: SparkSession, base: str, source: str, target: str) -> None:
    """A run whose only publication file is the first half of one of another run's."""
    folder = f"{base}/{AGENCY}/{source}/json/publications"
    name = discover.list_objects(spark, folder).where(F.col("key").endswith(".gz")).agg(F.min("key")).first()[0]
    data = Storage(spark, folder).read(name)
    Storage(spark, f"{base}/{AGENCY}/{target}/json/publications").write("part.json.gz", data[:len(data) // 2])
    years = spark.createDataFrame([], "publication_year int, documents bigint")
    feed_source.write_metadata(feed_source.no_aliases(spark), years, base, AGENCY, target)


def _faulty_feed(spark: SparkSession, sf_dir: str, base: str, repaired: bool = False) -> None:
    """Publications of the orders as a feed: run F is good, O states a document too many, P has a line of the wrong type."""
    orders = table(spark, sf_dir, "orders")
    records = orders.select(
        F.col("o_orderstatus").alias("version"), F.concat(F.lit("2-s2.0-"), F.col("o_orderkey").cast("string")).alias("eid"),
        F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("publication_title"),
        F.year("o_orderdate").alias("publication_year"), F.col("o_orderstatus").alias("journal_title"),
        F.lit(7).cast("bigint").alias("journal_scopus_source_id"))
    years = records.groupBy("version", "publication_year").agg(F.count(F.lit(1)).alias("documents"))
    off = F.when((F.col("version") == "O") & (F.col("publication_year") == 1998) & (not repaired), 1).otherwise(0)
    years = years.withColumn("documents", F.col("documents") + off)
    wrong = F.when((F.col("version") == "P") & (F.col("publication_year") == 1995) & (not repaired), F.lit("in 1995"))
    records = records.withColumn("publication_year", F.coalesce(wrong, F.col("publication_year").cast("string")))
    typed = F.when(F.col("publication_year").rlike("^[0-9]+$"), F.col("publication_year").cast("int"))
    text = F.when(F.col("publication_year").rlike("[a-z]"), F.col("publication_year"))
    no_alias = feed_source.no_aliases(spark)
    for r in records.select("version").distinct().collect():  # one row per run
        own = records.where(F.col("version") == r["version"])
        folder = f"{base}/{AGENCY}/{r['version']}/json/publications"
        own.where(typed.isNotNull()).withColumn("publication_year", typed).drop("version").write.mode("overwrite").option(
            "compression", "gzip").json(folder)
        if r["version"] == "P":
            own.where(typed.isNull()).withColumn("publication_year", text).drop("version").write.mode("append").option(
                "compression", "gzip").json(folder)
        feed_source.write_metadata(no_alias, years.where(F.col("version") == r["version"]), base, AGENCY, r["version"])


def _outcomes(w: Warehouse, outcome: DataFrame) -> DataFrame:
    runs = w.runs().select(F.col("id").alias("run_id"), "version")
    counts = w.table("publication").join(runs, "run_id").groupBy("version").agg(F.count(F.lit(1)).alias("documents"))
    return outcome.join(counts, "version", "left").select("version", "status", "reason", "documents")


@query
def ingest_isolated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good run, one with wrong counts, one with malformed lines and one with half a gzip file, in one load."""
    base, w = Workspace(spark).path("feed"), _warehouse(spark)
    _faulty_feed(spark, sf_dir, base)
    _truncated_run(spark, base, "F", "truncated")
    found = _outcomes(w, ingest_plan.ingest(spark, base, w))
    return found.withColumn("reason", F.regexp_replace("reason", "^load failed:.*FAILED_READ_FILE(?s).*", "load failed: FAILED_READ_FILE"))


@query
def ingest_streamed_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by stream; then repaired, a run flagged by another writer, and started again. Outcomes of all loads in the log."""
    space = Workspace(spark)
    base, w = space.path("feed"), _warehouse(spark)
    _faulty_feed(spark, sf_dir, base)
    ingest_stream(spark, base, w, space.path("checkpoint")).awaitTermination()
    _faulty_feed(spark, sf_dir, base, repaired=True)
    Warehouse(spark, w.root).request_reload(AGENCY, "F")
    ingest_stream(spark, base, w, space.path("checkpoint")).awaitTermination()
    last = w.load_log().groupBy("version").agg(F.max_by("status", "at").alias("status"), F.max_by("reason", "at").alias("reason"))
    return _outcomes(w, last)


@query
def staging_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine kinds written by run and read back by their visible loads: rows per run, and a sum of hashes of their values."""
    j = job(spark, sf_dir)
    w = _warehouse(spark)
    kinds = _kinds(spark, sf_dir, ("run_id", "agency", "version", "eid"))
    load_id = w.start_load()
    for name, rows in kinds.items():
        w.write_staging(load_id, name, rows, dealt=name in staging.FEED_KINDS)  # the feed's files hold one run each
    w.publish(load_id, j.runs, {}, {})
    return _kind_contents({n: w.staging(n, df.schema) for n, df in kinds.items()})


def _kinds(spark: SparkSession, sf_dir: str, keys: tuple[str, ...]) -> dict[str, DataFrame]:
    """The nine kinds, with snippets that hold a line break, quotes, a comma and a backslash."""
    kinds = staging.all_kinds(job(spark, sf_dir).feed, adapter.alias_list(spark, sf_dir), keys)
    marked = F.concat("snippet", F.lit('\n"quoted", \\'))
    return kinds | {"dyads": kinds["dyads"].withColumn("snippet", marked)}


#: What is compared of each kind beside its key: all but floating numbers.
CONTENT = {
    "publications": ("doi", "publication_title", "publication_type", "publication_year", "publication_month", "citation_count",
                     "journal_publishername", "journal_title", "journal_scopus_source_id", "journal_issn_isbn", "tested_expressions"),
    "dyads": ("alias", "snippet", "alias_id", "is_fuzzy", "model"),
    "authors": ("author_id", "author_position", "given_name", "family_name", "pn_given_name", "pn_family_name",
                "affiliation_sequences"),
    "affiliations": ("affiliation_sequence", "affiliation_id", "affiliation_ids", "affiliation_normalized",
                     "affiliation_organization", "affiliation_address_part", "country_code", "affiliation_state",
                     "affiliation_city", "affiliation_postal_code"),
    "asjcs": ("asjc", "label"), "ufcs": ("concept_id", "concept_name"), "topics": ("topic_id", "keywords"),
    "topicclusters": ("keywords", "cluster_id"), "datasets": ("alias", "alias_id", "parent_alias_id", "alias_type")}


def _kind_contents(kinds: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, df in kinds.items():
        columns = [*(["eid"] if name != "datasets" else []), *CONTENT[name]]
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in columns])
        value = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
        parts.append(df.groupBy("version").agg(F.lit(name).alias("kind"), F.count(F.lit(1)).alias("n_rows"),
                                               F.sum(value).alias("content")))
    return reduce(DataFrame.unionByName, parts)


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine kinds as CSV and back: rows per run and kind, and a sum of hashes of their values."""
    path = Workspace(spark).root
    kinds = _kinds(spark, sf_dir, ("agency", "version", "eid"))
    sinks.write_csv(kinds, path)
    return _kind_contents({n: sinks.read_csv(spark, f"{path}/{n}", sinks.without_arrays(df).schema) for n, df in kinds.items()})


@query
def csv_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of one flat table through CSV."""
    path = Workspace(spark).root
    sinks.write_csv({"part": table(spark, sf_dir, "part")}, path)
    schema = table(spark, sf_dir, "part").schema
    return sinks.read_csv(spark, f"{path}/part", schema)


@query
def redacted_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run rewritten with cut snippets and read back: documents per year as its metadata states them."""
    base, target = written_feed(spark, sf_dir), Workspace(spark).path("sample")
    runs = [r["version"] for r in job(spark, sf_dir).runs.collect()]  # one row per run
    with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
        list(pool.map(lambda version: feed_source.redact_run(spark, base, target, AGENCY, version), runs))
    feed = feed_source.read_feed(spark, f"{target}/*/*/{feed_source.PUBLICATION_FILES}")
    metadata = feed_source.read_metadata(spark, f"{target}/*/*/{feed_source.METADATA_FILE}")
    longest = F.max(F.array_max(F.transform(F.flatten(F.col("identified_datasets.snippets")), F.length)))
    seen = feed.groupBy("version", "publication_year").agg(F.count(F.lit(1)).alias("documents"), longest.alias("longest_snippet"))
    stated = feed_source.expected_years(metadata).select("version", "publication_year", "expected")
    return seen.join(stated, ["version", "publication_year"], "full_outer")


@query
def preview_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.preview(table(spark, sf_dir, "part"), ["p_partkey", "p_name"])


@query
def view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the visible tables of a warehouse."""
    w = _warehouse(spark)
    _load_orders(w, table(spark, sf_dir, "orders"))
    return w.query("""
        select r.version, p.month, count(*) as documents, count(p.journal_id) as with_journal
          from publication p join agency_run r on r.id = p.run_id group by r.version, p.month""")


@query
def staging_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged kinds by the names of their runs: authors and their publications of each run, by SQL over its views."""
    w, j = loaded(spark, sf_dir).warehouse, job(spark, sf_dir)
    kinds = staging.all_kinds(j.feed, adapter.alias_list(spark, sf_dir), ("run_id", "agency", "version", "eid"))
    names = w.register_staging_views({n: kinds[n].schema for n in ("authors", "publications")})
    try:
        return reduce(DataFrame.unionByName, [spark.sql(f"""
            select p.version, count(*) as n_rows, count(distinct a.author_id) as n_authors
              from `{n}` a join `{n.removesuffix('authors')}publications` p on p.eid = a.eid group by p.version""")
            for n in names if n.endswith("_authors")])
    finally:
        for n in names:
            spark.catalog.dropTempView(n)


@query
def redact_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as records whose snippets are the turns, cut to ten characters inside the record."""
    mention = F.struct("role", "turn", F.array("text").alias("snippets"))
    records = turn_records(spark, sf_dir, mention, "identified_datasets")
    cut = nested.explode_normalize(nested.redact_snippets(records), "identified_datasets", ("conv_id",))
    return cut.select("conv_id", "turn", "role", F.explode("snippets").alias("snippet"))


@query
def redact_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per year as the metadata of the rewritten feed states them."""
    return feed_source.year_counts(job(spark, sf_dir).feed, ("version",))


# -- reports ------------------------------------------------------------------------------------------------------

@query
def validated_dyads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts by return flag; mentions that start with "red" have none, fuzzy ones have an uncertain second one."""
    j = job(spark, sf_dir)
    dyad = j.star.table("dyad")
    flag = (F.when(F.col("snippet") == "A", 1).when(F.col("snippet") == "N", 0).when(F.col("snippet") == "R", -1))
    reviewed = dyad.where(~F.col("mention_candidate").startswith("red"))
    first = reviewed.select("run_id", F.col("id").alias("dyad_id"), F.lit(1).alias("reviewer_id"),
                            flag.cast("smallint").alias("agency_dataset_identified"))
    second = reviewed.where("is_fuzzy").select("run_id", F.col("id").alias("dyad_id"), F.lit(2).alias("reviewer_id"),
                                               F.lit(0).cast("smallint").alias("agency_dataset_identified"))
    runs = j.runs.withColumnRenamed("run_id", "id")
    view = analytics.validated_dyads(runs, j.star.table("dataset_alias"), dyad, first.unionByName(second))
    eids = j.star.table("publication").select(F.col("id").alias("publication_id"), F.col("external_id").alias("eid"))
    return view.join(eids, "publication_id").select(
        "agency", "version", "dataset", "eid", "num_identified", "num_rejected", "num_uncertain", "num_tbd",
        "num_distinct_alias", "num_distinct_mention")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as affiliations, with blank and missing parts in their addresses."""
    rows = (table(spark, sf_dir, "customer")
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    key = F.col("c_custkey")
    address = (F.when(key % 3 == 1, F.concat(F.lit("Dock|"), F.col("c_mktsegment"))).when(key % 3 == 2, F.lit("")))
    return rows.select(
        F.lit(1).cast("bigint").alias("run_id"), key.alias("id"), address.alias("address"), F.col("n_name").alias("city"),
        F.when(key % 4 != 0, F.col("r_name")).alias("state"),
        F.col("c_nationkey").cast("string").alias("country_code"))


def _geocoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geocoder answers, one per distinct address; every fifth country has no final query."""
    addresses = _places(spark, sf_dir).select("address", "city", "state", "country_code").distinct()
    shown = F.concat_ws("/", F.coalesce("address", F.lit("-")), "city", F.coalesce("state", F.lit("-")))
    staged = addresses.select(
        F.concat_ws(",", "city", "state").alias("q"), "address", "city", "state", "country_code",
        F.when(F.col("country_code").cast("int") % 5 != 0, F.col("city")).alias("q_final"), shown.alias("display_name"))
    return analytics.geo_append(staged)


@query
def geo_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geocoded(spark, sf_dir).select("q", "address", "city", "state", "country_code", "q_final", "display_name")


@query
def geo_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affiliations of the furniture trade have their pairs already."""
    geo = Workspace(spark).keep("geo", _geocoded(spark, sf_dir))
    places = _places(spark, sf_dir)
    furniture = table(spark, sf_dir, "customer").where("c_mktsegment = 'FURNITURE'").select(F.col("c_custkey").alias("id"))
    none = control_table(spark, [], "publication_affiliation_id bigint, affiliation_geo_id bigint")
    existing = analytics.geo_match(places.join(furniture, "id", "left_semi"), geo, none)
    pairs = analytics.geo_match(places, geo, existing.drop("run_id"))
    names = geo.select(F.col("id").alias("affiliation_geo_id"), "display_name")
    return pairs.join(names, "affiliation_geo_id").select("publication_affiliation_id", "display_name")


@query
def geo_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    countries = nation.where("n_nationkey <> 3").select(F.col("n_nationkey").cast("string").alias("country_code"),
                                                        F.concat(F.lit("Land "), "n_name").alias("country_name"))
    return analytics.geo_backlog(_places(spark, sf_dir), countries, _geocoded(spark, sf_dir))


@query
def ordered_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles per conversation in the order of turns, and flags; long conversations go through chunks of turns."""
    user = F.col("role") == "user"
    return analytics.ordered_agg(
        table(spark, sf_dir, "conversations"), ["conv_id"], "role", "turn",
        {"n_user": ("sum", F.when(user, 1).otherwise(0)), "last_user_turn": ("max", F.when(user, F.col("turn")))},
        out="roles", chunk=F.floor(F.col("turn") / 1000))


@query
def ordered_roles_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over two keys of which one is null for every third conversation."""
    turns = table(spark, sf_dir, "conversations").withColumn("third", F.when(F.col("conv_id") % 3 != 0, F.col("conv_id") % 3))
    return analytics.ordered_agg(
        turns, ["conv_id", "third"], "role", "turn", {"n_user": ("count_if", F.col("role") == "user")},
        out="roles", chunk=F.floor(F.col("turn") / 2))


@query
def mentions_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct mentions and matched mentions per run and publication year, over the built star."""
    j = job(spark, sf_dir)
    publication = j.star.table("publication").select(F.col("id").alias("publication_id"), "year")
    dyad = j.star.table("dyad").select("run_id", "publication_id", "dataset_alias_id", "mention_candidate")
    pairs = (dyad.join(publication, "publication_id").groupBy("run_id", "year", "mention_candidate")
                 .agg(F.count(F.lit(1)).alias("n"), F.count("dataset_alias_id").alias("linked")))
    years = pairs.groupBy("run_id", "year").agg(
        F.count(F.lit(1)).alias("n_mentions"), F.sum("n").alias("n_dyads"), F.sum("linked").alias("n_linked"))
    return _run(years, j, "year", "n_mentions", "n_dyads", "n_linked")
