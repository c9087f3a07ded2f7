"""The star build: staged kinds in, final tables out.

Every builder works on all runs of a load at once; ``run_id`` is part of each key. Staged rows are made distinct
before they are joined, so that repeats and hot values shrink in the map tasks. Parents are read from written tables,
which gives Spark their true size when it picks a join, and keeps the lineage short.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runstar.functions import text_length
from runstar.operators.joins import Lookup, bridge, lookup
from runstar.operators.keys import canonical_pick, collate, dense_id, dense_id_in_place, dimension
from runstar.schemas import MODEL_NAMES, TABLES

RUN = {"run_id": "run_id"}
# What a record's children agree in; the children of one record are few.
RECORD = ("run_id", "eid")


def _finish(df: DataFrame, table: str, **columns: Column) -> DataFrame:
    """Project to the final columns, casting to their types; columns not given come from ``df`` by name."""
    spec = TABLES[table]
    cols = [columns.get(c.name, F.col(c.name) if c.name in df.columns else F.lit(None)).cast(c.type).alias(c.name)
            for c in spec.columns]
    return df.select("id", *(["run_id"] if spec.run_scoped else []), *cols)


def _publication(publication: DataFrame) -> Lookup:
    return Lookup(publication, on={**RUN, "eid": "external_id"}, take={"id": "publication_id"}, plain=True)


def model_seed(spark: SparkSession) -> DataFrame:
    names = F.array(*[F.lit(n) for n in MODEL_NAMES])
    rows = spark.range(1).select(F.posexplode(names).alias("pos", "name"))
    return _finish(rows.select((F.col("pos") + 1).cast("bigint").alias("id"), "name"), "model")


def dataset_alias(datasets: DataFrame, start: int = 0) -> DataFrame:
    cols = ["run_id", "alias_id", "parent_alias_id", "alias", "alias_type"]
    counted = datasets.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    return _finish(dense_id(counted, start=start, copies="copies"), "dataset_alias")


def publisher(publications: DataFrame, start: int = 0) -> DataFrame:
    names = dimension(publications, {"run_id": F.col("run_id"), "name": F.col("journal_publishername")})
    return _finish(dense_id(names, start=start), "publisher")


def journal(publications: DataFrame, publisher: DataFrame, start: int = 0) -> DataFrame:
    """Distinct before the score is rounded: rows may look alike afterwards."""
    rows = dimension(publications, {
        "run_id": F.col("run_id"), "publisher": F.col("journal_publishername"), "title": F.col("journal_title"),
        "external_id": F.col("journal_scopus_source_id"), "cite_score": F.col("journal_citescore_value")})
    keyed = lookup(rows, Lookup(publisher, on={**RUN, "publisher": "name"}, take={"id": "publisher_id"}, how="left"))
    return _finish(dense_id(keyed.drop("publisher"), start=start), "journal")


def issn(publications: DataFrame, journal: DataFrame, start: int = 0) -> DataFrame:
    split = publications.select(
        "run_id", "journal_title", F.col("journal_scopus_source_id").cast("string").alias("source"),
        F.explode(F.split("journal_issn_isbn", "[|]")).alias("issn")).where(F.rtrim("issn") != "")
    rows = bridge(split, split.columns, [Lookup(
        journal, on={**RUN, "journal_title": "title", "source": "external_id"}, take={"id": "journal_id"})])
    return _finish(dense_id(rows.select("run_id", "journal_id", "issn"), start=start), "issn")


def publication(publications: DataFrame, journal: DataFrame, publisher: DataFrame, start: int = 0) -> DataFrame:
    """A publication without journal title or source is dropped; it is repeated for each journal row that fits.

    Its publisher is looked up, then its journal, in tables as written: what a join of the two would hold Spark can only guess, far
    too high, and would deal out the publications for it.
    """
    staged = publications.withColumn("source", F.col("journal_scopus_source_id").cast("string"))
    own = ["eid", "publication_title", "doi", "publication_year", "publication_month", "publication_type",
           "citation_count", "field_weighted_citation_impact", "tested_expressions"]
    rows = staged.select("run_id", *own, "journal_title", "source", "journal_publishername")
    rows = lookup(rows, Lookup(publisher, on={**RUN, "journal_publishername": "name"}, take={"id": "publisher_id"}, how="left"))
    rows = lookup(rows, Lookup(journal, on={**RUN, "journal_title": "title", "source": "external_id"},
                               null_safe={"publisher_id": "publisher_id"}, take={"id": "journal_id"}))
    # a journal is of one title, source and publisher, so these need not travel
    return _finish(
        dense_id_in_place(bridge(rows, ["run_id", "journal_id", *own], [], within=RECORD), start=start), "publication",
        external_id=F.col("eid"), title=F.col("publication_title"), year=F.col("publication_year"),
        month=F.col("publication_month"), pub_type=F.col("publication_type"),
        fw_citation_impact=F.col("field_weighted_citation_impact"))


def dyad(dyads: DataFrame, publication: DataFrame, dataset_alias: DataFrame, start: int = 0) -> DataFrame:
    own = ["alias_id", "fuzzy_score", "is_fuzzy", "alias", "snippet"]
    rows = bridge(dyads, ["run_id", "eid", *own], [
        _publication(publication),
        Lookup(dataset_alias, on={**RUN, "alias_id": "alias_id"}, take={"id": "dataset_alias_id"}, how="left")], within=RECORD)
    return _finish(dense_id(rows.drop("eid"), start=start), "dyad", mention_candidate=F.col("alias"))


def dyad_model(dyads: DataFrame, publication: DataFrame, dyad: DataFrame, model: DataFrame,
               start: int = 0) -> DataFrame:
    """Scores find their dyad by publication, alias, mention and snippet; fuzzy fields take no part."""
    rows = bridge(dyads, ["run_id", "eid", "alias_id", "alias", "snippet", "model", "score"], [
        _publication(publication),
        Lookup(model, on={"model": "name"}, take={"id": "model_id"})], within=RECORD)
    # scores of a dyad travel together: their dyad's texts and keys once
    keys = ["run_id", "publication_id", "alias_id", "alias", "snippet"]
    scores = rows.groupBy("run_id", "eid", *keys[1:]).agg(F.collect_list(F.struct("model_id", "score")).alias("scores"))
    found = lookup(scores.select(*keys, "scores"), Lookup(
        dyad, on={**RUN, "publication_id": "publication_id", "alias": "mention_candidate"},
        null_safe={"alias_id": "alias_id", "snippet": "snippet"}, take={"id": "dyad_id"}))
    links = found.select("run_id", "dyad_id", F.inline("scores"))
    return _finish(dense_id(links.select("run_id", "dyad_id", "model_id", "score"), start=start), "dyad_model")


def topic(topics: DataFrame, start: int = 0) -> DataFrame:
    rows = dimension(topics, {c: F.col(c) for c in ("run_id", "keywords", "topic_id", "prominence")})
    return _finish(dense_id(rows, start=start), "topic", external_topic_id=F.col("topic_id"))


def publication_topic(topics: DataFrame, publication: DataFrame, topic: DataFrame, start: int = 0) -> DataFrame:
    staged = topics.withColumn("external_topic_id", F.col("topic_id").cast("string"))
    rows = bridge(staged, ["run_id", "eid", "external_topic_id"], [
        _publication(publication),
        Lookup(topic, on={**RUN, "external_topic_id": "external_topic_id"}, take={"id": "topic_id"})], within=RECORD)
    return _finish(dense_id(rows.select("run_id", "publication_id", "topic_id"), start=start), "publication_topic")


def publication_ufc(ufcs: DataFrame, publication: DataFrame, start: int = 0) -> DataFrame:
    rows = bridge(ufcs, ["run_id", "eid", "concept_id", "concept_name", "rank", "a_freq"], [_publication(publication)], within=RECORD)
    return _finish(dense_id_in_place(rows, start=start), "publication_ufc")


def asjc(asjcs: DataFrame, start: int = 0) -> DataFrame:
    """Text that is no number gives a null code, which the audit reports for the run."""
    rows = dimension(asjcs, {c: F.col(c) for c in ("run_id", "asjc", "label")})
    return _finish(dense_id(rows, start=start), "asjc", code=F.col("asjc").try_cast("bigint"))


def publication_asjc(asjcs: DataFrame, publication: DataFrame, asjc: DataFrame, start: int = 0) -> DataFrame:
    """Keeps repeats. Codes are compared as numbers written out, so leading zeros find no partner."""
    codes = asjc.withColumn("code_text", F.col("code").cast("string"))
    rows = bridge(asjcs, ["run_id", "eid", "asjc"], [
        _publication(publication),
        Lookup(codes, on={**RUN, "asjc": "code_text"}, take={"id": "asjc_id"})], distinct=False, within=RECORD)
    # the copies in a record are few, so they need not be dealt out
    links = rows.select("run_id", "publication_id", "asjc_id", "copies")
    return _finish(dense_id(links, start=start, copies="copies", copies_per_chunk=None), "publication_asjc")


def author(authors: DataFrame, start: int = 0) -> DataFrame:
    """Per author id the longest preferred name; all rows without an id share one author."""
    given, family = F.col("pn_given_name"), F.col("pn_family_name")
    named = authors.where(~(F.col("author_id").isNull() & given.isNull() & family.isNull()))
    names = dimension(named, {c: F.col(c) for c in ("run_id", "author_id", "pn_given_name", "pn_family_name")})
    longest = text_length(F.concat(given, family)).desc_nulls_last()
    picked = canonical_pick(names, ["run_id", "author_id"], [longest, family.asc(), given.asc()])
    return _finish(dense_id(picked, start=start), "author",
                   external_id=F.col("author_id"), given_name=given, family_name=family)


def publication_author(authors: DataFrame, publication: DataFrame, author: DataFrame, start: int = 0) -> DataFrame:
    staged = authors.withColumn("author_key", F.col("author_id").cast("string"))
    own = ["given_name", "family_name", "author_position"]
    rows = bridge(staged, ["run_id", "eid", "author_key", *own], [
        _publication(publication),
        Lookup(author, on={**RUN, "author_key": "external_id"}, take={"id": "author_id"}, how="left")], within=RECORD)
    return _finish(dense_id(rows.drop("eid", "author_key"), start=start), "publication_author")


def publication_affiliation(affiliations: DataFrame, publication: DataFrame, start: int = 0) -> DataFrame:
    """The only table whose texts are cut to their column length, and only after DISTINCT."""
    # Which staged column fills which final one.
    staged = {"affiliation_sequence": "sequence_number", "affiliation_ids": "external_id",
              "affiliation_organization": "institution_name", "affiliation_address_part": "address",
              "affiliation_city": "city", "affiliation_state": "state", "country_code": "country_code",
              "affiliation_postal_code": "postal_code"}
    rows = bridge(affiliations, ["run_id", "eid", *staged], [_publication(publication)], within=RECORD)
    numbered = dense_id_in_place(rows.withColumnsRenamed(staged), start=start)
    cut = {c.name: F.substring(c.name, 1, c.length) for c in TABLES["publication_affiliation"].columns if c.length}
    return _finish(numbered, "publication_affiliation", **cut,
                   sequence_number=F.col("sequence_number").try_cast("smallint"))


def author_affiliation(authors: DataFrame, publication: DataFrame, author: DataFrame, publication_author: DataFrame,
                       publication_affiliation: DataFrame, start: int = 0) -> DataFrame:
    """Links for rows whose preferred name is the canonical one; null and blank names are the same."""
    names = ["pn_given_name", "pn_family_name", "given_name", "family_name"]
    staged = _blank(authors, names).select(
        "run_id", "eid", F.col("author_id").cast("string").alias("author_key"), *names,
        F.explode("affiliation_sequences_arr").alias("sequence"))
    rows = bridge(staged, staged.columns, [
        _publication(publication),
        Lookup(_blank(author, ["given_name", "family_name"]),
               on={**RUN, "author_key": "external_id", "pn_given_name": "given_name", "pn_family_name": "family_name"},
               take={"id": "author_id"}),
        Lookup(_blank(publication_author, ["given_name", "family_name"]),
               on={**RUN, "publication_id": "publication_id", "author_id": "author_id", "given_name": "given_name",
                   "family_name": "family_name"},
               take={"id": "publication_author_id"}),
        Lookup(publication_affiliation,
               on={**RUN, "publication_id": "publication_id", "sequence": "sequence_number"},
               take={"id": "publication_affiliation_id"})], within=RECORD)
    links = rows.select("run_id", "publication_author_id", "publication_affiliation_id")
    return _finish(dense_id(links, start=start), "author_affiliation")


def _blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})


# table: (builder, staged kinds, parent tables), in load order
BUILDERS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], tuple[str, ...]]] = {
    "dataset_alias": (dataset_alias, ("datasets",), ()),
    "publisher": (publisher, ("publications",), ()),
    "journal": (journal, ("publications",), ("publisher",)),
    "issn": (issn, ("publications",), ("journal",)),
    "publication": (publication, ("publications",), ("journal", "publisher")),
    "dyad": (dyad, ("dyads",), ("publication", "dataset_alias")),
    "dyad_model": (dyad_model, ("dyads",), ("publication", "dyad", "model")),
    "topic": (topic, ("topics",), ()),
    "publication_topic": (publication_topic, ("topics",), ("publication", "topic")),
    "publication_ufc": (publication_ufc, ("ufcs",), ("publication",)),
    "asjc": (asjc, ("asjcs",), ()),
    "publication_asjc": (publication_asjc, ("asjcs",), ("publication", "asjc")),
    "author": (author, ("authors",), ()),
    "publication_author": (publication_author, ("authors",), ("publication", "author")),
    "publication_affiliation": (publication_affiliation, ("affiliations",), ("publication",)),
    "author_affiliation": (author_affiliation, ("authors",), ("publication", "author", "publication_author",
                                                              "publication_affiliation")),
}


# Tables that do not need each other, but for the last two, which are large; a level needs the levels before it.
LEVELS = (
    ("publisher", "author", "dataset_alias", "topic", "asjc"),
    ("journal",),
    ("publication", "issn"),
    ("dyad", "publication_author", "publication_affiliation", "publication_asjc", "publication_ufc",
     "publication_topic"),
    ("author_affiliation",),
    ("dyad_model",))
# Tables whose rows are as many as the staged ones, or some of them: those of records.
OF_RECORDS = frozenset(t for level in LEVELS[2:] for t in level if t != "issn")
# Jobs at a time: small tables need not wait for large ones. Of those that build tables fewer: the exchanges of each take up disk
# until it is written.
JOBS_AT_A_TIME, BUILDS_AT_A_TIME = 4, 2


class StarLoad:
    """Builds final tables on demand, parents first. ``write`` stores a table and returns it as read back.

    ``collation`` (``UTF8_LCASE`` ignores case) governs DISTINCT and joins; by default texts are equal byte by byte.
    """

    def __init__(self, spark: SparkSession, kinds: Mapping[str, DataFrame],
                 write: Callable[[str, DataFrame], DataFrame], last_ids: Mapping[str, int] | None = None,
                 collation: str | None = None):
        self._kinds, self._write, self._last_ids, self._collation = kinds, write, last_ids or {}, collation
        self._tables: dict[str, DataFrame] = {"model": model_seed(spark)}
        # One time for the whole load, and a plain value, so that a task that runs again writes the same.
        self._stamp = spark.sql("select current_timestamp() as t").first()["t"]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            build, kinds, parents = BUILDERS[name]
            inputs = [collate(df, self._collation) for df in
                      [*[self._kinds[k] for k in kinds], *[self.table(p) for p in parents]]]
            rows = build(*inputs, start=self._last_ids.get(name, 0))
            if TABLES[name].stamped:
                rows = rows.withColumn("last_updated_date", F.lit(self._stamp))
            self._tables[name] = self._write(name, rows)
        return self._tables[name]

    def all(self) -> dict[str, DataFrame]:
        with ThreadPoolExecutor(BUILDS_AT_A_TIME) as pool:
            for level in LEVELS:
                list(pool.map(self.table, level))
        return {name: self.table(name) for name in TABLES}


def load_losses(kinds: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per run, what the join rules dropped or repeated: counters that the load itself does not show."""
    publication = tables["publication"]
    ids = publication.groupBy("run_id", F.col("external_id").alias("eid")).agg(F.count(F.lit(1)).alias("n"))
    staged = kinds["publications"].select("run_id", "eid").distinct()
    matched = staged.join(ids, ["run_id", "eid"], "left")
    fates = matched.groupBy("run_id").agg(
        F.count_if(F.col("n").isNull()).alias("publications_dropped"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("publications_repeated"))
    codes = tables["asjc"].select("run_id", F.col("code").cast("string").alias("asjc")).distinct()
    # Few distinct codes: count rows per code first, then look for a partner.
    used = kinds["asjcs"].groupBy("run_id", "asjc").agg(F.count(F.lit(1)).alias("n"))
    lost = (used.join(codes, ["run_id", "asjc"], "left_anti")
                .groupBy("run_id").agg(F.sum("n").alias("asjc_rows_lost")))
    return fates.join(lost, "run_id", "left").withColumn("asjc_rows_lost", F.coalesce("asjc_rows_lost", F.lit(0)))
