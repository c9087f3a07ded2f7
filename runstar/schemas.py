"""Feed, staging and final schemas."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Field names and types of one feed record.
FEED_SCHEMA = """
    eid string, doi string, publication_title string, publication_type string,
    publication_year int, publication_month int, citation_count int, field_weighted_citation_impact double,
    journal_publishername string, journal_title string, journal_scopus_source_id bigint,
    journal_issn_isbn array<string>,
    journal_citescore struct<citescore_value: double>,
    expressions array<string>,
    identified_datasets array<struct<
        identified_dataset_name: string, snippets: array<string>,
        models: array<struct<model: string, score: double>>,
        linked_alias: struct<alias: string, alias_id: bigint, fuzzy_score: double, is_fuzzy: boolean>>>,
    authors array<struct<
        author_id: bigint, author_position: int, given_name: string, family_name: string,
        pn_given_name: string, pn_family_name: string, affiliation_sequences: array<int>>>,
    affiliations array<struct<
        affiliation_sequence: int, affiliation_ids: array<bigint>, affiliation_normalized: array<string>,
        affiliation_text: struct<
            affiliation_organization: array<string>, affiliation_address_part: string, country_code: string,
            affiliation_state: string, affiliation_city: string, affiliation_postal_code: string>>>,
    asjcs array<struct<asjc: string, label: string>>,
    topic struct<topic_id: bigint, keywords: array<string>, prominence: double>,
    topic_cluster struct<keywords: array<string>, cluster_id: bigint>,
    unified_fingerprint_concepts array<struct<
        concept_id: bigint, concept_name: string, rank: double, a_freq: int>>
"""

# The parts of the export metadata document that are read.
METADATA_SCHEMA = """
    stats struct<
        overall: struct<unique_documents_per_year: array<struct<publication_year: int, documents: bigint>>>,
        documents_per_alias: array<struct<
            alias_id: bigint, alias: string, parent_alias_id: bigint, alias_type: string>>>
"""

# The nine staging kinds, the model names of the seed, and the texts that mean "no snippet".
STAGING_KINDS = ("publications", "dyads", "authors", "affiliations", "topics", "topicclusters", "asjcs", "ufcs",
                 "datasets")
MODEL_NAMES = ("string_matching", "model1", "model2", "model3")
NO_SNIPPET = ("Not Available",)


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    length: int | None = None
    required: bool = False


@dataclass(frozen=True)
class Table:
    """Columns beside ``id``, ``run_id`` and ``last_updated_date``, with the rules an insert must keep."""

    columns: tuple[Column, ...]
    parents: dict[str, str] = field(default_factory=dict)  # foreign key column -> parent table
    unique: tuple[str, ...] = ()
    run_scoped: bool = True
    stamped: bool = True

    @property
    def schema(self) -> T.StructType:
        ddl = ["id bigint"] + (["run_id bigint"] if self.run_scoped else [])
        ddl += [f"`{c.name}` {c.type}" for c in self.columns]
        ddl += ["last_updated_date timestamp"] if self.stamped else []
        return T.StructType.fromDDL(", ".join(ddl))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def _text(name: str, length: int | None = None, required: bool = False) -> Column:
    return Column(name, "string", length, required)


def _key(name: str, required: bool = True) -> Column:
    return Column(name, "bigint", None, required)


# Names, types, text lengths, required columns, keys and references of the final tables.
# The order is the load order: a parent stands before its children.
TABLES: dict[str, Table] = {
    "model": Table(
        (_text("name", 32, True), _text("github_commit_url", 1024), _text("description")),
        unique=("name",), run_scoped=False),
    "dataset_alias": Table(
        (_key("alias_id"), _key("parent_alias_id", False), _text("alias", 160), _text("alias_type", 50),
         _text("url", 2048))),
    "publisher": Table((_text("external_id", 128), _text("name", 256)), unique=("run_id", "name")),
    "journal": Table(
        (_key("publisher_id", False), _text("external_id", 128), _text("title", 1028, True),
         Column("cite_score", "decimal(9,2)")),
        {"publisher_id": "publisher"}),
    "issn": Table((_key("journal_id", False), _text("issn", 13)), {"journal_id": "journal"}),
    "publication": Table(
        (_key("journal_id", False), _text("external_id", 128), _text("title", 400), _text("doi", 80),
         Column("year", "int"), Column("month", "int"), _text("pub_type", 30), Column("citation_count", "int"),
         Column("fw_citation_impact", "double"), _text("tested_expressions")),
        {"journal_id": "journal"}),
    "dyad": Table(
        (_key("publication_id"), _key("dataset_alias_id", False), _key("alias_id", False),
         _text("mention_candidate", 1028, True), _text("snippet"), Column("is_fuzzy", "boolean"),
         Column("fuzzy_score", "float")),
        {"publication_id": "publication", "dataset_alias_id": "dataset_alias"}),
    "dyad_model": Table(
        (_key("dyad_id"), _key("model_id"), Column("score", "float")),
        {"dyad_id": "dyad", "model_id": "model"}),
    "topic": Table((_text("keywords", 1028), _text("external_topic_id", 128), Column("prominence", "float"))),
    "publication_topic": Table(
        (_key("publication_id"), _key("topic_id"), Column("score", "float")),
        {"publication_id": "publication", "topic_id": "topic"}),
    "publication_ufc": Table(
        (_key("publication_id"), _key("concept_id", False), _text("concept_name", 1024, True),
         Column("rank", "double"), Column("a_freq", "int")),
        {"publication_id": "publication"}, stamped=False),
    "asjc": Table((_key("code"), _text("label"))),
    "publication_asjc": Table(
        (_key("publication_id"), _key("asjc_id")), {"publication_id": "publication", "asjc_id": "asjc"}),
    "author": Table((_text("external_id", 128), _text("given_name", 150), _text("family_name", 150))),
    "publication_author": Table(
        (_key("publication_id"), _key("author_id", False), _text("given_name", 150), _text("family_name", 150),
         Column("author_position", "int")),
        {"publication_id": "publication", "author_id": "author"}),
    "publication_affiliation": Table(
        (_key("publication_id"), Column("sequence_number", "smallint"), _text("external_id", 128),
         _text("institution_name", 750), _text("address", 750), _text("city", 128), _text("state", 128),
         _text("country_code", 10), _text("postal_code", 32)),
        {"publication_id": "publication"}),
    "author_affiliation": Table(
        (_key("publication_author_id", False), _key("publication_affiliation_id", False)),
        {"publication_author_id": "publication_author", "publication_affiliation_id": "publication_affiliation"}),
}

# Tables that other people fill; here they are inputs of the verdict view and the geo match.
INPUT_TABLES: dict[str, Table] = {
    "reviewer": Table((_key("user_id"), _text("roles"))),
    "snippet_validation": Table(
        (_key("reviewer_id"), _key("dyad_id"), Column("is_dataset_reference", "smallint"),
         Column("agency_dataset_identified", "smallint"), _text("notes")),
        {"reviewer_id": "reviewer", "dyad_id": "dyad"}, unique=("run_id", "reviewer_id", "dyad_id")),
    "affiliation_geo": Table(
        (_text("q", None, True), _text("address", 750), _text("city", 128), _text("state", 128),
         _text("country_code", 10), _text("boundingbox"), Column("lat", "double"), Column("lon", "double"),
         _text("q_final"), Column("nattempt", "smallint"), _text("display_name"), Column("importance", "double")),
        run_scoped=False, stamped=False),
    "affiliation_geocoding": Table(
        (_text("source", 10), _text("boundingbox"), Column("lat", "double"), Column("lon", "double"), _text("city", 4000),
         _text("state", 4000), _text("state_short", 4000), _text("country", 4000), _text("country_short", 10),
         _text("display_name"), _text("q", None, True), _text("q_final"), Column("nattempt", "smallint"),
         Column("importance", "double")),
        run_scoped=False, stamped=False),
    "publication_affiliation_geocoding": Table(
        (_key("publication_affiliation_id"), _key("affiliation_geocoding_id")),
        {"publication_affiliation_id": "publication_affiliation", "affiliation_geocoding_id": "affiliation_geocoding"},
        stamped=False),
    "publication_affiliation_geo": Table(
        (_key("publication_affiliation_id"), _key("affiliation_geo_id")),
        {"publication_affiliation_id": "publication_affiliation", "affiliation_geo_id": "affiliation_geo"},
        stamped=False),
}
