"""The nine staging kinds, each a projection of the nested feed (no shuffle).

Arrays are encoded as text for readers of the staging tables. The affiliation numbers of an author are kept as a
native array as well (``*_arr``), from which the star plan explodes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runstar.functions import blank_to_null, first_or_null, json_text, pipe_join
from runstar.operators.nested import explode_normalize, struct_normalize
from runstar.schemas import NO_SNIPPET

KEYS = ("run_id", "eid")

# Scalar columns of a publication, and the names under which mention leaves are staged.
PUBLICATION_COLUMNS = (
    "doi", "publication_title", "publication_type", "publication_year", "publication_month", "citation_count",
    "field_weighted_citation_impact", "journal_publishername", "journal_title", "journal_scopus_source_id")
MENTION_NAMES = {
    "identified_dataset_name": "alias", "snippets": "snippet", "linked_alias.alias_id": "alias_id",
    "linked_alias.fuzzy_score": "fuzzy_score", "linked_alias.is_fuzzy": "is_fuzzy"}


def publications(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    expressions = json_text("expressions") if "expressions" in feed.columns else F.lit(None).cast("string")
    score = F.col("journal_citescore")
    scores = [score.getField(f.name).alias(f"journal_{f.name}") for f in feed.schema["journal_citescore"].dataType.fields]
    return feed.select(
        *keys, *PUBLICATION_COLUMNS, pipe_join("journal_issn_isbn").alias("journal_issn_isbn"),
        expressions.alias("tested_expressions"), *scores)


def dyads(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per mention, snippet and model; a mention without snippets or models keeps one row."""
    rows = explode_normalize(feed, "identified_datasets", keys)
    rows = rows.select(*[F.explode_outer("snippets").alias("snippets") if c == "snippets" else F.col(f"`{c}`")
                         for c in rows.columns if c != "linked_alias.alias"])
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "models"],
                       F.explode_outer("models").alias("_model"))
    kept = [c for c in rows.columns if c != "_model"]
    named = rows.select(*[F.col(f"`{c}`").alias(MENTION_NAMES.get(c, c)) for c in kept],
                        F.col("_model.model").alias("model"), F.col("_model.score").alias("score"))
    return named.withColumn("snippet", blank_to_null("snippet", *NO_SNIPPET))


def authors(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    rows = explode_normalize(feed, "authors", keys)
    rows = rows.dropna(how="all", subset=[c for c in rows.columns if c not in keys])
    sequences = F.col("affiliation_sequences")
    return rows.withColumns({"affiliation_sequences_arr": sequences, "affiliation_sequences": json_text(sequences)})


def affiliations(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    rows = explode_normalize(feed, "affiliations", keys)
    rows = rows.toDF(*[c.removeprefix("affiliation_text.") for c in rows.columns])
    return rows.withColumns({
        "affiliation_organization": pipe_join("affiliation_organization", ", "),
        "affiliation_id": first_or_null("affiliation_ids").cast("bigint"),
        "affiliation_ids": pipe_join("affiliation_ids"),
        "affiliation_normalized": json_text("affiliation_normalized")})


def asjcs(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return explode_normalize(feed, "asjcs", keys)


def topics(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return struct_normalize(feed, "topic", keys).withColumn("keywords", pipe_join("keywords"))


def topicclusters(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return struct_normalize(feed, "topic_cluster", keys).withColumn("keywords", pipe_join("keywords"))


def ufcs(feed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return explode_normalize(feed, "unified_fingerprint_concepts", keys)


def datasets(aliases: DataFrame, runs: Sequence[str] = ("run_id",)) -> DataFrame:
    """The alias list of the export metadata (``aliases`` may be empty)."""
    return aliases.select(*runs, "alias", "alias_id", "parent_alias_id", "alias_type")


FEED_KINDS: dict[str, Callable[..., DataFrame]] = {
    "publications": publications, "dyads": dyads, "authors": authors, "affiliations": affiliations,
    "topics": topics, "topicclusters": topicclusters, "asjcs": asjcs, "ufcs": ufcs}


def all_kinds(feed: DataFrame, aliases: DataFrame, keys: Sequence[str] = KEYS) -> dict[str, DataFrame]:
    """All nine kinds; ``aliases`` carries the keys without the record key."""
    kinds = {name: build(feed, keys) for name, build in FEED_KINDS.items()}
    kinds["datasets"] = datasets(aliases, [k for k in keys if k != "eid"])
    return kinds
