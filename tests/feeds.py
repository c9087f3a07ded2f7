"""Small hand-made feeds."""

from __future__ import annotations

import gzip
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runstar.schemas import FEED_SCHEMA


def record(eid: str = "e1", **fields) -> dict:
    """A complete record; keyword arguments replace fields."""
    base = {
        "eid": eid, "doi": f"10.1/{eid}", "publication_title": f"Title {eid}", "publication_type": "article",
        "publication_year": 2020, "publication_month": 5, "citation_count": 3, "field_weighted_citation_impact": 1.5,
        "journal_publishername": "Springer", "journal_title": "Journal", "journal_scopus_source_id": 77,
        "journal_issn_isbn": ["1234", "5678"], "journal_citescore": {"citescore_value": 2.5}, "expressions": ["a b"],
        "identified_datasets": [{
            "identified_dataset_name": "Data A", "snippets": ["uses Data A"],
            "models": [{"model": "model1", "score": 0.5}, {"model": "model2", "score": 0.25}],
            "linked_alias": {"alias": "Data A", "alias_id": 11, "fuzzy_score": 0.75, "is_fuzzy": False}}],
        "authors": [{
            "author_id": 501, "author_position": 1, "given_name": "A.", "family_name": "Miller",
            "pn_given_name": "Ann", "pn_family_name": "Miller", "affiliation_sequences": [1]}],
        "affiliations": [{
            "affiliation_sequence": 1, "affiliation_ids": [9, 8], "affiliation_normalized": ["Uni"],
            "affiliation_text": {
                "affiliation_organization": ["Uni", "Dept"], "affiliation_address_part": "Street 1", "country_code": "de",
                "affiliation_state": None, "affiliation_city": "Kiel", "affiliation_postal_code": "24105"}}],
        "asjcs": [{"asjc": "2000", "label": "Economics"}],
        "topic": {"topic_id": 4, "keywords": ["k1", "k2"], "prominence": 0.5},
        "topic_cluster": {"keywords": ["c1"], "cluster_id": 1},
        "unified_fingerprint_concepts": [{"concept_id": 1, "concept_name": "GDP", "rank": 0.5, "a_freq": 2}]}
    return {**base, **fields}


def frame(spark: SparkSession, *records: dict, run_id: int = 1) -> DataFrame:
    """Records as a feed with a run id, through JSON as a scan would see them."""
    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "line string")
    parsed = lines.select(F.from_json("line", FEED_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return parsed.select(F.lit(run_id).cast("bigint").alias("run_id"), "*")


ALIASES = [{"alias_id": 11, "alias": "Data A", "parent_alias_id": 1, "alias_type": "alias"},
           {"alias_id": 1, "alias": "Data", "parent_alias_id": 1, "alias_type": "parent"}]


def aliases(spark: SparkSession, run_id: int = 1) -> DataFrame:
    rows = [(run_id, a["alias_id"], a["alias"], a["parent_alias_id"], a["alias_type"]) for a in ALIASES]
    return spark.createDataFrame(rows, "run_id bigint, alias_id bigint, alias string, parent_alias_id bigint, alias_type string")


def write_run(base: Path, agency: str, version: str, records: list[dict], files: int = 1,
              years: dict[int, int] | None = None) -> None:
    """A run on disk: gzip JSON lines and metadata. ``years`` overrides the stated counts."""
    folder = base / agency / version
    (folder / "json" / "publications").mkdir(parents=True, exist_ok=True)
    (folder / "stat").mkdir(parents=True, exist_ok=True)
    for i in range(files):
        text = "\n".join(json.dumps(r) for r in records[i::files])
        with gzip.open(folder / "json" / "publications" / f"publication_{i}.json.gz", "wt", encoding="utf-8") as f:
            f.write(text)
    if years is None:
        years = {}
        for r in records:
            years[r["publication_year"]] = years.get(r["publication_year"], 0) + 1
    write_metadata(folder, years)


def write_metadata(folder: Path, years: dict[int, int]) -> None:
    stats = {"overall": {"unique_documents_per_year": [{"publication_year": y, "documents": n} for y, n in years.items()]},
             "documents_per_alias": ALIASES}
    (folder / "stat" / "export_metadata.json").write_text(json.dumps({"metadata": {"agency": "x"}, "stats": stats}))
