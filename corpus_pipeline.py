"""A training corpus from documents: stages that each keep, change or pack what the one before has kept.

A stage gets the documents as read back from the Parquet that the stage before was written to. All but the last return the
columns of documents, extra ones included, as they were given but for what a stage says it changes; names that begin with two underscores are the stages' own and must
not occur among them. Nulls may stand in any column, rows may repeat, and an empty table passes as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runstar.llm import language, near_dedup, packing, secrets, substring_dedup
from runstar.sources.workspace import Workspace

#: Words of a shingle, words of a repeated passage, ids of a sequence.
SHINGLE, PASSAGE, SEQUENCE = 5, 50, 2048


def _row_key(docs: DataFrame) -> Column:
    """64 bits of a row: rows with the same key are repeated rows."""
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put in ``lang`` the language that text, declaration and address together show, and drop documents whose text is in no
    language: without letters (null and empty texts too), or noise.

    A tag whose language is the one found stays as it is, and so does any tag where none is named; languages that few or no rows
    declare stay. Repeated rows are judged alike, by all their columns.
    """
    evidence = docs.select(_row_key(docs).alias("__key"), "text", F.col("lang").alias("declared"),
                           F.col("source").alias("address"))
    judged = language.identify(evidence, "__key").where("kept").groupBy("__key").agg(F.max("language").alias("__language"))
    keyed = docs.withColumn("__key", _row_key(docs)).join(judged, "__key")
    found, declared = F.col("__language"), language.declared_language(F.col("lang"))
    lang = F.when(found.isNull() | found.eqNullSafe(declared), F.col("lang")).otherwise(found)
    return keyed.withColumn("lang", lang.cast(docs.schema["lang"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, that of the smallest doc_id; a null id comes last.

    Of repeated rows, and of rows with equal ids and texts, one stays, any of them. Documents without words (null and empty texts
    too) are like nothing and all stay, but for repeated ones.
    """
    found = near_dedup.near_duplicates(docs, SHINGLE).where("first").select(F.col("text_key").alias("__key"))
    keyed = docs.withColumn("__key", near_dedup.text_key())
    return keyed.join(found, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove every word that a window of ``PASSAGE`` words covers which stands anywhere else as well, in all its places.

    What is left is joined by single spaces in documents that lose words; the others, null texts too, stay as they are. Repeated
    rows lose what they share. ``n_chars`` is that of the text that is left.
    """
    cleaned = substring_dedup.remove_repeats(docs, PASSAGE)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in a text by a mark; texts without one, null ones too, stay. ``n_chars`` is that of the new text."""
    cleaned = secrets.fresh_ledger(spark).redacted(docs, "doc_id", "text")
    return cleaned.select(*docs.columns).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids: a row for each piece of a document, with its ids and its place. A null text has the end's id alone."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE, keep_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
    ("secret_scan", secret_scan), ("packing", packed)]
#: The stages cannot be expressed in SQL (sketches, trained likelihoods, token ids); tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(f"stage-{name}", stage(spark, docs, sf_dir))
    return docs
