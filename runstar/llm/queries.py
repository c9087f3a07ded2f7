"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from runstar.llm import (
    fingerprints,
    forced_bpe,
    language,
    lm,
    near_dedup,
    neighbours,
    packing,
    periodic_runs,
    secrets,
    sharding,
    substring_dedup,
    token_alignment,
)
from runstar.llm import sentencepiece_lattice as lattice


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text by a public piece model."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return lattice.encode(_table(spark, sf_dir, "documents"), model).select(
        "doc_id", F.size("ids").alias("n_ids"), "ids")


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of all texts under a model of those outside the held-out fold."""
    return lm.score_held_out(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles are alike by 0.8 or more."""
    found = near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edit, and how alike they are."""
    return fingerprints.compare_with_edits(_table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text; the ledger begins empty, so every blob is scanned once."""
    found = secrets.fresh_ledger(spark).scan(_table(spark, sf_dir, "documents"), "doc_id", "text")
    kinds = [r.kind for r in secrets.BASE]
    base = F.filter("found", lambda x: x["rank"] < len(kinds))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(F.col("path").alias("doc_id"), *map(count, kinds),
                        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                        secrets.listed(F.col("found")).alias("spans"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards whose counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shuffle_into_shards(rows, 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, from its text, the language it declares and its source."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("address"))
    return language.identify(docs, "doc_id")


def op8_page_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every web page, from its text, its markup and its address."""
    return language.identify(language.page_evidence(_table(spark, sf_dir, "pages")), "page_id")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that repeated windows of 35 words cover, and what is left of each document."""
    return substring_dedup.removal_report(_table(spark, sf_dir, "documents"), 35)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, a tenth of them with a planted one, and what is left without their repeats."""
    return periodic_runs.run_report(_table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of tokens that two public tokenizers cut alike in every document, and their links against the whole corpus."""
    return token_alignment.alignment_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                            public_tokenizers.path("piece_bpe_32k.model"))


def op13_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids by a public vocabulary with word ends, and of the text they decode to."""
    return forced_bpe.round_trip_report(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents through the corpus pipeline, packed."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_lm_scores, op3_near_duplicates, op4_winnowing, op5_secret_scan, op6_shards, op7_packing,
                                 op8_language_id, op8_page_language, op9_neighbours, op10_substring_dedup, op11_periodic_runs, op12_token_alignment,
                                 op13_forced_bpe, pipeline)}
ORACLES: dict[str, str] = {
    "op3_near_duplicates": """
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_distinct(list_transform(range(1, len(w)),
                     lambda i: w[i] || ' ' || w[i + 1])) ELSE w END) AS s FROM w),
        n AS (SELECT w.doc_id, count(s.s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id
              GROUP BY 1, 2),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
              WHERE 100 * k >= 80 * (x.n + y.n - k)),
        e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        c AS (SELECT doc_id AS a, doc_id AS r FROM n UNION SELECT e.b, c.r FROM c JOIN e ON e.a = c.a AND c.r < e.b),
        m AS (SELECT a AS doc_id, min(r) AS component_id FROM c GROUP BY 1)
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN m USING (doc_id)""",
    "op10_substring_dedup": """
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        p AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35),
        g AS (SELECT p.doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS g FROM p JOIN w USING (doc_id)),
        r AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM g GROUP BY 1 HAVING count(*) > 1)),
        c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS j FROM r),
        l AS (SELECT doc_id, list(j) AS c FROM c GROUP BY 1)
        SELECT w.doc_id, len(w)::BIGINT AS n_words, len(coalesce(c, []))::BIGINT AS n_removed,
               sha256(array_to_string(CASE WHEN c IS NULL THEN w ELSE list_transform(list_filter(
                   range(1, len(w) + 1), lambda i: NOT list_contains(c, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
        FROM w LEFT JOIN l USING (doc_id)""",
    "op11_periodic_runs": """
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        h AS (SELECT *, len(w) AS n, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''),
                  lambda c: ascii(c)::BIGINT), lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                  lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) AS h FROM w),
        a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM h),
        p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
        t AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n),
                  lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM p),
        s AS (SELECT doc_id, n, unnest(w) AS s, unnest(range(0, n)) AS i FROM t),
        m AS (SELECT x.doc_id, y.i - x.i AS d, x.i AS i FROM s x JOIN s y
              ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i AND y.i - x.i <= x.n // 4),
        g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS g FROM m),
        l AS (SELECT doc_id, min(i) AS s, count(*) + d AS k, d AS q FROM g GROUP BY doc_id, d, g
              HAVING count(*) + d >= greatest(6, 4 * d)),
        r AS (SELECT * FROM l WHERE NOT EXISTS (SELECT 1 FROM l o WHERE o.doc_id = l.doc_id AND o.q < l.q AND o.s <= l.s
              AND o.s + o.k >= l.s + l.k)),
        f AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || k || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
                  list({'s': s, 'k': k, 'q': q} ORDER BY k * 10000000000 // q DESC, s, q)[1] AS b FROM r GROUP BY doc_id),
        c AS (SELECT doc_id, list(DISTINCT i) AS c FROM (SELECT doc_id, unnest(range(s + q, s + k)) AS i FROM r) GROUP BY doc_id)
        SELECT t.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b.s::BIGINT AS start, b.k::BIGINT AS length, b.q::BIGINT AS period,
               (1000 * b.k // b.q)::BIGINT AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
               sha256(array_to_string(CASE WHEN c IS NULL THEN w ELSE list_transform(list_filter(range(0, n),
                   lambda i: NOT list_contains(c, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
        FROM t LEFT JOIN f USING (doc_id) LEFT JOIN c USING (doc_id)""",
}
