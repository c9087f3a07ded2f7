"""Document fingerprints by winnowing.

The hashes of all runs of ``GRAM`` code points are taken in windows of ``WINDOW``; each window marks its smallest hash,
the rightmost of equal ones. Every passage of ``WINDOW + GRAM - 1`` code points that two texts share therefore leaves
them at least one hash in common, and no window leaves a gap. Places are kept. A text with fewer grams than a window is
one window; one shorter than a gram is a gram of its own; an empty text has no fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runstar.llm.hashing import blocks, code_points, mix, running, spans, window_minima
from runstar.llm.workers import map_arrow
from runstar.sources.workspace import control_table

GRAM, WINDOW = 25, 40
#: Runs of neighbouring documents for each shuffle partition: several even out what one partition gets.
RUNS = 4

_RECORD = np.dtype([("hash", ">u4"), ("gap", ">u2")])
Print = tuple[np.ndarray, np.ndarray]


def winnow(texts: pa.Array, gram: int = GRAM, window: int = WINDOW) -> Iterator[Print]:
    """(hashes, places in code points) of each text; a null text counts as empty."""
    for _, data, offsets in blocks(texts):
        points, first = code_points(data, offsets)
        total = running(mix(points.astype(np.uint64) + np.uint64(1)))
        start = np.arange(max(0, len(points) - gram + 1))
        hashes = spans(total, start, start + gram)
        length = np.diff(first)
        _, at = window_minima(hashes, window, first, window + gram - 1)
        chosen = at[np.concatenate(([True], at[1:] != at[:-1]))] if len(at) else at
        cut = np.searchsorted(chosen, first)
        for i, n in enumerate(length):
            if n >= window + gram - 1:
                own = chosen[cut[i]:cut[i + 1]]
                yield hashes[own], own - first[i]
            elif n >= gram:
                own = hashes[first[i]:first[i] + n - gram + 1]
                place = n - gram - int(np.argmin(own[::-1]))
                yield own[place:place + 1], np.array([place])
            elif n:
                yield spans(total, first[i:i + 1], first[i + 1:i + 2]), np.array([0])
            else:
                yield np.zeros(0, np.uint64), np.zeros(0, np.int64)


def as_text(print_: Print) -> str:
    """Twelve hex digits a mark: 32 bits of its hash, and how far it stands from the mark before it."""
    out = np.empty(len(print_[0]), _RECORD)
    out["hash"], out["gap"] = print_[0] >> np.uint64(32), np.diff(print_[1], prepend=0)
    return out.tobytes().hex()


def likeness(a: Print, b: Print) -> float:
    """Share of equal hashes in the hashes of both (Jaccard); two empty fingerprints are alike."""
    x, y = np.unique(a[0]), np.unique(b[0])
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def with_next(docs: DataFrame) -> DataFrame:
    """(run, own, doc_id, text, _tie): documents in runs of neighbours by descending doc_id, each followed by the next one.

    Run boundaries are quantiles of doc_id. The first document of a run is also dealt to the end of the run before it
    (``own`` is false there), that of the first run to the last. Null ids come last; equal ids by a hash of the text.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_tie", F.xxhash64("text"))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = RUNS * parts
    shares = [i / runs for i in range(1, runs)]
    edges = docs.agg(F.percentile_approx("doc_id", shares, 10 * runs).alias("e")).first()["e"]
    edges = sorted(set(edges or []), reverse=True)
    # run 0 holds the largest ids; a null id is in the last run
    run = F.coalesce(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e > F.col("doc_id"))) if edges else F.lit(0),
                     F.lit(0))
    run = F.when(F.col("doc_id").isNull(), len(edges)).otherwise(run)
    docs = docs.withColumn("run", run)
    heads = (docs.groupBy("run").agg(F.max(F.struct("doc_id", "_tie")).alias("h")).orderBy("run").collect())
    before = control_table(spark, [(heads[i - 1]["run"], x["run"], x["h"]["doc_id"], x["h"]["_tie"])
                                   for i, x in enumerate(heads)], "_before int, _run int, _id long, _hash long")
    tails = docs.join(F.broadcast(before), (F.col("run") == F.col("_run")) & F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("_tie") == F.col("_hash")))
    tails = tails.select("doc_id", "text", "_tie", F.col("_before").alias("run"), F.lit(False).alias("own"))
    dealt = docs.select("doc_id", "text", "_tie", "run", F.lit(True).alias("own")).unionByName(tails)
    return dealt.repartition(parts, "run").sortWithinPartitions("run", F.desc("own"), F.desc_nulls_last("doc_id"),
                                                                F.desc("_tie"))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from hashlib import sha256

    held = None  # the last row so far: its next may stand in the next batch
    for batch in batches:
        for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
            texts = rows["text"].to_pylist()
            marks = list(winnow(rows["text"]))
            line = list(zip(rows["run"].to_pylist(), rows["own"].to_pylist(), rows["doc_id"].to_pylist(), texts, marks,
                            strict=True))
            line = [held, *line] if held else line
            # of a run's rows only the last can be followed by another run's: a tail, which needs no result
            pairs = [(x, y) for x, y in zip(line, line[1:], strict=False) if x[1]]
            changed = [edited(x[3], y[3]) for x, y in pairs]
            prints = list(winnow(pa.array(changed, pa.large_string())))
            held = line[-1]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([x[2] for x, _ in pairs], pa.int64()),
                "n_chars": pa.array([len(x[3]) for x, _ in pairs], pa.int64()),
                "edited_sha256": pa.array([sha256(t.encode()).hexdigest() for t in changed], pa.string()),
                "fingerprint": pa.array([as_text(x[4]) for x, _ in pairs], pa.string()),
                "edited_fingerprint": pa.array([as_text(p) for p in prints], pa.string()),
                "near_edited": pa.array([likeness(x[4], p) for (x, _), p in zip(pairs, prints, strict=True)],
                                        pa.float64()),
                "near_next": pa.array([likeness(x[4], y[4]) for x, y in pairs], pa.float64())})


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are.

    A null text is empty; an empty table gives no row; repeated rows each get one. Other columns are not looked at.
    """
    return map_arrow(with_next(docs), _compare, SCHEMA)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, marks): the marks of each text as structs of a hash and its place in code points."""
    kind = docs.schema[key].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                marks = [[{"hash": int(h), "place": int(p)} for h, p in zip(a.view(np.int64), b, strict=True)]
                         for a, b in winnow(rows["text"])]
                yield pa.RecordBatch.from_arrays(
                    [rows["key"], pa.array(marks, pa.list_(pa.struct([("hash", pa.int64()), ("place", pa.int64())])))],
                    ["key", "marks"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_arrow(rows, each, f"key {kind}, marks array<struct<hash:long,place:long>>")
