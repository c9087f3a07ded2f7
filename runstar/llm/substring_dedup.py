"""Removal of word passages that repeat anywhere, by compressed full-text indexes over shards of the corpus.

Every window of ``window`` words is known by its anchor, the rightmost smallest hash of its runs of ``ANCHOR`` words;
equal windows have equal anchors. A first pass counts anchors, and a bit table of fixed size keeps those that occur more than
once: a window with any other anchor cannot repeat. A second pass cuts the remaining windows of each text into segments of
neighbours with one anchor and deals segments to shards by anchor, so that equal windows meet in one shard and each
shard's documents are streamed past one index only. Each shard builds an index over its distinct segments
and searches them backwards; windows whose occurrences weigh 2 or more repeat. Where the bit table is too small for a
corpus, more segments travel; results stay the same.

An anchor with more than ``HOT`` occurrences is replaced by a hash of the whole window, which spreads its windows over
all shards. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runstar.llm.bits import bit_table, maybe_in
from runstar.llm.fm_index import Index
from runstar.llm.hashing import blocks, grams, window_minima, words
from runstar.llm.workers import map_arrow
from runstar.sources.workspace import Workspace

WINDOW, ANCHOR = 35, 8
HOT = 50_000
#: Words that one index holds, about.
SHARD = 1 << 19


def _anchored(texts: pa.Array, window: int):
    """For each block: its words, the windows' first words, and the place and hash of each window's anchor."""
    for row, data, offsets in blocks(texts):
        found = words(data, offsets)
        hashes = grams(found.hashes(), ANCHOR)
        start, at = window_minima(hashes, window - ANCHOR + 1, found.first, window)
        yield row, found, start, at, hashes


def _count_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [hashes[np.unique(at)] for _, _, _, at, hashes in _anchored(batch["text"], window)]
            value, n = np.unique(np.concatenate(each or [np.zeros(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n)], ["anchor", "n"])
    return run


def _cut_segments(window: int, table: Broadcast, hot: Broadcast):
    """Segments whose anchors may repeat, once for each batch, with the places that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_pylist()
            owners: dict[tuple[int, bytes], dict[tuple[bytes, int], int]] = {}
            for row, found, start, at, hashes in _anchored(batch["text"], window):
                anchor = hashes[at]
                kept = maybe_in(table.value, anchor)
                start, at, anchor = start[kept], at[kept], anchor[kept]
                if not len(start):
                    continue
                common = np.isin(anchor, hot.value)
                text = np.searchsorted(found.first, start, "right") - 1
                fresh = np.ones(len(start), bool)
                fresh[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1) | common[1:] | (text[1:] != text[:-1])
                if common.any():
                    anchor = anchor.copy()
                    whole = found.hashes()
                    anchor[common] = [grams(whole[s:s + window], window)[0] for s in start[common]]
                head = np.flatnonzero(fresh)
                last = np.append(head[1:], len(start)) - 1
                raw = found.data.tobytes()
                for a, t, s, i, j in zip(anchor[head].view(np.int64).tolist(), text[head].tolist(),
                                         (start[head] - found.first[text[head]]).tolist(),
                                         found.start[start[head]].tolist(), found.end[start[last] + window - 1].tolist(),
                                         strict=True):
                    places = owners.setdefault((a, raw[i:j]), {})
                    place = (keys[row + t], s)
                    places[place] = places.get(place, 0) + 1
            held = list(owners.items())
            for part in (held[i:i + 20_000] for i in range(0, len(held), 20_000)):
                cuts = np.concatenate(([0], np.cumsum([len(p) for _, p in part]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a for (a, _), _ in part], pa.int64()), pa.array([s for (_, s), _ in part], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array([k for _, p in part for k, _ in p], pa.binary())),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array([s for _, p in part for _, s in p], pa.int32())),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array([n for _, p in part for n in p.values()],
                                                                      pa.int32()))],
                    ["anchor", "segment", "keys", "starts", "copies"])
    return run


def _repeated(rows: list[tuple], window: int) -> pa.RecordBatch:
    """(key, low, high): word ranges of each text that repeated windows cover, for one shard's rows."""
    data = b"\n".join(r[1] for r in rows)
    ends = np.cumsum([len(r[1]) + 1 for r in rows])
    found = words(np.frombuffer(data, np.uint8), np.concatenate(([0], ends[:-1], [len(data)])))
    codes = np.unique(found.hashes(), return_inverse=True)[1].astype(np.int64) + 1
    places: dict[bytes, dict[tuple[bytes, int], int]] = {}
    for k, (_, _, keys, starts, copies) in enumerate(rows):
        own = places.setdefault(codes[found.first[k]:found.first[k + 1]].tobytes(), {})
        for key, start, n in zip(keys, starts, copies, strict=True):
            own[key, start] = own.get((key, start), 0) + n
    sequences = [np.frombuffer(s, np.int64) for s in places]
    weights = Index(sequences, [sum(p.values()) for p in places.values()], window).window_weights(sequences)
    out = []
    for own, weight in zip(places.values(), weights, strict=True):
        again = np.concatenate(([0], weight >= 2, [0])).astype(np.int8)
        edge = np.diff(again)
        runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        out += [(key, start + a, start + b + window - 1) for key, start in own for a, b in runs]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()),
                                       pa.array([x[1] for x in out], pa.int32()),
                                       pa.array([x[2] for x in out], pa.int32())], ["key", "low", "high"])


def _search(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("anchor", "segment", "keys", "starts", "copies")), strict=True):
                if size >= SHARD and row[0] != rows[-1][0]:
                    yield _repeated(rows, window)
                    rows, size = [], 0
                rows.append(row)
                size += row[1].count(b" ") + 1
        if rows:
            yield _repeated(rows, window)
    return run


def repeated_ranges(docs: DataFrame, window: int = WINDOW, work: Workspace | None = None) -> DataFrame:
    """(key, ranges): the ranges of words that repeated windows cover, for each ``content_key`` that has any.

    A window of ``window`` consecutive words repeats if its word sequence starts anywhere else in the table as well, the same
    document included. Ranges of one text may overlap. Texts without a word, or with fewer than a window, have none.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark)
    texts = docs.select(content_key().alias("key"), "text").where("key is not null")
    counted = map_arrow(texts.select("text"), _count_anchors(window), "anchor long, n long")
    anchors = work.keep("anchors", counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1"))
    table = bit_table(anchors, "anchor")
    hot = anchors.where(F.col("n") > HOT).select("anchor").toArrow()["anchor"].to_numpy()  # one in HOT at most
    send = spark.sparkContext.broadcast
    segments = map_arrow(texts, _cut_segments(window, send(table), send(hot.astype(np.int64).view(np.uint64))),
                         "anchor long, segment binary, keys array<binary>, starts array<int>, copies array<int>")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = segments.repartition(parts, "anchor").sortWithinPartitions("anchor")
    ranges = map_arrow(dealt, _search(window), "key binary, low int, high int")
    ranges = work.keep("ranges", ranges)
    return ranges.groupBy("key").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))


def content_key() -> Column:
    """128 bits of a text; null for a null text."""
    return F.unhex(F.md5("text"))


def _kept(text: str | None, ranges: list[dict] | None) -> tuple[list[bytes], int]:
    """The words outside all ranges, and the number of those inside."""
    found = (text or "").encode().split()  # without an argument: at the bytes 0x20 and 0x09 to 0x0D
    out: list[bytes] = []
    at = 0
    for r in sorted((r["low"], r["high"]) for r in ranges or ()):
        if r[1] > at:
            out += found[at:max(at, r[0])]
            at = r[1]
    out += found[at:]
    return out, len(found) - len(out)


def map_kept(docs: DataFrame, ranges: DataFrame, task: Callable, schema: str, columns: list[str]) -> DataFrame:
    """Give each document's ranges to ``task``, as the column ``__ranges`` beside ``columns``."""
    found = ranges.select(F.col("key").alias("__key"), F.col("ranges").alias("__ranges"))
    joined = docs.withColumn("__content", content_key()).join(found, F.col("__content") == F.col("__key"), "left")
    return map_arrow(joined.select(*columns, "__ranges"), task, schema)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
            kept = [_kept(t, r) for t, r in zip(rows["text"].to_pylist(), rows["__ranges"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows["doc_id"], pa.array([len(k) + n for k, n in kept], pa.int64()),
                 pa.array([n for _, n in kept], pa.int64()),
                 pa.array([sha256(b" ".join(k)).hexdigest() for k, _ in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])


def removal_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each document.

    A null or empty text has no words and the hash of the empty text; a repeated row repeats all its windows; an empty table
    gives no row. Other columns are not looked at.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_kept(docs, repeated_ranges(docs, window), _report,
                    f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string", ["doc_id", "text"])


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = [t if not r else b" ".join(_kept(t, r)[0]).decode()
                for t, r in zip(batch["text"].to_pylist(), batch["__ranges"].to_pylist(), strict=True)]
        yield batch.drop_columns(["__ranges"]).set_column(batch.schema.get_field_index("text"), "text",
                                                         pa.array(text, pa.string()))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the repeated passages; a text without any stays as it is, others are their kept words."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_kept(docs, repeated_ranges(docs, window), _rewrite, schema, docs.columns)
