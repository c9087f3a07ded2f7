"""Language-model scoring by a Katz back-off model of any order, trained and evaluated over whole tables.

Tokens are words and one end a text, which is also the history of a text's first word. Every training word is a symbol:

    p(w | h) = d(c) c / (n + 0.5)    if h was followed by w c times, h having been seen n times
             = b(h) p(w | h')        else, h' being h without its first word

with Good-Turing discounts d for counts up to ``DISCOUNTED`` and b(h) such that the probabilities of all words after h sum
to 1 exactly. The 0.5 leaves every history some mass to back off with. p(w) adds 0.5 to each count, an unknown word
counting as one more word. A history that was not seen is its h'. So p sums to 1 over all known words, the end and one
unknown word, after any history. The first words of a text have the shorter histories that there are.

Texts are dealt in slices of some 800,000 tokens. Order by order, a slice sends each of its different grams once to the
bucket of the gram's history, with its count in training texts and its probability of the order below; the bucket adds up
counts, finds back-off weights, and sends both back. What comes back is written, as is the model: each order is a table of
rows by bucket, and a slice's state follows from those tables, so a lost executor costs its own tasks. Words and grams are
known by numbers that their buckets give them, small ones for frequent grams, so that they take two or three bytes each.
A history seen more than ``SPLIT`` times is dealt over several buckets by the next word; their sums meet in a table of
such histories. Nothing but two totals and the discounts' counts goes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from runstar.llm.hashing import Words, blocks, mix, words
from runstar.llm.packed import pack, steps, unpack
from runstar.llm.workers import map_arrow
from runstar.sources.workspace import Workspace

#: The largest count that is discounted, and how often a history is seen before it is dealt over several buckets.
DISCOUNTED, SPLIT = 5, 1 << 17
#: Tokens of one slice.
SLICE = 800_000
#: The key of the end; those of words are other numbers with the highest bit set.
END = -1
#: Kinds of rows: what a bucket is asked, a slice's texts, a bucket's part of the model. Replies bear their order.
ASKED, MODEL, HOME = -2, -1, 0


def _slices(texts: pa.Array) -> Iterator[tuple[int, list[Words]]]:
    """(first row, words of blocks) of consecutive rows with about ``SLICE`` tokens."""
    held: list[Words] = []
    begin = size = 0
    for row, data, offsets in blocks(texts):
        if size >= SLICE:
            yield begin, held
            held, begin, size = [], row, 0
        held.append(words(data, offsets, lower=True))
        size += len(held[-1].start) + len(offsets) - 1
    if held:
        yield begin, held


def _tokens(parts: list[Words]) -> tuple[np.ndarray, np.ndarray]:
    """Word keys with the ends, and how many each document has."""
    keys = [np.insert((p.hashes() | np.uint64(1 << 63)).view(np.int64), p.first[1:], END) for p in parts]
    return np.concatenate(keys), np.concatenate([np.diff(p.first) + 1 for p in parts])


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _numbers(count: np.ndarray, at: int, buckets: int) -> np.ndarray:
    """A number for each gram of a bucket that was seen, smaller ones for larger counts; 0 for the others."""
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(-count, kind="stable")] = np.arange(len(count))
    return np.where(count > 0, rank * buckets + at + 1, 0)


def _schema(doc_id: str) -> str:
    return f"kind int, slice long, at int, doc_ids array<{doc_id}>, held_out array<boolean>, sums array<long>, data binary"


def _rows(rows: list[tuple], doc_id: pa.DataType) -> pa.RecordBatch:
    """Rows of ``_schema``."""
    types = (("kind", pa.int32()), ("slice", pa.int64()), ("at", pa.int32()), ("doc_ids", pa.list_(doc_id)),
             ("held_out", pa.list_(pa.bool_())), ("sums", pa.list_(pa.int64())), ("data", pa.binary()))
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(columns, types, strict=True)],
                                      [c for c, _ in types])


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows that agree in a column; they come one after the other. Only the first has ``totals``, which are the same for all."""
    value, held = None, []
    for batch in batches:
        keys = batch[by].to_pylist()
        for i in range(batch.num_rows):
            if keys[i] != value:
                if held:
                    yield value, held
                value, held = keys[i], []
            held.append({c: batch[c][i].as_py() for c in batch.schema.names if c != "totals" or not held})
    if held:
        yield value, held


def _one_by_one(of_group: Callable[[int, list[dict]], pa.RecordBatch], by: str):
    """A task that calls ``of_group`` on each group of rows; nothing of one is held while the next is worked on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for value, rows in _groups(batches, by):
            yield of_group(value, rows)
    return run


def _joined(arrays: list[np.ndarray], like: type = np.int64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, like)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, rising, and each key's place among them in four bytes."""
    order = np.argsort(keys)
    keys = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    place = np.empty(len(keys), np.int32)
    place[order] = np.cumsum(fresh, dtype=np.int32) - np.int32(1)
    return keys[fresh], place


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairs of places as one number each."""
    both = left.astype(np.int64)
    both <<= 32
    both |= right
    return both


def _ask_words(buckets: int, doc_id: pa.DataType):
    """For each slice of texts its tokens, and its different words by bucket with their counts in training texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, parts in _slices(batch["text"]):
                keys, sizes = _tokens(parts)
                rows = batch.slice(begin, len(sizes))
                first, held = rows["row"][0].as_py(), rows["held_out"]
                learnt = np.repeat(~held.to_numpy(zero_copy_only=False), sizes)
                key, index = np.unique(keys.view(np.uint64), return_inverse=True)
                bucket = _bucket(key, buckets)
                order = np.argsort(bucket, kind="stable")
                place = np.empty(len(key), np.int64)
                place[order] = np.arange(len(key))
                token = place[index]
                n = np.bincount(token[learnt], minlength=len(key))
                out = [(HOME, first, None, rows["doc_id"].to_pylist(), held.to_pylist(), None, pack(token, sizes))]
                for at, cut in _cuts(bucket[order]):
                    out.append((ASKED, first, at, None, None, None, pack(steps(key[order[cut]]), n[cut])))
                yield _rows(out, doc_id)
    return run


def _cuts(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values."""
    value, begin = np.unique(values, return_index=True)
    ends = np.append(begin, len(values))[1:]
    for v, a, b in zip(value.tolist(), begin.tolist(), ends.tolist(), strict=True):
        yield v, slice(a, b)


def _answer_words(buckets: int, doc_id: pa.DataType):
    """Counts and numbers of a bucket's words, for each slice that asks, and as the model's first order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, rows in _groups(batches, "at"):
            asked = [unpack(r["data"]) for r in rows]
            keys = [np.cumsum(a.view(np.uint64)) for a, _ in asked]
            key, index = np.unique(np.concatenate(keys), return_inverse=True)
            count = np.rint(np.bincount(index, np.concatenate([n for _, n in asked]))).astype(np.int64)
            number = _numbers(count, at, buckets)
            seen = count > 0
            out = [(MODEL, None, at, None, None, [int(count.sum()), int(seen.sum())],
                    pack(steps(key[seen]), number[seen], count[seen]))]
            upto = np.cumsum([0, *map(len, keys)])
            for r, a, b in zip(rows, upto[:-1], upto[1:], strict=True):
                out.append((1, r["slice"], at, None, None, None, pack(count[index[a:b]], number[index[a:b]])))
            yield _rows(out, doc_id)
    return run


def discounts(seen: list[int]) -> np.ndarray:
    """Good-Turing discounts for counts 0 to ``DISCOUNTED`` from the numbers of grams seen once, twice, ...

    A count whose discount the numbers don't support (none seen, or not between 0 and 1) isn't discounted.
    """
    n = [0, *seen]
    out = np.ones(DISCOUNTED + 1)
    top = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        if n[r] and top < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - top) / (1 - top)
            out[r] = d if 0 < d < 1 else 1.0
    return out


@dataclass
class Totals:
    """Tokens and different words of the training texts, and the discounts of each order from two on."""

    tokens: int
    distinct: int
    discount: list[np.ndarray]

    @property
    def mass(self) -> int:
        """What all (2 count + 1) sum to, with an unknown word."""
        return 2 * self.tokens + max(self.distinct, 1) + 1


class Slice:
    """The tokens of a slice, each with the longest gram that ends there of an order: its number, count and probability."""

    def __init__(self, home: dict, reply: list[np.ndarray], totals: Totals):
        token, sizes = unpack(home.pop("data"), narrow=True)
        self.sizes = sizes.astype(np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.learnt = np.repeat(~np.array(home["held_out"], bool), self.sizes)
        count, number = (x.astype(np.int64) for x in reply)
        self.count, self.word = count[token], number[token]
        self.p = (2 * self.count + 1) / totals.mass
        self.gram, self.times = self.word, self.count

    def ask(self, order: int, buckets: int, split: int) -> Grams:
        """The different grams of the next order whose history was seen."""
        history, times = np.roll(self.gram, 1), np.roll(self.times, 1)
        end = self.sizes[0] - 1  # the first text's end
        history[self.first], times[self.first] = (self.word[end], self.count[end]) if order == 2 else (0, 0)
        return Grams(self, np.flatnonzero(history), history, times, buckets, split)

    def told(self, grams: Grams, reply: list[np.ndarray], discount: np.ndarray) -> None:
        """Go on to the order of ``grams``."""
        back, count, number = reply
        n = count[grams.index]
        kept = n * np.append(discount, 1.0)[np.minimum(n, DISCOUNTED + 1)]
        seen = kept / (grams.times + 0.5)
        self.p[grams.token] = np.where(n > 0, seen, back[grams.place[grams.index]] * self.p[grams.token])
        self.gram, self.times = np.zeros_like(self.gram), np.zeros_like(self.times)
        if len(number):
            self.gram[grams.token], self.times[grams.token] = number[grams.index], n


class Grams:
    """Different grams of a slice in the order in which they are sent: by bucket, history and word."""

    def __init__(self, own: Slice, token: np.ndarray, history: np.ndarray, times: np.ndarray, buckets: int, split: int):
        self.token, self.times = token, times[token]
        heads, head = _distinct(history[token])
        tails, tail = _distinct(own.word[token])
        both, index = _distinct(_pairs(head, tail))
        del head, tail
        some = np.empty(len(both), np.int32)  # a place where each gram stands
        some[index] = np.arange(len(index), dtype=np.int32)
        h, w = heads[both >> 32], tails[both & 0xFFFFFFFF]
        shares = -(-self.times[some] // split)
        share = np.where(shares > 1, mix(w.view(np.uint64)) % np.maximum(shares, 1).astype(np.uint64), 0).astype(np.int64)
        at = _bucket(mix(h.view(np.uint64)) + share.view(np.uint64), buckets)
        order = np.argsort(at, kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.index = place[index]
        self.at, self.history, self.word, self.split = at[order], h[order], w[order], (shares > 1)[order]
        self.n = np.bincount(self.index[own.learnt[token]], minlength=len(order))
        self.p = own.p[token[some]][order]
        #: where a history begins, and the place of each gram's history
        self.fresh = np.ones(len(order), bool)
        self.fresh[1:] = (self.history[1:] != self.history[:-1]) | (self.at[1:] != self.at[:-1])
        self.place = np.cumsum(self.fresh) - 1

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for at, cut in _cuts(self.at):
            fresh = np.flatnonzero(self.fresh[cut])
            n = self.n[cut]
            value, code = np.unique(self.p[cut][n > 0], return_inverse=True)
            yield at, pack(steps(self.history[cut][fresh]), np.diff(np.append(fresh, len(n))), self.split[cut][fresh],
                           self.word[cut], n, value, code)


def _replayed(rows: list[dict], order: int, totals: Totals, buckets: int, split: int) -> tuple[dict, Slice]:
    """A slice as it stands after an order, from its texts and all replies; rows come by kind and bucket."""
    replies: dict[int, list] = {k: [] for k in range(1, order + 1)}
    for r in rows:
        if r["kind"] != HOME:
            replies[r["kind"]].append(unpack(r.pop("data"), narrow=True))
    home = next(r for r in rows if r["kind"] == HOME)
    own = Slice(home, [_joined(list(x)) for x in zip(*replies.pop(1), strict=True)], totals)
    for k in range(2, order + 1):
        parts = list(zip(*replies.pop(k), strict=True)) or [[], [], []]
        own.told(own.ask(k, buckets, split), [_joined(list(x)) for x in parts], totals.discount[k - 2])
    return home, own


def _ask_grams(order: int, totals: Totals, buckets: int, split: int, doc_id: pa.DataType):
    """What each slice asks of an order's buckets."""
    def asked(first: int, rows: list[dict]) -> pa.RecordBatch:
        _, own = _replayed(rows, order - 1, totals, buckets, split)
        return _rows([(ASKED, first, at, None, None, None, data)
                      for at, data in own.ask(order, buckets, split).messages()], doc_id)

    return _one_by_one(asked, "slice")


class Counted:
    """The grams of a bucket: counts, and for each history what it needs for its back-off weight."""

    def __init__(self, rows: list[dict]):
        parts = [[] for _ in range(6)]
        for r in rows:
            head, many, split, word, n, value, code = unpack(r.pop("data"), narrow=True)
            for x, part in zip(parts, (np.cumsum(head, dtype=np.int64), many, split > 0, word, n, value[code]), strict=True):
                x.append(part)
        #: places of each row's histories, and how many grams it has
        self.sizes = [len(x) for x in parts[3]]
        cuts = np.cumsum([len(x) for x in parts[0]])[:-1]
        self.history, at = _distinct(_joined(parts[0]))
        self.heads = np.split(at, cuts)
        h = len(self.history)
        self.split = np.zeros(h, bool)
        self.split[at[_joined(parts[2], bool)]] = True
        head = np.repeat(at, _joined(parts[1]).astype(np.int64))
        word, n, p = _joined(parts[3]), _joined(parts[4]), _joined(parts[5], np.float64)
        del parts
        tails, tail = _distinct(word)
        del word
        head = _pairs(head, tail)
        del tail
        both, self.index = _distinct(head)
        del head
        self.head, self.word = (both >> 32).astype(np.int32), tails[both & 0xFFFFFFFF]
        del both
        self.count = np.rint(np.bincount(self.index, n, len(self.head))).astype(np.int64)
        lower = np.zeros(len(self.head))
        lower[self.index[n > 0]] = p  # the same number wherever the gram stands
        self.covered = np.bincount(self.head, lower, h)
        #: seen how often, and the numbers of words seen once, twice, ... after each history
        self.times = np.stack([np.rint(np.bincount(self.head, self.count, h)).astype(np.int64)]
                              + [np.bincount(self.head[self.count == r], minlength=h) for r in range(1, DISCOUNTED + 2)])


_SUMS = "at int, h long, covered double, " + ", ".join(f"n{r} long" for r in range(DISCOUNTED + 2))


def _sums(at: int, rows: list[dict]) -> pa.RecordBatch:
    """Sums of a bucket (without h) and of its part of each history that is dealt over several."""
    c = Counted(rows)
    some = np.flatnonzero(c.split)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(some) + 1, at, np.int32)), pa.array([None, *c.history[some].tolist()], pa.int64()),
         pa.array(np.append(0.0, c.covered[some])), *(pa.array(np.append(x.sum(), x[some])) for x in c.times)],
        ["at", "h", "covered", *(f"n{r}" for r in range(DISCOUNTED + 2))])


def _answer_grams(buckets: int, last: bool, doc_id: pa.DataType):
    """Counts, numbers and back-off weights of a bucket's grams, for each slice that asks, and as an order of the model."""
    def answered(at: int, rows: list[dict]) -> pa.RecordBatch:
        c = Counted(rows)
        covered, times, seen = c.covered, c.times, None
        for s in rows[0]["totals"]:
            if s["h"] is None:
                seen = s["n"]
            else:
                i = np.searchsorted(c.history, s["h"])
                covered[i], times[:, i] = s["covered"], s["n"]
        discount = discounts(seen[1:])
        freed = sum(((1 - discount[r]) * r * times[r] for r in range(1, DISCOUNTED + 1)), np.zeros(len(covered)))
        back = (0.5 + freed) / (times[0] + 0.5) / (1 - covered)
        number = np.zeros(0, np.int64) if last else _numbers(c.count, at, buckets)
        there = c.count > 0
        out = [(MODEL, None, at, None, None, seen,
                pack(steps(c.history), back, np.bincount(c.head[there], minlength=len(back)), c.word[there], c.count[there]))]
        begin = 0
        for r, own, size in zip(rows, c.heads, c.sizes, strict=True):
            index = c.index[begin:begin + size]
            begin += size
            out.append((r["order"], r["slice"], at, None, None, None,
                        pack(back[own], c.count[index], number if last else number[index])))
        return _rows(out, doc_id)

    return _one_by_one(answered, "at")


def _scores(order: int, totals: Totals, buckets: int, split: int, doc_id: pa.DataType):
    """A row for each document of a slice."""
    def scored(_: int, rows: list[dict]) -> pa.RecordBatch:
        home, own = _replayed(rows, order, totals, buckets, split)
        base = np.log10((own.count + 0.5) / (totals.tokens + 0.5 * (totals.distinct + 1)))
        return pa.RecordBatch.from_arrays(
            [pa.array(home["doc_ids"], doc_id), pa.array(home["held_out"], pa.bool_()), pa.array(own.sizes),
             pa.array(np.add.reduceat((own.count > 0).astype(np.int64), own.first)),
             pa.array(np.add.reduceat(base, own.first)), pa.array(np.add.reduceat(np.log10(own.p), own.first))],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return _one_by_one(scored, "slice")


class KatzModel:
    """A model of the rows of ``rows`` (doc_id, held_out, text) that are not held out, and the scores of all.

    ``tables[k - 1]`` is the written table of order k: one row of kind ``MODEL`` a bucket, and what each slice was told.
    """

    def __init__(self, rows: DataFrame, work: Workspace, order: int = 2, split: int = SPLIT):
        spark = rows.sparkSession
        if order < 1:
            raise ValueError("the order of a model is at least 1")
        self.order, self.split = order, split
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.kind = rows.schema["doc_id"].dataType.simpleString()
        self.doc_id = to_arrow_schema(rows.select("doc_id").schema).field(0).type
        numbered = rows.select("doc_id", "held_out", "text").withColumn("row", F.monotonically_increasing_id())
        texts = work.keep("texts", map_arrow(numbered, _ask_words(self.buckets, self.doc_id), _schema(self.kind)))
        self.homes = texts.where(F.col("kind") == HOME)
        asked = self._dealt(texts.where(F.col("kind") == ASKED)).sortWithinPartitions("at", "slice")
        self.tables = [work.keep("order-1", self._map(asked, _answer_words(self.buckets, self.doc_id)))]
        n, v = self._total(0), self._total(1)
        self.totals = Totals(n, v, [])
        for k in range(2, order + 1):
            asked = self._dealt(self._map(self._slices(), _ask_grams(k, self.totals, self.buckets, split, self.doc_id)))
            answered = self._map(asked.join(self._controls(asked), "at").withColumn("order", F.lit(k))
                                 .sortWithinPartitions("at", "slice"), _answer_grams(self.buckets, k == order, self.doc_id))
            self.tables.append(work.keep(f"order-{k}", answered))
            seen = self.tables[-1].where(F.col("kind") == MODEL).select("sums").first()  # the same in all buckets
            self.totals.discount.append(discounts(seen[0][1:] if seen else [0] * (DISCOUNTED + 1)))

    def _map(self, rows: DataFrame, task) -> DataFrame:
        return map_arrow(rows, task, _schema(self.kind))

    def _dealt(self, asked: DataFrame) -> DataFrame:
        # the join infers this condition for its side alone: said for both, they share the exchange
        return asked.select("at", "slice", "data").where(F.col("at").isNotNull()).repartition(self.buckets, "at")

    def _total(self, i: int) -> int:
        return self.tables[0].where(F.col("kind") == MODEL).agg(F.sum(F.get("sums", F.lit(i)))).first()[0] or 0

    def _slices(self) -> DataFrame:
        """The texts of each slice with all that it was told."""
        rows = self.homes
        for t in self.tables:
            rows = rows.unionByName(t.where(F.col("kind") > HOME))
        return rows.drop("sums").repartition(self.buckets, "slice").sortWithinPartitions("slice", "kind", "at")

    def _controls(self, asked: DataFrame) -> DataFrame:
        """For each bucket the sums of all, and those of the histories of which it holds a part; few rows."""
        numbers = [F.sum(f"n{r}").alias(f"n{r}") for r in range(DISCOUNTED + 2)]
        sums = map_arrow(asked.sortWithinPartitions("at", "slice"), _one_by_one(_sums, "at"), _SUMS).groupBy("h").agg(
            F.sum("covered").alias("covered"), *numbers, F.collect_list("at").alias("ats"))
        held = sums.select(F.explode("ats").alias("at"), F.struct(
            "h", "covered", F.array(*(f"n{r}" for r in range(DISCOUNTED + 2))).alias("n")).alias("of"))
        return held.groupBy("at").agg(F.collect_list("of").alias("totals"))

    def scores(self) -> DataFrame:
        """(doc_id, held_out, n_tokens, n_known, base_score, score) of each row."""
        return map_arrow(self._slices(), _scores(self.order, self.totals, self.buckets, self.split, self.doc_id),
                         f"doc_id {self.kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def score_held_out(docs: DataFrame, folds: int = 5, held_out: int = 1, order: int = 2, split: int = SPLIT) -> DataFrame:
    """Score all texts with a model of those outside one fold, by the CRC-32 of doc_id as text.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), a row for each row of ``docs``. A null text is
    an empty one, whose only token is the end; a null doc_id counts as an empty text and so is in fold 0. An empty table
    gives no row. If no text trains, every word is unknown.
    """
    spark: SparkSession = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds
    rows = docs.select("doc_id", (fold == held_out).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    model = KatzModel(rows, Workspace(spark), order, split)
    return model.scores().select("doc_id", "held_out", "n_tokens", "n_known",
                                 F.lit(model.totals.tokens).cast("long").alias("train_tokens"), "base_score", "score")
