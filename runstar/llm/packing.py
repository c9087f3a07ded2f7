"""Packing of documents into sequences by a grouping genetic algorithm on islands.

A chromosome is a list of bins. Crossover injects well-filled bins of one parent into the other, takes out the bins
that then hold a document twice, and puts the documents displaced with them where they fit best, largest first. Documents are dealt
into blocks of bounded size; several islands evolve each block in tasks of their own, and their elites migrate to the next island
between epochs through a written table. Bins that a block leaves too empty are opened again and their documents
dealt to new blocks, until one block holds all that is left or ``LEVELS`` levels have passed.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runstar.llm.bpe import encoder
from runstar.llm.workers import map_arrow
from runstar.sources.workspace import Workspace

CAPACITY = 2048
#: Documents of a block, islands of a block, epochs, individuals of an island, crossovers of an epoch.
BLOCK, ISLANDS, EPOCHS, POPULATION, CROSSOVERS = 4096, 2, 2, 4, 12
#: Bins emptier than this are opened again after a level.
FULL = 0.995
#: After so many levels emptier bins stay as they are: each level leaves few. Under 64.
LEVELS = 4

Bins = list[list[int]]


def best_fit(bins: Bins, items: Sequence[int], lengths: Sequence[int], capacity: int) -> Bins:
    """``bins`` with ``items`` added in this order, each where it leaves the least room."""
    room: dict[int, list[int]] = {}
    free = 0  # bit r: some bin has room r
    out = [list(b) for b in bins]
    for k, b in enumerate(out):
        r = capacity - sum(lengths[i] for i in b)
        room.setdefault(r, []).append(k)
        free |= 1 << r
    for i in items:
        n = lengths[i]
        fits = free >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            own = room[r]
            k = own.pop()
            if not own:
                free ^= 1 << r
            out[k].append(i)
            r -= n
        else:
            k, r = len(out), capacity - n
            out.append([i])
        own = room.setdefault(r, [])
        own.append(k)
        free |= 1 << r
    return out


def cost(bins: Bins, lengths: Sequence[int], capacity: int) -> float:
    """The number of bins, less at most one for how unevenly they are filled: uneven bins leave more to gain."""
    even = sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)
    return len(bins) - even / max(1, len(bins))


def crossover(giver: Bins, taker: Bins, lengths: Sequence[int], capacity: int, rng: random.Random) -> Bins:
    """``taker`` with well-filled bins of ``giver`` injected."""
    fills = [sum(lengths[i] for i in b) / capacity for b in giver]
    injected = [b for b, f in zip(giver, fills, strict=True) if rng.random() < f ** 8 / 2]
    held = {i for b in injected for i in b}
    kept = [b for b in taker if held.isdisjoint(b)]
    displaced = [i for b in taker if not held.isdisjoint(b) for i in b if i not in held]
    # the emptiest of the bins left are opened too: what they hold may fit better now
    kept.sort(key=lambda b: -sum(lengths[i] for i in b))
    opened = len(kept) // 20 + 1
    displaced += [i for b in kept[-opened:] for i in b]
    displaced.sort(key=lambda i: -lengths[i])
    return best_fit(injected + kept[:-opened], displaced, lengths, capacity)


def evolve(lengths: Sequence[int], capacity: int, seed: str, elites: Sequence[Bins] = (),
           population: int = POPULATION, crossovers: int = CROSSOVERS) -> Bins:
    """The best individual of one island after an epoch."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    every = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    people = [[list(b) for b in e] for e in elites]
    noise = 0.0
    while len(people) < population:
        key = [-n * (1 + noise * rng.random()) for n in lengths]
        people.append(best_fit([], sorted(every, key=key.__getitem__), lengths, capacity))
        noise += 0.15
        if len(people[-1]) == least:
            return people[-1]
    costs = [cost(p, lengths, capacity) for p in people]
    for _ in range(crossovers):
        a, b = rng.sample(range(len(people)), 2)
        child = crossover(people[a], people[b], lengths, capacity, rng)
        worst = max(range(len(people)), key=costs.__getitem__)
        if (c := cost(child, lengths, capacity)) < costs[worst]:
            people[worst], costs[worst] = child, c
        if len(child) == least:
            break
    return people[min(range(len(people)), key=costs.__getitem__)]


def _bins_of(numbers: Sequence[int]) -> Bins:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(numbers):
        out.setdefault(k, []).append(i)
    return list(out.values())


def _epoch(capacity: int, epoch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                elites = [_bins_of(e) for e in (row["elite"], row["migrant"]) if e]
                bins = evolve(row["lengths"], capacity, f"{row['block']}:{row['island']}:{epoch}", elites)
                numbers = [0] * len(row["lengths"])
                for k, b in enumerate(bins):
                    for i in b:
                        numbers[i] = k
                yield pa.RecordBatch.from_pylist(
                    [row | {"elite": numbers, "migrant": None, "cost": cost(bins, row["lengths"], capacity)}], _ISLAND)
    return run


_ISLAND = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("items", pa.list_(pa.int64())),
                     ("lengths", pa.list_(pa.int32())), ("elite", pa.list_(pa.int32())),
                     ("migrant", pa.list_(pa.int32())), ("cost", pa.float64())])
_ISLAND_DDL = ("block long, island int, items array<long>, lengths array<int>, elite array<int>, migrant array<int>, "
               "cost double")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a block: its bin, its place there, and how full the bin is."""
    for batch in batches:
        for row in batch.to_pylist():
            used: dict[int, int] = {}
            at = []
            for k, n in zip(row["elite"], row["lengths"], strict=True):
                at.append(used.get(k, 0))
                used[k] = at[-1] + n
            yield pa.RecordBatch.from_pydict({
                "item": pa.array(row["items"], pa.int64()), "length": pa.array(row["lengths"], pa.int32()),
                "bin": pa.array([(row["block"] << 20) + k for k in row["elite"]], pa.int64()),
                "offset": pa.array(at, pa.int64()), "fill": pa.array([used[k] for k in row["elite"]], pa.int64())})


def pack(items: DataFrame, capacity: int = CAPACITY, work: Workspace | None = None) -> DataFrame:
    """(item, sequence_id, offset) for rows (item, length): ``item`` unique, ``length`` from 1 to ``capacity``.

    Sequences hold ``capacity`` at most and have no gaps. An empty input gives no row. Numbers of sequences are unique, not dense.
    """
    work = work or Workspace(items.sparkSession)
    left = work.keep("left-0", items.select("item", F.col("length").cast("int").alias("length")))
    whole = left.where(F.col("length") == capacity)
    parts = [whole.select("item", (F.col("item") * 64).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    left, level = left.where(F.col("length") < capacity), 0
    while (n := left.count()):
        level += 1
        blocks = -(-n // BLOCK)
        dealt = left.withColumn("block", F.pmod(F.xxhash64(F.lit(level), "item"), F.lit(blocks)))
        gathered = dealt.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("all"))
        none = F.lit(None).cast("array<int>")
        state = gathered.select("block", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"),
                                F.col("all.item").alias("items"), F.col("all.length").alias("lengths"),
                                none.alias("elite"), none.alias("migrant"), F.lit(0.0).alias("cost"))
        for epoch in range(EPOCHS):
            if epoch:
                guest = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"),
                                     F.col("elite").alias("_guest"))
                state = state.join(guest, ["block", "island"]).withColumn("migrant", F.col("_guest")).drop("_guest")
            tasks = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            state = state.select(*_ISLAND.names).repartition(tasks, "block", "island")
            state = work.keep(f"epoch-{level}-{epoch}", map_arrow(state, _epoch(capacity, epoch), _ISLAND_DDL))
        best = state.groupBy("block").agg(F.min_by("island", F.struct("cost", "island")).alias("island"))
        best = state.join(best, ["block", "island"], "left_semi")
        placed = work.keep(f"placed-{level}", map_arrow(
            best, _placed, "item long, length int, bin long, offset long, fill long"))
        final = F.col("fill") >= FULL * capacity if blocks > 1 and level < LEVELS else F.lit(True)
        # multiples of 64 are the whole sequences, other remainders the levels
        parts.append(placed.where(final).select("item", (F.col("bin") * 64 + level).alias("sequence_id"), "offset"))
        left = placed.where(~final).select("item", "length")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pieces(name: str, vocabulary: Broadcast, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(name, vocabulary.value)
        for batch in batches:
            for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                out: list[tuple] = []
                for row, ids in enumerate(own.encode(rows["text"])):
                    ids = np.append(ids, np.uint32(0)).astype("<u4")
                    first = (len(ids) - 1) % capacity + 1
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    out += [(row, k, a, b - a, crc32(ids[a:b]), ids[a:b] if keep_ids else None)
                            for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
                columns = list(zip(*out, strict=True))
                made = [rows["doc_id"].take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32()),
                        pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    made, names = [*made, pa.array([x.astype(np.int32) for x in columns[5]], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(made, names)
        own.forget()
    return run


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): each document's ids and an id 0, cut if longer than ``capacity``.

    All pieces but the first have ``capacity`` ids; the first holds the rest. ``vocabulary`` is a file on the driver.
    """
    text = Path(vocabulary).read_text(encoding="utf-8")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    sent = docs.sparkSession.sparkContext.broadcast(text)
    return map_arrow(docs.select("doc_id", "text"),
                     _pieces(sha256(text.encode()).hexdigest(), sent, capacity, keep_ids), schema)


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: all documents in few sequences of ``capacity`` ids at most.

    A null text is an empty one: its only id is 0. Repeated rows are packed each. An empty table gives no row.
    """
    work = Workspace(docs.sparkSession)
    cut = work.keep("pieces", pieces(docs, vocabulary, capacity, keep_ids).withColumn(
        "item", F.monotonically_increasing_id()))
    return cut.join(pack(cut.select("item", "length"), capacity, work), "item").drop("item")
