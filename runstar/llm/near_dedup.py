"""Near-duplicate detection by fast similarity sketching.

A document's set holds its distinct word shingles. Its sketch has ``BANDS * ROWS`` coordinates. In round i every element
is thrown into a hashed bin with the value (i, hash); a bin keeps its smallest value, and rounds stop once all bins are
full. As many rounds later each round throws all elements into one given bin, so every coordinate fills. The share of equal
coordinates estimates the Jaccard similarity with the concentration of independent samples.

Documents with equal sets are one class. Classes whose sketches agree in a whole band share a bucket. Every class is compared on
full sets with one hub, the heaviest of its buckets; what is then in one component needs no further comparison. Classes of buckets
that still hold several components, joined through their hubs, are a *cluster* with a hub of its own. Each class there is written as
its difference to the hub's set: elements that only one of them has. Two sets are as far apart as their differences are, so

* a class whose difference is small enough is linked with the hub, which settles all pairs of such classes, and
* any other link needs a number of *common* elements in both differences, which their sizes tell. With a cluster's elements in
  order of frequency, it needs one among the rarest of each, so only classes with such an element in common are compared, and
  only if behind it, in both, there are as many elements as the link needs.

Copies of one text differ from each other where each was changed, and what a change brings in is rare; so these comparisons are few, and no
bucket is expanded into pairs or capped. What a cluster takes grows with its classes' differences to the hub.

A pair at similarity s shares no band with probability (1 - s**ROWS)**BANDS: 1.3e-8 at 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runstar.llm.bits import bit_table, maybe_in
from runstar.llm.components import components
from runstar.llm.hashing import blocks, grams, mix, words
from runstar.llm.workers import map_arrow
from runstar.sources.workspace import Workspace

ROWS, BANDS = 6, 60
PERCENT = 80
#: Classes of a cluster that meet their hub's set in one task.
PART = 1000

_SEEDS = mix(np.arange(1, 2 * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingles of each text: runs of ``size`` words, or the whole of a shorter sequence."""
    for _, data, offsets in blocks(texts):
        found = words(data, offsets, lower=True)
        hashes = found.hashes()
        for a, b in zip(found.first, found.first[1:], strict=False):
            yield np.unique(grams(hashes[a:b], min(size, b - a))) if b > a else np.zeros(0, np.uint64)


def sketch(elements: np.ndarray, size: int = ROWS * BANDS, seeds: np.ndarray = _SEEDS) -> np.ndarray:
    """``size`` coordinates of a set that isn't empty."""
    out = np.full(size, _EMPTY)
    some = max(1, 4096 // len(elements))  # rounds thrown at once: a later round never displaces an earlier one
    for low in range(0, size, some):
        rounds = np.arange(low, min(size, low + some))
        thrown = mix(elements[None, :] ^ seeds[rounds][:, None])
        value = (rounds.astype(np.uint64) << np.uint64(32))[:, None] | (thrown & np.uint64(0xFFFFFFFF))
        np.minimum.at(out, ((thrown >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).ravel(), value.ravel())
        if out.max() != _EMPTY:
            return out
    for j in np.flatnonzero(out == _EMPTY):
        thrown = mix(elements ^ seeds[size + j])
        out[j] = (np.uint64(size + j) << np.uint64(32)) | (thrown & np.uint64(0xFFFFFFFF)).min()
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band, different between bands."""
    key = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for column in coordinates.reshape(BANDS, ROWS).T:
        key = mix(key ^ column) + np.uint64(1)
    return key


def class_of(elements: np.ndarray) -> bytes | None:
    """128 bits that depend on the set alone; None for an empty set."""
    if not len(elements):
        return None
    n = np.uint64(len(elements))
    return np.array([mix(elements).sum() ^ n, mix(elements ^ _SEEDS[0]).sum() + n], np.uint64).tobytes()


def _sketched(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                sets = list(shingle_sets(rows["text"], size))
                keys = [band_keys(sketch(x)).view(np.int64) if len(x) else x.view(np.int64) for x in sets]
                cuts = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], rows["text_key"], pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([class_of(x) for x in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(keys)))],
                    ["doc_id", "text_key", "n_shingles", "class", "bands"])
    return run


def _sets_of(size: int, wanted: Broadcast):
    """(class, elements) of the rows whose ``text_key`` may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(maybe_in(wanted.value, batch["text_key"].to_numpy())))
            for rows in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                sets = list(shingle_sets(rows["text"], size))
                cuts = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([class_of(x) for x in sets], pa.binary()), pa.ListArray.from_arrays(
                        pa.array(cuts), pa.array(np.concatenate(sets).view(np.int64)))], ["class", "elements"])
    return run


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, either): sizes of the intersection and the union of each pair's sets."""
    mine = sets.select(F.col("node").alias("b"), F.col("elements").alias("_b"))
    theirs = sets.select(F.col("node").alias("a"), F.col("elements").alias("_a"))
    both = F.size(F.array_intersect("_a", "_b"))
    joined = pairs.join(mine, "b").join(theirs, "a")
    return joined.select("a", "b", F.size("_a").alias("_na"), F.size("_b").alias("_nb"), both.alias("both")).select(
        "a", "b", "both", (F.col("_na") + F.col("_nb") - F.col("both")).alias("either"))


def _linked(compared: DataFrame, percent: int) -> DataFrame:
    return compared.where(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = PERCENT, work: Workspace | None = None) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, node, first) for each document.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their sets, ``percent`` being 80 or more;
    ``component_id`` is the smallest doc_id that links reach. Words are whitespace-separated, A to Z in lower case. A null or
    empty text, or one without words, has an empty set and is linked with nothing: its component is its own doc_id.
    Repeated rows have equal sets and share a component; of a component's rows exactly one is ``first``, one with the
    smallest doc_id (a null id comes after all others). ``text_key`` is ``text_key(doc_id, text)``. Other columns are not
    looked at; an empty table gives no row.
    """
    work = work or Workspace(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", text_key().alias("text_key"), "text")
    sketches = work.keep("sketches", map_arrow(
        keyed, _sketched(shingle), f"doc_id {kind}, text_key long, n_shingles long, class binary, bands array<long>")
        .withColumn("node", F.monotonically_increasing_id()))
    filled = sketches.where(F.col("class").isNotNull())
    classes = work.keep("classes", filled.groupBy("class").agg(F.min("node").alias("node")))
    buckets = (filled.select("node", "bands").join(classes.select("node"), "node", "left_semi")
               .select("node", F.explode("bands").alias("band")))
    shared = buckets.groupBy("band").agg(F.count("*").alias("held")).where("held > 1")
    members = work.keep("members", buckets.join(shared, "band"))
    # a class near the middle of a group shares more bands with the others and makes the better hub
    weights = members.groupBy("node").agg(F.sum("held").alias("weight"))
    weighed = members.select("band", "node").join(weights, "node")
    hubs = work.keep("hubs", weighed.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("hub")))
    # each class begins with one comparison, with the heaviest hub of its buckets
    refs = members.join(hubs, "band").groupBy("node").agg(F.max("hub").alias("hub"))
    nodes = work.keep("nodes", refs.select("node", F.col("hub.node").alias("ref")).join(
        sketches.select("node", "class", "text_key"), "node"))
    sets = work.keep("sets", _sets(keyed, nodes, shingle))
    first = work.keep("first", _linked(_compared(
        nodes.where("node != ref").select(F.col("ref").alias("a"), F.col("node").alias("b")), sets), percent))
    labels = components(first, work, "first-stars")
    mixed = work.keep("mixed", _mixed(members.select("band", "node"), labels))
    ties = mixed.join(hubs.select("band", F.col("hub.node").alias("a")), "band").select("a", F.col("node").alias("b"))
    clusters = components(ties.distinct(), work, "cluster-stars").withColumnRenamed("component", "cluster")
    clustered = (mixed.select("node", "component").distinct().join(clusters, "node").join(weights, "node"))
    apart = work.keep("differences", _differences(work.keep("clustered", clustered), sets))
    pairs = _close_pairs(work.keep("rarest", _rarest(apart, percent)), percent)
    others = work.keep("others", _linked_by_differences(pairs, apart, percent))
    own = apart.where(_settled(percent) & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    labels = components(first.unionByName(own).unionByName(others), work, "stars")
    return _labelled(sketches, classes, labels)


def _sets(keyed: DataFrame, nodes: DataFrame, shingle: int) -> DataFrame:
    """(node, elements) of the classes that share a bucket, from the texts; only their sets are shuffled."""
    wanted = keyed.sparkSession.sparkContext.broadcast(bit_table(nodes, "text_key"))
    found = map_arrow(keyed.select("text_key", "text"), _sets_of(shingle, wanted), "class binary, elements array<long>")
    return found.join(nodes.select("node", "class"), "class").select("node", "elements").dropDuplicates(["node"])


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their component."""
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    spread = placed.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return placed.join(spread.where("_low != _high").select("band"), "band", "left_semi")


def _differences(clustered: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, component, cluster, hub, n, hub_n, apart): each class of a cluster, its size, and its difference to the hub's set.

    A hub's set is dealt to as many parts as its cluster has thousands of classes.
    """
    hubs = clustered.groupBy("cluster").agg(F.max(F.struct("weight", "node")).alias("hub"),
                                            F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    hubs = hubs.select("cluster", F.col("hub.node").alias("hub"), "parts")
    theirs = (hubs.join(sets.select(F.col("node").alias("hub"), F.col("elements").alias("_hub")), "hub")
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
    dealt = clustered.drop("weight").join(hubs.select("cluster", "parts"), "cluster")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("parts")
    both = dealt.join(sets, "node").join(theirs, ["cluster", "part"])
    return both.select("node", "component", "cluster", "hub", F.size("elements").alias("n"), F.size("_hub").alias("hub_n"),
                       F.concat(F.array_except("elements", "_hub"), F.array_except("_hub", "elements")).alias("apart"))


def _settled(percent: int) -> Column:
    """Whether a class is linked with its cluster's hub: sets are linked if they differ in at most (100 - percent) / (100 +
    percent) of both sizes together."""
    return F.size("apart") * (100 + percent) <= (F.col("n") + F.col("hub_n")) * (100 - percent)


def _rarest(apart: DataFrame, percent: int) -> DataFrame:
    """(cluster, element, node, component, n, settled, short, size, rest): the elements of each difference that may decide, the size of
    the difference, and how many of its elements come from this one on.

    Let d be a class's difference, n and h the sizes of its set and the hub's, q = (100 - percent) / (100 + percent). A linked set has at
    most n * 100 / percent elements, so the two differ in at most n (100 - percent) / percent; of d all others are common elements. A link
    to a class that isn't settled, whose difference is over q (its size + h), also needs over (d + q (h - n)) / 2 of them. So one is among
    the rarest d minus what is needed, the ``short`` list. A link of a class that isn't settled to one that is needs the former, and at
    least one: its longer list. Both lists begin with elements that no other class has; these decide nothing and are only counted.
    """
    size = F.size("apart")
    least_any = F.ceil((size * percent - F.col("n") * (100 - percent)) / percent)
    least_short = F.greatest(least_any, F.floor(
        (size * (100 + percent) + (F.col("hub_n") - F.col("n")) * (100 - percent)) / (2 * (100 + percent))) + 1)
    least_long = F.greatest(least_any, F.lit(1))
    settled = _settled(percent)
    short, long = size - least_short + 1, F.when(settled, 0).otherwise(size - least_long + 1)
    rows = apart.select("cluster", "node", "component", "n", settled.alias("settled"), size.alias("size"), short.alias("_short"),
                        long.alias("_long"), F.explode("apart").alias("element"))
    often = rows.groupBy("cluster", "element").agg(F.count("*").alias("_often")).where("_often > 1")
    rows = rows.join(often, ["cluster", "element"])
    mine = Window.partitionBy("node")
    # the place in order of frequency, behind the elements that are the class's own
    place = F.row_number().over(mine.orderBy("_often", "element")) + F.col("size") - F.count("*").over(mine)
    rows = rows.withColumn("_place", place).withColumn("short", F.col("_place") <= F.col("_short"))
    return rows.where("short or _place <= _long").select(
        "cluster", "element", "node", "component", "n", "settled", "short", "size", (F.col("size") - F.col("_place") + 1).alias("rest"))


def _close_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components with a deciding element in common, of which one at least is not settled.

    The rarest element that a linked pair has in common is in both lists, and no more than the ``rest`` of either is common.
    """
    one = rows.where("not settled").select("cluster", "element", F.col("node").alias("a"), F.col("component").alias("_of"),
                                           F.col("short").alias("_a_short"), F.col("n").alias("_n"),
                                           F.col("size").alias("_size"), F.col("rest").alias("_rest"))
    other = rows.where("short").select("cluster", "element", F.col("node").alias("b"), "component", "settled", "n", "size", "rest")
    sizes = (F.col("_n") * 100 >= F.col("n") * percent) & (F.col("n") * 100 >= F.col("_n") * percent)
    enough = 2 * F.least("rest", "_rest") * (100 + percent) >= (
        (F.col("size") + F.col("_size")) * (100 + percent) - (F.col("n") + F.col("_n")) * (100 - percent))
    pairs = one.join(other, ["cluster", "element"]).where((F.col("component") != F.col("_of")) & sizes & enough & (
        F.col("settled") | (F.col("_a_short") & (F.col("a") < F.col("b")))))
    return pairs.select("a", "b").distinct()


def _linked_by_differences(pairs: DataFrame, apart: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of one cluster that are linked: what both differences hold cancels out between the two sets."""
    mine = apart.select(F.col("node").alias("b"), F.col("apart").alias("_b"), F.col("n").alias("_nb"))
    theirs = apart.select(F.col("node").alias("a"), F.col("apart").alias("_a"), F.col("n").alias("_na"))
    joined = pairs.join(mine, "b").join(theirs, "a")
    between = F.size("_a") + F.size("_b") - 2 * F.size(F.array_intersect("_a", "_b"))
    return joined.where(between * (100 + percent) <= (F.col("_na") + F.col("_nb")) * (100 - percent)).select("a", "b")


def text_key() -> Column:
    """64 bits of a row's id and text."""
    return F.xxhash64("doc_id", F.coalesce("text", F.lit("")))


def _labelled(sketches: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    of_class = classes.join(labels, "node", "left").select("class", F.coalesce("component", "node").alias("component"))
    rows = sketches.drop("bands").join(of_class, "class", "left")
    # without a class a document is a component of its own
    rows = rows.withColumn("component", F.coalesce("component", F.col("node")))
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min(F.struct(
        F.col("doc_id").isNull().alias("null"), "doc_id", "node")).alias("_least"))
    return rows.join(least, "component").select(
        "doc_id", "text_key", "n_shingles", "component_id", "node", (F.col("node") == F.col("_least.node")).alias("first"))
