"""Language identification by Bayesian fusion of evidence.

    p(language | row)  ~  p(language | host)  p(declared | language)  p(text | language)

* Text: hashed byte trigrams, counted for each declared language over all rows. Neighbouring trigrams depend on each other, so
  the mean log-likelihood of the whole text weighs as ``WEIGHT`` independent ones at most.
* Declaration: how often rows whose text alone points to a language declare what they declare.
* Address: p(language | host) is smoothed towards the address suffix, and that towards all rows, by grouped counts of
  what texts point to. A row's own text is taken out of the counts that judge it.

One more hypothesis is that the text is of no modelled language: all trigrams equally likely. If that is the most probable one, the
row's language is the one it declares, if any; what the text itself shows decides whether the row stays. A row is rejected (``kept`` is
false) only if it has no letters, or if its letters are *noise*: some hundred of them, about equally frequent and independent of
their neighbours, as in random strings, dumps and keys and in no language. That needs no declarations and no other rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runstar.llm.bpe import LETTER
from runstar.llm.forced_bpe import KINDS
from runstar.llm.hashing import LOWER, blocks, mix
from runstar.llm.workers import map_arrow
from runstar.sources.workspace import Workspace

#: Hashed trigrams, what a text weighs at most, pseudo-rows of each smoothing, prior of no language.
GRAMS, WEIGHT, SMOOTH, NONE = 1 << 16, 60, 10.0, 1e-4
#: Added to each count of a trigram; and the share of any text that may be noise, which bounds what a rare word costs.
ADDED, NOISE = 0.02, 0.1
#: A model parameter: likelihoods are fitted for so many languages, those declared most often. Rows of all others stay as well.
LANGUAGES = 200
#: Noise has so many letters and equal pairs of them at least, and at most so much of a preference for some letters and for some
#: neighbours (1 is none at all; prose has about 1.7 and 2 to 4).
LETTERS, EQUAL, UNEVEN, BOUND = 60, 20, 1.25, 1.5
#: A text whose mean log-likelihood is within this of equally likely trigrams is tested for noise.
DOUBT = 0.5

_LETTERS = np.where((np.arange(256) >= 0x80) | ((LOWER >= 0x61) & (LOWER <= 0x7A)), LOWER, 0x20).astype(np.uint64)


def trigrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block: hashed trigrams whose middle byte belongs to a letter, and the row of each."""
    for row, data, offsets in blocks(texts):
        n = len(offsets) - 1
        # a blank before and after each text
        at = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, np.diff(offsets))
        line = np.full(len(data) + 2 * n, 0x20, np.uint64)
        line[at] = _LETTERS[data]
        middle = at[line[at] != 0x20]
        code = line[middle - 1] << np.uint64(16) | line[middle] << np.uint64(8) | line[middle + 1]
        yield mix(code) % np.uint64(GRAMS), row + np.searchsorted(offsets + 2 * np.arange(n + 1), middle, "right") - 1


def declared_language(column: Column) -> Column:
    """The primary subtag of a language tag, in lower case; null if empty."""
    tag = F.lower(F.trim(F.substring_index(F.substring_index(column, "-", 1), "_", 1)))
    return F.when(tag != "", tag)


def host_of(address: Column) -> Column:
    """The host of an address, or the address itself if it names no scheme; in lower case."""
    rest = F.substring_index(address, "://", -1)
    host = F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1)
    return F.lower(F.regexp_replace(F.substring_index(host, "@", -1), r":\d+$", ""))


def suffix_of(host: Column) -> Column:
    """What follows the last dot; empty without one."""
    return F.when(host.contains("."), F.substring_index(host, ".", -1)).otherwise("")


def page_evidence(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, text, declared, address) of web pages: text without markup, the language of the html element, the address."""
    plain = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    lang = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z_-]+)""", 1)
    return pages.select(key, plain.alias("text"), lang.alias("declared"), F.col(url).alias("address"))


def is_noise(text: str) -> bool:
    """Whether a text's letters are too evenly spread, and too little bound to their neighbours, for any language."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = KINDS[points] == LETTER
    found = points[letter]
    n = len(found)
    if n < LETTERS:
        return False
    _, count = np.unique(found, return_counts=True)
    equal = (count * (count - 1)).sum() / 2
    chance = equal / (n * (n - 1) / 2)  # that two letters of the text are equal
    if equal < EQUAL or chance * len(count) >= UNEVEN:
        return False
    both = letter[1:] & letter[:-1]
    pairs = points[:-1][both].astype(np.uint64) << np.uint64(32) | points[1:][both].astype(np.uint64)
    _, count = np.unique(pairs, return_counts=True)
    m = len(pairs)
    return (count * (count - 1)).sum() < BOUND * chance ** 2 * m * (m - 1)


def _count(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {n: i for i, n in enumerate(names)}
        for batch in batches:
            label = np.array([place[d] for d in batch["declared"].to_pylist()], np.int64)
            for gram, row in trigrams(batch["text"]):
                some, n = np.unique(label[row] * GRAMS + gram.astype(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n)], ["cell", "n"])
    return run


@dataclass
class TextModel:
    """Log-likelihoods of trigrams: a row for each language."""

    names: list[str]
    logs: np.ndarray

    def mean_logs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(trigrams of each text, mean log-likelihood of each text and language)."""
        n = np.zeros(len(texts), np.int64)
        sums = np.zeros((len(texts), len(self.names)))
        for gram, row in trigrams(texts):
            n += np.bincount(row, minlength=len(texts))
            for k, log in enumerate(self.logs):
                sums[:, k] += np.bincount(row, log[gram], len(texts))
        return n, sums / np.maximum(n, 1)[:, None]


def _score(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: TextModel = model.value
        for batch in batches:
            n, logs = m.mean_logs(batch["text"])
            weighed = logs * np.minimum(n, WEIGHT)[:, None]
            cuts = pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(m.names))
            best = weighed.argmax(axis=1) if len(m.names) else np.zeros(len(n), np.int64)
            # a text that some language fits needs no other look, unless that is by its host or declaration alone
            doubtful = (n > 0) & (logs.max(axis=1, initial=-np.inf) < -np.log(GRAMS) + DOUBT)
            noise = np.zeros(len(n), bool)
            noise[doubtful] = [is_noise(t) for t in batch["text"].filter(pa.array(doubtful)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], batch["declared"], batch["host"], pa.array(n), pa.array(np.where(n > 0, best, -1)),
                 pa.ListArray.from_arrays(cuts, pa.array(weighed.ravel())), pa.array(noise)],
                ["key", "declared", "host", "grams", "pointed", "logs", "noise"])
    return run


def identify(evidence: DataFrame, key: str, work: Workspace | None = None) -> DataFrame:
    """(key, declared, host, text_language, language, probability, kept) for rows (key, text, declared, address).

    Any of the four may be null: without text there is no language and the row isn't kept; without a declaration or an
    address that evidence is left out (rows without an address share one host). Repeated rows are judged each. An empty
    table gives no row; where no row declares a language, none is named and rows stay all the same. Other columns are not
    looked at.
    """
    spark = evidence.sparkSession
    work = work or Workspace(spark)
    rows = evidence.select(F.col(key).alias("key"), "text", declared_language(F.col("declared")).alias("declared"),
                           F.coalesce(host_of(F.col("address")), F.lit("")).alias("host"))
    often = rows.where("declared is not null").groupBy("declared").count()
    names = [r["declared"] for r in often.orderBy(F.desc("count"), "declared").limit(LANGUAGES).collect()]
    cells = map_arrow(rows.where(F.col("declared").isin(names)).select("text", "declared"), _count(names),
                      "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # names x GRAMS at most
    counts = np.zeros((len(names), GRAMS))
    counts.ravel()[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    shares = (counts + ADDED) / (counts.sum(axis=1, keepdims=True) + ADDED * GRAMS)
    logs = np.log((1 - NOISE) * shares + NOISE / GRAMS)
    model = spark.sparkContext.broadcast(TextModel(names, logs.astype(np.float32)))
    kind = evidence.schema[key].dataType.simpleString()
    scored = work.keep("scored", map_arrow(
        rows, _score(model), f"key {kind}, declared string, host string, grams long, pointed long, logs array<double>, noise boolean")
        .withColumn("suffix", suffix_of(F.col("host"))))
    return _fused(scored, names).withColumnRenamed("key", key)


def _fused(scored: DataFrame, names: list[str]) -> DataFrame:
    size = len(names)
    if not size:
        none = F.lit(None).cast("string")
        return scored.select("key", "declared", "host", none.alias("text_language"), none.alias("language"),
                             F.lit(None).cast("double").alias("probability"), _kept().alias("kept"))
    known = [F.count_if(F.col("pointed") == i) for i in range(size)]
    total = scored.agg(F.array(*known).alias("n_all"), F.array(*[F.count_if(
        (F.col("pointed") == i) & F.col("declared").isNotNull()) for i in range(size)]).alias("n_said")).first()
    forms = scored.select("declared").distinct().where("declared is not null").count()
    hosts = scored.groupBy("host").agg(F.array(*known).alias("n_host"), F.first("suffix").alias("suffix"))
    by_suffix = [F.sum(F.col("n_host")[i]) for i in range(size)]
    suffixes = hosts.groupBy("suffix").agg(F.array(*by_suffix).alias("n_suffix"))
    declared = scored.where("declared is not null").groupBy("declared").agg(F.array(*known).alias("n_declared"))
    n_all, n_said = list(total["n_all"]), list(total["n_said"])
    rows = (scored.join(hosts.select("host", "n_host"), "host").join(suffixes, "suffix")
            .join(declared, "declared", "left"))

    def own(i: int) -> Column:
        return (F.col("pointed") == i).cast("int")

    logits = []
    has = F.when(F.col("pointed") >= 0, 1).otherwise(0)
    for i in range(size):
        overall = (F.lit(float(n_all[i])) - own(i) + 1) / (F.lit(float(sum(n_all))) - has + size)
        n_suffix, n_host = (F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) - has for c in ("n_suffix", "n_host"))
        suffix = (F.col("n_suffix")[i] - own(i) + SMOOTH * overall) / (n_suffix + SMOOTH)
        prior = (F.col("n_host")[i] - own(i) + SMOOTH * suffix) / (n_host + SMOOTH)
        stated = (F.col("n_declared")[i] - own(i) + 1) / (F.lit(float(n_said[i])) - own(i) + forms + 1)
        stated = F.when(F.col("declared").isNull(), 0.0).otherwise(F.log(stated))
        logits.append(F.log(prior * (1 - NONE)) + stated + F.col("logs")[i])
    weighed = F.least("grams", F.lit(WEIGHT))
    nothing = F.log(F.lit(NONE)) - weighed * float(np.log(GRAMS)) - F.when(
        F.col("declared").isNull(), 0.0).otherwise(float(np.log(forms + 1)))
    rows = rows.withColumn("logits", F.array(*logits, nothing))
    rows = rows.withColumn("top", F.array_max("logits"))
    rows = rows.withColumn("best", F.array_position("logits", F.col("top")).cast("int"))
    mass = F.aggregate("logits", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))
    name = F.array(*map(F.lit, names))
    named = F.when(F.col("best") <= size, F.get(name, F.col("best") - 1)).otherwise(F.col("declared"))
    return rows.select("key", "declared", "host", F.when(F.col("grams") > 0, F.get(name, F.col("pointed").cast("int")))
                       .alias("text_language"), F.when(_kept(), named).alias("language"),
                       (1 / mass).alias("probability"), _kept().alias("kept"))


def _kept() -> Column:
    return (F.col("grams") > 0) & ~F.col("noise")
