"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by its SHA-256. A scan looks only at pairs of blob and rule version that the
ledger has not seen, writes their findings, and joins findings back to every path that holds the blob. All work on
texts is Spark SQL expressions: a text is split at a rule's matches, and the lengths of the pieces and the matches give
the places.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runstar.sources.workspace import Workspace


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost, without overlaps; matches whose ``group`` is under ``least`` characters drop."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


#: The three base kinds in the order in which they are listed.
BASE = (Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
             2, 6),
        Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
        # every run of 24 and more; shorter runs would fail the length
        Rule("hex", r"[0-9a-f]{24,}", 0, 24))
#: What may stand between the lines of a key: white space (line breaks may have been lost), written escapes, quote marks.
_BREAK = r"""(?:[\s"'>#*,|]|\\+[nrt])"""
#: Key material: header fields; lines of base64, which any break may end, and narrow ones that are alone in their line.
_FIELDS = rf"(?:{_BREAK}++(?:Proc-Type|DEK-Info|Version|Comment|Charset|Hash|MessageID):\s*+\S++)*+"
_LINES = (rf"(?:(?:{_BREAK}|\+)*+[A-Za-z0-9+/]{{16,}}+={{0,2}}+"
          r"|[\r\n]++[^\S\r\n]*+[A-Za-z0-9+/]++={0,2}+(?=[^\S\r\n]*+[\r\n]))")
#: A key block up to its END line, if nothing but key material stands between; else its header fields, the lines of base64 that
#: follow and a shorter last one. Prose ends the match.
_PEM = (rf"-----BEGIN [A-Z ]{{0,30}}PRIVATE KEY-----(?:{_FIELDS}(?:{_LINES}++(?:(?:{_BREAK}|\+)*+[A-Za-z0-9+/]{{1,15}}+={{0,2}}+)?+)?+"
        rf"(?:{_BREAK}|\+)*+-----END [A-Z ]{{0,30}}PRIVATE KEY-----"
        rf"|(?:{_BREAK}++(?:Proc-Type|DEK-Info):\s*+\S++)*+(?:{_BREAK}*+[A-Za-z0-9+/]{{16,}}+={{0,2}})++"
        rf"(?:{_BREAK}++[A-Za-z0-9+/]++(?:={{1,2}}|(?=[ \t]*+(?:[\r\n]|\z))))?+)?+")
#: What the scan adds: key blocks and prefixed tokens.
MORE = (Rule("pem", _PEM, version=3), Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"))

#: Matches that are folded at a time.
SLICE = 256
FINDING = "array<struct<start:int,rank:int,kind:string,end:int>>"


def _version(rules: Sequence[Rule]) -> str:
    """One text that changes with any rule."""
    return ",".join(f"{r.kind}:{r.version}" for r in rules)


def _spans(text: str, rank: int, rule: Rule) -> Column:
    """All spans of a rule in code points, as ``FINDING``."""
    pattern = F.lit(rule.pattern)
    none = F.array().cast(FINDING)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    sizes = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + x["gap"]
        found = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
                         (start + x["length"]).alias("end"))
        return F.struct((start + x["length"]).alias("at"),
                        F.when(x["size"] >= rule.least, F.concat(done["found"], F.array(found))).otherwise(
                            done["found"]).alias("found"))

    pieces = F.filter(F.arrays_zip(gaps.alias("gap"), lengths.alias("length"), sizes.alias("size")),
                      lambda x: x["length"].isNotNull())
    def placed(pieces: Column) -> Column:
        # places within a slice first, then where each slice begins
        return _bound(F.transform(_sliced(pieces), lambda part: F.aggregate(
            part, F.struct(F.lit(0).alias("at"), none.alias("found")), step)), moved)

    def moved(folded: Column) -> Column:
        begins = F.aggregate(folded, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda done, x: F.struct(
            (done["at"] + x["at"]).alias("at"), F.concat(done["all"], F.array(done["at"])).alias("all")), lambda x: x["all"])
        return F.flatten(F.transform(F.arrays_zip(folded.alias("part"), begins.alias("begin")), lambda x: F.transform(
            x["part"]["found"], lambda f: F.struct((f["start"] + x["begin"]).alias("start"), f["rank"].alias("rank"),
                                                   f["kind"].alias("kind"), (f["end"] + x["begin"]).alias("end")))))

    return F.when(F.col(text).rlike(rule.pattern), _bound(pieces, placed)).otherwise(none)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.transform(F.array(value), use)[0]


def _sliced(array: Column) -> Column:
    """An array in slices of ``SLICE``: what is folded step by step grows by the slice, not by the array."""
    last = F.greatest(F.size(array) - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last, F.lit(SLICE)), lambda i: F.slice(array, i + 1, F.lit(SLICE)))


def scan_blobs(blobs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, found) for rows (blob, text): spans by start, then by rule; blobs without a finding have an empty array."""
    found = [_spans("text", i, r) for i, r in enumerate(rules)]
    return blobs.select("blob", F.array_sort(F.concat(*found)).alias("found"))


class Ledger:
    """The blobs scanned so far and what was found in them, as a table of (blob, rules, found) that only grows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self) -> DataFrame:
        schema = f"blob binary, rules string, found {FINDING}"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], schema)

    def findings(self, rows: DataFrame, path: str, text: str, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
        """(blob, found) of all blobs with a finding; blobs of ``rows`` that are new are scanned and written first.

        Of the rows that share a blob one is scanned, that of the smallest path (twice if a path is repeated).
        """
        version = _version(rules)
        held = rows.select(F.col(path).alias("path"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                           blob_of(F.col(text)).alias("blob"))
        known = self.entries().where(F.col("rules") == version).select("blob")
        unseen = (held.groupBy("blob").agg(F.min("path").alias("path")).join(known, "blob", "left_anti"))
        carrier = held.join(unseen.withColumnRenamed("blob", "__blob").withColumnRenamed("path", "__path"),
                            (F.col("blob") == F.col("__blob")) & F.col("path").eqNullSafe(F.col("__path")), "left_semi")
        (scan_blobs(carrier, rules).dropDuplicates(["blob"]).select("blob", F.lit(version).alias("rules"), "found")
         .write.mode("append").parquet(self.path))
        return self.entries().where(F.col("rules") == version).where(F.size("found") > 0).select("blob", "found")

    def scan(self, rows: DataFrame, path: str, text: str, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
        """(path, blob, found) for each row of ``rows``.

        A null text counts as an empty one; null and repeated paths keep their rows; an empty input gives no row. Other
        columns are not looked at.
        """
        found = self.findings(rows, path, text, rules)
        paths = rows.select(F.col(path).alias("path"), blob_of(F.col(text)).alias("blob"))
        none = F.array().cast(FINDING)
        return paths.join(found, "blob", "left").select("path", "blob", F.coalesce("found", none).alias("found"))

    def redacted(self, rows: DataFrame, path: str, text: str, rules: Sequence[Rule] = BASE + MORE) -> DataFrame:
        """``rows`` with every secret in ``text`` replaced; texts without one, null ones too, stay as they are."""
        found = self.findings(rows, path, text, rules).withColumnRenamed("blob", "__blob").withColumnRenamed("found", "__found")
        joined = rows.join(found, blob_of(F.col(text)) == F.col("__blob"), "left")
        clean = F.when(F.col("__found").isNotNull(), redact(F.col(text), F.col("__found"))).otherwise(F.col(text))
        return joined.withColumn(text, clean).drop("__blob", "__found")


def blob_of(text: Column) -> Column:
    """The address of a text's content; a null text's is that of an empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def fresh_ledger(spark: SparkSession) -> Ledger:
    """A ledger of its own in the shared folder."""
    return Ledger(spark, Workspace(spark).path("ledger"))


def listed(found: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans become one."""
    furthest = F.aggregate(F.transform(_sliced(found), lambda part: F.array_max(F.transform(part, lambda x: x["end"]))),
                           F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda done, x: F.struct(
        F.greatest(done["at"], F.coalesce(x, F.lit(0))).alias("at"), F.concat(done["all"], F.array(done["at"])).alias("all")), lambda x: x["all"])

    def part(x: Column) -> Column:
        """A slice's stretch of the text, from where the spans before it end."""
        ends = F.transform(x["spans"], lambda f: f["end"])
        upto = F.greatest(x["from"], F.coalesce(F.array_max(ends), x["from"]))
        return F.struct(x["spans"].alias("spans"), x["from"].alias("from"), upto.alias("upto"),
                        F.substring(text, x["from"] + 1, upto - x["from"]).alias("text"))

    def replaced(p: Column) -> Column:
        def step(done: Column, x: Column) -> Column:
            fresh = x["start"] >= done["at"]
            gap = F.substring(p["text"], done["at"] - p["from"] + 1, x["start"] - done["at"])
            return F.struct(F.greatest(done["at"], x["end"]).alias("at"),
                            F.when(fresh, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"]).alias("out"))

        return F.aggregate(p["spans"], F.struct(p["from"].alias("at"), F.lit("").alias("out")), step, lambda x: x["out"])

    parts = F.transform(F.arrays_zip(_sliced(found).alias("spans"), furthest.alias("from")), part)
    last = F.coalesce(F.array_max(F.transform(found, lambda x: x["end"])), F.lit(0))
    rest = F.substring(text, last + 1, F.char_length(text))
    return F.when(F.size(found) > 0, F.concat(F.array_join(F.transform(parts, replaced), ""), rest)).otherwise(text)
