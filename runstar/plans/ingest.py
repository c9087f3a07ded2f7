"""Changed runs, from the object listing to visible tables, all runs in one load."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runstar.operators.validate import Watched, audit_constraints, run_verdict
from runstar.plans import staging
from runstar.plans.star import BUILDERS, JOBS_AT_A_TIME, OF_RECORDS, StarLoad, load_losses
from runstar.schemas import FEED_SCHEMA, TABLES
from runstar.sources import discover
from runstar.sources.feed import (CORRUPT, METADATA_FILE, PUBLICATION_FILES, expected_years, metadata_aliases,
                                  read_feed, read_metadata)
from runstar.sources.sinks import few_large
from runstar.sources.warehouse import REPORT, Conflict, Warehouse
from runstar.sources.workspace import control_table, size_exchanges

RUNS = ["agency", "version"]


@dataclass(frozen=True)
class LoadOptions:
    """How runs are loaded.

    ``if_exists``: ``replace`` a published run, or ``fail`` it unless its reload was requested. ``schema`` of a feed
    record, ``record_key`` that must be unique in a run. ``references`` adds the reference checks to the audit; the
    builders keep references by construction. ``collation`` governs DISTINCT and joins of the star (``UTF8_LCASE`` ignores case).
    """

    if_exists: str = "replace"
    schema: str = FEED_SCHEMA
    record_key: tuple[str, ...] = ("eid",)
    references: bool = False
    collation: str | None = None

    def __post_init__(self) -> None:
        if not self.schema:
            raise ValueError("a load needs a schema: the kinds are typed; read_feed(schema=None) infers one for a look")


SPARK_ERRORS = (PySparkException, Py4JJavaError)
DEFAULTS = LoadOptions()
# Fixed value: how the key of a publication file goes on after agency and version.
PUBLICATION_KEY = "^[^/]+/[^/]+/json/publications/[^/]*[.]json[.]gz$"
METADATA_KEY = f"^[^/]+/[^/]+/{METADATA_FILE}(/|$)"


def admit_runs(warehouse: Warehouse, work: DataFrame, if_exists: str = "replace") -> DataFrame:
    """``work`` with a ``reason`` for runs that may not load: in ``fail`` mode those that exist and are not forced."""
    if if_exists not in ("fail", "replace"):
        raise ValueError("if_exists must be 'fail' or 'replace'")
    if if_exists == "replace":
        return work.withColumn("reason", F.lit(None).cast("string"))
    loaded = (warehouse.runs().withColumnRenamed("id", "run_id")
              .join(warehouse.published(), "run_id", "left_semi").select(*RUNS, F.lit(True).alias("loaded")))
    refused = F.col("loaded") & ~F.col("force")
    return (work.join(loaded, RUNS, "left")
                .withColumn("reason", F.when(refused, F.lit("run exists"))).drop("loaded"))


def presence(listing: DataFrame) -> DataFrame:
    """Per run: are there publication files, and is there metadata?"""
    runs = listing.select("key", *discover.run_of_key(F.col("key"))).where(F.col("agency").isNotNull())
    return runs.groupBy(*RUNS).agg(F.bool_or(F.col("key").rlike(PUBLICATION_KEY)).alias("has_feed"),
                                   F.bool_or(F.col("key").rlike(METADATA_KEY)).alias("has_metadata"))


def validated_runs(feed: DataFrame, metadata: DataFrame, record_key: Sequence[str] = ("eid",)) -> DataFrame:
    """Verdict per run with a ``reason`` for the invalid ones; unreadable lines and documents count as invalid."""
    bad_documents = metadata.groupBy(*RUNS).agg(F.count(CORRUPT).alias("bad_documents"))
    verdict = run_verdict(feed, expected_years(metadata), RUNS, record_key=record_key, corrupt=CORRUPT)
    joined = verdict.join(bad_documents, RUNS, "full_outer")
    reason = (F.when(F.col("bad_documents") > 0, F.lit("malformed metadata"))
               .when(F.col("bad_lines") > 0, F.lit("malformed feed line"))
               .when(~F.coalesce("counts_ok", F.lit(True)), F.lit("input validation failed: documents per year"))
               .when(~F.coalesce("unique_ok", F.lit(False)), F.lit("input validation failed: repeated eid")))
    return joined.select(*RUNS, reason.alias("reason"))


def stage_runs(warehouse: Warehouse, load_id: int, feed: DataFrame, aliases: DataFrame) -> dict[str, DataFrame]:
    """The nine kinds of a load, written by run. ``feed`` and ``aliases`` are read from files of one run each (``write_raw``)."""
    kinds = staging.all_kinds(feed, aliases, keys=("run_id", *RUNS, "eid"))
    with ThreadPoolExecutor(JOBS_AT_A_TIME) as pool:
        written = pool.map(lambda name: warehouse.write_staging(load_id, name, kinds[name], dealt=True), kinds)
        return dict(zip(kinds, written, strict=True))


def load_runs(spark: SparkSession, base: str, warehouse: Warehouse, work: DataFrame,
              options: LoadOptions = DEFAULTS, listing: DataFrame | None = None) -> DataFrame:
    """Validate, stage, build and publish the runs in ``work`` ``(agency, version, force)``.

    A run that fails is recorded with its reason and the others go on. Returns the outcome of every run. ``listing`` is
    what ``list_objects`` has found below ``base``, if known. If another load is published meanwhile, this one is done again, for it
    numbered its rows without that one's.
    """
    while True:
        try:
            return _load_runs(spark, base, warehouse, work, options, listing)
        except Conflict:
            continue


def _load_runs(spark: SparkSession, base: str, warehouse: Warehouse, work: DataFrame, options: LoadOptions,
               listing: DataFrame | None) -> DataFrame:
    base = base.rstrip("/")
    listing = discover.list_objects(spark, base) if listing is None else listing
    admitted = admit_runs(warehouse, work, options.if_exists).join(presence(listing), RUNS, "left")
    reason = (F.when(F.col("reason").isNotNull(), F.col("reason"))
               .when(~F.coalesce("has_feed", F.lit(False)), F.lit("no publication data found"))
               .when(~F.coalesce("has_metadata", F.lit(False)), F.lit("no export metadata found")))
    outcome = {(r["agency"], r["version"]): r["reason"]
               for r in admitted.select(*RUNS, reason.alias("reason")).collect()}  # one row per run
    good = [run for run, why in outcome.items() if why is None]
    report: dict[tuple[str, str], dict[str, int]] = {}
    if good:
        failures, report = _load_admitted(spark, base, warehouse, warehouse.start_load(), good, options)
        outcome |= failures
    rows = [(a, v, "failed" if why else "loaded", why, *(report.get((a, v), {}).get(c) for c in REPORT))
            for (a, v), why in sorted(outcome.items())]
    schema = "agency string, version string, status string, reason string, " + ", ".join(f"{c} bigint" for c in REPORT)
    result = control_table(spark, rows, schema)
    if rows:
        warehouse.record(result)
    return result.select("agency", "version", "status", "reason")


def _frames(spark: SparkSession, base: str, runs: list[tuple[str, str]], options: LoadOptions) -> tuple[DataFrame, DataFrame]:
    folders = [f"{base}/{a}/{v}" for a, v in runs]
    return (read_feed(spark, [f"{f}/{PUBLICATION_FILES}" for f in folders], options.schema, keep_corrupt=True),
            read_metadata(spark, [f"{f}/{METADATA_FILE}" for f in folders], keep_corrupt=True))


def _scan(spark: SparkSession, base: str, warehouse: Warehouse, load_id: int, runs: list[tuple[str, str]],
          options: LoadOptions) -> tuple[dict[tuple[str, str], str], DataFrame, DataFrame]:
    """Reasons of the runs with a file that cannot be read; records and metadata of the others.

    A gzip file is one task. Its records are written once as scanned, typed and splittable; everything else reads those,
    so a large file costs one long task and no shuffle. All runs are scanned in one job; if a file cannot be read, the error names
    it, its run is left out and the others are scanned again together: one scan more than there are such runs. Errors that
    are not about reading a file end the load: they are no run's fault.
    """
    failures: dict[tuple[str, str], str] = {}
    while len(failures) < len(runs):
        readable = [run for run in runs if run not in failures]
        try:
            warehouse.write_raw(load_id, *_frames(spark, base, readable, options))
            break
        except SPARK_ERRORS as e:
            if not _unreadable(e):
                raise
            warehouse.discard_raw(load_id)  # metadata may have been written before the records broke
            failures |= {run: f"load failed: {_reason(e)}" for run in _runs_named(e, readable)}
    bad = control_table(spark, list(failures), "agency string, version string")
    metadata, feed = (warehouse.raw(load_id, n, f.schema).join(bad, RUNS, "left_anti")
                      for n, f in zip(("_metadata", "_raw"), _frames(spark, base, runs, options)[::-1], strict=True))
    return failures, feed, metadata


def _runs_named(error: Exception, runs: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The runs whose files an error says cannot be read; it ends the load if it names none of them."""
    known, named = set(runs), []
    for path in re.findall(r"reading file (\S+)", str(error)):
        for text in (path, unquote(path)):
            parts = text.split("/")
            named += [run for run in zip(parts, parts[1:], strict=False) if run in known and run not in named]
    if not named:
        raise error
    return named


def _unreadable(error: Exception) -> bool:
    return "FAILED_READ_FILE" in str(error)


def _reason(error: Exception) -> str:
    return "\n".join(line for line in str(error).splitlines() if "FAILED_READ_FILE" in line).strip()


def _load_admitted(spark: SparkSession, base: str, warehouse: Warehouse, load_id: int, runs: list[tuple[str, str]],
                   options: LoadOptions) -> tuple[dict[tuple[str, str], str], dict[tuple[str, str], dict[str, int]]]:
    """Reasons of the runs that fail, and what the load reports of the others."""
    failures, feed, metadata = _scan(spark, base, warehouse, load_id, runs, options)
    size_exchanges(spark, feed.count())
    wanted = control_table(spark, [r for r in runs if r not in failures], "agency string, version string")
    verdicts = wanted.join(validated_runs(feed, metadata, options.record_key).withColumn("judged", F.lit(True)), RUNS, "left")
    reason = F.when(F.col("judged").isNull(), F.lit("no records found")).otherwise(F.col("reason"))
    failures |= {(r["agency"], r["version"]): r["reason"]
                 for r in verdicts.select(*RUNS, reason.alias("reason")).where("reason is not null").collect()}  # one row per run
    valid = [run for run in runs if run not in failures]
    if not valid:
        return failures, {}

    keys = warehouse.register(control_table(spark, valid, "agency string, version string"))
    feed = feed.join(keys, RUNS)
    kinds = stage_runs(warehouse, load_id, feed, metadata_aliases(metadata).join(keys, RUNS))
    staged = {name: rows.count() for name, rows in kinds.items()}
    tasks = size_exchanges(spark, max(staged.values()))
    since, watched = warehouse.position(), {}

    def write(name: str, rows: DataFrame) -> DataFrame:
        watch = watched.setdefault(name, Watched(name, TABLES[name]))
        # rows of records are many and lie in tasks of like size
        dealt = name in OF_RECORDS and few_large(min(staged[k] for k in BUILDERS[name][1]), len(valid), tasks)
        return warehouse.write_table(load_id, name, rows, watch, dealt)

    load = StarLoad(spark, kinds, write, warehouse.last_ids(), options.collation)
    tables = load.all()
    report = audit_constraints(tables, TABLES, options.references, watched=watched)
    broken = {r["run_id"]: r for r in report.where((F.col("violations") > 0) & F.col("run_id").isNotNull())
                                            .groupBy("run_id").agg(F.sort_array(F.collect_set(F.concat_ws(" ", "table_name", "rule"))).alias("rules"))
                                            .collect()}  # at most one row per run
    names = {r["run_id"]: (r["agency"], r["version"]) for r in keys.collect()}
    failures |= {names[i]: f"constraint violated: {', '.join(r['rules'])}" for i, r in broken.items()}
    fine = keys.where(~F.col("run_id").isin(list(broken))) if broken else keys
    losses = load_losses(kinds, tables).collect()  # one row per run
    stale = warehouse.table("snippet_validation").join(fine, "run_id", "left_semi").groupBy("run_id").count().collect()
    stale = {r["run_id"]: r["count"] for r in stale}
    if len(broken) < len(names):
        last_ids = {n: w.last_id for n, w in watched.items() if w.rows}
        warehouse.publish(load_id, fine, {n: w.rows for n, w in watched.items()}, last_ids, since)
    rows = {r["run_id"]: r.asDict() for r in losses}
    return failures, {names[i]: rows.get(i, dict.fromkeys(REPORT, 0)) | {"stale_verdicts": stale.get(i, 0)}
                      for i in names if i not in broken}


def ingest(spark: SparkSession, base: str, warehouse: Warehouse, overwrite: bool = False,
           options: LoadOptions = DEFAULTS) -> DataFrame:
    """Load every run with new objects below ``base`` and every run flagged for reload.

    Objects are remembered once their run is loaded, so a failed run is tried again next time.
    """
    listing = discover.list_objects(spark, base)
    fresh = discover.new_objects(listing, warehouse.ledger(), overwrite)
    work = discover.work_list(discover.changed_runs(fresh), warehouse.reload_requests())
    work = control_table(spark, work.collect(), work.schema)  # one row per run
    result = load_runs(spark, base, warehouse, work, options, listing)
    loaded = result.where(F.col("status") == "loaded")
    seen = fresh.select("key", *discover.run_of_key(F.col("key"))).join(loaded, RUNS, "left_semi")
    warehouse.remember(discover.new_objects(seen, warehouse.ledger()))
    return result
