"""Checks of a feed against its metadata, and of built tables against their constraints."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from runstar.schemas import Table


class ValidationError(AssertionError):
    """A run does not match its export metadata."""


def observed_counts(df: DataFrame, key: str, id_col: str, runs: Sequence[str] = ()) -> DataFrame:
    """Distinct ids per key value; null keys and null ids are not counted.

    Distinct pairs first, then a plain count: a hot key value is spread over its ids instead of one task.
    """
    pairs = df.where(F.col(key).isNotNull()).select(*runs, key, id_col).distinct()
    return pairs.groupBy(*runs, key).agg(F.count(id_col).alias("observed"))


def reconcile_counts(expected: DataFrame, observed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of ``expected`` and ``observed`` counts; a missing side counts zero."""
    both = expected.join(observed, list(keys), "full_outer")
    both = both.withColumn("expected", F.coalesce("expected", F.lit(0)).cast("bigint"))
    both = both.withColumn("observed", F.coalesce("observed", F.lit(0)).cast("bigint"))
    return both.withColumn("diff", F.col("expected") - F.col("observed"))


def all_equal(differences: DataFrame, runs: Sequence[str]) -> DataFrame:
    """Per run: does every difference vanish?"""
    return differences.groupBy(*runs).agg(F.bool_and(F.col("diff") == 0).alias("counts_ok"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values with more than one row; rows whose key is null are ignored."""
    present = df.dropna(how="any", subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def check_unique(df: DataFrame, keys: Sequence[str], runs: Sequence[str] = ()) -> DataFrame:
    """Per run (or once): is every key unique? No keys at all is not unique."""
    counts = (df.dropna(how="any", subset=list(keys)).groupBy(*runs, *keys)
                .agg(F.count(F.lit(1)).alias("n_rows")))
    return counts.groupBy(*runs).agg(
        F.coalesce(F.max("n_rows") == 1, F.lit(False)).alias("unique_ok"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.max("n_rows"), F.lit(0)).cast("bigint").alias("max_rows_per_key"))


def run_verdict(feed: DataFrame, expected: DataFrame, runs: Sequence[str] = ("agency", "version"),
                year: str = "publication_year", id_col: str = "eid", record_key: Sequence[str] | None = None,
                corrupt: str | None = None) -> DataFrame:
    """One row per run with ``counts_ok``, ``unique_ok`` and ``valid``; with ``corrupt``, a column that is null but for bad
    lines, also ``bad_lines``.

    ``expected`` holds the runs, the year and the number of documents as ``expected``. Runs that appear on one
    side only get a verdict as well. ``record_key`` (by default the id) is what must be unique.

    The feed is read once: records are grouped by key and year, these groups by id, and those by year, so each step
    works on what the one before has left; a hot year or run is spread over its ids.
    """
    key = list(record_key or [id_col])
    if id_col not in key:  # uniqueness needs a grouping of its own
        unique = check_unique(feed, key, runs).select(*runs, "unique_ok")
        rest = run_verdict(feed, expected, runs, year, id_col, None, corrupt).drop("unique_ok", "valid")
        joined = rest.join(unique, list(runs), "full_outer")
        joined = joined.withColumn("counts_ok", F.coalesce("counts_ok", F.lit(True)))
        joined = joined.withColumn("unique_ok", F.coalesce("unique_ok", F.lit(False)))
        return joined.withColumn("valid", F.col("counts_ok") & F.col("unique_ok"))
    bad = F.count(corrupt) if corrupt else F.lit(0)
    by_year = feed.groupBy(*runs, *key, year).agg(F.count(F.lit(1)).alias("_rows"), bad.alias("_bad"))
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    by_key = by_year.groupBy(*runs, *key).agg(
        F.when(whole, F.sum("_rows")).alias("_rows"), F.sum("_bad").alias("_bad"), F.collect_set(year).alias("_years"))
    if key != [id_col]:
        by_key = by_key.groupBy(*runs, id_col).agg(F.max("_rows").alias("_rows"), F.sum("_bad").alias("_bad"),
                                                   F.array_distinct(F.flatten(F.collect_list("_years"))).alias("_years"))
    years = by_key.select(*runs, id_col, "_rows", "_bad", F.posexplode_outer("_years").alias("_pos", year))
    seen = years.groupBy(*runs, year).agg(
        F.count(id_col).alias("observed"), F.max("_rows").alias("_rows"),
        F.sum(F.when(F.coalesce("_pos", F.lit(0)) == 0, F.col("_bad")).otherwise(0)).alias("_bad"))
    both = reconcile_counts(expected, seen, [*runs, year])
    stated = F.col(year).isNotNull()
    verdict = both.groupBy(*runs).agg(
        F.coalesce(F.bool_and(F.when(stated, F.col("diff") == 0)), F.lit(True)).alias("counts_ok"),
        F.coalesce(F.max("_rows") == 1, F.lit(False)).alias("unique_ok"),  # no keys means an empty feed
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad_lines"))
    verdict = verdict.withColumn("valid", F.col("counts_ok") & F.col("unique_ok"))
    return verdict if corrupt else verdict.drop("bad_lines")


def require_valid(verdict: DataFrame, runs: Sequence[str] = ("agency", "version"), raise_on_fail: bool = True) -> bool:
    """True if every run is valid; otherwise raise with the names of failing runs, or return False."""
    failing = verdict.where(~F.col("valid")).select(*runs).collect()  # one row per run
    if failing and raise_on_fail:
        names = ", ".join("_".join(str(v) for v in row) for row in failing)
        raise ValidationError(f"input validation failed for {names}")
    return not failing


def row_rules(df: DataFrame, required: Sequence[str] = (), lengths: Mapping[str, int] | None = None,
              by: Sequence[str] = ()) -> DataFrame:
    """``(rule, violations)`` for required columns and text lengths, from a single pass."""
    checks = {f"not_null:{c}": F.col(c).isNull() for c in required}
    checks |= {f"max_length:{c}": F.length(c) > n for c, n in (lengths or {}).items()}
    return _count_rules(df, checks, by)


def _count_rules(df: DataFrame, checks: dict, by: Sequence[str]) -> DataFrame:
    counts = df.groupBy(*by).agg(*[F.count_if(cond).alias(f"r{i}") for i, cond in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
                     for i, rule in enumerate(checks)])
    return counts.select(*by, F.inline(rows))


def unique_rule(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Number of key values that occur more than once; null counts as a value, as in a unique constraint."""
    grouped = list(dict.fromkeys([*by, *columns]))
    counts = df.groupBy(*grouped).agg(F.count(F.lit(1)).alias("n_rows"))
    return (counts.groupBy(*by).agg(F.count_if(F.col("n_rows") > 1).alias("violations"))
                  .select(*by, F.lit("unique:" + ",".join(columns)).alias("rule"), "violations"))


def reference_rule(child: DataFrame, column: str, parent: DataFrame, parent_column: str = "id",
                   by: Sequence[str] = ()) -> DataFrame:
    """Number of non-null references without a parent.

    References are counted per value before the join, so a hot parent travels as one row per map task.
    """
    refs = child.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
    keys = parent.select(F.col(parent_column).alias("_parent")).distinct()
    orphans = refs.join(keys, F.col(column) == F.col("_parent"), "left_anti")
    return (orphans.groupBy(*by).agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations"))
                   .select(*by, F.lit(f"reference:{column}").alias("rule"), "violations"))


class Watched:
    """Figures of a table gathered while it is written: rows, highest id, rows that break a required column or a length."""

    def __init__(self, name: str, spec: Table):
        self._seen = Observation(f"{name}-{uuid4().hex}")
        self._checks = _row_checks(spec)

    def __call__(self, rows: DataFrame) -> DataFrame:
        last = F.max("id") if "id" in rows.columns else F.lit(None).cast("bigint")
        broken = [F.count_if(c).alias(f"r{i}") for i, c in enumerate(self._checks.values())]
        return rows.observe(self._seen, F.count(F.lit(1)).alias("n"), last.alias("last_id"), *broken)

    @property
    def rows(self) -> int:
        return self._seen.get["n"]

    @property
    def last_id(self) -> int:
        return self._seen.get["last_id"] or 0

    @property
    def sound(self) -> bool:
        """Whether no row breaks a rule about itself."""
        return not any(self._seen.get[f"r{i}"] for i in range(len(self._checks)))


def _row_checks(spec: Table) -> dict[str, Column]:
    lengths = {c.name: c.length for c in spec.columns if c.length}
    checks = {f"not_null:{c.name}": F.col(c.name).isNull() for c in spec.columns if c.required}
    return checks | {f"max_length:{c}": F.length(c) > n for c, n in lengths.items()}


def audit_table(name: str, spec: Table, tables: Mapping[str, DataFrame], references: bool = True,
                by_run: bool = True, row_rules_too: bool = True) -> DataFrame | None:
    """Report ``(table_name, [run_id,] rule, violations)`` of one built table; rules without violations may be absent
    for references and keys. Without ``row_rules_too`` only these are checked, and there may be none."""
    df = tables[name]
    by = ["run_id"] if by_run and spec.run_scoped else []
    lengths = {c.name: c.length for c in spec.columns if c.length}
    required = [c.name for c in spec.columns if c.required]
    parts = [row_rules(df, required, lengths, by)] if row_rules_too and (required or lengths) else []
    if spec.unique:
        parts.append(unique_rule(df, spec.unique, by))
    if references:
        for column, parent in spec.parents.items():
            if parent in tables:
                parts.append(reference_rule(df, column, tables[parent], by=by))
    if not parts:
        return None
    report = reduce(DataFrame.unionByName, parts)
    if not by and by_run:
        report = report.withColumn("run_id", F.lit(None).cast("bigint"))
    leading = ["run_id"] if by_run else []
    return report.select(F.lit(name).alias("table_name"), *leading, "rule", "violations")


def audit_constraints(tables: Mapping[str, DataFrame], specs: Mapping[str, Table], references: bool = True,
                      by_run: bool = True, watched: Mapping[str, Watched] | None = None) -> DataFrame:
    """Constraint report of all given tables.

    Tables whose writing was ``watched`` are read for their rules about single rows only if some row breaks one: to tell its run.
    """
    watched = watched or {}
    reports = [audit_table(n, specs[n], tables, references, by_run, not (n in watched and watched[n].sound)) for n in tables
               if n in specs and _has_rules(specs[n], tables if references else ())]
    return reduce(DataFrame.unionByName, [r for r in reports if r is not None])


def _has_rules(spec: Table, parents: Iterable[str]) -> bool:
    return bool(spec.unique) or any(c.required or c.length for c in spec.columns) or any(
        p in parents for p in spec.parents.values())


def checked_rules(name: str, spec: Table, tables: Iterable[str], references: bool = True) -> list[str]:
    """The rules that the audit of a table checks."""
    rules = [f"not_null:{c.name}" for c in spec.columns if c.required]
    rules += [f"max_length:{c.name}" for c in spec.columns if c.length]
    rules += ["unique:" + ",".join(spec.unique)] if spec.unique else []
    return rules + [f"reference:{c}" for c, p in spec.parents.items() if references and p in tables]
