"""Joins of child rows to their parents."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runstar.sources.workspace import exchange_tasks


@dataclass(frozen=True)
class Lookup:
    """How child rows find a parent row, and what they take from it.

    ``on`` and ``null_safe`` map child columns to parent columns, ``take`` parent columns to new names.
    """

    parent: DataFrame
    on: Mapping[str, str] = field(default_factory=dict)
    null_safe: Mapping[str, str] = field(default_factory=dict)
    take: Mapping[str, str] = field(default_factory=lambda: {"id": "parent_id"})
    how: str = "inner"
    # join by the keys as they are: child rows that are dealt by them already stay where they are
    plain: bool = False


def lookup(rows: DataFrame, spec: Lookup) -> DataFrame:
    """Join one parent.

    The first join key is a hash of the text and number keys: a sort-merge join then sorts by one number instead of
    long texts with a common beginning. It is an expression of the join, not a column, so it does not travel. A left join spreads rows with a null key, which match nothing, over many tasks.
    """
    keys = {**spec.on, **spec.null_safe}
    wanted = dict.fromkeys([*keys.values(), *spec.take])
    parent = spec.parent.select(*[F.col(c).alias(f"_p_{c}") for c in wanted])
    columns = rows.columns
    hashed = [] if spec.plain else _hashable(rows, spec.parent, keys)
    pairs: list[Column] = []
    if hashed:
        pairs.append(F.xxhash64(*hashed) == F.xxhash64(*[f"_p_{keys[c]}" for c in hashed]))
    child = {c: _collated_like(rows, c, spec.parent, p) for c, p in keys.items()}
    pairs += [child[c] == F.col(f"_p_{p}") for c, p in spec.on.items()]
    pairs += [child[c].eqNullSafe(F.col(f"_p_{p}")) for c, p in spec.null_safe.items()]
    if spec.how == "left" and spec.on:
        unmatched = _any_null(spec.on)
        tasks = 4 * exchange_tasks(rows.sparkSession)
        spread = F.when(unmatched, F.pmod(F.xxhash64(*columns), F.lit(tasks)) + 1).otherwise(0)
        rows = rows.withColumn("_spread", spread)
        pairs.append(F.col("_spread") == F.when(_any_null(f"_p_{p}" for p in spec.on.values()), -1).otherwise(0))
    condition = pairs[0]
    for p in pairs[1:]:
        condition = condition & p
    taken = [F.col(f"_p_{c}").alias(n) for c, n in spec.take.items()]
    return rows.join(parent, condition, spec.how).select(*columns, *taken)


def _collated_like(rows: DataFrame, column: str, parent: DataFrame, parent_column: str) -> Column:
    """A child key, with the collation of its parent key if both are texts."""
    own, wanted = rows.schema[column].dataType, parent.schema[parent_column].dataType
    both_text = isinstance(own, T.StringType) and isinstance(wanted, T.StringType)
    return F.col(column).cast(wanted) if both_text and own != wanted else F.col(column)


def _hashable(rows: DataFrame, parent: DataFrame, keys: Mapping[str, str]) -> list[str]:
    """Child keys whose hash equals that of an equal parent key: same plain type on both sides, one of them text."""
    child_types, parent_types = dict(rows.dtypes), dict(parent.dtypes)
    plain = [c for c, p in keys.items() if child_types[c] == parent_types[p] and child_types[c] in ("string", "bigint")]
    return plain if any(child_types[c] == "string" for c in plain) else []


def _any_null(columns: Iterable[str]) -> Column:
    checks = [F.col(c).isNull() for c in columns]
    result = checks[0]
    for c in checks[1:]:
        result = result | c
    return result


def bridge(df: DataFrame, columns: Iterable[str], lookups: Iterable[Lookup], distinct: bool = True,
           copies: str = "copies", within: Iterable[str] = ()) -> DataFrame:
    """Child rows with the keys of their parents.

    Duplicates are removed (or, with ``distinct=False``, counted in ``copies``) before any join; joins to parents with unique
    ids cannot bring duplicates back. Without ``within`` a partial aggregation in the map tasks comes first. With it, keys that
    spread the rows well, rows are dealt by these keys once: duplicates, which agree in them, and a ``plain`` lookup by them need no
    other exchange of the child rows; if there is no other lookup, ``dense_id_in_place`` can number them there.
    """
    rows = df.select(*columns)
    if within:
        rows = rows.repartition(exchange_tasks(rows.sparkSession), *within)
    rows = rows.distinct() if distinct else rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(copies))
    for spec in lookups:
        rows = lookup(rows, spec)
    return rows
