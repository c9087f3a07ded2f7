"""Flattening of nested records."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _leaves(dtype: T.DataType, value: Column, path: str) -> Iterator[Column]:
    if isinstance(dtype, T.StructType):
        for f in dtype.fields:
            yield from _leaves(f.dataType, value.getField(f.name), f"{path}.{f.name}" if path else f.name)
    else:
        yield value.alias(path)


def _leaf_columns(rows: DataFrame, name: str) -> list[Column]:
    return list(_leaves(rows.schema[name].dataType, F.col(name), ""))


def explode_normalize(df: DataFrame, column: str, keys: Iterable[str] = ("eid",)) -> DataFrame:
    """One row per element of an array of structs, one column per leaf.

    Nested structs become dotted names at every depth, arrays stay arrays. Missing arrays, empty arrays and
    null elements give no row.
    """
    rows = df.select(*keys, F.explode(column).alias("_element")).where(F.col("_element").isNotNull())
    return rows.select(*keys, *_leaf_columns(rows, "_element"))


def struct_normalize(df: DataFrame, column: str, keys: Iterable[str] = ("eid",)) -> DataFrame:
    """One row per non-null struct, one column per leaf."""
    rows = df.where(F.col(column).isNotNull())
    return rows.select(*keys, *_leaf_columns(rows, column))


def redact_snippets(df: DataFrame, column: str = "identified_datasets", field: str = "snippets",
                    length: int = 10) -> DataFrame:
    """Cut every text in ``column[*].field`` to ``length`` characters, in place in the nested record."""
    def cut(element: Column) -> Column:
        return element.withField(field, F.transform(element.getField(field), lambda s: F.substring(s, 1, length)))

    return df.withColumn(column, F.transform(column, cut))
