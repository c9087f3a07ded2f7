"""Column expressions used by the staging and star plans. All of them stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pipe_join(array: str | Column, sep: str = "|") -> Column:
    """Array to delimited text; a missing array stays null, null elements are skipped."""
    return F.array_join(_col(array).cast("array<string>"), sep)


def json_text(value: str | Column) -> Column:
    """Array or struct as compact JSON text that keeps null struct fields."""
    return F.to_json(_col(value), {"ignoreNullFields": "false"})


def first_or_null(array: str | Column) -> Column:
    """First element; null for a missing or an empty array."""
    return F.get(_col(array), F.lit(0))


def blank_to_null(value: str | Column, *blanks: str) -> Column:
    """Null for the empty string and for every other text that stands for "no value"."""
    c = _col(value)
    return F.when(~c.isin("", *blanks), c)


def text_length(value: Column) -> Column:
    """Length without trailing blanks, null for null."""
    return F.length(F.rtrim(value))


def address_query(address: Column, city: Column, state: Column, country: Column) -> Column:
    """One-line geocoder query: parts joined by commas, null parts left out."""
    return F.concat_ws(",", F.replace(address, F.lit("|"), F.lit(",")), city, state, country)


def run_prefix(agency: Column, version: Column) -> Column:
    """Name prefix of a run's staging tables: blanks around the agency cut, inner blanks as underscores."""
    return F.concat(F.replace(F.trim(agency), F.lit(" "), F.lit("_")), F.lit("_"), version, F.lit("_"))
