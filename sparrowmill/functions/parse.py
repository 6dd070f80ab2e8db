"""Strict and lenient parsing of delimited text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ON_BAD = ("fail", "reject")


def check_on_bad(on_bad: str) -> None:
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, not {on_bad!r}")


def comma_fields(line: Column | str) -> Column:
    """Comma-separated fields; empty fields at the end are dropped."""
    return F.split(F.rtrim(F.col(line) if isinstance(line, str) else line, F.lit(",")), ",")


def as_double(field: Column) -> Column:
    """The number, or NULL where the text is not one (whatever the ANSI setting)."""
    return field.try_cast("double")


def require(ok: Column, line: Column | str, what: str) -> Column:
    """A filter that lets rows pass where ``ok`` holds; any other row fails the job, which names the line.

    As a filter it is kept whatever columns are read later.
    """
    col = F.col(line) if isinstance(line, str) else line
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{what}: "), col)).cast("boolean"))
