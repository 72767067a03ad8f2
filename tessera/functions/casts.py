"""Casts that fail the job on malformed input, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_cast(value: Column, to: str, what: str) -> Column:
    """Cast a string; raise when a non-null value does not parse.

    ``what`` names the field in the error. Null stays null. Leading and
    trailing spaces are accepted, as Spark's cast accepts them.
    """
    parsed = value.try_cast(to)
    return F.when(value.isNull(), F.lit(None).cast(to)).otherwise(
        F.coalesce(parsed, _fail(what, value))
    )


def required_cast(value: Column, to: str, what: str) -> Column:
    """Like :func:`strict_cast`, but a missing (null) value is also an error."""
    return F.coalesce(value.try_cast(to), _fail(what, value))


def _fail(what: str, value: Column) -> Column:
    shown = F.coalesce(F.concat(F.lit("'"), value, F.lit("'")), F.lit("<missing>"))
    return F.raise_error(F.concat(F.lit(f"malformed {what}: "), shown))
