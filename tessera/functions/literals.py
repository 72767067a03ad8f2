"""Driver-side values as SQL literal text.

A list of values turned into columns one ``lit`` at a time costs one JVM
round trip per value; the same values as one SQL expression cost one. Used
for vocabularies and small parameter tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
)

_ESCAPES = {"\\": "\\\\", "'": "\\'", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\0": "\\0"}


def sql_string(value: str) -> str:
    """A Spark SQL string literal for ``value`` (backslash escapes)."""
    out = []
    for ch in value:
        if ch in _ESCAPES:
            out.append(_ESCAPES[ch])
        elif ord(ch) < 0x20:
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def sql_literal(value, data_type: DataType) -> str:
    """SQL text for one value of ``data_type`` (strings, integers, doubles, booleans)."""
    name = data_type.simpleString()
    if value is None:
        return f"CAST(NULL AS {name})"
    if isinstance(data_type, StringType):
        return sql_string(str(value))
    if isinstance(data_type, (IntegerType, LongType, ShortType)):
        return f"CAST({int(value)} AS {name})"
    if isinstance(data_type, (DoubleType, FloatType)):
        v = float(value)
        text = "NaN" if math.isnan(v) else ("Infinity" if v > 0 else "-Infinity") if math.isinf(v) else repr(v)
        return f"CAST('{text}' AS {name})"
    if isinstance(data_type, BooleanType):
        return "TRUE" if value else "FALSE"
    raise TypeError(f"no SQL literal for {name}")


def string_array(values: Sequence[str]) -> Column:
    """``array<string>`` literal of ``values``, built with one call."""
    if not values:
        return F.array().cast("array<string>")
    return F.expr("array(" + ", ".join(sql_string(v) for v in values) + ")")


def struct_array(rows: Sequence[Sequence], schema: StructType) -> Column:
    """``array<struct>`` literal with one struct per row, built with one call."""
    structs = [
        "named_struct("
        + ", ".join(f"{sql_string(f.name)}, {sql_literal(v, f.dataType)}" for v, f in zip(row, schema.fields))
        + ")"
        for row in rows
    ]
    return F.expr("array(" + ", ".join(structs) + ")")
