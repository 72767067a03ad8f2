"""Time-use survey CSV and its typed projection."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from ..functions.casts import strict_cast

#: Labour-force status, sex and age.
DEMOGRAPHIC_COLUMNS = ("telfs", "tesex", "teage")


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line of a CSV; one line is read."""
    first = spark.read.text(path).head(1)
    if not first:
        raise ValueError(f"no header line in {path}")
    return next(csv.reader([first[0]["value"]]))


def survey_schema(columns: Sequence[str]) -> StructType:
    """The types that a survey column's name implies.

    The first column is the case id (bigint); minute columns (``t`` and digits) and the demographic
    codes are integers; any other column, such as a weight, is a double.
    """
    first, *rest = columns
    kinds = [IntegerType() if re.fullmatch(r"t\d+", c) or c in DEMOGRAPHIC_COLUMNS else DoubleType() for c in rest]
    return StructType([StructField(first, LongType()), *[StructField(c, k) for c, k in zip(rest, kinds)]])


def read_survey(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> tuple[list[str], DataFrame]:
    """Read a headed CSV; returns ``(column names, DataFrame)``.

    Without ``schema`` the types follow from the names in the header line
    (:func:`survey_schema`), so the file is scanned once, when the result is used. A
    value that is not of its column's type fails the job; a blank is null.
    """
    if schema is None:
        schema = survey_schema(header_of(spark, path))
    df = spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)
    return list(df.columns), df


def survey_typed(df: DataFrame) -> DataFrame:
    """First column as string, every other column as double.

    A value that does not parse as a number fails the job.
    """
    first, *rest = df.columns
    return df.select(
        F.col(first).cast("string").alias(first),
        *[strict_cast(F.col(c).cast("string"), "double", f"number in {c}").alias(c) for c in rest],
    )
