"""Driver values as SQL literal text round-trip exactly."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tessera.functions.literals import string_array, struct_array

AWKWARD = ["the", "the,", "C++", "C#", "O'Reilly", "back\\slash", "tab\tx", "new\nline", "cr\rx", "é", "日本", "😀",
           "'", "\\", "\\'", "a\x01b", "nul\0x", "$1", "%s", "`tick`", '"dq"', ""]


def test_string_array_round_trip(spark):
    assert spark.range(1).select(string_array(AWKWARD).alias("a")).first().a == AWKWARD


def test_struct_array_round_trip(spark):
    schema = StructType([StructField("s", StringType()), StructField("n", LongType()),
                         StructField("d", DoubleType()), StructField("i", IntegerType())])
    rows = [("x'y", 2**40, 0.1, -(2**31)), (None, None, float("nan"), None), ("z", -1, 1e300, 7), ("v", 5, float("-inf"), 1)]
    df = spark.range(1).select(F.inline(struct_array(rows, schema)))
    assert df.dtypes == [("s", "string"), ("n", "bigint"), ("d", "double"), ("i", "int")]
    for got, want in zip([tuple(r) for r in df.collect()], rows):
        for a, b in zip(got, want):
            assert a == b or (isinstance(a, float) and math.isnan(a) and math.isnan(b))
