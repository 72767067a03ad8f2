"""Schemas of the DataFrames the operators consume and produce."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ARTICLE = StructType([
    StructField("title", StringType()),
    StructField("text", StringType()),
])

POSTING = StructType([
    StructField("posting_type", IntegerType()),
    StructField("id", LongType()),
    StructField("accepted_answer", LongType()),
    StructField("parent_id", LongType()),
    StructField("score", IntegerType()),
    StructField("tags", StringType()),
])
POSTING_COLUMNS = tuple(f.name for f in POSTING.fields)

# x = vocabulary index * spread, y = best answer score.
VECTOR = StructType([
    StructField("x", IntegerType()),
    StructField("y", IntegerType()),
])

# Vectors pre-aggregated to distinct points with their multiplicity.
WEIGHTED_VECTOR = StructType([
    StructField("x", IntegerType()),
    StructField("y", IntegerType()),
    StructField("n", LongType()),
])

RANKING = StructType([
    StructField("lang", StringType()),
    StructField("n", LongType()),
])

CENTRE = StructType([
    StructField("pos", IntegerType()),
    StructField("x", IntegerType()),
    StructField("y", IntegerType()),
])

CENTRE_MOVE = StructType([
    StructField("pos", IntegerType()),
    StructField("old_x", IntegerType()),
    StructField("old_y", IntegerType()),
    StructField("new_x", IntegerType()),
    StructField("new_y", IntegerType()),
])

CLUSTER_RESULT = StructType([
    StructField("lang", StringType()),
    StructField("lang_percent", DoubleType()),
    StructField("cluster_size", LongType()),
    StructField("median_score", IntegerType()),
])

KMEANS_TRACE = StructType([
    StructField("iter", IntegerType()),
    StructField("pos", IntegerType()),
    StructField("old_x", IntegerType()),
    StructField("old_y", IntegerType()),
    StructField("new_x", IntegerType()),
    StructField("new_y", IntegerType()),
    StructField("distance", DoubleType()),
    StructField("iter_distance", DoubleType()),
])

# Nullable on purpose: DataFrame.to() refuses nullable input for a
# non-nullable field, and the hour sums are null when any minute is null.
TIME_USAGE = StructType([
    StructField("working", StringType()),
    StructField("sex", StringType()),
    StructField("age", StringType()),
    StructField("primaryNeeds", DoubleType()),
    StructField("work", DoubleType()),
    StructField("other", DoubleType()),
])
