"""Posting lines -> ``POSTING``.

Line layout: ``type,id,accepted?,parent?,score[,tags]``. There is no
quoting; fields past the sixth are ignored. A blank or absent optional field
is null; a malformed integer fails the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import required_cast, strict_cast


def parse_postings(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse comma-separated posting lines; a narrow projection (no shuffle).

    Each line is split once into an array column that the other fields read.
    The posting type is read as the text before the first comma, without the
    split: filters on the type (questions, answers, the join sides) are
    pushed below this projection onto the raw line, and there they then cost
    no array allocation.
    """
    split = lines.select(
        F.substring_index(F.col(column), ",", 1).alias("_type"),
        F.split(F.col(column), ",", -1).alias("_fields"),
    )

    def field(i: int):
        return F.get(F.col("_fields"), i)  # null past the end, never an error

    def optional(i: int):
        return F.nullif(field(i), F.lit(""))

    return split.select(
        required_cast(F.col("_type"), "int", "posting type").alias("posting_type"),
        required_cast(field(1), "bigint", "posting id").alias("id"),
        strict_cast(optional(2), "bigint", "accepted answer id").alias("accepted_answer"),
        strict_cast(optional(3), "bigint", "parent id").alias("parent_id"),
        required_cast(field(4), "int", "score").alias("score"),
        optional(5).alias("tags"),
    )
