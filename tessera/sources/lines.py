"""Plain text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a UTF-8 text file (or folder of files): ``value string``.

    The read is split across tasks by file block; nothing passes through the
    driver. A missing path fails with ``PATH_NOT_FOUND``.
    """
    return spark.read.text(path)
