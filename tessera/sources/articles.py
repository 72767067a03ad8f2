"""Article lines -> ``ARTICLE(title, text)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import ARTICLE_SEPARATOR, ARTICLE_TAIL, ARTICLE_TITLE_OFFSET


def parse_articles(
    lines: DataFrame,
    column: str = "value",
    title_offset: int = ARTICLE_TITLE_OFFSET,
    tail: int = ARTICLE_TAIL,
    separator: str = ARTICLE_SEPARATOR,
) -> DataFrame:
    """Cut each line into title and text at fixed offsets around ``separator``.

    With ``i`` the 0-based position of the first separator, the title is the
    characters ``[title_offset, i)`` and the text runs from just after the
    separator up to ``tail`` characters before the end of the line. A line
    without the separator, or too short for these offsets, fails the job.
    A narrow projection: no shuffle.
    """
    line = F.col(column)
    found = F.instr(line, separator)  # 1-based, 0 when absent
    start = found - 1  # 0-based separator position
    text_start = start + len(separator)
    text_end = F.length(line) - tail
    valid = (found > 0) & (start >= title_offset) & (text_end >= text_start)
    error = F.raise_error(
        F.lit(f"malformed article line: no '{separator}' at a valid offset")
    )
    title = line.substr(F.lit(title_offset + 1), start - title_offset)
    text = line.substr(text_start + 1, text_end - text_start)
    # The check sits in both outputs so that pruning either column keeps it.
    return lines.select(
        F.when(valid, title).otherwise(error).alias("title"),
        F.when(valid, text).otherwise(error).alias("text"),
    )
