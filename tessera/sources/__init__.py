"""Readers and line parsers (text lines, articles, postings, survey CSV)."""

from .articles import parse_articles
from .lines import read_lines
from .postings import parse_postings
from .survey import read_survey, survey_typed

__all__ = ["parse_articles", "parse_postings", "read_lines", "read_survey", "survey_typed"]
