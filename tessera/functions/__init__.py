"""Column-expression helpers: built-in Spark functions only, no Python UDFs."""

from .casts import required_cast, strict_cast
from .geometry import nearest_centre, squared_distance
from .survey import age_band, hours, sex, working_status
from .text import mentioned_terms, mentions, term_position, tokens, vocabulary_array

__all__ = [
    "age_band",
    "hours",
    "mentioned_terms",
    "mentions",
    "nearest_centre",
    "required_cast",
    "sex",
    "squared_distance",
    "strict_cast",
    "term_position",
    "tokens",
    "vocabulary_array",
    "working_status",
]
