"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from tessera.functions.formatting import report_line
from tessera.functions.geometry import centres_literal, nearest_centre, squared_distance
from tessera.functions.text import (
    check_terms, mentioned_terms, mentions, term_index, terms_array, tokens,
)

__all__ = [
    "report_line", "centres_literal", "nearest_centre", "squared_distance",
    "check_terms", "mentioned_terms", "mentions", "term_index", "terms_array", "tokens",
]
