"""Sources: text lines, the two line parsers, and the test-table adapters."""

from tessera.sources.articles import parse_article_lines
from tessera.sources.postings import POSTING_COLUMNS, POSTING_SCHEMA, parse_posting_lines
from tessera.sources.text import read_lines

__all__ = ["parse_article_lines", "POSTING_COLUMNS", "POSTING_SCHEMA",
           "parse_posting_lines", "read_lines"]
