from presswork.functions.text import (
    MAX_CHARS,
    collapse_whitespace,
    is_blank,
    normalize_text,
    scoring_text,
)
from presswork.functions.wire import parse_articles, parse_fields, to_wire

__all__ = [
    "MAX_CHARS",
    "collapse_whitespace",
    "is_blank",
    "normalize_text",
    "parse_articles",
    "parse_fields",
    "scoring_text",
    "to_wire",
]
