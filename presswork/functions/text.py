"""Column expressions for article text. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a scoring service with short inputs takes.
MAX_CHARS = 2000


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def collapse_whitespace(text: Column | str) -> Column:
    """Each whitespace run becomes one space."""
    return F.regexp_replace(_column(text), r"\s+", " ")


def normalize_text(text: Column | str) -> Column:
    """Trim spaces, then collapse: a run that starts with a tab or a line break
    survives at the ends as one space."""
    return collapse_whitespace(F.trim(_column(text)))


def scoring_text(
    summary: Column | str = "summary",
    title: Column | str = "title",
    body: Column | str = "text_prepped",
    max_chars: int | None = None,
) -> Column:
    """The text to score: first non-null of summary, title and body, collapsed and
    trimmed. It is whole unless a scorer takes ``max_chars`` characters only; the cut
    may leave a final space.

    ``body`` may as well be the raw article text: collapsing and then trimming it
    gives what normalising it first would give.
    """
    chosen = F.coalesce(_column(summary), _column(title), _column(body))
    whole = F.trim(collapse_whitespace(chosen))
    return whole if max_chars is None else F.substring(whole, 1, max_chars)


def is_blank(text: Column | str) -> Column:
    """True for null and for text of nothing but whitespace in Python's sense:
    Unicode white space and the separators U+001C to U+001F."""
    visible = _column(text).rlike(r"(?U)[^\s\x1c-\x1f]")
    return ~F.coalesce(visible, F.lit(False))
