"""Counts over an enriched batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stat_columns() -> list[Column]:
    """All rows, and the rows with a sentiment or a category error."""
    return [
        F.count("*").alias("total"),
        F.count("sentiment_error").alias("sentiment_errors"),
        F.count("category_error").alias("category_errors"),
    ]


def batch_stats(enriched: DataFrame) -> DataFrame:
    """One row with the three counts, in one pass over the two error columns."""
    return enriched.agg(*stat_columns())


def error_rows(enriched: DataFrame, *prefixes: str) -> DataFrame:
    """Rows on which any of the named scorers (both by default) reported an error."""
    failed = F.lit(False)
    for prefix in prefixes or ("sentiment", "category"):
        failed = failed | F.col(f"{prefix}_error").isNotNull()
    return enriched.filter(failed)
