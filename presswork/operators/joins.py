"""Bringing stand-alone result tables back to the articles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.schemas import IDENTITY

_WIDE = "decimal(38,0)"


def join_results(
    base: DataFrame, *results: DataFrame, on: str | Sequence[str] = tuple(IDENTITY)
) -> DataFrame:
    """``base`` left outer joined with each result table in turn.

    On the row's identity, which ``score_table`` carries: one row out per row in, null
    fingerprints being equal. ``enrich`` has no join at all. ``on="url_hash"`` pairs all
    rows that share one, k rows becoming k² with one table and k³ with two; to know only
    how many that would be, use ``count_joined``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    return reduce(lambda left, right: _left_join(left, right, keys), results, base)


def _left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    own = {key: f"_right_{key}" for key in keys}
    matches = [
        F.col(key) == F.col(other) if key == "url_hash" else F.col(key).eqNullSafe(F.col(other))
        for key, other in own.items()
    ]
    return left.join(right.withColumnsRenamed(own), matches, "left").drop(*own.values())


def count_joined(base: DataFrame, results: dict[str, DataFrame]) -> DataFrame:
    """Per ``url_hash``, the rows ``join_results`` gives and the errors among them.

    ``results`` maps an answer prefix to its result table. Every table is reduced to
    counts per key first and the counts are multiplied, so no pair is ever formed and
    keys meet at most once. Counts are decimals of 38 digits: k³ outgrows a bigint.
    """
    joined = base.groupBy("url_hash").agg(F.count("*").cast(_WIDE).alias("rows"))
    for prefix, table in results.items():
        counts = table.groupBy("url_hash").agg(
            F.count("*").cast(_WIDE).alias(f"_{prefix}_rows"),
            F.count(f"{prefix}_error").cast(_WIDE).alias(f"_{prefix}_failed"),
        )
        joined = joined.join(counts, "url_hash", "left")
    # A key without results keeps its rows once, with no error among them.
    one, none = F.lit(1).cast(_WIDE), F.lit(0).cast(_WIDE)
    matches = {p: F.coalesce(F.col(f"_{p}_rows"), one) for p in results}
    failed = {p: F.coalesce(F.col(f"_{p}_failed"), none) for p in results}

    def times(factors: dict[str, Column]) -> Column:
        return reduce(lambda a, b: (a * b).cast(_WIDE), factors.values(), F.col("rows"))

    errors = [times({**matches, p: failed[p]}).alias(f"{p}_errors") for p in results]
    return joined.select("url_hash", times(matches).alias("rows"), *errors)
