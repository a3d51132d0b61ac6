"""Articles in, enriched articles out: one plan for tables and micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from presswork.operators.articles import prepare_articles
from presswork.operators.scorers import ScorerFactory
from presswork.operators.scoring import CATEGORY, SENTIMENT, score_all
from presswork.schemas import IDENTITY


def enrich(
    articles: DataFrame,
    sentiment: ScorerFactory,
    category: ScorerFactory,
    *,
    max_chars: int | None = None,
    order_by: Sequence[str | Column] | None = None,
    keep: Sequence[str] = (),
    partitions: int | None = None,
    **scoring,
) -> DataFrame:
    """Parsed articles to twelve base and eight answer columns, one row per article.

    The only shuffle is that of the deduplication; both scorers run in the stage
    behind it, on the partitions it leaves. ``partitions`` spreads a small batch over
    that many tasks first, at the price of a second shuffle, where waiting for a remote
    scorer matters more. ``scoring`` goes to ``score`` (chunk size and the like).
    """
    base = prepare_articles(articles, max_chars, order_by, keep)
    if partitions:
        base = base.repartition(partitions, *IDENTITY)
    return score_all(base, {SENTIMENT: sentiment, CATEGORY: category}, **scoring)
