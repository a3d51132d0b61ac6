"""Projection, filter and deduplication of parsed articles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presswork.functions.text import normalize_text, scoring_text
from presswork.schemas import ARTICLE_FIELDS, BASE_FIELDS, IDENTITY


def select_base(
    articles: DataFrame, max_chars: int | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Parsed articles to the twelve base columns, ``keep`` in front of them."""
    with_text = articles.withColumn("text_for_inference", scoring_text(max_chars=max_chars))
    return with_text.select(*keep, *BASE_FIELDS)


def keep_scorable(base: DataFrame) -> DataFrame:
    """Rows with a key and a text to score; the fingerprint may be null."""
    return base.filter(F.col("url_hash").isNotNull() & F.col("text_for_inference").isNotNull())


def filter_parsed(articles: DataFrame) -> DataFrame:
    """The articles that ``keep_scorable`` lets through, told from their parsed fields. No
    rows here means none after deduplication and scoring either."""
    has_text = F.coalesce("summary", "title", "text").isNotNull()
    return articles.filter(F.col("url_hash").isNotNull() & has_text)


def dedup_articles(
    df: DataFrame, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per ``(url_hash, fingerprint)``, nulls being equal to each other.

    Which copy stays is left to Spark, unless ``order_by`` names the order whose first
    row survives. Either way copies are dropped before the shuffle as well as behind it
    (as a partial aggregate, or a limit on the rows per key), so that a key with a large
    share of the rows arrives as one row per map task, and unused columns are pruned.
    """
    if not order_by:
        return df.dropDuplicates(IDENTITY)
    copies = Window.partitionBy(*IDENTITY).orderBy(*order_by)
    numbered = df.withColumn("_copy", F.row_number().over(copies))
    return numbered.filter(F.col("_copy") == 1).drop("_copy")


def prepare_articles(
    articles: DataFrame,
    max_chars: int | None = None,
    order_by: Sequence[str | Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Base columns of the scorable, deduplicated articles.

    Same rows as ``dedup_articles(keep_scorable(select_base(articles)))``, but the
    two texts derived from the body are computed after the shuffle instead of
    travelling through it next to the body. ``articles`` needs the ten article
    fields only; a ``text_prepped`` it brings along is derived anew.
    """
    scorable = filter_parsed(articles.select(*keep, *ARTICLE_FIELDS))
    derived = {
        "text_prepped": normalize_text("text"),
        "text_for_inference": scoring_text(body="text", max_chars=max_chars),
    }
    return dedup_articles(scorable, order_by).withColumns(derived).select(*keep, *BASE_FIELDS)
