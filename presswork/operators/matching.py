"""Matching a table of scorer replies to articles, in one distributed join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presswork.functions.text import is_blank
from presswork.operators.scoring import EMPTY_TEXT, ScoreSpec
from presswork.storage import as_table

#: Rows of one key that go to one task.
TARGET_ROWS = 100_000

#: A key with a smaller share of the rows is not split: there are at most 1 / LEAST_SHARE
#: keys with a larger one, which bounds the broadcasts below.
LEAST_SHARE = 1e-5

# Rows without a key match nothing; they are dealt out evenly.
_NULL_SALTS = 1000


def last_replies(
    replies: DataFrame, specs: Sequence[ScoreSpec], order_by: Sequence[str | Column]
) -> DataFrame:
    """One ``reply`` per ``url_hash``, the last by ``order_by``; replies without a key
    are ignored. Aggregated before the shuffle, so a much-repeated key is harmless."""
    answers = [name for spec in specs for name in (spec.label_key, spec.score_key)]
    reply = F.max_by(F.struct(*answers), F.struct(*order_by))
    keyed = replies.filter(F.col("url_hash").isNotNull())
    return keyed.groupBy("url_hash").agg(reply.alias("reply"))


def match_scores(
    base: DataFrame,
    replies: DataFrame,
    *specs: ScoreSpec,
    order_by: Sequence[str | Column],
    target_rows: int = TARGET_ROWS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """``base`` with label, score and error from a table of replies, row for row.

    The bulk form of what ``score`` does with the replies to one request: the last
    reply to a ``url_hash`` counts for all its rows, blank texts are not matched, and
    a row without a reply says so. ``replies`` has ``url_hash``, the answer columns of
    the specs and those of ``order_by``.
    """
    latest = last_replies(replies, specs, order_by)
    matched = join_unique(base, latest, "url_hash", target_rows, least_share)
    blank = is_blank("text_for_inference")
    asked = F.when(~blank, F.col("reply"))
    columns: list[str | Column] = [*base.columns]
    for spec in specs:
        missing = F.when(F.col("reply").isNull(), F.lit(spec.missing_error))
        columns += [
            asked[spec.label_key].alias(f"{spec.prefix}_label"),
            asked[spec.score_key].cast("double").alias(f"{spec.prefix}_score"),
            F.when(blank, F.lit(EMPTY_TEXT)).otherwise(missing).alias(f"{spec.prefix}_error"),
        ]
    return matched.select(*columns)


def join_unique(
    left: DataFrame,
    right: DataFrame,
    key: str,
    target_rows: int = TARGET_ROWS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Left outer join to a ``right`` that has each ``key`` at most once.

    A key with more than ``target_rows`` rows in ``left`` is spread over as many salts as it
    takes to leave each about so many, and its row of ``right`` is repeated once per salt;
    all other rows keep salt 0. ``left`` is shuffled once, and ``right`` grows by the rows of
    ``left`` over ``target_rows``, and a row per hot key, at most. Rows without a key are
    spread as well. Finding the hot keys evaluates ``left`` a second time, pruned to its key;
    where that costs more than a copy, give ``storage.as_table(left)``. They are kept as a
    table, ``1 / least_share`` rows at most, which both sides are given.
    """
    salts = as_table(hot_keys(left, key, target_rows, least_share))
    hot = F.broadcast(salts)
    none = F.lit(0).cast("bigint")
    widest = salts.agg(F.coalesce(F.max("_salts"), F.lit(1)).alias("n")).first()["n"]
    # From the row and its input partition: exact copies are told apart, and a
    # recomputed task repeats its choice, which a random number might not.
    traits = [name for name in left.columns if name != key]
    number = F.xxhash64(F.spark_partition_id(), *traits)
    nulls = F.when(F.col(key).isNull(), F.lit(max(widest, _NULL_SALTS)))
    spread = F.pmod(number, F.coalesce("_salts", nulls, F.lit(1)).cast("bigint"))
    salted_left = left.join(hot, key, "left").withColumn("_salt", spread).drop("_salts")
    last = F.coalesce(F.col("_salts") - 1, none)
    salted_right = (
        right.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(none, last)))
        .drop("_salts")
    )
    return salted_left.join(salted_right, [key, "_salt"], "left").drop("_salt")


def hot_keys(
    df: DataFrame,
    key: str,
    target_rows: int = TARGET_ROWS,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The keys with more than ``target_rows`` rows and at least ``least_share`` of the keyed
    ones, and ``_salts``, over how many tasks to spread each. Reads the key column only."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    hot = (F.col("_rows") > target_rows) & (F.col("_rows") >= F.lit(least_share) * total)
    salts = F.ceil(F.col("_rows") / F.lit(target_rows)).cast("bigint")
    return counts.filter(hot).select(key, salts.alias("_salts"))
