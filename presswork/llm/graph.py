"""Connected components of links, by Spark jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.storage import as_table


def _mark(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def components(links: DataFrame, table: Callable[[DataFrame], DataFrame] = as_table) -> DataFrame:
    """``node, component`` for every node in ``links`` (``a, b``): the smallest node it can
    reach.

    Large-star and small-star steps in turn, until nothing changes: each node ties its
    larger neighbours, then its smaller ones and itself, to the smallest it knows. A node
    with very many links is never gathered in one place: its minimum is aggregated on the
    map side, and the join back is one that Spark can split. ``table`` writes each step's
    links and reads them back.
    """
    links = links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    links = table(links.distinct())
    mark = _mark(links)
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), "m")
        large = table(large.filter("a != m").distinct().withColumnRenamed("m", "b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), "m")
        small = small.union(least).distinct().withColumnRenamed("m", "b")
        links = table(small)
        before, mark = mark, _mark(links)
        if mark == before:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(nodes.select("component", "component").distinct())
