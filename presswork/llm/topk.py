"""Exact top-k search by inner product, with Fagin's threshold algorithm.

The vectors are dealt into blocks. A block keeps a list of its rows for every dimension,
sorted by that component. A query walks down all lists at once, from the end that its own
component favours, and scores in full every row it meets. The components where it stands
bound the score of all rows not met; once the k-th best score is above that bound, no other
row of the block can enter. The blocks' results are then ranked together.

Queries are a stated share of the rows and come in blocks too. A cell is a block of rows
with a block of queries; its size does not grow with the table. The queries of a cell walk
in step, twice as deep each time, so that a step is a few products of matrices; one that has
stopped takes no further part.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.tables import read_table
from presswork.storage import as_table, scratch

K = 10
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
# Rows read from every list before the first look at the bound.
STEP = 16
# Whole numbers up to this are exact as doubles, which multiply faster.
_EXACT = 1 << 53


class SortedLists:
    """One list per dimension over the rows of a block, and the search on them."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.up = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.up, 0)
        self.place = np.argsort(self.up, axis=0, kind="stable")

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and scores of the k best rows with another id than the query's, best
        first, ties to the smaller id."""
        return self.search_all(np.array([query_id]), query[None, :], k)[0]

    def search_all(
        self, query_ids: np.ndarray, queries: np.ndarray, k: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """``search`` for several queries."""
        n, favours_high = len(self.ids), queries > 0
        found = [(np.empty(0, "i8"), np.empty(0, "i8"))] * len(queries)
        active, met = np.arange(len(queries)), np.zeros(n, bool)
        largest = max(1, int(np.abs(self.values).max(initial=0)))
        top = largest * max(1, int(np.abs(queries).max(initial=0))) * max(1, queries.shape[1])
        kind = "f8" if top < _EXACT else "i8"
        depth = STEP
        while len(active) and n:
            last, high = min(depth, n), favours_high[active]
            up, down = high.any(0), (~high).any(0)
            read = (self.place[:, up] >= n - last).any(1) | (self.place[:, down] < last).any(1)
            new = np.flatnonzero(read & ~met)
            met[new] = True
            asked = queries[active]
            scores = (asked.astype(kind) @ self.rows[new].astype(kind).T).astype("i8")
            bounds = np.where(high, self.values[n - last], self.values[last - 1])
            bounds = (bounds * asked).sum(1)
            going = []
            for i, q in enumerate(active.tolist()):
                others = self.ids[new] != query_ids[q]
                ids = np.concatenate([found[q][0], self.ids[new][others]])
                values = np.concatenate([found[q][1], scores[i][others]])
                if len(values) > k:
                    enough = np.flatnonzero(values >= np.partition(values, -k)[-k])
                    ids, values = ids[enough], values[enough]
                best = np.lexsort((ids, -values))[:k]
                found[q] = ids[best], values[best]
                # At equal scores a row not met could still have the smaller id.
                if last < n and not (len(best) == k and values[best[-1]] > bounds[i]):
                    going.append(q)
            active = np.array(going, "i8")
            depth *= 2
        return found


def _matrix(vectors: pd.Series) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    rows = np.zeros((len(vectors), width), "i8")
    for i, v in enumerate(vectors):
        rows[i, : len(v)] = v
    return rows


def _cell(k: int) -> Callable:
    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(points) and len(queries):
            both = _matrix(pd.concat([points["_vector"], queries["_vector"]]))
            lists = SortedLists(points["_id"].to_numpy(), both[: len(points)])
            query_ids = queries["_id"].to_numpy()
            best = lists.search_all(query_ids, both[len(points) :], k)
            found = [
                pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores})
                for query_id, (ids, scores) in zip(query_ids.tolist(), best, strict=True)
            ]
        if not found:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="i8")
        return pd.concat(found)

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``vectors`` with the columns ``vec_id`` and
    ``vector`` (an array of whole numbers), of which ``is_query`` picks the queries.

    Each query gets its ``k`` highest scores among all rows with another ``vec_id``, ties to
    the smaller one; all of them if there are fewer. Rows without ``vec_id`` or vector take
    no part. Rows may repeat and share ``vec_id``; each is a candidate, and queries that share
    one are ranked together, as one. Of vectors with different lengths the shorter ones are
    filled up with zeros. An empty table, or one without queries, gives no rows. Other
    columns are ignored.
    """
    with scratch(vectors.sparkSession) as table:
        return as_table(_ranked(vectors, is_query, k, block_rows, query_rows, table))


def _ranked(
    vectors: DataFrame, is_query: Column, k: int, block_rows: int, query_rows: int, table: Callable
) -> DataFrame:
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    # A row's number, kept as it is written, deals it out whatever the ids are.
    rows = table(
        rows.select(
            F.col("vec_id").cast("long").alias("_id"),
            F.col("vector").alias("_vector"),
            F.coalesce(is_query, F.lit(False)).alias("_asks"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if("_asks").alias("q")).first()
    blocks = max(1, math.ceil(sizes["n"] / block_rows))
    query_blocks = max(1, math.ceil(sizes["q"] / query_rows))
    deal = lambda n: F.pmod(F.xxhash64("_row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    points = rows.select("_id", "_vector", deal(blocks).alias("_b"), every(query_blocks).alias("_q"))
    # Another hash than the points', or few of the query blocks would be filled.
    mixed = F.pmod(F.xxhash64("_row", F.lit("query")), F.lit(query_blocks)).cast("int")
    queries = rows.filter("_asks").select("_id", "_vector", mixed.alias("_q"), every(blocks).alias("_b"))
    found = points.groupBy("_b", "_q").cogroup(queries.groupBy("_b", "_q")).applyInPandas(
        _cell(k), "query_id long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = read_table(spark, sf_dir, "embeddings")
    values = F.col("embedding").cast("array<double>")
    whole = F.transform(values, lambda x: F.floor(x * 1024))
    finite = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    usable = embeddings.filter(finite).select("vec_id", whole.alias("vector"))
    return top_k(usable, F.col("vec_id") % 100 == 0)


SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id
  where q.vec_id % 100 = 0
)
select query_id, (row_number() over best)::int as rank, vec_id, score
from scored
window best as (partition by query_id order by score desc, vec_id)
qualify row_number() over best <= 10
"""
