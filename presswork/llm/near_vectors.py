"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components.

Vectors whose sign patterns over the hyperplanes of one of several tables agree meet in a
bucket, and there every cosine is computed. The number of bits follows the number of vectors, so
that a bucket of unrelated vectors has about ``bucket_rows``; the number of tables follows
from the bits, so that two vectors right at the threshold miss each other with a
probability of ``miss`` at most.

Exact copies are one point from the start, with its number of copies. Pairs are never rows:
a bucket's task adds up the links of each point and passes on a spanning forest of them. A
pair that shares several buckets counts in the first of their tables only, which the sign
patterns, carried along, say. A crowded bucket is dealt over blocks of ``block_rows``, and
every two blocks of it are compared as two packed rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.graph import components
from presswork.llm.tables import read_table, tidy, worker_cache
from presswork.storage import as_table, scratch

THRESHOLD = 0.95
MISS = 1e-5
BUCKET_ROWS = 512
BLOCK_ROWS = 2048
SEED = 20_12
# Cosines this near to the threshold are computed again, with exact sums.
_DOUBT = 1e-9
_SLICE = 256

_FOUND = pa.list_(pa.struct([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))
_FOUND_SQL = "array<struct<node: long, links: long, root: long>>"


def plan_tables(
    n: int, threshold: float = THRESHOLD, miss: float = MISS, bucket_rows: int = BUCKET_ROWS
) -> tuple[int, int]:
    """Bits and tables for ``n`` vectors."""
    bits = min(60, max(1, math.ceil(math.log2(max(n, 1) / bucket_rows))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    if agree == 1:
        return bits, 1
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def _planes(width: int, count: int) -> np.ndarray:
    cache = worker_cache("planes")
    if (width, count) not in cache:
        cache.clear()
        cache[width, count] = np.random.default_rng(SEED).standard_normal((width, count))
    return cache[width, count]


def _scaled(vectors: list, width: int) -> np.ndarray:
    """Rows filled up with zeros, each scaled by a power of two, which rounds nothing."""
    rows = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        rows[i, : len(v)] = v
    _, power = np.frexp(np.abs(rows).max(1, initial=0))
    return np.ldexp(rows, -power[:, None])


def _sign(width: int, bits: int, tables: int, kind: str):
    weights = np.left_shift(np.int64(1), np.arange(bits, dtype="i8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _scaled(batch.column("v").to_pylist(), width)
            signs = rows @ _planes(width, bits * tables) >= 0
            patterns = signs.reshape(len(rows), tables, bits) @ weights
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("copies"),
                    pa.array([row.tobytes() for row in rows.astype(kind)], pa.binary()),
                    pa.array(patterns.tolist(), pa.list_(pa.int64())),
                ],
                ["node", "copies", "vector", "patterns"],
            )

    return tidy(run)


class Block:
    """Points of a bucket, unpacked."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, rows: np.ndarray, patterns: np.ndarray):
        self.nodes, self.copies, self.patterns = nodes, copies, patterns
        self.rows = rows.astype("f8")
        self.norms = np.sqrt((self.rows * self.rows).sum(1))

    @classmethod
    def of(cls, table: pa.Table, kind: str) -> Block:
        rows = np.frombuffer(b"".join(table.column("vector").to_pylist()), kind)
        patterns = table.column("patterns").combine_chunks().flatten().to_numpy()
        n = table.num_rows
        return cls(
            table.column("node").to_numpy(),
            table.column("copies").to_numpy(),
            rows.reshape(n, -1),
            patterns.reshape(n, -1),
        )

    def packed(self, kind: str) -> list[bytes]:
        return [
            self.nodes.astype("i8").tobytes(),
            self.copies.astype("i8").tobytes(),
            self.rows.astype(kind).tobytes(),
            self.patterns.astype("i8").tobytes(),
        ]

    @classmethod
    def unpack(cls, parts: list[bytes], kind: str) -> Block:
        nodes = np.frombuffer(parts[0], "i8")
        rows = np.frombuffer(parts[2], kind).reshape(len(nodes), -1)
        patterns = np.frombuffer(parts[3], "i8").reshape(len(nodes), -1)
        return cls(nodes, np.frombuffer(parts[1], "i8"), rows, patterns)


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine with sums that round once."""
    squares = math.fsum((a * a).tolist()) * math.fsum((b * b).tolist())
    return math.fsum((a * b).tolist()) / math.sqrt(squares)


def _close(a: Block, b: Block, begin: int, end: int, threshold: float) -> np.ndarray:
    cosines = a.rows[begin:end] @ b.rows.T
    cosines /= a.norms[begin:end, None]
    cosines /= b.norms[None, :]
    close = cosines >= threshold
    for i, j in np.argwhere(np.abs(cosines - threshold) < _DOUBT).tolist():
        close[i, j] = exact_cosine(a.rows[begin + i], b.rows[j]) >= threshold
    return close


def compare(a: Block, b: Block, table: int, threshold: float) -> tuple[np.ndarray, ...]:
    """Points with a link between the two blocks, or inside one if it is given twice: their
    nodes, the links that count in this table, and a node that stands for each one's component."""
    inside = a is b
    close = np.zeros((len(a.nodes), len(b.nodes)), bool)
    rows, columns = np.zeros(len(a.nodes), "i8"), np.zeros(len(b.nodes), "i8")
    for begin in range(0, len(a.nodes), _SLICE):
        end = min(begin + _SLICE, len(a.nodes))
        part = _close(a, b, begin, end, threshold)
        if inside:
            part[np.arange(end - begin), np.arange(begin, end)] = False
        if not part.any():
            continue
        close[begin:end] = part
        for t in range(table):
            part &= a.patterns[begin:end, t, None] != b.patterns[None, :, t]
        rows[begin:end] = part @ b.copies
        if not inside:
            columns += a.copies[begin:end] @ part
    # The smallest node that links inside the cell lead to, for rows and for columns.
    low, other = a.nodes.copy(), b.nodes.copy()
    linked, across = np.flatnonzero(close.any(1)), np.flatnonzero(close.any(0))
    close = close[np.ix_(linked, across)]
    none = np.iinfo("i8").max
    while len(linked):
        before = low[linked], other[across]
        reach = np.where(close, other[across][None, :], none).min(1)
        low[linked] = np.minimum(low[linked], reach)
        reach = np.where(close, low[linked][:, None], none).min(0)
        other[across] = np.minimum(other[across], reach)
        if inside:
            low = other = np.minimum(low, other)
        if (before[0] == low[linked]).all() and (before[1] == other[across]).all():
            break
    if inside:
        return a.nodes[linked], rows[linked], low[linked]
    return (
        np.concatenate([a.nodes[linked], b.nodes[across]]),
        np.concatenate([rows[linked], columns[across]]),
        np.concatenate([low[linked], other[across]]),
    )


def _found(nodes: np.ndarray, links: np.ndarray, roots: np.ndarray) -> list[dict]:
    listed = zip(nodes.tolist(), links.tolist(), roots.tolist(), strict=True)
    return [{"node": n, "links": m, "root": r} for n, m, r in listed]


def _in_block(threshold: float, kind: str):
    """A block's own links and, if its bucket has further ones, the block as a row."""

    def run(rows: pa.Table) -> pa.Table:
        table, bucket, number, blocks = (
            rows.column(name)[0].as_py() for name in ("t", "bucket", "block", "blocks")
        )
        block = Block.of(rows, kind)
        found = _found(*compare(block, block, table, threshold)) if len(block.nodes) > 1 else []
        packed = block.packed(kind) if blocks > 1 else None
        return pa.table(
            {
                "t": pa.array([table], pa.int32()),
                "bucket": pa.array([bucket], pa.int64()),
                "block": pa.array([number], pa.int32()),
                "packed": pa.array([packed], pa.list_(pa.binary())),
                "found": pa.array([found], _FOUND),
            }
        )

    return run


def _between(threshold: float, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = Block.unpack(batch.column("one")[i].as_py(), kind)
                two = Block.unpack(batch.column("two")[i].as_py(), kind)
                found = _found(*compare(one, two, batch.column("t")[i].as_py(), threshold))
                yield pa.RecordBatch.from_arrays([pa.array([found], _FOUND)], ["found"])

    return tidy(run)


def _links(
    points: DataFrame, table: Callable, threshold: float, miss: float, bucket_rows: int,
    block_rows: int, kind: str,
) -> DataFrame:
    """``node, links, root`` of the cells that points (``node, copies, v``) are linked in."""
    sizes = points.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    bits, tables = plan_tables(sizes["n"], threshold, miss, bucket_rows)
    signed = table(
        points.mapInArrow(
            _sign(sizes["width"] or 0, bits, tables, kind),
            "node long, copies long, vector binary, patterns array<long>",
        )
    )
    places = signed.select("*", F.posexplode("patterns").alias("t", "bucket"))
    counted = places.groupBy("t", "bucket").agg(F.count("*").alias("_n"))
    crowded = counted.filter(F.col("_n") > block_rows).select(
        "t", "bucket", F.ceil(F.col("_n") / block_rows).cast("int").alias("blocks")
    )
    dealt = places.join(crowded, ["t", "bucket"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))
    )
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    cells = table(
        dealt.groupBy("t", "bucket", "block").applyInArrow(
            _in_block(threshold, kind),
            f"t int, bucket long, block int, packed array<binary>, found {_FOUND_SQL}",
        )
    )
    packed = cells.filter(F.col("packed").isNotNull())
    one = packed.select("t", "bucket", F.col("block").alias("_i"), F.col("packed").alias("one"))
    two = packed.select("t", "bucket", F.col("block").alias("_j"), F.col("packed").alias("two"))
    both = one.join(two, ["t", "bucket"]).filter("_i < _j").select("t", "one", "two")
    across = both.mapInArrow(_between(threshold, kind), f"found {_FOUND_SQL}")
    return table(cells.select("found").union(across).select(F.inline("found")))


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    miss: float = MISS,
    bucket_rows: int = BUCKET_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id`` and
    ``vector``, an array of numbers).

    Two vectors link when their cosine is ``threshold`` (above 0) or more, in double
    precision. ``n_links`` counts the other vectors that one links with, ``component_id`` is the
    smallest ``vec_id`` that links lead to, its own included, and ``kept`` says whether that is
    its own. No link is below the threshold; one at the threshold is found with a probability of
    ``1 - miss`` at least, closer ones more surely.

    Vectors that are null, without a component other than 0, or with a null or non-finite
    one have no link. Rows may repeat and share ``vec_id``; each is a vector. A null
    ``vec_id`` names a component only if there is no other. Of vectors with different
    lengths the shorter ones are filled up with zeros. Other columns are ignored, and an empty
    table gives an empty one. Exact copies are told by 128 bits of hashes."""
    spark = vectors.sparkSession
    kind = "f4" if dict(vectors.dtypes)["vector"] == "array<float>" else "f8"
    v = F.col("vector").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), usable.alias("_ok"))
    keys = [F.xxhash64("v").alias("_k"), F.xxhash64(F.lit("copy"), "v").alias("_l")]
    with scratch(spark) as table:
        listed = rows.select("vec_id", "_ok", *keys)
        points = rows.filter("_ok").select("vec_id", "v", *keys).groupBy("_k", "_l").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("least"), F.first("v").alias("v")
        )
        # Numbered while they are written, once: read again they keep their numbers.
        points = table(points.withColumn("node", F.monotonically_increasing_id()))
        found = _links(
            points.select("node", "copies", "v"), table, threshold, miss, bucket_rows,
            block_rows, kind,
        )
        edges = found.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        joined = components(edges, table)
        linked = found.groupBy("node").agg(F.sum("links").alias("links"))
        named = points.select("_k", "_l", "node", "copies", "least")
        named = named.join(linked, "node", "left").join(joined, "node", "left")
        named = named.withColumn("component", F.coalesce("component", "node"))
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        links = (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        named = named.join(least, "component").select(
            "_k", "_l", links, "component_id", F.lit(True).alias("_ok")
        )
        result = listed.join(named, ["_k", "_l", "_ok"], "left")
        component = F.when(F.col("_ok"), F.col("component_id")).otherwise(F.col("vec_id"))
        result = result.select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
        return as_table(result)


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = read_table(spark, sf_dir, "embeddings")
    return near_vectors(embeddings.select("vec_id", F.col("embedding").alias("vector")))


SQL = """
with recursive usable as (
  select vec_id, e, sqrt(list_inner_product(e, e)) as norm
  from (select vec_id, embedding::double[] as e from embeddings)
  where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(e, lambda x: x <> 0)) > 0
), links as materialized (
  select a.vec_id as a, b.vec_id as b
  from usable a join usable b on a.vec_id <> b.vec_id
  where list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), reach as (
  select a, b from links
  union
  select reach.a, links.b from reach join links on reach.b = links.a
), named as (
  select a, min(b) as b from reach group by a
), counted as (
  select a, count(*) as n from links group by a
)
select vec_id, coalesce(n, 0)::bigint as n_links,
  least(vec_id, coalesce(b, vec_id)) as component_id,
  vec_id = least(vec_id, coalesce(b, vec_id)) as kept
from embeddings left join named on named.a = vec_id left join counted on counted.a = vec_id
"""
