"""Exact similarity join of documents on word shingles, as a join in Jaccard's metric space.

The Jaccard distance is a metric, so distances to pivots bound distances between documents.

First level: the pivots are the sets of a single shingle. A document is closer to those of
its own shingles than to any other, equally close to all of these, and ties are broken by an
order of all shingles, the rare ones first; its Voronoi region is that of its first shingle.
A document within the distance of a link shares so many of its shingles that the first one
they have in common lies among its first ``n - ceil(0.85 n) + 1``, for links from 85% on: the
window of regions to which the document is replicated. Shingles that stand in one document only open no region.

Second level: the pivot of a region is a document, its smallest, and regions with the same
pivot are one. Sizes (the distance to the empty set's side of the space) leave a window of
documents to measure against it. The ones within a link's distance are one component with the
pivot. What is left to find are links between different components. A region's largest component
is dealt over cells once, and only the documents of its others go to all of them, so the
rows do not grow as the square of a large group of near copies.

Inside a cell: a few documents are pivots again, each other document belongs to the nearest, and
by the triangle inequality to a further one if its distance is larger by no more than twice a
link's. These smaller regions are joined in the same way, until they are small or shrink no
more; there, the documents outside the largest component are measured one by one against those
that sizes and distances to pivots allow. Copies of a set are one point from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import hash_groups as hg
from presswork.llm.graph import components
from presswork.llm.tables import read_table, tidy
from presswork.storage import as_table, new_folder, remove, scratch

SHINGLE_WORDS = 4
# Two documents link when 100 * intersection >= PERCENT * union.
PERCENT = 85
# Documents and shingles that a cell is expected to have of the largest component, and of others.
CELL_DOCS = 1024
CELL_SHINGLES = 1_000_000
# Pivots of a region in a cell, and the documents from which on it is divided.
PIVOTS = 8
LEAF_DOCS = 48
# A region is divided if the largest part has this share of it at most.
SHRINK = 0.7


def shingles(raw: bytes, ends: np.ndarray, words: int = SHINGLE_WORDS) -> hg.Hashes:
    """The hashed shingles of a group's documents, sorted by document and hash, each once
    per document. A document with fewer words has one, all of them."""
    lower = raw.lower()
    space = np.frombuffer(lower.translate(_SPACE), "u1").astype(bool)
    starts_doc = np.zeros(len(lower) + 1, bool)
    begins_doc = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    starts_doc[begins_doc] = True
    before = np.concatenate([[True], space[:-1]]) | starts_doc[:-1]
    begins = np.flatnonzero(~space & before)
    after = np.concatenate([space[1:], [True]]) | starts_doc[1:]
    stops = np.flatnonzero(~space & after) + 1
    docs = np.searchsorted(ends, begins, "right")
    spelled = hg.Substrings(lower)(begins, stops) if len(begins) else np.empty(0, "u8")
    one = np.uint64(1)
    if len(spelled) >= words:
        hashes = spelled[: len(spelled) - words + 1]
        for i in range(1, words):
            part = spelled[i : len(spelled) - words + 1 + i]
            hashes = hg.mix(hashes * np.uint64(31) + part + one)
        whole = docs[: len(hashes)] == docs[words - 1 :]
        hashes, owners = hashes[whole], docs[: len(hashes)][whole]
    else:
        hashes, owners = np.empty(0, "u8"), np.empty(0, "i8")
    counts = np.bincount(docs, minlength=len(ends))
    first = np.concatenate([[0], np.cumsum(counts)])
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        folded = np.full(len(short), words, "u8")
        for i in range(words - 1):
            more = counts[short] > i
            folded[more] = hg.mix(folded[more] * np.uint64(31) + spelled[first[short[more]] + i])
        hashes, owners = np.concatenate([hashes, folded]), np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
        hashes, owners = hashes[fresh], owners[fresh]
    return hashes, owners


_SPACE = bytes(1 if b in (9, 10, 11, 12, 13, 32) else 0 for b in range(256))


def _sets(hashes: hg.Hashes, n: int) -> np.ndarray:
    """Where the set of each of ``n`` documents begins, and the last one ends."""
    return np.searchsorted(hashes[1], np.arange(n + 1))


def _describe(
    raw: bytes, ends: np.ndarray, words: int = SHINGLE_WORDS
) -> tuple[int, list[int], list[bytes]]:
    found = shingles(raw, ends, words)
    cuts = _sets(found, len(ends)).tolist()
    prints = [
        hashlib.blake2b(found[0][a:b].tobytes(), digest_size=16).digest()
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    return len(found[0]), np.diff(cuts).tolist(), prints


def _windows(bits: int, percent: int, hashes_of: Callable):
    """For the representatives of a group: set, and the shingles whose regions they are
    replicated to. Documents that are alone in all of theirs are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid, ends, body, answers, chosen in hg.rows_of(batch):
                found = hashes_of(hg.unsqueeze(body), np.array(ends))
                keys, _ = hg.distinct(found, bits)
                cut = found[0] >> np.uint64(64 - bits)
                shared = hg.read_answers(answers)[np.searchsorted(keys, cut)]
                cuts = _sets(found, len(ends))
                nodes, sizes, sets, pivots = [], [], [], []
                for doc in chosen:
                    place, copies = doc["place"], doc["copies"]
                    a, b = cuts[place], cuts[place + 1]
                    n = int(b - a)
                    window = n - (percent * n + 99) // 100 + 1
                    first = np.lexsort((found[0][a:b], shared[a:b]))[:window]
                    others = shared[a:b][first]
                    known = first[(others > copies) | (others == hg.MOST)]
                    if len(known):
                        nodes.append(gid << 20 | place)
                        sizes.append(n)
                        sets.append(found[0][a:b].tobytes())
                        pivots.append(found[0][a:b][known].astype("i8"))
                if nodes:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(nodes, pa.int64()),
                            pa.array(sizes, pa.int32()),
                            pa.array(sets, pa.binary()),
                            pa.array(pivots, pa.list_(pa.int64())),
                        ],
                        ["node", "n", "hashes", "pivots"],
                    )

    return tidy(run)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        common = [
            len(
                np.intersect1d(
                    np.frombuffer(x.as_buffer(), "u8"),
                    np.frombuffer(y.as_buffer(), "u8"),
                    assume_unique=True,
                )
            )
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(common, pa.int32())], ["a", "b", "n", "m", "common"]
        )


def _linked(common: F.Column, n: F.Column, m: F.Column, percent: int) -> F.Column:
    return 100 * common.cast("long") >= percent * (n.cast("long") + m - common)


class _Sets:
    """The sets of a cell, with intersections of one with several by one look at a table."""

    def __init__(self, packed: list[bytes]):
        self.sizes = np.array([len(raw) // 8 for raw in packed], "i8")
        self._starts = np.cumsum(self.sizes) - self.sizes
        hashes = np.frombuffer(b"".join(packed), "u8")
        distinct, self._numbers = np.unique(hashes, return_inverse=True)
        self._table = np.zeros(len(distinct), bool)

    def common(self, one: int, others: np.ndarray) -> np.ndarray:
        own = self._numbers[self._starts[one] : self._starts[one] + self.sizes[one]]
        sizes = self.sizes[others]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(self._starts[others] - ends + sizes, sizes)
        self._table[own] = True
        hits = np.add.reduceat(self._table[self._numbers[at]], ends - sizes, dtype="i8")
        self._table[own] = False
        return hits


class _Cell:
    """The documents of a cell and the components they are in so far."""

    def __init__(self, sets: list[bytes], labels: np.ndarray, away: np.ndarray, percent: int):
        self.sets, self.away, self.percent = _Sets(sets), away, percent
        _, self.labels = np.unique(labels, return_inverse=True)
        self.limit = 1 - percent / 100 + 1e-9
        self.links: list[tuple[int, int]] = []

    def measure(self, one: int, others: np.ndarray) -> np.ndarray:
        """Distances to ``others``; what links is one component from here on."""
        common = self.sets.common(one, others)
        union = self.sets.sizes[one] + self.sets.sizes[others] - common
        for other in others[100 * common >= self.percent * union].tolist():
            if self.labels[other] != self.labels[one]:
                self.links.append((one, other))
                self.labels[self.labels == self.labels[other]] = self.labels[one]
        return 1 - common / union

    def join(self) -> list[tuple[int, int]]:
        """Links that make one component of all documents that any links of the cell join."""
        everything = np.arange(len(self.labels))
        todo = [(everything, np.ones(len(everything), bool))]
        while todo:
            members, home = todo.pop()
            if len(members) > LEAF_DOCS and len(np.unique(self.labels[members])) > 1:
                parts = self._divide(members, home)
                if parts:
                    todo += parts
                    continue
            self._sweep(members, home)
        return self.links

    def _divide(self, members: np.ndarray, home: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Voronoi regions with the documents of their windows, of which those at home are
        marked; nothing if that leaves a region nearly as large. What has nothing in common with
        any pivot is a region too."""
        pivots = members[:: -(-len(members) // PIVOTS)]
        distances = np.stack([self.measure(int(pivot), members) for pivot in pivots])
        nearest, least = distances.argmin(0), distances.min(0)
        far = least >= 1 - 1e-12
        parts = [(least >= 1 - self.limit, home & far)]
        for i, away in enumerate(distances):
            at_home = home & ~far & (nearest == i)
            reach = away[at_home].max(initial=0) + self.limit
            parts.append(((away <= least + 2 * self.limit) & (away <= reach), at_home))
        parts = [(window, at_home) for window, at_home in parts if at_home.any()]
        if max((window.sum() for window, _ in parts), default=0) > SHRINK * len(members):
            return []
        return [(members[window], at_home[window]) for window, at_home in parts]

    def _sweep(self, members: np.ndarray, home: np.ndarray) -> None:
        """All documents but the largest component's, one by one. A link with two guests is
        found where one of them is at home."""
        labels, counts = np.unique(self.labels[members], return_counts=True)
        largest = labels[counts.argmax()]
        sizes, away = self.sets.sizes[members], self.away[members]
        waiting = np.ones(len(members), bool)
        for at in np.flatnonzero(self.labels[members] != largest).tolist():
            waiting[at] = False  # measured against all
            one = int(members[at])
            fits = waiting & (self.labels[members] != self.labels[one]) & (home | home[at])
            fits &= 100 * np.minimum(sizes, sizes[at]) >= self.percent * np.maximum(sizes, sizes[at])
            fits &= ~(np.abs(away - away[at]) > self.limit)  # true for distances not measured
            if fits.any():
                self.measure(one, members[fits])


def _compare(percent: int):
    """Links between the documents of a cell, a spanning forest of them."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("node", kind="stable")
        nodes = cell["node"].to_numpy()
        found = _Cell(
            cell["hashes"].tolist(), cell["component"].to_numpy(), cell["away"].to_numpy(), percent
        ).join()
        links = [(int(nodes[i]), int(nodes[j])) for i, j in found]
        return pd.DataFrame(links, columns=["a", "b"]).astype("i8")

    return run


def _regions(points: DataFrame, percent: int, table: Callable) -> tuple[DataFrame, DataFrame]:
    """The documents of each pivot's region, and ``a, b, n, m, common`` for documents
    and their pivots that differ little enough in size."""
    places = points.select("node", "n", F.explode("pivots").alias("region"))
    heads = places.groupBy("region").agg(
        F.min(F.struct("node", "n")).alias("pivot"), F.max("node").alias("_last")
    )
    heads = heads.filter(F.col("pivot.node") != F.col("_last")).drop("_last")
    members = places.join(heads, "region").filter(F.col("node") != F.col("pivot.node"))
    members = table(
        members.select(
            "node", "n", F.col("pivot.node").alias("p"), F.col("pivot.n").alias("m")
        ).distinct()
    )
    fits = 100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    pairs = members.filter(fits).select(F.col("node").alias("a"), F.col("p").alias("b"), "n", "m")
    sets = points.select("node", "hashes")
    pairs = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    measured = pairs.select("a", "b", "n", "m", "x", "y").mapInArrow(
        _measure, "a long, b long, n int, m int, common int"
    )
    return members, table(measured)


def _blocks(docs: F.Column, shingles: F.Column) -> F.Column:
    return F.greatest(F.ceil(docs / CELL_DOCS), F.ceil(shingles / CELL_SHINGLES)).cast("int")


def _rest(members: DataFrame, measured: DataFrame, known: DataFrame, points: DataFrame,
          percent: int, table: Callable) -> DataFrame:
    """Links between the documents of a region that are in different components so far."""
    distance = 1 - F.col("common") / (F.col("n") + F.col("m") - F.col("common"))
    away = measured.select(F.col("a").alias("node"), F.col("b").alias("p"), distance.alias("away"))
    placed = members.select("p", "node", "n").join(known, "node", "left")
    placed = table(placed.withColumn("component", F.coalesce("component", "node")))
    parts = placed.groupBy("p", "component").agg(
        F.count("*").alias("docs"), F.sum(F.col("n").cast("long")).alias("shingles")
    )
    regions = parts.groupBy("p").agg(
        F.max(F.struct("docs", "component", "shingles")).alias("most"),
        F.sum("docs").alias("docs"),
        F.sum("shingles").alias("shingles"),
    )
    regions = regions.filter(F.col("docs") > F.col("most.docs")).select(
        "p",
        F.col("most.component").alias("largest"),
        _blocks(F.col("most.docs"), F.col("most.shingles")).alias("cells"),
        _blocks(
            F.col("docs") - F.col("most.docs"), F.col("shingles") - F.col("most.shingles")
        ).alias("others"),
    )
    todo = placed.join(regions, "p").join(away, ["node", "p"], "left")
    todo = todo.withColumn("inner", F.col("component") == F.col("largest"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("inner"), F.col("cells")).otherwise(F.col("others")))
    own = own.cast("int")
    # Cells (i, j): a part of the largest component with a part of the others; and, as
    # (-1 - i, j), two parts of the others.
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    further = F.filter(upto("others"), lambda j: j != F.col("own"))
    cells = F.when(
        F.col("inner"), F.transform(upto("others"), lambda j: cell(F.col("own"), j))
    ).otherwise(
        F.concat(
            F.transform(upto("cells"), lambda i: cell(i, F.col("own"))),
            F.transform(
                further, lambda j: cell(-1 - F.least(j, F.col("own")), F.greatest(j, F.col("own")))
            ),
        )
    )
    dealt = todo.withColumn("own", own).select(
        "p", "node", "component", F.coalesce("away", F.lit(float("nan"))).alias("away"),
        F.inline(cells),
    )
    dealt = dealt.join(points.select("node", "hashes"), "node")
    return dealt.groupBy("p", "i", "j").applyInPandas(_compare(percent), "a long, b long")


def jaccard_components(
    docs: DataFrame, percent: int = PERCENT, words: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id, text``).

    Words are runs of anything but ASCII white space, A-Z in lower case; a document's set
    is its distinct shingles of ``words`` words, or the whole sequence if it has fewer. Documents
    link when their sets' Jaccard similarity reaches ``percent``; ``component_id`` is the
    smallest ``doc_id`` that links lead to, the document's own included. Null texts and
    texts without words have no shingle and no link. Rows may repeat and share ``doc_id``;
    each is a document. A null ``doc_id`` is no component's name unless there is no other.
    Other columns are ignored, and an empty table gives an empty one. Shingles are compared
    by 64-bit hashes.
    """
    with scratch(docs.sparkSession) as table:
        return as_table(_components(docs, percent, words, table))


def _components(docs: DataFrame, percent: int, words: int, table: Callable) -> DataFrame:
    spark, folder = docs.sparkSession, new_folder(docs.sparkSession, "groups")
    groups = hg.pack(docs, partial(_describe, words=words), folder)
    hashes_of = partial(shingles, words=words)
    listed = table(hg.list_documents(groups).withColumnRenamed("size", "n_shingles"))
    # Copies of a set are one point; the smallest node stands for it.
    classes = listed.filter("n_shingles > 0").groupBy("print").agg(
        F.min(F.struct("node", "gid", "place")).alias("first"),
        F.min("doc_id").alias("least_id"),
        F.count("*").alias("copies"),
    )
    classes = table(classes.select("print", "first.*", "least_id", "copies"))
    copies = F.least("copies", F.lit(hg.MOST)).cast("int").alias("copies")
    chosen = classes.groupBy("gid").agg(
        F.sort_array(F.collect_list(F.struct("place", copies))).alias("chosen")
    )
    answers, bits = hg.census(groups, hashes_of)
    asked = groups.select("gid", "ends", "body").join(answers, "gid").join(chosen, "gid")
    points = table(
        asked.mapInArrow(
            _windows(bits, percent, hashes_of),
            "node long, n int, hashes binary, pivots array<long>",
        )
    )
    remove(spark, folder)
    members, measured = _regions(points, percent, table)
    near = measured.filter(_linked(F.col("common"), F.col("n"), F.col("m"), percent))
    near = near.select("a", "b")
    known = table(components(near, table))
    rest = table(_rest(members, measured, known, points, percent, table))
    # The components so far stand for the links they came from.
    joined = components(rest.union(known.select("node", "component")), table)
    named = classes.select("print", "node", "least_id").join(joined, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").select("print", "component_id")
    rows = listed.join(named, "print", "left")
    return rows.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id"))
        .otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), sets as (
  select doc_id, unnest(list_distinct(case
    when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i : i + 3], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as shingle
  from words
), sizes as (
  select doc_id, count(*) as n from sets group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)
), ways as (
  select a, b from links union all select b, a from links
), reach as (
  select a, b from ways
  union
  select reach.a, ways.b from reach join ways on reach.b = ways.a
), least as (
  select a, min(b) as b from reach group by a
)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles,
  least(d.doc_id, coalesce(l.b, d.doc_id)) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join least l on l.a = d.doc_id
"""
