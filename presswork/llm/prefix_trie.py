"""The prefix trie of conversations: what they share, from their first turns on.

A conversation is the sequence of its turns, each known by 128 bits of hashes and its number
of bytes; texts are read once and never shuffled. Equal sequences are one, with its members.
The distinct sequences are sorted into ranges, and ranges are cut into shards of bounded size. A shard
numbers its turns and puts its sequences into a ternary search trie, medians first, so that
the search trees at its nodes are balanced. One iterative walk numbers its nodes from the top
down, and one from the bottom up adds up members, leaves and savings.

Only nodes on the paths to a shard's first and last sequence can be in other shards as well:
the boundary nodes. Their sums are merged by path. What the two neighbours of a cut share is
the common prefix of the sequences beside it; the nodes there were counted once too often, as
children and as texts to keep, and a sequence that ends right at the cut as a leaf. Corrections
for that are added to the sums, as rows of their own.
"""

from __future__ import annotations

import hashlib
import math
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.tables import read_table, tidy
from presswork.storage import as_table, scratch

# Turns in a shard, unless one sequence is longer, and in a range of shards.
SHARD_TURNS = 20_000
RANGE_TURNS = 50_000
# Neighbouring conversation ids that may travel in one row.
BLOCK_IDS = 1 << 16

NO_ENDS = hashlib.sha256(b"").hexdigest()

_TURN_SQL = "struct<k: long, l: long, n: long>"
_SEQ = pa.list_(pa.struct([("k", pa.int64()), ("l", pa.int64()), ("n", pa.int64())]))
_WHOLE, _CHILD, _OPEN, _CUT, _FIRST, _LAST = range(6)
_NUMBERS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
_ROWS_SQL = (
    "kind int, shard long, path binary, parent binary, "
    + ", ".join(f"{name} long" for name in _NUMBERS)
    + f", ends_sha256 string, seq array<{_TURN_SQL}>"
)
_ROWS = pa.schema(
    [
        ("kind", pa.int32()),
        ("shard", pa.int64()),
        ("path", pa.binary()),
        ("parent", pa.binary()),
        *((name, pa.int64()) for name in _NUMBERS),
        ("ends_sha256", pa.string()),
        ("seq", _SEQ),
    ]
)


class TernaryTrie:
    """Sequences of numbers. Node 0 is the empty prefix; the children of a node are a binary
    search tree that starts at its ``middle``."""

    def __init__(self) -> None:
        self.turn, self.end = [-1], [-1]
        self.low, self.middle, self.high = [-1], [-1], [-1]

    def _new(self, turn: int) -> int:
        self.turn.append(turn)
        for links in (self.end, self.low, self.middle, self.high):
            links.append(-1)
        return len(self.turn) - 1

    def insert(self, sequence: list[int], row: int) -> int:
        node = 0
        for turn in sequence:
            at, links, holder = self.middle[node], self.middle, node
            while at >= 0 and self.turn[at] != turn:
                links, holder = (self.low if turn < self.turn[at] else self.high), at
                at = links[at]
            if at < 0:
                at = links[holder] = self._new(turn)
            node = at
        self.end[node] = row
        return node

    def walk(self) -> Iterator[tuple[int, int, int]]:
        """``node, parent, depth``, parents first. Nothing recursive: conversations may
        have any number of turns."""
        yield 0, -1, 0
        todo = [(self.middle[0], 0, 1)]
        while todo:
            at, parent, depth = todo.pop()
            if at < 0:
                continue
            yield at, parent, depth
            todo.append((self.high[at], parent, depth))
            todo.append((self.low[at], parent, depth))
            todo.append((self.middle[at], at, depth + 1))


def medians_first(n: int) -> Iterator[int]:
    """The numbers below ``n``, the middle of each part before its halves."""
    parts = deque([(0, n)])
    while parts:
        begin, end = parts.popleft()
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            parts.append((begin, middle))
            parts.append((middle + 1, end))


def path_ids(sequence: list[dict]) -> list[bytes]:
    """A name for each prefix, the empty one first."""
    names = [b""]
    for turn in sequence:
        key = b"%d,%d" % (turn["k"], turn["l"])
        names.append(hashlib.blake2b(names[-1] + key, digest_size=16).digest())
    return names


def _key(turn: dict) -> tuple[int, int]:
    return turn["k"], turn["l"]


def cut_rows(before: list[dict], after: list[dict]) -> list[dict]:
    """What the shards on both sides of a cut counted twice, by shared node."""
    shared = 0
    while shared < min(len(before), len(after)) and _key(before[shared]) == _key(after[shared]):
        shared += 1
    names, size, rows = path_ids(before[:shared]), 0, []
    for depth in range(shared, -1, -1):
        size += before[depth - 1]["n"] if depth else 0
        rows.append(
            {
                "kind": _CUT,
                "path": names[depth],
                "n_convs": 0,
                "n_children": -1 if depth < shared else 0,
                "n_leaves": -1 if len(before) == shared else 0,
                "saved_tokens": size,
            }
        )
    return rows


def shard_rows(rows: list[dict], shard: int) -> list[dict]:
    """The nodes of a shard's distinct, sorted sequences (``seq, members, least,
    ends_sha256``): whole ones, children of boundary nodes, and its part of boundary nodes."""
    numbers = {key: i for i, key in enumerate(sorted({_key(t) for r in rows for t in r["seq"]}))}
    sizes = {numbers[_key(t)]: t["n"] for r in rows for t in r["seq"]}
    trie = TernaryTrie()
    for i in medians_first(len(rows)):
        trie.insert([numbers[_key(t)] for t in rows[i]["seq"]], i)
    order = list(trie.walk())
    nodes = len(trie.turn)
    parents, depths = [-1] * nodes, [0] * nodes
    members, least = [0] * nodes, [None] * nodes
    children, leaves, saved = [0] * nodes, [0] * nodes, [0] * nodes
    for node, parent, depth in reversed(order):
        parents[node], depths[node] = parent, depth
        if trie.end[node] >= 0:
            row = rows[trie.end[node]]
            members[node] += row["members"]
            own = row["least"]
            least[node] = own if least[node] is None else min(own, least[node])
        leaves[node] += not children[node]
        if node:
            saved[node] += (members[node] - 1) * sizes[trie.turn[node]]
            members[parent] += members[node]
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
            own = least[node]
            least[parent] = own if least[parent] is None else min(own, least[parent])
    # The boundary nodes, with the names of their paths.
    names = {0: b""}
    for row in (rows[0], rows[-1]):
        node = 0
        for turn, name in zip(row["seq"], path_ids(row["seq"])[1:], strict=True):
            node, wanted = trie.middle[node], numbers[_key(turn)]
            while trie.turn[node] != wanted:
                node = trie.low[node] if wanted < trie.turn[node] else trie.high[node]
            names[node] = name
    out = []
    for node, parent, depth in order:
        is_open, below_open = node in names, parent in names
        out.append(
            {
                "kind": _OPEN if is_open else _CHILD if below_open else _WHOLE,
                "shard": shard,
                "path": names.get(node),
                "parent": names.get(parent),
                "conv_id": least[node],
                "depth": depth,
                "parent_conv_id": None if below_open or parent < 0 else least[parent],
                "n_convs": members[node],
                "n_children": children[node],
                "n_leaves": leaves[node],
                "saved_tokens": saved[node],
                "ends_sha256": rows[trie.end[node]]["ends_sha256"] if trie.end[node] >= 0 else None,
            }
        )
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ROWS)


def _shards(shard_turns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        rows, turns, last = [], 0, None
        for batch in batches:
            for row in batch.to_pylist():
                if rows and turns + len(row["seq"]) > shard_turns:
                    yield _batch(shard_rows(rows, shard))
                    yield _batch(cut_rows(rows[-1]["seq"], row["seq"]))
                    rows, turns, shard = [], 0, shard + 1
                if last is None:
                    yield _batch([{"kind": _FIRST, "shard": shard, "seq": row["seq"]}])
                rows.append(row)
                turns += len(row["seq"])
                last = row["seq"]
        if rows:
            yield _batch(shard_rows(rows, shard))
            yield _batch([{"kind": _LAST, "shard": shard, "seq": last}])

    return tidy(run)


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _batch(cut_rows(row["before"], row["seq"]))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by sequence and ids to one row a sequence, holding none of its ids."""
    kinds = [_SEQ, pa.int64(), pa.int64(), pa.string()]
    names = ["seq", "members", "least", "ends_sha256"]

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    key, state = None, []
    for batch in batches:
        done = []
        keys = zip(batch.column("p").to_pylist(), batch.column("q").to_pylist(), strict=True)
        for i, new in enumerate(keys):
            ids = batch.column("ids")[i].as_py()
            text = ",".join(map(str, ids)).encode()
            if new == key:
                state[1] += len(ids)
                state[3].update(b"," + text)
                continue
            if state:
                done.append((*state[:3], state[3].hexdigest()))
            key, state = new, [batch.column("seq")[i].as_py(), len(ids), ids[0], hashlib.sha256(text)]
        if done:
            yield rows(done)
    if state:
        yield rows([(*state[:3], state[3].hexdigest())])


def turn_sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, seq`` of ``conversations`` (``conv_id, turn, role, text``): the turns in
    order, null first, with hashes ``k, l`` and the UTF-8 bytes ``n`` of the text. Null role or text is
    empty. Turns that share a number are ordered by their hashes, so that reruns agree.
    Rows without ``conv_id`` belong to no conversation and take no part."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            F.xxhash64(role, text).alias("k"),
            F.xxhash64(F.lit("turn"), text, role).alias("l"),
            F.octet_length(text).cast("long").alias("n"),
        ).alias("turn"),
    )
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("seq"))
    return ordered.select("conv_id", F.transform("seq", lambda t: t.dropFields("turn")).alias("seq"))


def _distinct(sequences: DataFrame) -> DataFrame:
    """``seq, members, least, ends_sha256``. The members of a sequence travel in rows of
    neighbouring ids, and the hash over all of them takes these as they come, in order."""
    keyed = sequences.select(
        "conv_id",
        "seq",
        F.xxhash64("seq").alias("p"),
        F.xxhash64(F.lit("path"), "seq").alias("q"),
        F.floor(F.col("conv_id") / BLOCK_IDS).alias("block"),
    )
    packed = keyed.groupBy("p", "q", "block").agg(
        F.first("seq").alias("seq"), F.array_sort(F.collect_set("conv_id")).alias("ids")
    )
    sorted_rows = packed.repartition("p", "q").sortWithinPartitions("p", "q", "block")
    return sorted_rows.select("p", "q", "seq", "ids").mapInArrow(
        tidy(_members), f"seq array<{_TURN_SQL}>, members long, least long, ends_sha256 string"
    )


def _rows(distinct: DataFrame, shard_turns: int, range_turns: int) -> DataFrame:
    turns = distinct.agg(F.sum(F.size("seq") + 1)).first()[0] or 0
    ranges = max(1, math.ceil(turns / range_turns))
    dealt = distinct.repartitionByRange(ranges, "seq").sortWithinPartitions("seq")
    return dealt.mapInArrow(_shards(shard_turns), _ROWS_SQL)


def _merge(rows: DataFrame, table: Callable[[DataFrame], DataFrame]) -> DataFrame:
    # Two rows a range: what lies between the end of one and the start of the next.
    edges = rows.filter(F.col("kind").isin(_FIRST, _LAST)).select("shard", "kind", "seq")
    before = F.lag("seq").over(Window.orderBy("shard", "kind"))
    cuts = edges.select("kind", "seq", before.alias("before")).filter(
        (F.col("kind") == _FIRST) & F.col("before").isNotNull()
    )
    cuts = cuts.select("seq", "before").mapInArrow(tidy(_cuts), _ROWS_SQL)
    parts = rows.filter(F.col("kind").isin(_OPEN, _CUT)).union(cuts)
    merged = table(
        parts.groupBy("path").agg(
            F.min("parent").alias("parent"),
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            *(F.sum(name).alias(name) for name in _NUMBERS[3:]),
            F.max("ends_sha256").alias("ends_sha256"),
        )
    )
    ids = merged.select(F.col("path").alias("parent"), F.col("conv_id").alias("_id"))
    boundary = merged.join(ids, "parent", "left")
    # A node's shard knows its parent; so the root's children do not meet in one place.
    opened = rows.filter(F.col("kind") == _OPEN).select("shard", F.col("path").alias("parent"))
    children = rows.filter(F.col("kind") == _CHILD).join(
        opened.join(ids, "parent"), ["shard", "parent"]
    )
    whole = rows.filter(F.col("kind") == _WHOLE).withColumn("_id", F.col("parent_conv_id"))
    columns = [F.col("_id").alias(n) if n == "parent_conv_id" else F.col(n) for n in _NUMBERS]
    ends = F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")
    found = [part.select(*columns, ends) for part in (whole, children, boundary)]
    return found[0].union(found[1]).union(found[2])


def prefix_trie(
    sequences: DataFrame, shard_turns: int = SHARD_TURNS, range_turns: int = RANGE_TURNS
) -> DataFrame:
    """One row for each node of the trie of ``sequences`` (``conv_id, seq``, one row for each
    ``conv_id``, as ``turn_sequences`` gives them).

    ``conv_id`` is the smallest member, ``depth`` the number of turns, ``parent_conv_id`` that
    of the node one turn up (null for the root). ``n_convs`` counts members, ``n_children``
    children, and ``n_leaves`` the nodes without children from this one down. ``saved_tokens``
    adds up, from this node down, the bytes of each node's last text times its members but one.
    ``ends_sha256`` is of the ids of the conversations that end here, ascending, joined by
    commas. Conversations without turns end at the root. An empty table has no node. A
    sequence is a value of one row, 24 bytes a turn; nothing else of a task grows with the
    length or the number of conversations. The ids of a sequence's members pass through one
    task, packed and as a stream, since their hash is one over all of them."""
    with scratch(sequences.sparkSession) as table:
        distinct = table(_distinct(sequences))
        rows = table(_rows(distinct, shard_turns, range_turns))
        return as_table(_merge(rows, table))


def _rebuilt(sequences: DataFrame) -> DataFrame:
    """Each conversation with the first turns of the one whose id is the next multiple of
    five below its own instead of as many of its own."""
    fifth = F.col("conv_id") - F.col("conv_id") % 5
    groups = sequences.withColumn("base", fifth).groupBy("base").agg(
        F.collect_list(F.struct("conv_id", "seq")).alias("convs")
    )
    first = F.filter("convs", lambda c: c["conv_id"] == F.col("base"))
    opening = F.get(first, F.lit(0))["seq"]
    each = groups.select(opening.alias("opening"), F.inline("convs"))
    h = (F.crc32(F.col("conv_id").cast("string")) % 9).cast("int")
    opening = F.coalesce(F.slice("opening", F.lit(1), h), F.slice("seq", 1, 0))
    rest = F.slice("seq", h + 1, F.greatest(F.size("seq") - h, F.lit(0)))
    return each.select("conv_id", F.concat(opening, rest).alias("seq"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return prefix_trie(_rebuilt(turn_sequences(conversations)))


SQL = """
with turns as (
  select conv_id, list(
    {'k': md5(coalesce(role, '') || chr(1) || coalesce(text, '')),
     'n': octet_length(encode(coalesce(text, '')))}
    order by turn nulls first, role, text) as s
  from conversations where conv_id is not null group by conv_id
), digests as (
  select conv_id, s, list_reduce(
    list_prepend(4294967295::ubigint, list_transform(
      string_split(conv_id::varchar, ''), lambda x: ascii(x)::ubigint)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), list_transform(range(8), lambda i: i::ubigint)),
      lambda v, i: case when v % 2 = 1 then xor(v // 2, 3988292384::ubigint) else v // 2 end)
  ) as crc
  from turns
), built as (
  select c.conv_id, list_concat(coalesce(b.s[:c.h], []), c.s[c.h + 1:]) as s
  from (select *, (xor(crc, 4294967295::ubigint) % 9)::bigint as h from digests) c
  left join turns b on b.conv_id = c.conv_id - c.conv_id % 5
), prefixes as (
  select conv_id, s[:d] as p, d, d = len(s) as ends
  from (select *, unnest(range(0, len(s) + 1)) as d from built)
), nodes as (
  select p, d, min(conv_id) as conv_id, count(*) as n_convs,
    case when d > 0 then (count(*) - 1) * p[d].n else 0 end as saved,
    string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends) as members
  from prefixes group by p, d
), linked as (
  select n.*, parent.conv_id as parent_conv_id
  from nodes n left join nodes parent on n.d > 0 and parent.d = n.d - 1 and parent.p = n.p[:n.d - 1]
), children as (
  select p[:d - 1] as p, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all
), above as (
  select p[:e] as p, e as d, saved, leaf
  from (
    select n.p, n.d, n.saved, coalesce(c.n_children, 0) = 0 as leaf, unnest(range(0, n.d + 1)) as e
    from nodes n left join children c on c.d = n.d and c.p = n.p
  )
), sums as (
  select p, d, sum(saved) as saved_tokens, count(*) filter (where leaf) as n_leaves
  from above group by p, d
)
select l.conv_id, l.d as depth, l.parent_conv_id, l.n_convs,
  coalesce(c.n_children, 0)::bigint as n_children, s.n_leaves,
  s.saved_tokens::bigint as saved_tokens, sha256(coalesce(l.members, '')) as ends_sha256
from linked l join sums s on s.d = l.d and s.p = l.p left join children c on c.d = l.d and c.p = l.p
"""
