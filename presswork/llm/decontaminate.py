"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are streamed
through it, and the state it is in tells the longest run ending at the word that also
stands in an item. Where that reaches the window length, the last words are a window of an
item; where it covers a whole shorter item, that item occurs.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.llm.tables import read_table, slices, tidy
from presswork.storage import as_table, scratch

WINDOW = 10
# Item words that one automaton takes; about twice as many states, each a small dict. More
# items make more automata, and the documents pass through one after the other.
AUTOMATON_WORDS = 100_000
# Share of a document's words beyond which the whole document goes.
MAX_COVERAGE = 0.8

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
# Bytes to words: A-Z to lower case, all other ASCII but letters and digits to a space.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)
)


def item_words(text: str | bytes) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text
    return raw.translate(_TO_WORDS).split()


class Automaton:
    """Of items added as ``(item_id, words)``, for windows of ``window`` words."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [
            (item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            for item, words in items
        ]
        for _, ids in coded:
            self._add(ids)
        self._mark(coded)

    @classmethod
    def restored(cls, state: bytes) -> Automaton:
        made = cls.__new__(cls)
        made.__dict__ |= pickle.loads(state)
        return made

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, at: int, word: int) -> int:
        """The state after ``word`` from ``at`` that holds only what ``at`` extends to."""
        to = self.step[at][word]
        if self.length[to] == self.length[at] + 1:
            return to
        clone = self._state(self.length[at] + 1, dict(self.step[to]), self.link[to])
        self.link[to] = clone
        while at >= 0 and self.step[at].get(word) == to:
            self.step[at][word] = clone
            at = self.link[at]
        return clone

    def _add(self, ids: list[int]) -> None:
        last = 0
        for word in ids:
            if word in self.step[last]:
                last = self._split(last, word)
                continue
            new, at = self._state(self.length[last] + 1, {}, 0), last
            while at >= 0 and word not in self.step[at]:
                self.step[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word)
            last = new

    def _holder(self, state: int, length: int) -> int:
        """The state, at or above this one, of the suffix with so many words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _mark(self, coded: list[tuple[str | None, list[int]]]) -> None:
        """Which items a state's window, or its short strings, stand for."""
        self.items: dict[int, set[str]] = {}
        whole: dict[int, int] = {}
        pairs, self.least = set(), self.window
        for item, ids in coded:
            pairs.update(zip(ids, ids[1:], strict=False))
            at = 0
            for i, word in enumerate(ids, 1):
                at = self.step[at][word]
                size = self.window if i >= self.window else i if i == len(ids) else 0
                if size:
                    holder = self._holder(at, size)
                    found = self.items.setdefault(holder, set())
                    if item is not None:
                        found.add(item)
                    if size < self.window:
                        whole[holder] = size
                        self.least = min(self.least, size)
        # For each state, the items' states on the way to the root, with their lengths.
        self.found: list[tuple[tuple[int, int], ...]] = [()] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            above = self.found[self.link[state]]
            if state in whole:
                above = (*above, (whole[state], state))
            if self.length[self.link[state]] < self.window <= self.length[state]:
                above = (*above, (self.window, state))
            self.found[state] = above
        width = len(self.vocabulary)
        self.pairs = np.array(sorted(a * width + b for a, b in pairs), "i8")

    def runs(self, ids):
        """Begins and ends of the runs of words in which each pair of neighbours stands in
        an item, if a window fits. ``ids``: the words' numbers, -1 for others. At the first
        word of a run nothing longer than it matches, so the automaton may start there."""
        chained = np.zeros(len(ids) + 1, bool)
        if len(ids) > 1 and len(self.pairs):
            code = ids[:-1] * len(self.vocabulary) + ids[1:]
            code[(ids[:-1] < 0) | (ids[1:] < 0)] = -1
            at = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            chained[1:-1] = self.pairs[at] == code
        begins = np.flatnonzero(~chained[:-1])
        ends = np.flatnonzero(~chained[1:]) + 1
        fits = (ends - begins >= self.least) & (ids[begins] >= 0)
        return zip(begins[fits].tolist(), ends[fits].tolist(), strict=True)

    def match(self, ids: list[int], first: int) -> Iterator[tuple[int, int, int]]:
        """``begin, end, state`` of what occurs in a run that starts at word ``first``."""
        step, link, length, found = self.step, self.link, self.length, self.found
        at = matched = 0
        for end, word in enumerate(ids, first + 1):
            while at and word not in step[at]:
                at = link[at]
                matched = length[at]
            if word in step[at]:
                at = step[at][word]
                matched += 1
            for size, state in found[at]:
                if size <= matched:
                    yield end - size, end, state


def _build(window: int):
    """Automata of the items of a partition, of ``AUTOMATON_WORDS`` words each. A longer item is
    cut into pieces that share ``window - 1`` words, so no window is lost."""
    limit = AUTOMATON_WORDS

    def packed(held: list) -> pa.RecordBatch:
        state = pickle.dumps(Automaton(held, window).__dict__)
        return pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["automaton"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in (part for whole in batches for part in slices(whole)):
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = item_words(text.as_py() or "")
                for begin in range(0, max(len(words) - window + 1, 1), limit):
                    piece = words[begin : begin + limit + window - 1]
                    if held and size + len(piece) > limit:
                        yield packed(held)
                        held, size = [], 0
                    if piece:
                        held.append((item, piece))
                        size += len(piece)
        if held:
            yield packed(held)

    return tidy(run)


def _automata(items: DataFrame, window: int, table: Callable) -> DataFrame:
    """A row for each ``AUTOMATON_WORDS`` words of items, about, built where the items are
    dealt to."""
    texts = items.select(items["item_id"].cast("string"), items["text"])
    words = F.regexp_count(texts["text"], F.lit(_WORD.pattern))
    total = texts.agg(F.sum(words.cast("long"))).first()[0] or 0
    dealt = texts.repartition(max(1, math.ceil(total / AUTOMATON_WORDS)))
    return table(dealt.mapInArrow(_build(window), "automaton binary"))


# In words, and in characters of the text.
_SPANS = "array<struct<begin:int,end:int,from:int,to:int>>"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _match(shared, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton.restored(shared.value)
        number = automaton.vocabulary.get
        for batch in (part for whole in batches for part in slices(whole)):
            n_words, all_spans, all_items = [], [], []
            before = zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist())
            for text, (spans, items) in zip(batch.column("_text").cast("binary"), before):
                words = item_words(text.as_py() or b"")
                ids = [number(word, -1) for word in words]
                new, states = [], set()
                for begin, end in automaton.runs(np.array(ids, "i8")) if ids else ():
                    for a, b, state in automaton.match(ids[begin:end], begin):
                        new.append((a, b))
                        states.add(state)
                if new:
                    spans = _merged([*((x["begin"], x["end"]) for x in spans), *new])
                    items = sorted(set(items).union(*map(automaton.items.get, states)))
                    places = [m.span() for m in _WORD.finditer(text.as_py().decode())]
                    spans = [
                        {"begin": a, "end": b, "from": places[a][0], "to": places[b - 1][1]}
                        for a, b in spans
                    ]
                n_words.append(len(words))
                all_spans.append(spans)
                all_items.append(items)
            columns = {
                "n_words": pa.array(n_words, pa.int64()),
                "hits": pa.array(all_spans, schema.field("hits").type),
                "items": pa.array(all_items, schema.field("items").type),
            }
            yield pa.RecordBatch.from_arrays(
                [columns.get(name, batch.column(i)) for i, name in enumerate(batch.schema.names)],
                batch.schema.names,
            )

    return tidy(run)


def _through(rows: DataFrame, automaton: Broadcast) -> DataFrame:
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    span = pa.struct([(name, pa.int32()) for name in ("begin", "end", "from", "to")])
    plain = pa.schema([("hits", pa.list_(span)), ("items", pa.list_(pa.string()))])
    return rows.mapInArrow(_match(automaton, plain), schema)


def find_items(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``_row`` (the columns of ``docs`` but ``text``), ``_text``, ``n_words``, ``hits``
    (word spans covered by windows of items, merged) and ``items`` (the distinct
    ``item_id`` that occur, as strings, sorted).

    A window is ``window`` words in a row of an item, or all of a shorter item that has
    any. Null and empty texts have no words; a row of ``items`` without ``item_id`` covers
    words but is not named. Rows of either table may repeat; every row of ``docs`` comes
    back. No items, no hits.
    """
    others = [docs[name] for name in docs.columns if name != "text"]
    rows = docs.select(
        F.struct(*others).alias("_row") if others else F.lit(None).cast("int").alias("_row"),
        docs["text"].alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(_SPANS).alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    spark, shared = docs.sparkSession, None
    with scratch(spark) as table:
        # One at a time, as it was packed in its task: a bounded number of words.
        for row in _automata(items, window, table).toLocalIterator():
            if shared is not None:
                rows = as_table(rows)
                shared.unpersist()
            shared = spark.sparkContext.broadcast(bytes(row["automaton"]))
            rows = _through(rows, shared)
    if shared is None:
        none = pickle.dumps(Automaton([], window).__dict__)
        rows = _through(rows, spark.sparkContext.broadcast(none))
    return rows


def _covered() -> Column:
    spans = F.transform("hits", lambda span: (span["end"] - span["begin"]).cast("long"))
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, n: total + n)


def _without(text: Column, hits: Column) -> Column:
    """What stands before, between and behind the hits."""

    def piece(i: Column) -> Column:
        begin = F.coalesce(F.get(hits, i - 1)["to"], F.lit(0))
        end = F.coalesce(F.get(hits, i)["from"], F.length(text))
        return F.substring(text, begin + 1, end - begin)

    pieces = F.transform(F.sequence(F.lit(0), F.size(hits)), piece)
    return F.when(F.size(hits) > 0, F.array_join(pieces, "")).otherwise(text)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
) -> DataFrame:
    """``docs`` with the covered words, and what stands between them, cut out of ``text``.
    A document goes if more than ``max_coverage`` of its words are covered. Documents
    without a hit stay as they are, null texts too. ``n_chars``, if there is one, follows
    the text."""
    rows = find_items(docs, items, window)
    kept = rows.filter(_covered() <= F.col("n_words") * max_coverage)
    kept = kept.withColumn("_text", _without(F.col("_text"), F.col("hits")))
    out = {name: F.col("_row")[name] for name in docs.columns if name != "text"}
    out["text"] = F.col("_text")
    if "n_chars" in out:
        shorter = F.length("_text").cast(docs.schema["n_chars"].dataType)
        out["n_chars"] = F.when(F.size("hits") > 0, shorter).otherwise(out["n_chars"])
    return kept.select(*[out[name].alias(name) for name in docs.columns])


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_items(documents, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("_row.doc_id").alias("doc_id"),
        "n_words",
        _covered().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


SQL = r"""
with words as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos, len(w) as n
  from (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents)
), items as (
  select item_id::varchar as item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), windows as (
  select distinct item_id, least(len(w), 10) as size,
         array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as phrase
  from (select *, unnest(range(1, greatest(len(w) - 8, 2))) as i from items where len(w) > 0)
), sizes as (
  select distinct size from windows
), phrases as (
  select doc_id, pos, size,
         array_to_string((list(word) over (partition by doc_id, size order by pos
           rows between current row and 9 following))[:size], ' ') as phrase,
         n
  from words, sizes
), found as (
  select p.doc_id, p.pos, p.size, w.item_id
  from phrases p join windows w on p.size = w.size and p.phrase = w.phrase
  where p.pos + p.size - 1 <= p.n
), hit as (
  select doc_id, count(*) as n_hit
  from (select distinct doc_id, unnest(range(pos, pos + size)) as pos from found) group by doc_id
), named as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from found) group by doc_id
), counted as (
  select doc_id, max(n) as n_words from words group by doc_id
)
select d.doc_id, coalesce(c.n_words, 0)::bigint as n_words, coalesce(h.n_hit, 0)::bigint as n_hit,
       coalesce(i.n_items, 0)::bigint as n_items, sha256(coalesce(i.ids, '')) as items_sha256,
       coalesce(h.n_hit, 0) > 0 as contaminated
from documents d left join counted c using (doc_id) left join hit h using (doc_id)
     left join named i using (doc_id)
"""
