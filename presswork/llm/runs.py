"""Periodic runs in word sequences, by Lyndon roots from the first phase of Baier's suffix sorter.

A run is a maximal stretch in which every word equals the one a period before it. Each run
holds a Lyndon root: the longest Lyndon word at some position, for one of an order of the
words and the opposite order. So the longest Lyndon words at all positions under both orders are
the only candidates, and how far each repeats to either side (longest common extensions)
says which of them are runs.

Baier's grouping gives these Lyndon words directly. Positions are in groups that share a
prefix, one word at first. From the highest group down, each stretch of blocks of the group
goes to the block before it, whose prefix grows by them; the blocks that grew by as many of
one group form a new group right above their old one. When a group's turn comes, its prefix
is the longest Lyndon word of its positions, and the second phase, which would sort the
suffixes inside the groups, is not needed.

Only words inside a repeated string of words can be in a run of a given least length. So
documents are first cut, by hashes, to the stretches that consist of strings repeated in
them. That leaves out no run; what is cut out by mistake of a hash costs work only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.tables import read_table, slices, tidy

MIN_WORDS = 12
# Words gathered from several documents before their runs are looked for together.
GATHER_WORDS = 100_000

RUNS_SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)

_DONE = -1


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """The length of the longest Lyndon word at each position, for words numbered from 0
    without gaps in the order that is meant."""
    n = len(ranks)
    lengths, left = [1] * n, list(range(-1, n - 1))
    group, before = list(ranks), [-1] * n
    members: list[list[int]] = [[] for _ in range(max(ranks, default=-1) + 1)]
    for i, g in enumerate(ranks):
        members[g].append(i)
    # Neighbours in the order of all groups, which starts with one for each word.
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    current = len(members) - 1
    while current >= 0:
        live = [i for i in members[current] if group[i] == current]
        members[current] = []
        grown: dict[int, int] = {}
        for i in live:
            j = left[i]
            if j >= 0:
                other = group[j]
                if other == current:
                    j = before[j]
                elif other == _DONE:  # nothing lower lies further left
                    j = -1
            before[i] = j
            if j >= 0:
                grown[j] = grown.get(j, 0) + 1
        if live:
            size = lengths[live[0]]
            for i in live:
                if before[i] < 0:
                    group[i] = _DONE
                elif i + size < n:
                    left[i + size] = before[i]
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in grown.items():
                lengths[j] += times * size
                moved.setdefault((times, group[j]), []).append(j)
            for times, old in sorted(moved, reverse=True):
                new, over = len(members), above[old]
                members.append(moved[times, old])
                for j in moved[times, old]:
                    group[j] = new
                below.append(old)
                above.append(over)
                above[old] = new
                if over < len(below) and over != new:
                    below[over] = new
        current = below[current]
    return lengths


class Extensions:
    """Longest common extensions, by numbers for all strings of 1, 2, 4, … words. Exact."""

    def __init__(self, ranks: np.ndarray):
        self.n, self.levels = len(ranks), [ranks.astype("i8")]
        width = 1
        while 2 * width <= self.n:
            last = self.levels[-1]
            pairs = last[:-width] * (int(last.max()) + 1) + last[width:]
            _, numbers = np.unique(pairs, return_inverse=True)
            if len(numbers) == int(numbers.max()) + 1:
                break  # no longer string stands twice
            self.levels.append(numbers)
            width *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on equal those from ``j`` on, for ``i < j``."""
        return self._extend(i, j, 1)

    def leftward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before ``i`` equal those before ``j``, for ``i < j``."""
        return self._extend(i, j, -1)

    def _extend(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        i, j, found = i.copy(), j.copy(), np.zeros(len(i), "i8")
        # The last level may fit more than once: strings twice as long are not numbered.
        todo = [len(self.levels) - 1] + list(range(len(self.levels) - 1, -1, -1))
        for k in todo:
            width, numbers = 1 << k, self.levels[k]
            low, high = (i, j) if way > 0 else (i - width, j - width)
            fits = (low >= 0) & (high + width <= self.n)
            same = np.zeros(len(i), bool)
            same[fits] = numbers[low[fits]] == numbers[high[fits]]
            step = np.where(same, width, 0)
            i, j, found = i + way * step, j + way * step, found + step
        return found


def find_runs(ranks: np.ndarray, min_words: int = MIN_WORDS) -> np.ndarray:
    """``start, length, period`` of the runs of at least ``min_words`` words, by start and
    period. ``ranks`` numbers the words from 0 without gaps."""
    n = len(ranks)
    if n < 2:
        return np.empty((0, 3), "i8")
    top = int(ranks.max())
    starts, periods = [], []
    for order in (ranks, top - ranks):
        lengths = np.array(lyndon_lengths(order.tolist()), "i8")
        at = np.arange(n)
        fits = at + lengths < n
        starts.append(at[fits])
        periods.append(lengths[fits])
    roots = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)], 1), axis=0)
    i, period = roots[:, 0], roots[:, 1]
    extensions = Extensions(ranks)
    right = extensions.right(i, i + period)
    back = extensions.leftward(i, i + period)
    length = back + period + right
    runs = (length >= 2 * period) & (length >= min_words)
    found = np.stack([i - back, length, period], 1)[runs]
    found = np.unique(found[:, [0, 2, 1]], axis=0)
    return found[:, [0, 2, 1]]


def repeated_stretches(ids: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Stretches, begin and end, outside which no run of ``min_words`` words can reach.

    A run of length m and period q repeats its first m - q words a period later, and these
    are ``min_words / 2`` at least. So each of its words is in a string of so many words that
    stands in the run twice."""
    width = (min_words + 1) // 2
    todo, found = [(0, len(ids))], []
    while todo:
        begin, end = todo.pop()
        if end - begin < min_words:
            continue
        count = end - begin - width + 1
        mixed = (ids[begin:end].astype("u8") + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        hashes = np.zeros(count, "u8")
        for k in range(width):
            hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[k : k + count]
        ordered = np.sort(hashes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            continue
        twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
        place = np.minimum(np.searchsorted(twice, hashes), len(twice) - 1)
        again = np.flatnonzero(twice[place] == hashes)
        edges = np.zeros(end - begin + 1, "i4")
        np.add.at(edges, again, 1)
        np.add.at(edges, again + width, -1)
        inside = np.cumsum(edges[:-1]) > 0
        change = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype("i1")))
        parts = [(begin + int(a), begin + int(b)) for a, b in change.reshape(-1, 2)]
        if parts == [(begin, end)]:
            found.append((begin, end))
        else:
            todo.extend(parts)
    return sorted(found)


def runs_of(documents: list[np.ndarray], min_words: int = MIN_WORDS) -> list[np.ndarray]:
    """The runs of each document, given as numbers of its words."""
    found: list[list[np.ndarray]] = [[] for _ in documents]
    pieces, places, at, base = [], [], 0, 0
    for doc, ids in enumerate(documents):
        for begin, end in repeated_stretches(ids, min_words):
            pieces.append(ids[begin:end] + base)
            places.append((at, doc, begin))
            at += end - begin + 1
        base += int(ids.max()) + 1 if len(ids) else 0
    if not pieces:
        return [np.empty((0, 3), "i8")] * len(documents)
    # Words of their own between the stretches, so that no run goes across.
    marked = []
    for number, piece in enumerate(pieces):
        marked += [piece, np.array([base + number])]
    _, ranks = np.unique(np.concatenate(marked), return_inverse=True)
    runs = find_runs(ranks, min_words)
    offsets = np.array([p[0] for p in places])
    owner = np.searchsorted(offsets, runs[:, 0], "right") - 1
    cuts = np.searchsorted(owner, np.arange(len(places) + 1))
    for (offset, doc, begin), a, b in zip(places, cuts, cuts[1:], strict=False):
        if b > a:
            found[doc].append(runs[a:b] + [begin - offset, 0, 0])
    none = np.empty((0, 3), "i8")
    return [np.concatenate(parts) if parts else none for parts in found]


def collapse(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by spaces, without those that a run has behind its first period."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, "i8")
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edges[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _search(min_words: int):
    def flush(gathered: list[tuple]) -> pa.RecordBatch:
        found = runs_of([ids for _, _, ids in gathered], min_words)
        texts = [
            collapse(words, runs).decode()
            for (_, words, _), runs in zip(gathered, found, strict=True)
        ]
        flat = np.concatenate([*found, np.empty((0, 3), "i8")])
        ends = np.cumsum([0, *(len(runs) for runs in found)])
        values = pa.StructArray.from_arrays(
            [pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"]
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([doc_id for doc_id, _, _ in gathered], pa.int64()),
                pa.array([len(words) for _, words, _ in gathered], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values),
                pa.array(texts, pa.string()),
            ],
            ["doc_id", "n_words", "runs", "collapsed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, size = [], 0
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    words = (text.as_py() or b"").split()
                    numbers = {word: i for i, word in enumerate(dict.fromkeys(words))}
                    ids = np.fromiter(map(numbers.__getitem__, words), "i8", len(words))
                    gathered.append((doc_id, words, ids))
                    size += len(words)
                    if size >= GATHER_WORDS:
                        yield flush(gathered)
                        gathered, size = [], 0
        if gathered:
            yield flush(gathered)

    return tidy(run)


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs`` (``doc_id, text``).

    Words are runs of anything but ASCII white space. ``runs`` has ``start`` (number of a
    word, from 0), ``length`` and smallest ``period`` in words of each stretch with
    ``length >= max(min_words, 2 * period)`` that neither neighbour continues, ordered by start,
    then period. ``collapsed`` is the text without the words that a run has behind its first
    period, joined by single spaces. Null texts and texts without words have no runs and an
    empty ``collapsed``. Rows may repeat or lack ``doc_id``; each is a document. Other columns
    are ignored; an empty table gives an empty one. A document is searched as a whole, in
    one task, with some 200 bytes of memory for each of its words."""
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.encode(docs["text"], "UTF-8").alias("text"),
    )
    return rows.mapInArrow(_search(min_words), RUNS_SCHEMA)


def _planted(doc_id: str, text: str) -> Column:
    """The text of every tenth document, by the hash of its id, with a period from some
    word on; the other texts as they are."""
    digest = F.crc32(F.col(doc_id).cast("string"))
    g = F.floor(digest / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = (g % n).cast("int")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / period).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, period), times))
    built = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((digest % 10 == 0) & (n > 0), built).otherwise(F.col(text))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    found = periodic_runs(documents.select("doc_id", _planted("doc_id", "text").alias("text")))
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p")
            ),
        )
    )
    shown = found.select(
        "doc_id",
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return shown.select(
        "doc_id",
        "n_words",
        "n_runs",
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
