"""Counting the hashes of all documents without a shuffled row for each of them.

Documents are packed into groups, rows of a table that hold a few megabytes of text. A group
sends its distinct hashes to the buckets they fall into, sorted and packed as differences,
and each bucket answers with the number of documents for every hash it was sent. The answer
comes back in the order of the question, a byte per hash. So a hash costs about four bytes of
shuffle on the way and next to nothing on the way back, and no task holds more than a bucket
or a group.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presswork.llm.tables import tidy, worker_cache
from presswork.storage import as_table

# Text in a group, in bytes, unless one document is longer, and documents in it.
GROUP_BYTES = 1 << 19
GROUP_DOCS = 1 << 16
# Hashes that a bucket is expected to be sent.
BUCKET_HASHES = 500_000
# Hashes are cut to the bits that number them all and so many more: one in 2^18 looks
# shared without being so. That costs work, never a result.
SPARE_BITS = 18
MOST = 255

GROUP_SCHEMA = (
    "gid long, doc_ids array<long>, ends array<long>, body binary, n_hashes long, "
    "sizes array<int>, prints array<binary>"
)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

Hashes = tuple[np.ndarray, np.ndarray]
"""The hashes of a group, and the place of the document each stands in."""


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the input reaches every bit of the output; one to one."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    cache = worker_cache("powers")
    if len(cache.get(name, ())) < n:
        powers = np.full(n + n // 2, base, "u8")
        powers[0] = 1
        cache[name] = np.cumprod(powers, dtype="u8")
    return cache[name][:n]


class Substrings:
    """Hashes of any substrings of ``raw``, by one running sum over its bytes."""

    def __init__(self, raw: bytes):
        values = np.frombuffer(raw, "u1").astype("u8") + np.uint64(1)
        sums = np.cumsum(values * _powers("base", _BASE, len(values)), dtype="u8")
        self._sums = np.concatenate([np.zeros(1, "u8"), sums])
        self._back = _powers("inverse", _INVERSE, len(values) + 1)

    def __call__(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[begins]) * self._back[begins])


def squeeze(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(raw)


def unsqueeze(body: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(body)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch, one after the other: each may be large."""
    for i in range(batch.num_rows):
        yield tuple(column[i].as_py() for column in batch.columns)


def _pack(describe: Callable):
    def group(ids: list, texts: list[bytes], gid: int) -> pa.RecordBatch:
        raw, ends = b"".join(texts), np.cumsum([len(t) for t in texts], dtype="i8")
        n_hashes, sizes, prints = describe(raw, ends)
        values = [gid, ids, ends.tolist(), squeeze(raw), n_hashes, sizes, prints]
        kinds = [
            pa.int64(),
            pa.list_(pa.int64()),
            pa.list_(pa.int64()),
            pa.binary(),
            pa.int64(),
            pa.list_(pa.int32()),
            pa.list_(pa.binary()),
        ]
        names = ["gid", "doc_ids", "ends", "body", "n_hashes", "sizes", "prints"]
        arrays = [pa.array([v], kind) for v, kind in zip(values, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        gid = TaskContext.get().partitionId() << 24
        for batch in batches:
            for doc_id, text in rows_of(batch):
                raw = text or b""
                if ids and (size + len(raw) > GROUP_BYTES or len(ids) == GROUP_DOCS):
                    yield group(ids, texts, gid)
                    ids, texts, size, gid = [], [], 0, gid + 1
                ids.append(doc_id)
                texts.append(raw)
                size += len(raw)
        if ids:
            yield group(ids, texts, gid)

    return tidy(run)


def pack(docs: DataFrame, describe: Callable, folder: str | None = None) -> DataFrame:
    """The whole texts of ``docs`` (``doc_id, text``) in groups, as a table. Null is empty.

    ``describe(raw, ends)`` gives about the number of hashes of a group and, if wanted, a
    size and a fingerprint of each document.
    """
    rows = docs.select(docs["doc_id"].cast("long"), F.encode(docs["text"], "UTF-8"))
    return as_table(rows.mapInArrow(_pack(describe), GROUP_SCHEMA), folder)


def list_documents(groups: DataFrame) -> DataFrame:
    """``node, gid, place, doc_id, size, print`` of each document; ``node`` is its own
    whatever its ``doc_id``."""
    documents = F.arrays_zip("doc_ids", "sizes", "prints")
    listed = groups.select("gid", F.posexplode(documents).alias("place", "doc"))
    return listed.select(
        F.shiftleft("gid", 20).bitwiseOR(F.col("place")).alias("node"),
        "gid",
        "place",
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.sizes").cast("long").alias("size"),
        F.col("doc.prints").alias("print"),
    )


def distinct(hashes: Hashes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a group, cut to ``bits``, and the documents that have each.
    A hash must come once per document."""
    cut = np.sort(hashes[0] >> np.uint64(64 - bits))
    first = np.concatenate([[True], cut[1:] != cut[:-1]]) if len(cut) else np.empty(0, bool)
    at = np.flatnonzero(first)
    return cut[at], np.diff(np.append(at, len(cut)))


def _bounds(buckets: int, bits: int) -> np.ndarray:
    return np.array([(i << bits) // buckets for i in range(1, buckets)], "u8")


def _ask(hashes_of: Callable, bits: int, buckets: int):
    bounds = _bounds(buckets, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid, ends, body in rows_of(batch):
                keys, counts = distinct(hashes_of(unsqueeze(body), np.array(ends)), bits)
                cuts = np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])
                out = []
                for i in np.flatnonzero(np.diff(cuts)).tolist():
                    some = keys[cuts[i] : cuts[i + 1]]
                    steps = np.diff(some, prepend=np.uint64(0))
                    width = max(1, (int(steps[1:].max(initial=0)).bit_length() + 7) // 8)
                    steps[0] = 0
                    raw = np.ascontiguousarray(steps.astype("<u8")).view("u1").reshape(-1, 8)
                    held = np.minimum(counts[cuts[i] : cuts[i + 1]], MOST).astype("u1").tobytes()
                    packed = raw[:, :width].tobytes()
                    out.append((i, gid, int(some[0]), width, packed, zlib.compress(held, 1)))
                if out:
                    columns = zip(*out, strict=True)
                    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                        ["bucket", "gid", "first", "width", "steps", "held"],
                    )

    return tidy(run)


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    asked, held = [], []
    for first, width, steps, packed in zip(
        group["first"], group["width"], group["steps"], group["held"], strict=True
    ):
        raw = np.frombuffer(steps, "u1").reshape(-1, width)
        wide = np.zeros((len(raw), 8), "u1")
        wide[:, :width] = raw
        asked.append(np.cumsum(wide.view("<u8")[:, 0], dtype="u8") + np.uint64(first))
        held.append(np.frombuffer(zlib.decompress(packed), "u1"))
    _, place = np.unique(np.concatenate(asked), return_inverse=True)
    totals = np.bincount(place, weights=np.concatenate(held))
    answers = np.minimum(totals[place], MOST).astype("u1")
    cuts = np.cumsum([len(a) for a in asked])[:-1]
    return pd.DataFrame(
        {
            "gid": group["gid"].to_numpy(),
            "bucket": group["bucket"].to_numpy(),
            "counts": [zlib.compress(part.tobytes(), 1) for part in np.split(answers, cuts)],
        }
    )


def census(groups: DataFrame, hashes_of: Callable) -> tuple[DataFrame, int]:
    """``gid, answers`` for the groups that have hashes, and the bits that hashes were cut
    to. ``hashes_of(raw, ends)`` gives the ``Hashes`` of a group, each once per document."""
    total = groups.agg(F.sum("n_hashes")).first()[0] or 0
    bits = min(62, max(1, total).bit_length() + SPARE_BITS)
    buckets = max(1, math.ceil(total / BUCKET_HASHES))
    asked = groups.select("gid", "ends", "body").mapInArrow(
        _ask(hashes_of, bits, buckets),
        "bucket int, gid long, first long, width int, steps binary, held binary",
    )
    answered = asked.groupBy("bucket").applyInPandas(
        _answer, "gid long, bucket int, counts binary"
    )
    answers = F.sort_array(F.collect_list(F.struct("bucket", "counts")))
    return answered.groupBy("gid").agg(answers.alias("answers")), bits


def read_answers(answers: list | None) -> np.ndarray:
    """The number of documents, up to ``MOST``, of each of ``distinct``'s hashes."""
    parts = [np.frombuffer(zlib.decompress(a["counts"]), "u1") for a in answers or ()]
    return np.concatenate([np.empty(0, "u1"), *parts])
