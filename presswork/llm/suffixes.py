"""Removal of repeated byte strings with suffix arrays sorted in two stages.

A suffix array of a whole corpus would cost dozens of bytes of shuffle for each byte of
text. So the corpus is cut into the places where repeats can be, and each place gets a
suffix array that is exact.

* Every string of ``LENGTH`` bytes contains an anchor, its 25-byte substring with the
  smallest hash, so equal strings have equal anchors. Anchors that stand in one document
  only, by a census of all anchors, are done with.
* Around a shared anchor stands a fragment, the strings that it is the anchor of. Equal
  fragments are one, of the smallest ``doc_id`` that has it.
* The fragments that share an anchor are sorted by their suffixes, those smaller than their
  successors directly, the rest by scans of the buckets; the common prefixes of neighbours
  give the groups of equal strings, and the least document of each.
* An anchor with very many fragments is one of a phrase with many surroundings. Each of its
  different fragments is halved: the strings with half of the other bytes at least before
  the anchor, and those with as many behind it. What the strings of a half have in common is
  longer than the anchor and takes its place; what is crowded still is halved again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm import hash_groups as hg
from presswork.llm.tables import read_table, tidy
from presswork.storage import as_table, new_folder, remove, scratch

LENGTH = 50
ANCHOR = 25
# Bytes of text for an anchor, about: half of the strings' starts around it.
ANCHOR_EVERY = 13
# Fragments that are sorted together, and those of one anchor above which they are halved: a
# task sorts so many at once, some 1.5 MB of text, whatever comes with them.
BATCH_FRAGMENTS = 4000
CROWDED = 20_000
_LAST = (1 << 63) - 1
_PLACE = ["key", "low", "fragment", "place"]


# Suffix sorting


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number that sorts like them."""
    padded = np.concatenate([text, np.zeros(LENGTH + 8, "u1")]).astype("u8")
    words = np.zeros(len(text) + LENGTH, "u8")
    for i in range(8):
        words |= padded[i : i + len(words)] << np.uint64(56 - 8 * i)
    return words


def rises(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not, being
    followed by the empty one."""
    n = len(text)
    steps = np.zeros(n, "i2")
    steps[:-1] = text[1:].astype("i2") - text[:-1]
    steps[-1:] = -1
    places = np.where(steps != 0, np.arange(n), n)
    return steps[np.minimum.accumulate(places[::-1])[::-1]] > 0


def suffix_array(text: np.ndarray, words: np.ndarray) -> np.ndarray:
    """All suffixes by their first ``LENGTH`` bytes at least.

    Suffixes smaller than their successors are sorted directly. Any other suffix begins
    with a byte not smaller than its successor's, so a scan of the buckets (by first byte)
    in order meets its successor before it: the larger suffixes of a bucket come first in
    it, in the order in which their successors are met.
    """
    up = rises(text)
    direct = np.flatnonzero(up)
    keys = [words[direct + at] for at in range((LENGTH - 1) // 8 * 8, -1, -8)]
    direct = direct[np.lexsort(keys)]
    cuts = np.searchsorted(text[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    induced[text[-1]].append(np.array([len(text) - 1]))
    out = []
    for byte in np.unique(text).tolist():
        part = met = np.concatenate([np.empty(0, "i8"), *induced[byte]])
        while len(met):  # one more of the same byte in front
            before = met[met > 0] - 1
            met = before[text[before] == byte]
            part = np.concatenate([part, met])
        bucket = np.concatenate([part, direct[cuts[byte] : cuts[byte + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > byte]
        before = before[np.argsort(text[before], kind="stable")]
        first = text[before]
        for some in np.split(before, np.flatnonzero(first[1:] != first[:-1]) + 1):
            if len(some):
                induced[text[some[0]]].append(some)
    return np.concatenate(out)


def common_prefixes(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Bytes that each suffix has in common with the one before it, up to ``LENGTH``."""
    common = np.zeros(len(order), "i8")
    still = np.arange(1, len(order))
    for at in range(0, LENGTH, 8):
        differ = words[order[still] + at] ^ words[order[still - 1] + at]
        same = differ == 0
        common[still[same]] += 8
        rest = differ[~same]
        high = np.zeros(len(rest), "i8")
        for byte in range(1, 8):  # leading bytes that are equal
            high += rest >> np.uint64(64 - 8 * byte) == 0
        common[still[~same]] += high
        still = still[same]
    return np.minimum(common, LENGTH)


def first_owners(fragments: list[bytes], owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of strings of ``LENGTH`` bytes in each fragment, and for every one of them,
    fragment by fragment, the least owner of any fragment that has it."""
    text = np.frombuffer(b"".join(fragments), "u1")
    words = _words(text)
    sizes = np.array([len(f) for f in fragments])
    begins = np.cumsum(sizes) - sizes
    strings = np.maximum(sizes - LENGTH + 1, 0)
    order = suffix_array(text, words)
    group = np.cumsum(common_prefixes(order, words) < LENGTH) - 1
    # Suffixes that leave their fragment belong to nobody.
    owner = np.full(len(text), _LAST)
    starts = np.repeat(begins - np.cumsum(strings) + strings, strings) + np.arange(strings.sum())
    owner[starts] = np.repeat(owners, strings)
    heads = np.flatnonzero(np.diff(group, prepend=-1))
    least = np.minimum.reduceat(owner[order], heads)
    owner[order] = least[group]
    return strings, owner[starts]


# Anchors


def anchors(raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each string of ``LENGTH`` bytes inside a document: where it begins, where its
    anchor does, and the anchor's hash."""
    empty = np.empty(0, "i8")
    if len(raw) < LENGTH:
        return empty, empty, np.empty(0, "u8")
    begins = np.arange(len(raw) - ANCHOR + 1)
    hashes = hg.Substrings(raw)(begins, begins + ANCHOR)
    count, least, place, have = LENGTH - ANCHOR + 1, hashes, begins, 1
    while have < count:  # the least of twice as many, as far as needed
        step = min(have, count - have)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        have += step
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(raw) + 1, "i4")
    long = ends - starts >= LENGTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    strings = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    return strings, place[strings], least[strings]


def anchor_hashes(raw: bytes, ends: np.ndarray) -> hg.Hashes:
    """The distinct anchors of each document, by document."""
    return _by_document(ends, *anchors(raw, ends)[1:])


def _by_document(ends: np.ndarray, places: np.ndarray, hashes: np.ndarray) -> hg.Hashes:
    first = np.ones(len(places), bool)
    first[1:] = places[1:] != places[:-1]
    places, hashes = places[first], hashes[first]
    docs = np.searchsorted(ends, places, "right")
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    if len(hashes):
        fresh = np.ones(len(hashes), bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        hashes, docs = hashes[fresh], docs[fresh]
    return hashes, docs


def _describe(raw: bytes, ends: np.ndarray) -> tuple[int, list[int], list[bytes]]:
    cuts = [0, *ends.tolist()]
    prints = [
        hashlib.blake2b(raw[a:b], digest_size=16).digest()
        for a, b in zip(cuts, cuts[1:], strict=False)
    ]
    return len(raw) // ANCHOR_EVERY, np.diff(cuts).tolist(), prints


def _fragments(bits: int):
    """For the representatives of a group: the fragments around shared anchors, and the
    text of those that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gid, ends, body, answers, chosen in hg.rows_of(batch):
                raw, ends = hg.unsqueeze(body), np.array(ends)
                begins, places, hashes = anchors(raw, ends)
                keys, _ = hg.distinct(_by_document(ends, places, hashes), bits)
                known = hg.read_answers(answers)
                # The strings of an anchor lie side by side.
                first = np.flatnonzero(np.diff(places, prepend=-1))
                strings = np.diff(np.append(first, len(places)))
                begins, places, hashes = begins[first], places[first], hashes[first]
                shared = (
                    known[np.searchsorted(keys, hashes >> np.uint64(64 - bits))]
                    if len(known)
                    else np.empty(0, "u1")
                )
                out = []
                for doc in chosen:
                    place, copies = doc["place"], doc["copies"]
                    a, b = int(ends[place - 1]) if place else 0, int(ends[place])
                    some = slice(*np.searchsorted(begins, [a, b]))
                    found = (shared[some] > copies) | (shared[some] == hg.MOST)
                    text, any_found = raw[a:b], bool(found.any())
                    out.append(
                        (
                            gid << 20 | place,
                            doc["owner"],
                            hashlib.sha256(text).hexdigest(),
                            text if any_found else None,
                            hashes[some][found].astype("i8"),
                            (begins[some][found] - a).astype("i4"),
                            strings[some][found].astype("i4"),
                            (places[some][found] - begins[some][found]).astype("i4"),
                        )
                    )
                kinds = [
                    pa.int64(),
                    pa.int64(),
                    pa.string(),
                    pa.binary(),
                    pa.list_(pa.int64()),
                    pa.list_(pa.int32()),
                    pa.list_(pa.int32()),
                    pa.list_(pa.int32()),
                ]
                for i in range(0, len(out), 1000):
                    columns = zip(*out[i : i + 1000], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                        ["node", "owner", "whole", "body", "keys", "lows", "strings", "places"],
                    )

    return tidy(run)


def _sort(batch: pd.DataFrame) -> pd.DataFrame:
    own = batch["owner"].to_numpy()
    strings, first = first_owners(batch["fragment"].tolist(), own)
    begins = np.cumsum(strings) - strings
    bits = np.left_shift(1, np.arange(len(first)) - np.repeat(begins, strings))
    bits[first >= np.repeat(own, strings)] = 0
    early = np.bitwise_or.reduceat(bits, begins)
    return pd.DataFrame(
        {"key": batch["key"], "print": batch["print"], "owner": own, "early": early}
    )


def _strings(fragment: Column) -> Column:
    """Strings of ``LENGTH`` bytes in a fragment."""
    return F.length(fragment) - (LENGTH - 1)


def _print(fragment: Column) -> Column:
    return F.xxhash64(fragment, F.lit(0))


def _every(strings: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), strings) - 1


def _halve(fragments: DataFrame, depth: int) -> DataFrame:
    """Two rows at most for each fragment. ``place`` is where the anchor begins in it; its
    strings have between ``fewest`` and ``most`` bytes before the anchor. A half's key is of
    the bytes that all its strings have."""
    fragment, place = F.col("fragment"), F.col("place")
    middle = F.expr("(fewest + most + 1) div 2").cast("int")
    halves = []
    for fewest, most in ((F.col("fewest"), middle - 1), (middle, F.col("most"))):
        first = F.greatest(F.lit(0), place - most)
        last = F.least(_strings(fragment) - 1, place - fewest)
        common = F.substring(fragment, place - fewest + 1, fewest - most + LENGTH)
        half = F.struct(
            first.alias("shift"),
            F.xxhash64(common, F.lit(depth)).alias("key"),
            F.substring(fragment, first + 1, last - first + LENGTH).alias("fragment"),
            (place - first).alias("place"),
            fewest.alias("fewest"),
            most.alias("most"),
        )
        halves.append(F.when(first <= last, half))
    made = fragments.select(
        F.col("key").alias("whole"),
        _print(fragment).alias("whole_print"),
        "owner",
        F.explode(F.array_compact(F.array(*halves))).alias("_half"),
    )
    return made.select("whole", "whole_print", "owner", "_half.*")


def _judge(fragments: DataFrame, table: Callable) -> DataFrame:
    """``key, print, owner, early`` for each different fragment of each anchor (``key,
    fragment, place, owner``): its least owner, and as bits its strings that an earlier
    document has."""
    level = table(
        fragments.groupBy("key", "fragment").agg(
            F.min("place").alias("place"),
            F.min("owner").alias("owner"),
            F.lit(0).alias("fewest"),
            F.lit(LENGTH - ANCHOR).alias("most"),
        )
    )
    sortable, halved, total = [], [], 0
    for depth in range((LENGTH - ANCHOR).bit_length() + 1):
        counts = table(level.groupBy("key").count())
        # After so many halvings a half is a string, and there is one row of it.
        crowded = counts.filter(F.col("count") > CROWDED).select("key")
        if depth == (LENGTH - ANCHOR).bit_length() or crowded.isEmpty():
            sortable.append(level)
            total += counts.agg(F.sum("count")).first()[0] or 0
            break
        sortable.append(level.join(crowded, "key", "left_anti"))
        total += counts.filter(F.col("count") <= CROWDED).agg(F.sum("count")).first()[0] or 0
        halved.append(table(_halve(level.join(crowded, "key", "left_semi"), depth)))
        names = ["place", "owner", "fewest", "most"]
        level = table(
            halved[-1].groupBy("key", "fragment").agg(*(F.min(n).alias(n) for n in names))
        )
    batches = max(1, math.ceil(total / BATCH_FRAGMENTS))
    columns = [F.col("key"), F.col("owner"), F.col("fragment")]
    dealt = reduce(DataFrame.unionByName, [some.select(*columns) for some in sortable])
    dealt = dealt.withColumn("print", _print(F.col("fragment"))).withColumn(
        "batch", F.pmod(F.xxhash64("key"), F.lit(batches))
    )
    known = table(
        dealt.groupBy("batch").applyInPandas(
            _sort, "key long, print long, owner long, early long"
        )
    )
    for halves in reversed(halved):
        # All strings of a half that an earlier document has are in that document.
        bits = F.when(F.col("owner") > F.col("first"), _every(F.col("strings")))
        bits = bits.otherwise(F.col("early"))
        halves = halves.withColumns(
            {"print": _print(F.col("fragment")), "strings": _strings(F.col("fragment"))}
        )
        joined = halves.join(known.withColumnRenamed("owner", "first"), ["key", "print"])
        whole = joined.groupBy("whole", "whole_print").agg(
            F.min("owner").alias("owner"),
            F.sum(F.call_function("shiftleft", bits, F.col("shift"))).alias("early"),
        )
        known = table(known.unionByName(whole.toDF("key", "print", "owner", "early")))
    return known


def _cut(length: int):
    """Removes the strings that ``lows`` and ``bits`` say from a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            repeats = batch.column("repeats")
            cuts, places = repeats.offsets.to_numpy(), repeats.values
            lows, bits = (places.field(n).to_numpy() for n in ("low", "bits"))
            for body, a, b in zip(batch.column("body"), cuts, cuts[1:], strict=False):
                text = np.frombuffer(body.as_py(), "u1")
                one = np.unpackbits(
                    bits[a:b].astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little"
                )
                place, string = np.nonzero(one)
                begins = lows[a:b][place] + string
                steps = np.bincount(begins, minlength=len(text) + 1)
                steps -= np.bincount(begins + length, minlength=len(text) + 1)
                gone = np.cumsum(steps[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(np.diff(gone.astype("i1"), prepend=0) == 1)))
                kept.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(removed), pa.array(spans), pa.array(kept)],
                ["node", "n_removed", "n_spans", "kept"],
            )

    return tidy(run)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for every row of ``docs``
    (``doc_id, text``): each byte goes that is covered by a string of 50 bytes that also
    starts in a document with a smaller ``doc_id``. Strings are judged on the input.

    Null and empty texts have no bytes, texts under 50 bytes lose none. Rows may repeat:
    rows with the same ``doc_id`` remove nothing from each other, and a row without
    ``doc_id`` counts as the last of all. Other columns are ignored; an empty table gives an
    empty one.
    """
    with scratch(docs.sparkSession) as table:
        return as_table(_removed(docs, table))


def _removed(docs: DataFrame, table: Callable) -> DataFrame:
    spark, folder = docs.sparkSession, new_folder(docs.sparkSession, "groups")
    groups = hg.pack(docs, _describe, folder)
    listed = hg.list_documents(groups).withColumnRenamed("size", "n_bytes")
    listed = table(listed.withColumn("owner", F.coalesce("doc_id", F.lit(_LAST))))
    texts = table(_shared_places(groups, listed))
    remove(spark, folder)
    at = F.col("_at")
    fragments = F.transform(
        F.arrays_zip("keys", "lows", "strings", "places"),
        lambda x: F.struct(
            x["keys"].alias("key"),
            x["lows"].alias("low"),
            F.substring(F.col("body"), x["lows"] + 1, x["strings"] + (LENGTH - 1)).alias(
                "fragment"
            ),
            x["places"].alias("place"),
        ),
    )
    places = texts.filter(F.col("body").isNotNull()).select(
        "node", "owner", F.explode(fragments).alias("_at")
    )
    places = places.select("node", "owner", *(at[n].alias(n) for n in _PLACE))
    known = _judge(places.select("key", "fragment", "place", "owner"), table)
    slim = places.select(
        "node",
        "owner",
        "key",
        "low",
        _print(F.col("fragment")).alias("print"),
        _strings(F.col("fragment")).alias("strings"),
    )
    found = slim.join(known.withColumnRenamed("owner", "first"), ["key", "print"])
    later = F.col("owner") > F.col("first")
    bits = F.when(later, _every(F.col("strings"))).otherwise(F.col("early"))
    found = found.select("node", "low", bits.alias("bits"))
    repeats = found.filter("bits <> 0").groupBy("node").agg(
        F.collect_list(F.struct("low", "bits")).alias("repeats")
    )
    repeats = table(repeats)
    cut = table(
        texts.select("node", "body").join(repeats, "node").mapInArrow(
            _cut(LENGTH), "node long, n_removed long, n_spans long, kept string"
        )
    )
    clean = F.lit(0).cast("long")
    results = texts.select("node", "owner", "whole").join(cut, "node", "left").select(
        "node",
        F.col("owner").alias("first"),
        F.coalesce("n_removed", clean).alias("n_removed"),
        F.coalesce("n_spans", clean).alias("n_spans"),
        F.coalesce("kept", "whole").alias("kept"),
    )
    results = listed.select("node", "print").join(results, "node").drop("node")
    rows = listed.drop("node").join(results, "print")
    gone = (F.col("owner") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(gone, 1).otherwise(F.col("n_spans")).cast("long").alias("n_spans"),
        F.when(gone, hashlib.sha256().hexdigest()).otherwise(F.col("kept")).alias("kept_sha256"),
    )


def _shared_places(groups: DataFrame, listed: DataFrame) -> DataFrame:
    """A row for each different text, of the smallest ``doc_id`` that has it."""
    classes = listed.groupBy("print").agg(
        F.min(F.struct("owner", "node", "gid", "place")).alias("first"),
        F.count("*").alias("copies"),
    )
    copies = F.least("copies", F.lit(hg.MOST)).cast("int").alias("copies")
    chosen = classes.select("first.*", copies).groupBy("gid").agg(
        F.sort_array(F.collect_list(F.struct("place", "copies", "owner"))).alias("chosen")
    )
    answers, bits = hg.census(groups, anchor_hashes)
    asked = groups.select("gid", "ends", "body").join(answers, "gid", "left").join(chosen, "gid")
    return asked.select("gid", "ends", "body", "answers", "chosen").mapInArrow(
        _fragments(bits),
        "node long, owner long, whole string, body binary, keys array<long>, lows array<int>, "
        "strings array<int>, places array<int>",
    )


def op2_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


# Bytes as two hexadecimal digits each.
SQL = """
with texts as (
  select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), strings as (
  select doc_id, i, substring(h, 2 * i + 1, 100) as s
  from (select *, unnest(range(0, length(h) // 2 - 49)) as i from texts where length(h) >= 100)
), firsts as (
  select s, min(doc_id) as first from strings group by s
), hits as (
  select doc_id, i from strings join firsts using (s) where doc_id > first
), islands as (
  select *, sum(fresh) over (partition by doc_id order by i) as island
  from (select *, case when i > lag(i) over (partition by doc_id order by i) + 50 then 1 else 0 end
          as fresh from hits)
), runs as (
  select doc_id, min(i) as low, max(i) + 50 as high from islands group by doc_id, island
), gaps as (
  select doc_id, lag(high, 1, 0) over (partition by doc_id order by low) as low, low as high
  from runs
  union all
  select doc_id, max(r.high), max(length(h) // 2) from texts join runs r using (doc_id)
  group by doc_id
), kept as (
  select doc_id, string_agg(substring(h, 2 * low + 1, 2 * (high - low)), '' order by low) as h
  from gaps join texts using (doc_id) group by doc_id
), removed as (
  select doc_id, sum(high - low) as n_removed, count(*) as n_spans from runs group by doc_id
)
select t.doc_id, (length(t.h) // 2)::bigint as n_bytes,
  coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(coalesce(k.h, t.h))) as kept_sha256
from texts t left join removed using (doc_id) left join kept k using (doc_id)
"""
