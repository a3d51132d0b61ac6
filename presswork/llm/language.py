"""Language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector over hashed byte 2-grams and 3-grams of its lower-cased
letters, scaled to length one. The labelled vectors of each language are clustered by
spherical k-means, so that prose, lists and shouting may have centroids of their own. A text
takes the language of the centroid with the largest cosine; if that is farther away than
the language's own texts are, the text is rejected. How far those are, and how far texts of
other languages, is measured on the sample, on whole texts and on pieces of all lengths.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presswork.llm.tables import read_table, ship, slices, tidy, unpack
from presswork.storage import scratch

UNKNOWN = "und"
DIMENSIONS = 1 << 13
CENTROIDS = 4
# The classifier is fitted on about so many labelled documents of each language, those
# with the smallest hashes of doc_id. A language's clustering holds that many vectors.
SAMPLE = 400
ROUNDS = 8
BROADCAST_LANGS = 10_000
# A text is rejected if its cosine is below the middle between two cosines: the one that all
# but REJECT_TAIL of the language's own texts reach, and the median of texts of the languages
# beside it. Both are taken among texts with as many different grams, by powers of two.
REJECT_TAIL = 0.02
OCTAVES = 14
# So many pieces of 1, 2, 4, 8 … words are cut out of each text of the sample.
PIECES = 3
_BATCH = 256

_LETTER = re.compile(r"[^\W\d_]")
_SPACED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def count_grams(text: str) -> np.ndarray:
    """Counts of the hashed 2-grams and 3-grams of a whole text."""
    raw = b" " + text.lower().encode("utf-8", "replace").translate(_SPACED) + b" "
    at = np.frombuffer(raw, "u1").astype("u4")
    pairs = at[:-1] << 8 | at[1:]
    triples = pairs[:-1] << 8 | at[2:]
    grams = np.concatenate([pairs | np.uint32(1 << 30), triples]) * np.uint32(2654435761)
    return np.bincount(grams >> np.uint32(32 - 13), minlength=DIMENSIONS)


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length one; the term frequency is logarithmic."""
    rows = np.log1p(counts.astype("f4")) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.maximum(norms, 1e-12)


def cluster(rows: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of length one. The first is the mean; each further one starts at the row
    farthest from those there are."""
    unit = lambda v: v / max(np.linalg.norm(v), 1e-12)
    centroids = [unit(rows.mean(0))]
    while len(centroids) < min(k, len(rows)):
        nearest = (rows @ np.array(centroids).T).max(1)
        centroids.append(rows[nearest.argmin()])
    for _ in range(rounds):
        own = (rows @ np.array(centroids).T).argmax(1)
        centroids = [
            unit(rows[own == i].mean(0)) if (own == i).any() else c
            for i, c in enumerate(centroids)
        ]
    return np.array(centroids, "f4")


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray  # a row per centroid
    langs: list[str]  # of each centroid, in order
    limits: np.ndarray  # least cosine, a row per centroid and a column per octave

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines and rejections."""
        known = [i for i, text in enumerate(texts) if has_letter(text)]
        langs = [UNKNOWN] * len(texts)
        scores, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        for at in range(0, len(known) if self.langs else 0, _BATCH):
            some = known[at : at + _BATCH]
            counts = np.array([count_grams(texts[i]) for i in some])
            rows = weigh(counts, self.idf)
            cosines = rows @ self.centroids.T
            best = cosines.argmax(1)
            for i, j in zip(some, best.tolist(), strict=True):
                langs[i] = self.langs[j]
            top = cosines[np.arange(len(some)), best]
            scores[some] = np.clip(top, 0, 1)
            rejected[some] = top < self._least(best, octaves(counts))
        return langs, scores, rejected

    def _least(self, best: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The limits of these centroids, straight between octaves."""
        low = np.minimum(place.astype("i4"), OCTAVES - 2)
        below, above = self.limits[best, low], self.limits[best, low + 1]
        return below + (above - below) * (place - low)


def octaves(counts: np.ndarray) -> np.ndarray:
    """Binary logarithms of the numbers of different grams."""
    return np.log2(np.maximum(1, (counts > 0).sum(1)))


def pieces(text: str) -> Iterator[str]:
    """Runs of 1, 2, 4, 8 … words at places that follow from the text."""
    words, raw = text.split(), text.encode("utf-8", "replace")
    size = 1
    while size < len(words):
        for turn in range(PIECES):
            at = zlib.crc32(raw, turn) % (len(words) - size + 1)
            piece = " ".join(words[at : at + size])
            if has_letter(piece):
                yield piece
        size *= 2


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of whole texts and of their pieces."""
    for part in (part for whole in batches for part in slices(whole, 16)):
        rows = []
        for lang, text in zip(*(column.to_pylist() for column in part.columns), strict=True):
            for turn, piece in enumerate([text, *pieces(text)]):
                counts = count_grams(piece)
                found = np.flatnonzero(counts)
                rows.append((lang, turn == 0, found.astype("i4"), counts[found].astype("i4")))
        langs, whole, found, counts = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs),
                pa.array(whole),
                pa.array(found, pa.list_(pa.int32())),
                pa.array(counts, pa.list_(pa.int32())),
            ],
            ["lang", "whole", "grams", "counts"],
        )


def _centroids(idf: np.ndarray):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((len(group), DIMENSIONS), "f4")
        # In the order of their content: the clusters must not hang on that of the rows.
        keys = [(tuple(g), tuple(c)) for g, c in zip(group["grams"], group["counts"], strict=True)]
        for row, (grams, values) in enumerate(sorted(keys)):
            counts[row, list(grams)] = values
        rows = weigh(counts, idf)
        centroids = cluster(rows)
        return pd.DataFrame(
            {
                "lang": [group["lang"].iloc[0]] * len(centroids),
                "centroid": [c.tobytes() for c in centroids],
            }
        )

    return run


def _cosines(shared):
    """For each text the cosine to its own language, and to the nearest one beside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = unpack(shared)
        owners = np.array(model.langs, object)
        for part in (part for batch in batches for part in slices(batch, _BATCH)):
            langs, grams, values = (column.to_pylist() for column in part.columns)
            counts = np.zeros((len(langs), DIMENSIONS), "f4")
            for row, (found, n) in enumerate(zip(grams, values, strict=True)):
                counts[row, found] = n
            cosines = weigh(counts, model.idf) @ model.centroids.T
            is_own = owners[None, :] == np.array(langs, object)[:, None]
            others = np.where(is_own, -1, cosines)
            nearest = others.argmax(1)
            there = others.max(1) >= 0
            octave = np.rint(octaves(counts)).astype("i4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*langs, *owners[nearest][there]], pa.string()),
                    pa.array(np.concatenate([octave, octave[there]])),
                    pa.array(np.arange(len(langs) + there.sum()) < len(langs)),
                    pa.array(
                        np.concatenate(
                            [np.where(is_own, cosines, -1).max(1), others.max(1)[there]]
                        ).astype("f8")
                    ),
                ],
                ["lang", "octave", "own", "cosine"],
            )

    return tidy(run)


def _limits(grams: DataFrame, model: Model) -> np.ndarray:
    """The limit of each language in each octave; octaves without texts of its own lie
    straight between their neighbours, from 0 at a single gram on."""
    shared = ship(grams.sparkSession.sparkContext, model)
    spec = "lang string, octave int, own boolean, cosine double"
    cosines = grams.select("lang", "grams", "counts").mapInArrow(_cosines(shared), spec)
    measured = cosines.groupBy("lang", "octave").agg(
        F.percentile(F.when(F.col("own"), F.col("cosine")), F.lit(REJECT_TAIL)).alias("low"),
        F.percentile(F.when(~F.col("own"), F.col("cosine")), F.lit(0.5)).alias("other"),
    )
    known: dict[str, dict[int, float]] = {}
    for row in measured.filter("low is not null").collect():  # OCTAVES rows a language at most
        low = max(0.0, row["low"])
        # Where the two are close, as in single words, a quarter of the own cosine is room.
        other = min(max(0.0, row["other"] or 0.0), low / 2)
        known.setdefault(row["lang"], {0: 0.0})[row["octave"]] = (low + other) / 2
    table = [sorted(known[lang].items()) for lang in model.langs]
    lines = [np.interp(range(OCTAVES), *zip(*line, strict=True)) for line in table]
    return np.array(lines).reshape(len(lines), OCTAVES)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """From the columns ``doc_id, text, lang``. Rows with null or letterless text or null
    ``lang`` teach nothing; of each language about ``sample`` documents are used, all if it
    has fewer. The model holds ``CENTROIDS`` vectors of ``DIMENSIONS`` floats a language."""
    with scratch(labelled.sparkSession) as table:
        return _fitted(labelled, sample, table)


def _fitted(labelled: DataFrame, sample: int, table: Callable) -> Model:
    usable = labelled.filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & F.col("doc_id").isNotNull()
    )
    sizes = table(usable.groupBy("lang").agg(F.count("*").alias("_n")))
    # Texts stay where they are unless there are more languages than a broadcast may hold.
    if sizes.count() <= BROADCAST_LANGS:
        sizes = F.broadcast(sizes)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    picked = usable.join(sizes, "lang").filter(place * F.col("_n") < sample)
    spec = "lang string, whole boolean, grams array<int>, counts array<int>"
    cut = table(picked.select("lang", "text").mapInArrow(_grams, spec))
    grams = cut.filter("whole")
    total = grams.count()
    present = grams.select(F.explode("grams").alias("gram")).groupBy("gram").count()
    idf = np.zeros(DIMENSIONS, "f4")
    for gram, n in present.collect():  # a row per dimension at most
        idf[gram] = np.log((1 + total) / (1 + n)) + 0.1
    found = grams.groupBy("lang").applyInPandas(
        _centroids(idf), "lang string, centroid binary"
    )
    rows = sorted(found.collect(), key=lambda r: (r["lang"], bytes(r["centroid"])))
    centroids = [np.frombuffer(r["centroid"], "f4") for r in rows]
    model = Model(
        idf,
        np.array(centroids, "f4").reshape(len(rows), DIMENSIONS),
        [r["lang"] for r in rows],
        np.zeros((len(rows), OCTAVES)),
    )
    model.limits = _limits(cut, model)
    return model


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = unpack(shared)
        for part in (part for batch in batches for part in slices(batch, _BATCH)):
            texts = pc.struct_field(part.column(0), "text").to_pylist()
            langs, scores, rejected = model.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(langs), pa.array(scores), pa.array(rejected)],
                ["_row", "lang_pred", "score", "rejected"],
            )

    return tidy(run)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``lang_pred, score, rejected``.

    ``lang_pred`` is a language of the model, ``und`` for texts that are null or have no
    letter; those have score 0 and are rejected. So is every text if the model has no
    language. ``score`` is the cosine to the nearest centroid, from 0 to 1. Rows may repeat.
    """
    rows = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("_row"))
    schema = T.StructType(
        [
            T.StructField("_row", rows.schema["_row"].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    shared = ship(docs.sparkSession.sparkContext, model)
    return rows.mapInArrow(_predict(shared), schema)


def held_out(doc_id: str | Column) -> Column:
    """The documents that nothing is learned from. A null ``doc_id`` is not among them."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op8_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    model = fit(documents.filter(~held_out("doc_id")))
    slim = documents.select("doc_id", "text")
    found = identify(slim, model)
    doc_id = F.col("_row.doc_id")
    return found.select(
        doc_id.alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )
