"""A training corpus from the ``documents`` table, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept, and is
written as Parquet and read again for the next one. All stages but the last return the
columns of ``documents``; further columns of the input are carried along, whatever their
names.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from presswork.llm import decontaminate, jaccard, language, mixing, token_files  # noqa: E402
from presswork.llm.tables import read_table  # noqa: E402
from presswork.storage import as_table, new_folder  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Null texts, texts without a letter and texts
    far from every language's centroids go. ``lang`` stays as it was given: the classifier
    learns from it, on the documents that are not held out."""
    model = language.fit(docs.filter(~language.held_out("doc_id")))
    found = language.identify(docs, model).filter(~F.col("rejected"))
    return _columns(found.withColumnRenamed("_row", "row"), docs)


def _as_row(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """All columns in one, ``row``, where no name can clash, and ``columns`` beside it."""
    return docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), *columns)


def _columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of ``row``."""
    return rows.select(*[F.col("row")[name].alias(name) for name in docs.columns])


# Near-duplicates of this stage: shingles of so many words, and a similarity of so many
# percent or more. op10's contract has its own.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest ``doc_id``. ``doc_id`` is
    a key; of rows that repeat with the same text one stays, and rows without ``doc_id``
    stay unless they repeat."""
    grouped = jaccard.jaccard_components(
        docs.select("doc_id", "text"), NEAR_PERCENT, NEAR_WORDS
    )
    stays = (F.col("component_id") == F.col("doc_id")) | F.col("doc_id").isNull()
    keep = grouped.filter(stays).select("doc_id").distinct()
    kept = docs.join(keep, docs["doc_id"].eqNullSafe(keep["doc_id"]), "left_semi")
    same = Window.partitionBy("row.doc_id", "row.text").orderBy("row.source")
    turns = _as_row(kept).select("row", F.row_number().over(same).alias("turn"))
    return _columns(turns.filter("turn = 1"), docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; what is little else goes as a whole."""
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them, in training order. One that it does
    not take goes."""
    counted = as_table(_as_row(docs, "doc_id", "source", mixing.count_words("text").alias("size")))
    return _columns(mixing.arrange(mixing.mix(counted, size=counted["size"])), docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of all documents in files, and what the files say of each document."""
    folder = new_folder(spark, "corpus")
    token_files.write_tokens(docs, folder, token_files.tokenizer_path())
    return token_files.token_digests(token_files.read_tokens(spark, folder))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", write_token_files),
]

# The classifier of the first stage and the tokenizer of the last are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = as_table(stage(spark, docs, sf_dir))
    return docs
