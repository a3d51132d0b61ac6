"""Intermediate tables, and where they go."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from itertools import count

from pyspark.sql import DataFrame, SparkSession


# Whether an execution's shuffle files go when it ends.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_stated: list[str] = []
_stated_for_one_machine: list[str] = []


def use_shared_dir(folder: str, one_machine: bool = False) -> None:
    """The folder to use in sessions that do not name one in ``spark.checkpoint.dir``.
    Every executor must see it under this path. With ``one_machine`` it counts only where
    the executor is the driver itself."""
    (_stated_for_one_machine if one_machine else _stated)[:] = [folder]


def on_one_machine(spark: SparkSession) -> bool:
    """Is the executor the driver itself, so that any folder is shared?"""
    return re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")) is not None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: what ``spark.checkpoint.dir`` names, else what
    ``use_shared_dir`` stated. There is no default, on one machine neither."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    local = _stated_for_one_machine if on_one_machine(spark) else []
    for folder in (configured, *_stated, *local):
        if folder:
            return folder.rstrip("/")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/presswork-{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_REMOVE_SHUFFLES, "false")
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)


def as_table(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written to ``folder`` (by default a new shared one) and read back.

    For rows that several plans need: they are computed here and now, once, and no
    executor lost later brings the computation back. So the shuffle files it took go as
    soon as the table is there, where Spark would keep them until the driver's JVM finds
    them to be garbage.
    """
    folder = folder or new_folder(df.sparkSession, "table")
    with _shuffles_removed(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a table that nothing reads any more."""
    files, path = _locate(spark, folder)
    files.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, path = _locate(spark, path)
    return files.exists(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a file, or of all files below a folder."""
    files, path = _locate(spark, path)
    return files.getContentSummary(path).getLength()


def _locate(spark: SparkSession, path: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``as_table`` for tables that only what happens inside the scope reads: they go at its
    end. What is to outlast it is written by ``as_table`` itself, before."""
    folder, numbers = new_folder(spark, "scratch"), count()
    try:
        yield lambda df: as_table(df, f"{folder}/{next(numbers)}")
    finally:
        remove(spark, folder)
