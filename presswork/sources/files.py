"""Raw articles from files of JSON lines, in the shape the Kafka source has."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader


def read_articles_files(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Stream of the lines under ``path``, one JSON object each, as column ``value``.

    A micro-batch takes the oldest files first. ``max_files_per_trigger`` or
    ``max_bytes_per_trigger``, one of the two, bounds it after a standstill; a file is never
    split over batches, and one that is larger than the bound is a batch of its own. Other
    ``options`` go to Spark's source as they are.
    """
    return read_wire_files(
        spark.readStream.format("text").options(**options),
        path,
        max_files_per_trigger,
        max_bytes_per_trigger,
    ).select("value")


def read_wire_files(
    reader: DataStreamReader,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """What ``reader`` makes of the files under ``path``, in micro-batches of bounded size."""
    if max_files_per_trigger is not None and max_bytes_per_trigger is not None:
        raise ValueError("a micro-batch is bounded by files or by bytes, not by both")
    for name, bound in (
        ("maxFilesPerTrigger", max_files_per_trigger),
        ("maxBytesPerTrigger", max_bytes_per_trigger),
    ):
        if bound is not None:
            if bound < 1:
                raise ValueError(f"{name} must be at least 1")
            reader = reader.option(name, bound)
    return reader.load(path)
