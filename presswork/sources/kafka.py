"""Raw articles from a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader

STARTING_OFFSETS = ("earliest", "latest")


def read_articles_kafka(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "latest",
    *,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    reader: DataStreamReader | None = None,
) -> DataFrame:
    """Stream of one topic's records; the JSON is in the binary column ``value``.

    ``starting_offsets`` counts on a fresh checkpoint only. ``max_offsets_per_trigger``
    bounds a micro-batch after a standstill, and ``min_partitions`` has Spark split the
    offset range of a crowded topic partition over several tasks.
    """
    if starting_offsets not in STARTING_OFFSETS:
        raise ValueError(f"starting_offsets must be one of {STARTING_OFFSETS}")
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return (reader or spark.readStream).format("kafka").options(**options).load()
