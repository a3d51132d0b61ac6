"""What a sink is, and the choice of the built-in ones by flags."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame

from presswork.sinks.kafka import OUTPUT_TOPIC, KafkaSink
from presswork.sinks.parquet import ParquetSink


class Sink(Protocol):
    """Anything that can write an enriched batch. A batch that failed half-way is
    written again under the same ``batch_id``; one without rows to score is not offered.
    A sink that reads all rows in one action may say so with ``single_pass = True`` (see
    ``reuse`` of ``batch_writer``). One that says so and runs no action on the rows would
    keep the batch waiting for its counts for ever."""

    def write(self, enriched: DataFrame, batch_id: int) -> None: ...


def build_sinks(
    write_parquet: bool,
    write_kafka: bool,
    parquet_dir: str,
    bootstrap_servers: str | None = None,
    output_topic: str = OUTPUT_TOPIC,
    per_batch: bool = False,
) -> list[Sink]:
    """Parquet first; Kafka only if asked for and the servers are known."""
    sinks: list[Sink] = []
    if write_parquet:
        sinks.append(ParquetSink(parquet_dir, per_batch))
    if write_kafka and bootstrap_servers:
        sinks.append(KafkaSink(bootstrap_servers, output_topic))
    return sinks
