"""Enriched articles to a Kafka topic."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from presswork.functions.wire import to_wire

OUTPUT_TOPIC = "enriched_news"  # fixed value: the topic consumers subscribe to


def kafka_payload(enriched: DataFrame) -> DataFrame:
    """One JSON ``value`` per row; records have no key."""
    return enriched.select(to_wire().alias("value"))


@dataclass(frozen=True)
class KafkaSink:
    """Writes at least once: a batch that is replayed is sent again."""

    bootstrap_servers: str
    topic: str = OUTPUT_TOPIC

    single_pass = True

    def write(self, enriched: DataFrame, batch_id: int) -> None:
        options = {"kafka.bootstrap.servers": self.bootstrap_servers, "topic": self.topic}
        records = kafka_payload(enriched).write.format("kafka")
        records.options(**options).mode("append").save()
