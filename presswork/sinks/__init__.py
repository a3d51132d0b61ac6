from presswork.sinks.base import Sink, build_sinks
from presswork.sinks.console import ConsoleSink
from presswork.sinks.kafka import KafkaSink, kafka_payload
from presswork.sinks.parquet import ParquetSink, utc_date

__all__ = [
    "ConsoleSink",
    "KafkaSink",
    "ParquetSink",
    "Sink",
    "build_sinks",
    "kafka_payload",
    "utc_date",
]
