"""The parameters of a stream."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class StreamOptions:
    # The defaults below are those users of the stream rely on.
    bootstrap_servers: str = "localhost:9092"
    topic: str = "raw_news"
    output_topic: str = "enriched_news"
    starting_offsets: str = "latest"
    checkpoint_location: str | None = None  # see ``streaming.checkpoint_path``
    write_parquet: bool = True
    write_kafka: bool = False
    parquet_dir: str = "./data/parquet/news_enriched"
    show_console: bool = True
    console_rows: int = 50
    console_truncate: bool = False
    sentiment_endpoint: str = "http://localhost:9000/api/sentiment/batch"
    topic_endpoint: str = "http://localhost:9000/api/topic/batch"
    health_endpoint: str = "http://localhost:9000/health"
    timeout_s: float = 30
    chunk_size: int = 25
    chunk_bytes: int | None = None  # of texts in a request; no limit
    max_chars: int | None = None  # whole texts

    # Own additions; the defaults leave Spark's behaviour alone.
    max_in_flight: int = 1
    survivor_order: tuple[str, ...] | None = None  # e.g. ("published_at", "title")
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    scoring_partitions: int | None = None
    deliver_once: bool = True
    on_error: str = "fail"
    on_not_ready: str = "fail"  # or "skip", or "wait"
    wait_limit_s: float = 300
    wait_interval_s: float = 5
    reuse: str = "table"
    parquet_per_batch: bool = False
