"""Starting the stream."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from presswork.functions.wire import parse_articles
from presswork.operators.scorers import HttpReady, HttpScorer, ScorerFactory
from presswork.options import StreamOptions
from presswork.sinks import ConsoleSink, Sink, build_sinks
from presswork.sources import read_articles_kafka
from presswork.storage import on_one_machine, remove, shared_dir
from presswork.streaming.ledger import Ledger
from presswork.streaming.release import AtEnd
from presswork.streaming.writer import batch_writer

_LOCAL_CHECKPOINT = "/tmp/raw_news_checkpoints"  # fixed value: default on one machine


def start(
    spark: SparkSession,
    options: StreamOptions = StreamOptions(),
    *,
    sentiment: ScorerFactory | None = None,
    category: ScorerFactory | None = None,
    ready: Callable[[], bool] | None = None,
    sinks: Sequence[Sink] | None = None,
    wire: DataFrame | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream and return its query; ``awaitTermination()`` blocks on it.

    Without further arguments it reads the topic, asks the two services over HTTP and
    writes to the sinks the options choose. The services' health page is asked before each
    batch if one of them is used; ``ready`` is another test. ``wire`` is another stream with a ``value``
    column, ``sinks`` replaces the chosen ones (not the console), and ``trigger`` holds
    arguments of ``DataStreamWriter.trigger``, such as ``{"availableNow": True}``.

    Which sinks have a batch is kept inside the checkpoint (``deliver_once``), so that a
    restart after a failed sink repeats none of the others. Scored rows that wait for such a
    restart are all that the stream leaves in the shared folder.
    """
    if sinks is None:
        sinks = build_sinks(
            options.write_parquet,
            options.write_kafka,
            options.parquet_dir,
            options.bootstrap_servers,
            options.output_topic,
            options.parquet_per_batch,
        )
    if options.show_console:
        sinks = [*sinks, ConsoleSink(options.console_rows, options.console_truncate)]
    if wire is None:
        wire = read_articles_kafka(
            spark,
            options.bootstrap_servers,
            options.topic,
            options.starting_offsets,
            max_offsets_per_trigger=options.max_offsets_per_trigger,
            min_partitions=options.min_partitions,
        )
    over_http = sentiment is None or category is None
    if sentiment is None:
        sentiment = partial(HttpScorer, options.sentiment_endpoint, options.timeout_s)
    if category is None:
        category = partial(HttpScorer, options.topic_endpoint, options.timeout_s)
    if ready is None:
        ready = HttpReady(options.health_endpoint) if over_http else lambda: True
    checkpoint = checkpoint_path(spark, options)
    work_dir = _work_dir(spark, checkpoint) if options.reuse == "table" else None
    ledger = Ledger(spark, f"{checkpoint}/deliveries") if options.deliver_once else None
    write_batch = batch_writer(
        sinks,
        sentiment,
        category,
        ready=ready,
        on_not_ready=options.on_not_ready,
        wait_limit_s=options.wait_limit_s,
        wait_interval_s=options.wait_interval_s,
        on_error=options.on_error,
        reuse=options.reuse,
        work_dir=work_dir,
        ledger=ledger,
        max_chars=options.max_chars,
        order_by=options.survivor_order,
        partitions=options.scoring_partitions,
        chunk_size=options.chunk_size,
        chunk_bytes=options.chunk_bytes,
        max_in_flight=options.max_in_flight,
    )
    writer = (
        parse_articles(wire)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write_batch)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    if work_dir is None:
        return writer.start()
    at_end = AtEnd(spark, lambda: remove(spark, work_dir))
    query = writer.start()
    at_end.watch(query)
    return query


def checkpoint_path(spark: SparkSession, options: StreamOptions) -> str:
    """The stated checkpoint location; else one in the cluster's shared folder; else,
    with a local master only, the one-machine default."""
    if options.checkpoint_location:
        return options.checkpoint_location
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/{options.topic}_checkpoints"
    if on_one_machine(spark):
        return _LOCAL_CHECKPOINT
    raise ValueError("state checkpoint_location, or set spark.checkpoint.dir")


def _work_dir(spark: SparkSession, checkpoint: str) -> str:
    """One folder per stream that stays the same over restarts, with a table for the batch
    in hand."""
    name = hashlib.sha1(checkpoint.encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/presswork-batch-{name}"
