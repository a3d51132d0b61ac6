"""Article enrichment on Spark: parse, prepare, score and deliver news articles."""

from presswork.functions import parse_articles
from presswork.operators import CATEGORY, SENTIMENT, HttpScorer, ScoreSpec, score
from presswork.options import StreamOptions
from presswork.plans import enrich
from presswork.sinks import ConsoleSink, KafkaSink, ParquetSink, Sink, build_sinks
from presswork.streaming import batch_writer, start

__all__ = [
    "CATEGORY",
    "ConsoleSink",
    "HttpScorer",
    "KafkaSink",
    "ParquetSink",
    "SENTIMENT",
    "ScoreSpec",
    "Sink",
    "StreamOptions",
    "batch_writer",
    "build_sinks",
    "enrich",
    "parse_articles",
    "score",
    "start",
]
