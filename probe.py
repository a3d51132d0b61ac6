"""The dataflow this package avoids, next to its own, on the same records and scorers.

``python probe.py [TABLES]`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` prints
one line of JSON: seconds for rows that are pickled to Python per scorer, joined back twice,
and counted from a base that nothing keeps, and seconds for ``batch_writer``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from presswork import ParquetSink, batch_writer, parse_articles
from presswork.operators import prepare_articles
from presswork.plans import demo
from presswork.schemas import IDENTITY


def by_rows(base: DataFrame, scorer, prefix: str, key: str) -> DataFrame:
    """Chunks of 25 rows per partition through the scorer, as an RDD of rows."""

    def partition(rows):
        rows = list(rows)
        for at in range(0, len(rows), 25):
            chunk = rows[at : at + 25]
            for row, reply in zip(chunk, scorer([{"text": r.text_for_inference} for r in chunk])):
                yield Row(url_hash=row.url_hash, fingerprint=row.fingerprint,
                          **{f"{prefix}_label": (reply or {}).get(key)})

    asked = base.select(*IDENTITY, "text_for_inference").rdd.mapPartitions(partition)
    return base.sparkSession.createDataFrame(
        asked, f"url_hash string, fingerprint string, {prefix}_label string"
    )


def row_dataflow(articles: DataFrame, folder: str) -> None:
    base = prepare_articles(articles)
    sentiment = by_rows(base, demo.LengthSentiment(), "sentiment", "sentiment_label")
    category = by_rows(base, demo.LengthTopic(), "category", "topic_label")
    joined = base.join(sentiment, list(IDENTITY), "left").join(category, list(IDENTITY), "left")
    base.count()
    joined.count()
    joined.filter(F.col("sentiment_label").isNull() | F.col("category_label").isNull()).count()
    joined.write.parquet(folder)


def main() -> None:
    tables = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="presswork-probe-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = spark.conf.get("spark.checkpoint.dir")
    wire = demo.document_wire(demo.read_documents(spark, tables))
    wire.write.parquet(f"{folder}/wire")
    articles = parse_articles(spark.read.parquet(f"{folder}/wire"))
    write = batch_writer(
        [ParquetSink(f"{folder}/own")], demo.LengthSentiment(), demo.LengthTopic()
    )
    seconds = {"rows": [], "own": []}
    for turn in range(3):
        began = time.perf_counter()
        row_dataflow(articles, f"{folder}/rows-{turn}")
        seconds["rows"].append(round(time.perf_counter() - began, 2))
        began = time.perf_counter()
        write(articles, turn)
        seconds["own"].append(round(time.perf_counter() - began, 2))
    print(json.dumps(seconds))
    spark.stop()


if __name__ == "__main__":
    main()
