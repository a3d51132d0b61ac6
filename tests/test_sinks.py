import json
from datetime import date, datetime, timezone
from unittest.mock import MagicMock

import pytest
from helpers import STAMP, article, clock, wire
from pyspark.sql import functions as F

from presswork import ConsoleSink, KafkaSink, ParquetSink, build_sinks, enrich, parse_articles
from presswork.operators import batch_stats, error_rows
from presswork.plans.demo import LengthSentiment, LengthTopic
from presswork.schemas import BASE_FIELDS, CONSOLE_FIELDS, KAFKA_FIELDS
from presswork.sinks import kafka_payload


@pytest.fixture
def enriched(spark):
    records = [
        article(url_hash="a", summary="four"),
        article(url_hash="b", summary=" "),
        article(url_hash="c", summary="x" * 11),
    ]
    articles = parse_articles(wire(spark, *records))
    return enrich(articles, LengthSentiment(), LengthTopic(11), clock=clock)


def test_enriched_columns(enriched):
    answers = [
        f"{prefix}_{part}"
        for prefix in ("sentiment", "category")
        for part in ("label", "score", "inferred_at", "error")
    ]
    assert enriched.columns == BASE_FIELDS + answers


def test_parquet_files_are_compressed_with_zstd(spark, enriched, tmp_path):
    ParquetSink(str(tmp_path)).write(enriched, 0)
    files = list(tmp_path.rglob("part-*"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)


def test_stats_and_error_rows(enriched):
    assert tuple(batch_stats(enriched).first()) == (3, 1, 2)
    assert {r.url_hash for r in error_rows(enriched).collect()} == {"b", "c"}
    assert {r.url_hash for r in error_rows(enriched, "sentiment").collect()} == {"b"}
    assert tuple(batch_stats(enriched.limit(0)).first()) == (0, 0, 0)


def test_kafka_payload(enriched):
    payload = kafka_payload(enriched.filter("url_hash = 'a'"))
    assert payload.columns == ["value"]
    record = json.loads(payload.first().value)
    absent = {"sentiment_error", "category_error"}
    assert list(record) == [name for name in KAFKA_FIELDS if name not in absent]
    assert record["published_at"] == "2029-11-03T06:15:42.000Z"
    assert record["sentiment_inferred_at"] == STAMP
    assert record["sentiment_score"] == 0.04


def test_kafka_writer_options(enriched, monkeypatch):
    writer = MagicMock()
    for method in ("format", "options", "mode"):
        getattr(writer, method).return_value = writer
    monkeypatch.setattr(type(enriched), "write", property(lambda self: writer))
    KafkaSink("host:1").write(enriched, 0)
    writer.format.assert_called_once_with("kafka")
    writer.options.assert_called_once_with(
        **{"kafka.bootstrap.servers": "host:1", "topic": "enriched_news"}
    )
    writer.mode.assert_called_once_with("append")
    writer.save.assert_called_once_with()


def test_parquet_sink_appends_under_todays_date(spark, enriched, tmp_path):
    folder = str(tmp_path / "out")
    days = [datetime.now(timezone.utc).date()]
    ParquetSink(folder).write(enriched, 0)
    ParquetSink(folder).write(enriched, 1)
    days.append(datetime.now(timezone.utc).date())
    written = spark.read.parquet(folder)
    assert written.columns == [*enriched.columns, "ingest_date"]
    assert written.count() == 6
    assert {r.ingest_date for r in written.collect()} <= set(days)
    assert all(path.name.startswith("ingest_date=") for path in tmp_path.glob("out/*="))


def test_parquet_sink_reads_back_what_was_written(spark, enriched, tmp_path):
    folder = str(tmp_path / "out")
    day = F.lit("2024-02-03").cast("date")
    ParquetSink(folder, ingest_date=day, one_date=True).write(enriched, 0)
    written = spark.read.parquet(folder).filter(F.col("ingest_date") == date(2024, 2, 3))
    assert sorted(map(tuple, written.drop("ingest_date").collect())) == sorted(
        map(tuple, enriched.collect())
    )
    assert "PartitionFilters: [isnotnull(ingest_date" in (
        written._jdf.queryExecution().executedPlan().toString()
    )


def test_dates_that_vary_are_brought_together(spark, tmp_path):
    rows = spark.range(0, 400, 1, 8)
    by_row = F.date_from_unix_date((F.col("id") % 4).cast("int"))
    files = {}
    for one_date in (False, True):
        sink = ParquetSink(str(tmp_path / str(one_date)), ingest_date=by_row, one_date=one_date)
        sink.write(rows, 0)
        assert spark.read.parquet(sink.output_dir).count() == 400
        files[one_date] = len(list((tmp_path / str(one_date)).glob("*/*.parquet")))
    assert files == {False: 4, True: 32}


def test_a_replayed_batch_overwrites_itself_only(spark, enriched, tmp_path):
    sink = ParquetSink(str(tmp_path / "out"), per_batch=True, stream_id="s")
    for batch in (0, 1, 1):
        sink.write(enriched, batch)
    written = spark.read.parquet(sink.output_dir)
    assert dict(written.groupBy("batch_id").count().collect()) == {0: 3, 1: 3}
    with pytest.raises(ValueError, match="stream_id"):
        ParquetSink(sink.output_dir, per_batch=True).write(enriched, 0)
    assert "ingest_date" in written.columns


def test_console(enriched, capsys):
    ConsoleSink().write(enriched, 0)
    shown = capsys.readouterr().out
    assert all(name in shown for name in CONSOLE_FIELDS) and "author" not in shown
    assert shown.count("|Title") == 3
    ConsoleSink(rows=1).write(enriched, 0)
    shown = capsys.readouterr().out
    assert shown.count("|Title") == 1 and "only showing top 1 row" in shown


@pytest.mark.parametrize(
    ("parquet", "kafka", "servers", "kinds"),
    [
        (True, True, "localhost:9092", [ParquetSink, KafkaSink]),
        (True, True, None, [ParquetSink]),
        (True, True, "", [ParquetSink]),
        (True, False, "localhost:9092", [ParquetSink]),
        (False, True, "localhost:9092", [KafkaSink]),
        (False, False, "localhost:9092", []),
    ],
)
def test_sinks_by_flags(parquet, kafka, servers, kinds):
    assert [type(s) for s in build_sinks(parquet, kafka, "some/where", servers)] == kinds
