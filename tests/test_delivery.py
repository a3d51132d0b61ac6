"""Delivery once per sink, what a stream leaves behind, and jobs per batch."""

import os
import time

import pytest
from helpers import Recorder, article, clock
from pyspark.errors import StreamingQueryException
from test_streaming import NOW, Collected, Feed

from presswork import ParquetSink, StreamOptions, batch_writer, parse_articles, start
from presswork.operators import CATEGORY, SENTIMENT
from presswork.plans import queries
from presswork.plans.demo import LengthSentiment, LengthTopic
from presswork.sinks import ConsoleSink, KafkaSink
from presswork.sources import read_articles_files, read_wire_files
from presswork.streaming.ledger import KEPT_BATCHES, Ledger, sink_keys


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def shared(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    return lambda: {name for name in os.listdir(folder) if name.startswith("presswork-batch")}


def begin(spark, feed, sinks, tmp_path, **changes):
    options = {"checkpoint_location": str(tmp_path / "checkpoint"), "show_console": False}
    scorers = {"sentiment": LengthSentiment(), "category": LengthTopic()}
    scorers |= {name: changes.pop(name) for name in ("sentiment", "category") if name in changes}
    trigger = changes.pop("trigger", NOW)
    return start(
        spark,
        StreamOptions(**options, **changes),
        **scorers,
        ready=lambda: True,
        sinks=sinks,
        wire=read_articles_files(spark, str(feed.incoming), max_files_per_trigger=1),
        trigger=trigger,
    )


def run(*arguments, **changes):
    begin(*arguments, **changes).awaitTermination()


class Appended(Collected):
    """Keeps what it was given each time."""

    def __init__(self, fail_on=()):
        super().__init__(fail_on)
        self.writes = []

    def write(self, enriched, batch_id):
        super().write(enriched, batch_id)
        self.writes.append(batch_id)


def recorders(tmp_path):
    made = []
    for spec in (SENTIMENT, CATEGORY):
        (tmp_path / spec.prefix).mkdir()
        made.append(Recorder(tmp_path / spec.prefix, spec))
    return made


def test_a_replay_passes_by_the_sinks_that_have_the_batch(spark, feed, tmp_path, shared):
    for key in "ab":
        feed.add(article(url_hash=key))
    table, broken, last = ParquetSink(str(tmp_path / "out")), Appended([1]), Appended()
    before = shared()
    with pytest.raises(StreamingQueryException, match="sink 1"):
        run(spark, feed, [table, broken, last], tmp_path)
    assert last.writes == [0, 1] and len(shared() - before) == 1
    broken.fail_on = set()
    run(spark, feed, [table, broken, last], tmp_path)
    assert broken.writes == last.writes == [0, 1]
    assert sorted(r.url_hash for r in spark.read.parquet(table.output_dir).collect()) == ["a", "b"]


def test_a_replay_hands_on_the_answers_there_are(spark, feed, tmp_path):
    feed.add(*[article(url_hash=f"k{n}", title=f"t{n}") for n in range(30)])
    asked = dict(zip(("sentiment", "category"), recorders(tmp_path)))
    broken = Appended([0])
    with pytest.raises(StreamingQueryException):
        run(spark, feed, [broken], tmp_path, **asked)
    broken.fail_on = set()
    run(spark, feed, [broken], tmp_path, **asked)
    assert len(broken.batches[0]) == 30
    for recorder in asked.values():
        assert sum(map(len, recorder.requests)) == 30


def test_the_first_sinks_batch_serves_a_replay(spark, feed, tmp_path):
    feed.add(*[article(url_hash=f"k{n}", title=f"t{n}") for n in range(20)])
    asked = dict(zip(("sentiment", "category"), recorders(tmp_path)))
    table, broken = ParquetSink(str(tmp_path / "out"), per_batch=True), Appended([0])
    with pytest.raises(StreamingQueryException):
        run(spark, feed, [table, broken], tmp_path, reuse="sink", **asked)
    broken.fail_on = set()
    run(spark, feed, [table, broken], tmp_path, reuse="sink", **asked)
    assert len(broken.batches[0]) == 20
    assert spark.read.parquet(table.output_dir).count() == 20
    for recorder in asked.values():
        assert sum(map(len, recorder.requests)) == 20


def test_without_a_ledger_all_sinks_get_the_replay(spark, feed, tmp_path, shared):
    feed.add(article(url_hash="a"))
    first, broken = Appended(), Appended([0])
    before = shared()
    with pytest.raises(StreamingQueryException):
        run(spark, feed, [first, broken], tmp_path, deliver_once=False)
    folder = spark.conf.get("spark.checkpoint.dir")
    assert not any(os.listdir(f"{folder}/{name}") for name in shared() - before)
    broken.fail_on = set()
    run(spark, feed, [first, broken], tmp_path, deliver_once=False)
    assert (first.writes, broken.writes) == ([0, 0], [0])


def test_a_driver_lost_before_the_commit_repeats_nothing(spark, feed, tmp_path):
    """All sinks have the batch, Spark has no commit of it."""
    feed.add(article(url_hash="a"))
    sink = Appended()
    run(spark, feed, [sink], tmp_path)
    for path in (tmp_path / "checkpoint" / "commits").iterdir():
        path.unlink()
    asked = dict(zip(("sentiment", "category"), recorders(tmp_path)))
    run(spark, feed, [sink], tmp_path, **asked)
    assert sink.writes == [0] and not any(r.requests for r in asked.values())


def test_a_new_checkpoint_is_a_new_stream(spark, feed, tmp_path):
    feed.add(article(url_hash="a"))
    sink = Appended()
    run(spark, feed, [sink], tmp_path)
    (tmp_path / "other").mkdir()
    run(spark, feed, [sink], tmp_path / "other")
    assert sink.writes == [0, 0]


def test_a_given_up_share_is_not_offered_again(spark, feed, tmp_path, shared):
    feed.add(article(url_hash="a"))
    before, broken, other = shared(), Appended([0]), Appended()
    run(spark, feed, [broken, other], tmp_path, on_error="skip")
    feed.add(article(url_hash="b"))
    run(spark, feed, [broken, other], tmp_path, on_error="skip")
    assert (broken.writes, other.writes) == ([1], [0, 1])
    _wait(lambda: shared() <= before)


def _wait(done, seconds=20):
    until = time.monotonic() + seconds
    while not done() and time.monotonic() < until:
        time.sleep(0.1)
    assert done()


def test_nothing_stays_in_the_shared_folder_after_a_stop(spark, feed, tmp_path, shared):
    before, sink = shared(), Collected()
    query = begin(spark, feed, [sink], tmp_path, trigger={"processingTime": "0 seconds"})
    feed.add(article(url_hash="a"))
    _wait(lambda: 0 in sink.batches)
    query.stop()
    _wait(lambda: shared() <= before)


def test_entries(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.entered("s", 3) == set()
    ledger.enter("s", 3, "one")
    ledger.enter("s", 3, "one")  # again, by a replay
    ledger.enter("s", 3, "two")
    ledger.enter("s", 11, "one")
    ledger.enter("t", 3, "three")
    assert ledger.entered("s", 3) == {"one", "two"} and ledger.entered("t", 3) == {"three"}
    ledger.forget("s", 11)
    assert ledger.entered("s", 3) == set() and ledger.entered("s", 11) == {"one"}
    ledger.forget("nobody", 5)
    assert KEPT_BATCHES == 100


def test_a_sink_keeps_its_name_when_it_changes_places():
    parquet, kafka = ParquetSink("a"), KafkaSink("server:1")
    keys = sink_keys([parquet, kafka, ConsoleSink()])
    assert sink_keys([ConsoleSink(), kafka, ParquetSink("a")]) == [keys[2], keys[1], keys[0]]
    assert sink_keys([ParquetSink("b")])[0] not in keys

    class Named:
        def __init__(self, name):
            self.name = name

    assert sink_keys([Named("x"), Named("y")]) == sink_keys([Named("y"), Named("x")])[::-1]
    assert len(set(sink_keys([Collected(), Collected(), Named("x"), Named("x")]))) == 4


def test_a_ledger_is_for_streams(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    frame = parse_articles(spark.createDataFrame([('{"url_hash": "a", "title": "t"}',)], "value string"))
    write = batch_writer([Collected()], LengthSentiment(), LengthTopic(), ledger=ledger)
    with pytest.raises(ValueError, match="stream"):
        write(frame, 0)


def test_counts_are_taken_while_the_table_is_written(spark, caplog):
    """Three jobs for a batch with one sink: is it empty, the table, the sink."""
    lines = [(f'{{"url_hash": "k{n}", "title": "t{n}"}}',) for n in range(20)]
    frame = parse_articles(spark.createDataFrame(lines, "value string"))
    write = batch_writer([Collected()], LengthSentiment(), LengthTopic(), clock=clock)
    spark.sparkContext.setJobGroup("counting", "a batch")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with caplog.at_level("INFO", logger="presswork"):
            write(frame, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counting")) == 3
    assert "batch 0: 20 articles scored, 0 without sentiment" in caplog.text


def test_a_repeated_task_is_counted_once(spark, tmp_path, caplog):
    """Its first attempt fails after it has scored; the session takes one more."""
    import subprocess
    import sys

    script = tmp_path / "retry.py"
    script.write_text(
        f"""
import logging, sys
sys.path[:0] = {[str(p) for p in sys.path if p]!r}
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from presswork import batch_writer, parse_articles
from presswork.plans.demo import LengthSentiment, LengthTopic

class FailsOnce(LengthSentiment):
    def __call__(self, items=None):
        replies = super().__call__(items)
        if items is not None and TaskContext.get().attemptNumber() == 0:
            raise SystemExit("lost")  # not a failed request: the task ends
        return replies

class Nothing:
    def write(self, enriched, batch_id):
        pass

logging.basicConfig(level=logging.INFO, stream=sys.stdout)
spark = SparkSession.builder.master("local[2, 3]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
lines = [('{{"url_hash": "k%d", "title": "t%d"}}' % (n, n),) for n in range(20)]
frame = parse_articles(spark.createDataFrame(lines, "value string"))
batch_writer([Nothing()], FailsOnce(), LengthTopic())(frame, 0)
"""
    )
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=180)
    assert "batch 0: 20 articles scored, 0 without sentiment, 0 without category" in done.stdout


def test_files_are_admitted_by_number_or_size(spark, feed, tmp_path):
    for key in "abcde":
        feed.add(article(url_hash=key))
    size = os.path.getsize(next(feed.incoming.iterdir()))
    for n, (bound, batches) in enumerate(
        [({"max_files_per_trigger": 2}, 3), ({"max_bytes_per_trigger": size * 3}, 2), ({}, 1)]
    ):
        sink = Collected()
        stream = read_articles_files(spark, str(feed.incoming), **bound)
        writer = parse_articles(stream).writeStream.option("checkpointLocation", str(tmp_path / f"c{n}"))
        write = batch_writer([sink], LengthSentiment(), LengthTopic())
        writer.foreachBatch(write).trigger(**NOW).start().awaitTermination()
        assert len(sink.batches) == batches
        assert sorted(sum(sink.batches.values(), [])) == list("abcde")


def test_bounds_are_checked(spark):
    for bounds in ((1, 1), (0, None), (None, 0)):
        with pytest.raises(ValueError):
            read_wire_files(spark.readStream.format("text"), "/nowhere", *bounds)


@pytest.mark.parametrize(
    "name, batch",
    [
        *[("stream_bounded", batch) for batch in range(4)],
        ("stream_empty_batch", 0),
        ("stream_empty_batch", 2),
        ("stream_replayed_batch", 0),
        ("stream_replayed_batch", 1),
    ],
)
def test_a_failed_stream_has_no_result(spark, monkeypatch, tmp_path, name, batch):
    """The sink takes every batch but one; those it has are not the query's rows."""

    class Full(ParquetSink):
        def write(self, enriched, batch_id):
            if batch_id == batch:
                raise OSError("no space left")
            super().write(enriched, batch_id)

    rows = [(n, f"text {n} " * 9, f"source{n % 3}") for n in range(60)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, source string")
    documents.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "ParquetSink", Full)
    with pytest.raises(StreamingQueryException, match=rf"batch {batch}: sink 0 \(Full\)"):
        queries.QUERIES[name](spark, str(tmp_path)).collect()
