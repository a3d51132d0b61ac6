"""The registered queries: each operator over the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.functions.text import MAX_CHARS, is_blank, normalize_text, scoring_text
from presswork.functions.wire import parse_articles, parse_fields
from presswork.operators import (
    CATEGORY,
    SENTIMENT,
    ScorerFactory,
    Tally,
    batch_stats,
    count_joined,
    dedup_articles,
    error_rows,
    join_results,
    keep_scorable,
    match_scores,
    prepare_articles,
    score,
    score_all,
    score_table,
    select_base,
)
from presswork.options import StreamOptions
from presswork.plans import demo
from presswork.plans.enrich import enrich
from presswork.schemas import ARTICLE_FIELDS, BASE_FIELDS, CONSOLE_FIELDS, IDENTITY
from presswork.sinks import ParquetSink, Sink, kafka_payload, utc_date
from presswork.sources import read_wire_files
from presswork.storage import as_table, new_folder, remove, stored_bytes
from presswork.streaming import batch_writer, start

_FIRST = ["published_at", "doc_id"]
_ANSWERS = [
    f"{prefix}_{part}"
    for prefix in ("sentiment", "category")
    for part in ("label", "score", "inferred_at", "error")
]
_DIGESTED = ("text", "text_prepped", "text_for_inference")
# Texts whose length is a multiple of these get no answer from the demo scorers.
_GAP = 11
_TOPIC_GAP = 13
# Requests with a text whose length is a multiple of this fail.
_REFUSED = 7
# So small that the address many articles share is split on few documents too.
_KEY_ROWS = 16
# Partitions of the queries on requests, and the two budgets of a request.
_PARTS = 8
_REQUEST_ROWS = 10
_REQUEST_BYTES = 16_384
# Micro-batches of the bounded streams, the files of each at least, and the bytes of the
# documents that a file stands for: a file is written by one task.
_BOUNDED = 4
_BATCH_FILES = 2
_FILE_BYTES = 16 << 20


def _readable(*names: str) -> list[str | Column]:
    """Long texts as MD5 and timestamps as seconds, for comparing and for size."""
    shown: list[str | Column] = []
    for name in names:
        if name in _DIGESTED:
            shown.append(F.md5(name).alias(f"{name}_md5"))
        elif name.endswith("ed_at") and name not in _ANSWERS:
            shown.append(F.unix_seconds(name).alias(name))
        else:
            shown.append(name)
    return shown


def _size(text: str) -> Column:
    return F.length(text).cast("bigint").alias("n")


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = demo.read_articles(spark, sf_dir)
    return prepare_articles(articles, order_by=_FIRST, keep=["doc_id"])


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What scoring needs of the base, as a table for the plans that read it repeatedly."""
    return as_table(_base(spark, sf_dir).select("doc_id", *IDENTITY, "text_for_inference"))


def _enriched(articles: DataFrame, gaps: bool = False) -> DataFrame:
    return enrich(
        articles,
        demo.LengthSentiment(_GAP if gaps else None),
        demo.LengthTopic(_TOPIC_GAP if gaps else None),
        order_by=_FIRST,
        keep=["doc_id"],
        clock=demo.fixed_clock,
    )


def _enriched_documents(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    return _enriched(demo.read_articles(spark, sf_dir), gaps)


def parse_wire_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    wire = demo.document_wire(demo.read_documents(spark, sf_dir))
    return parse_fields(wire, keep=["doc_id"]).select("doc_id", *_readable(*ARTICLE_FIELDS))


def normalize_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = demo.read_documents(spark, sf_dir).select(
        "doc_id", normalize_text("text").alias("text_prepped")
    )
    return texts.select("doc_id", *_readable("text_prepped"), _size("text_prepped"))


def choose_scoring_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = demo.read_articles(spark, sf_dir).select(
        "doc_id", scoring_text(body=normalize_text("text"), max_chars=MAX_CHARS).alias("text_for_inference")
    )
    return texts.select("doc_id", *_readable("text_for_inference"), _size("text_for_inference"))


def project_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = demo.read_articles(spark, sf_dir)
    parsed = articles.withColumn("text_prepped", normalize_text("text"))
    return select_base(parsed, keep=["doc_id"]).select("doc_id", *_readable(*BASE_FIELDS))


def filter_scorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = demo.read_articles(spark, sf_dir)
    parsed = articles.withColumn("text_prepped", normalize_text("text"))
    return keep_scorable(select_base(parsed, keep=["doc_id"])).select("doc_id", *IDENTITY)


def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles = demo.read_articles(spark, sf_dir).filter(F.col("url_hash").isNotNull())
    return dedup_articles(articles).select(*IDENTITY)


def dedup_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _base(spark, sf_dir).select("doc_id", *_readable(*BASE_FIELDS))


def score_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(
        _base(spark, sf_dir), SENTIMENT, demo.LengthSentiment(_GAP), clock=demo.fixed_clock
    )
    return scored.select("doc_id", "url_hash", *_ANSWERS[:4])


def score_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(
        _base(spark, sf_dir), CATEGORY, demo.LengthTopic(_TOPIC_GAP), clock=demo.fixed_clock
    )
    return scored.select("doc_id", "url_hash", *_ANSWERS[4:])


def match_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replies of one run as a table, several per ``url_hash`` and none to some
    articles; the last one counts."""
    base = _asked(spark, sf_dir)
    scorers = {SENTIMENT: demo.LengthSentiment(_GAP), CATEGORY: demo.LengthTopic()}
    answered = score_all(base, scorers).filter(F.col("sentiment_error").isNull())
    topics = {"category_label": "topic_label", "category_score": "topic_score"}
    replies = answered.withColumnsRenamed(topics)
    matched = match_scores(
        base, replies, SENTIMENT, CATEGORY, order_by=["doc_id"], target_rows=_KEY_ROWS
    )
    return matched.drop("fingerprint", "text_for_inference")


def route_empty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring operator's verdict next to that of the column expression."""
    scored = score(
        _base(spark, sf_dir), SENTIMENT, demo.LengthSentiment(), clock=demo.fixed_clock
    )
    return scored.select(
        "doc_id",
        "url_hash",
        is_blank("text_for_inference").alias("blank"),
        "sentiment_label",
        "sentiment_error",
    )


def count_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = error_rows(_enriched_documents(spark, sf_dir, gaps=True))
    return failed.groupBy("sentiment_error", "category_error").agg(F.count("*").alias("rows"))


def join_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both result tables brought back to the articles on the row's identity."""
    base = _asked(spark, sf_dir)
    asked = base.drop("doc_id")
    tables = [
        score(asked, spec, scorer, clock=demo.fixed_clock).drop("text_for_inference")
        for spec, scorer in (
            (SENTIMENT, demo.LengthSentiment(_GAP)),
            (CATEGORY, demo.LengthTopic(_TOPIC_GAP)),
        )
    ]
    joined = join_results(base, *tables)
    return joined.select("doc_id", *IDENTITY, *_ANSWERS)


def join_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _asked(spark, sf_dir)
    return count_joined(
        base, {"sentiment": score_table(base, SENTIMENT, demo.LengthSentiment(_GAP))}
    )


def join_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _asked(spark, sf_dir)
    return count_joined(
        base,
        {
            "sentiment": score_table(base, SENTIMENT, demo.LengthSentiment(_GAP)),
            "category": score_table(base, CATEGORY, demo.LengthTopic()),
        },
    )


def count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_stats(_enriched_documents(spark, sf_dir, gaps=True))


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kafka_payload(_enriched_documents(spark, sf_dir))


def parquet_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink brings the rows of a date together behind the scoring, so it is handed a
    table: a stage that is lost there asks no scorer again."""
    folder = new_folder(spark, "roundtrip")
    scored = new_folder(spark, "scored")
    sink = ParquetSink(folder, ingest_date=utc_date("published_at"))
    sink.write(as_table(_enriched_documents(spark, sf_dir), scored), 0)
    remove(spark, scored)
    written = spark.read.parquet(folder)
    return written.select(
        "doc_id",
        *_readable(*BASE_FIELDS),
        *_ANSWERS,
        F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"),
    )


def console_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched_documents(spark, sf_dir, gaps=True).select(*CONSOLE_FIELDS)


def enrich_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From wire bytes to enriched articles."""
    wire = demo.document_wire(demo.read_documents(spark, sf_dir))
    enriched = _enriched(parse_articles(wire, keep=["doc_id"]))
    return enriched.select("doc_id", *_readable(*BASE_FIELDS), *_ANSWERS)


def failed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text in a request of its own; some requests fail."""
    refusing = demo.LengthSentiment(_GAP, _REFUSED)
    asked = _base(spark, sf_dir)
    scored = score(asked, SENTIMENT, refusing, chunk_size=1, clock=demo.fixed_clock)
    return scored.select("doc_id", "url_hash", *_ANSWERS[:4])


def dedup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole rows without an order; shown are the columns that follow from the key."""
    copies = dedup_articles(keep_scorable(select_base(_parsed(spark, sf_dir))))
    return copies.select(*IDENTITY, *_readable("text", "text_prepped"), "url")


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demo.read_articles(spark, sf_dir).withColumn("text_prepped", normalize_text("text"))


def _batch_files(spark: SparkSession, sf_dir: str) -> int:
    """The files of a micro-batch of a bounded stream: so many that the tasks which write and
    read them grow in number with the input."""
    held = stored_bytes(spark, f"{sf_dir}/documents.parquet")
    return max(_BATCH_FILES, held // (_BOUNDED * _FILE_BYTES))


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through Structured Streaming: wire records in files, a few files a micro-batch, the
    micro-batch function, and the Parquet sink, read back. The records of one text are in one
    batch, so that batch's deduplication is that of the whole table."""
    folder = new_folder(spark, "stream")
    documents = demo.read_documents(spark, sf_dir)
    share = F.coalesce(F.crc32(F.md5("text").cast("binary")), F.lit(0)) % _BOUNDED
    files = _batch_files(spark, sf_dir)
    for part in range(_BOUNDED):
        records = demo.document_wire(documents.filter(share == part))
        records = records.repartition(files).write.mode("append")
        records.option("compression", "zstd").parquet(f"{folder}/wire")
    reader = spark.readStream.format("parquet").schema("doc_id long, value binary")
    wire = read_wire_files(reader, f"{folder}/wire", files)
    write_batch = batch_writer(
        [ParquetSink(f"{folder}/enriched", per_batch=True)],
        demo.LengthSentiment(_GAP),
        demo.LengthTopic(_TOPIC_GAP),
        reuse="sink",
        order_by=_FIRST,
        keep=["doc_id"],
        clock=demo.fixed_clock,
    )
    articles = parse_articles(wire, keep=["doc_id"])
    stream = articles.writeStream.option("checkpointLocation", f"{folder}/checkpoint")
    stream.trigger(availableNow=True).foreachBatch(write_batch).start().awaitTermination()
    for used in ("wire", "checkpoint"):
        remove(spark, f"{folder}/{used}")
    written = spark.read.parquet(f"{folder}/enriched")
    return written.select("doc_id", *_readable(*BASE_FIELDS), *_ANSWERS)


class _Broken:
    """A sink that takes nothing."""

    def write(self, enriched: DataFrame, batch_id: int) -> None:
        raise OSError("out of order")


def _stream_in_two(
    spark: SparkSession,
    sf_dir: str,
    before: Sequence[Sink] = (),
    ready: Callable[[], bool] | None = None,
    **options,
) -> DataFrame:
    """What a stream makes of the documents with even ``doc_id`` in its first micro-batch
    and the others in its second. It is started three times on one checkpoint; the third
    start finds nothing to do."""
    folder = new_folder(spark, "stream")
    stated = StreamOptions(
        checkpoint_location=f"{folder}/checkpoint",
        show_console=False,
        survivor_order=("published_at", "source", "author", "title", "summary"),
        **options,
    )
    sink = ParquetSink(f"{folder}/enriched", per_batch=True)
    records = demo.document_wire(demo.read_documents(spark, sf_dir))
    for rest in (0, 1, None):
        if rest is not None:
            part = records.filter(F.col("doc_id") % 2 == rest).select("value")
            part = part.write.mode("append").option("compression", "zstd")
            part.parquet(f"{folder}/wire")
        wire = spark.readStream.schema("value binary").parquet(f"{folder}/wire")
        start(
            spark,
            stated,
            sentiment=demo.LengthSentiment(_GAP),
            category=demo.LengthTopic(_TOPIC_GAP),
            ready=ready,
            sinks=[*before, sink],
            wire=wire,
            trigger={"availableNow": True},
        ).awaitTermination()
    for used in ("wire", "checkpoint"):
        remove(spark, f"{folder}/{used}")
    written = spark.read.parquet(f"{folder}/enriched")
    timeless = [name for name in _ANSWERS if not name.endswith("_at")]
    return written.select("batch_id", *_readable(*BASE_FIELDS), *timeless)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies are dropped within a batch and kept in the next; nothing is replayed."""
    return _stream_in_two(spark, sf_dir, reuse="sink")


def stream_sink_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sink behind one that fails gets every batch."""
    return _stream_in_two(spark, sf_dir, before=[_Broken()], on_error="skip")


def stream_skipped_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorer is not ready for the first batch, which is given up."""
    asked = iter([False])
    gate = lambda: next(asked, True)
    return _stream_in_two(spark, sf_dir, ready=gate, on_not_ready="skip", reuse="sink")


def _in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base in partitions, and an order in them, that the rows state themselves."""
    base = _base(spark, sf_dir).select("doc_id", "url_hash", "text_for_inference")
    part = F.pmod("doc_id", F.lit(_PARTS)).cast("int")
    return base.repartitionById(_PARTS, part).sortWithinPartitions("doc_id")


def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests bounded by rows and bytes, with one stamp each."""
    scored = score(
        _in_parts(spark, sf_dir),
        SENTIMENT,
        demo.RequestLog,
        chunk_size=_REQUEST_ROWS,
        chunk_bytes=_REQUEST_BYTES,
        clock=demo.CountingClock(),
    )
    return scored.select("doc_id", *_ANSWERS[:4])


def score_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorers made and requests sent by a run, and the rows it answered."""
    tally = Tally(spark)
    answered = score(
        _in_parts(spark, sf_dir),
        SENTIMENT,
        demo.RequestLog,
        chunk_size=_REQUEST_ROWS,
        chunk_bytes=_REQUEST_BYTES,
        tally=tally,
    )
    rows = as_table(answered.select("doc_id", "sentiment_label"))
    return rows.agg(
        F.lit(tally.scorers.value).cast("bigint").alias("scorers"),
        F.lit(tally.requests.value).cast("bigint").alias("requests"),
        F.count("sentiment_label").alias("answers"),
    )


class _Stream:
    """Wire records of the documents in a folder, and starts of one stream on them."""

    def __init__(self, spark: SparkSession, sf_dir: str, parts: int) -> None:
        self.spark, self.parts, self.folder = spark, parts, new_folder(spark, "stream")
        self.records = demo.document_wire(demo.read_documents(spark, sf_dir))
        self.options = {
            "checkpoint_location": f"{self.folder}/checkpoint",
            "show_console": False,
            "survivor_order": ("published_at", "source", "author", "title", "summary"),
        }

    def add(self, rest: int, value: Column | None = None, files: int | None = None) -> None:
        """The documents with this remainder arrive, with another ``value`` if one is given."""
        part = self.records.filter(F.col("doc_id") % self.parts == rest)
        part = part.select("value" if value is None else value.alias("value"))
        part = part.repartition(files) if files else part
        part = part.write.mode("append").option("compression", "zstd")
        part.parquet(f"{self.folder}/wire")

    def run(
        self,
        sinks: Sequence[Sink],
        sentiment: ScorerFactory | None = None,
        max_files: int | None = None,
        **options,
    ) -> None:
        """Until all that is there is done. What fails is raised: what the sinks have then is
        no result."""
        reader = self.spark.readStream.format("parquet").schema("value binary")
        start(
            self.spark,
            StreamOptions(**self.options, **options),
            sentiment=sentiment or demo.LengthSentiment(_GAP),
            category=demo.LengthTopic(_TOPIC_GAP),
            sinks=sinks,
            wire=read_wire_files(reader, f"{self.folder}/wire", max_files),
            ready=lambda: True,
            trigger={"availableNow": True},
        ).awaitTermination()

    def fails(self, *arguments, **options) -> bool:
        """A run that may fail, to be followed by another. Says whether it did."""
        try:
            self.run(*arguments, **options)
        except StreamingQueryException:
            return True
        return False

    def done(self) -> None:
        """Only what was delivered stays. For streams whose last run did not fail."""
        for used in ("wire", "checkpoint"):
            remove(self.spark, f"{self.folder}/{used}")


def _shown(written: DataFrame, *more: str | Column) -> DataFrame:
    timeless = [name for name in _ANSWERS if not name.endswith("_at")]
    return written.select(*more, *_readable(*BASE_FIELDS), *timeless)


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records are there from the start; admission deals them into micro-batches of
    so many files, the oldest first."""
    stream, files = _Stream(spark, sf_dir, _BOUNDED), _batch_files(spark, sf_dir)
    for rest in range(_BOUNDED):
        stream.add(rest, files=files)
    sink = ParquetSink(f"{stream.folder}/enriched", per_batch=True)
    stream.run([sink], max_files=files)
    stream.done()
    return _shown(spark.read.parquet(sink.output_dir), "batch_id")


class _Late:
    """Its first write of each batch fails; then it hands the rows on."""

    name = "late"

    def __init__(self, sink: Sink) -> None:
        self._sink, self._asked = sink, set()

    def write(self, enriched: DataFrame, batch_id: int) -> None:
        if batch_id not in self._asked:
            self._asked.add(batch_id)
            raise OSError("not yet")
        self._sink.write(enriched, batch_id)


def stream_delivered_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sinks that append. The second fails once in each batch, and the stream is started
    again: the first has each row once all the same."""
    stream = _Stream(spark, sf_dir, 2)
    steady, other = (ParquetSink(f"{stream.folder}/sink{n}") for n in range(2))
    sinks = [steady, _Late(other)]
    for rest in range(2):
        stream.add(rest)
        while stream.fails(sinks):
            pass
    stream.done()
    taken = [
        _shown(spark.read.parquet(sink.output_dir), F.lit(n).alias("sink"))
        for n, sink in enumerate((steady, other))
    ]
    return taken[0].union(taken[1])


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the second of three batches cannot be parsed. It is committed, and no
    sink has it."""
    stream = _Stream(spark, sf_dir, 3)
    sink = ParquetSink(f"{stream.folder}/enriched", per_batch=True)
    for rest in range(3):
        stream.add(rest, F.lit(b"no record") if rest == 1 else None)
        stream.run([sink])
    commits = spark.read.text(f"{stream.folder}/checkpoint/commits")
    batch = F.regexp_extract(F.input_file_name(), r"(\d+)$", 1).cast("int").alias("batch_id")
    committed = as_table(commits.select(batch).distinct())
    stream.done()
    written = spark.read.parquet(sink.output_dir).groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.count("sentiment_error").alias("sentiment_errors")
    )
    return committed.join(written, "batch_id", "left").select(
        "batch_id", *(F.coalesce(n, F.lit(0)).alias(n) for n in ("rows", "sentiment_errors"))
    )


def stream_replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second batch fails while it is scored; the next start replays it."""
    stream = _Stream(spark, sf_dir, 2)
    sink = ParquetSink(f"{stream.folder}/enriched")
    stream.add(0)
    stream.run([sink])
    stream.add(1)
    if not stream.fails([sink], demo.Unavailable()):
        raise RuntimeError("scored without a scorer")
    stream.run([sink])
    stream.done()
    return _shown(spark.read.parquet(sink.output_dir))


QUERIES = {
    "parse_wire_json": parse_wire_json,
    "normalize_text": normalize_body,
    "scoring_text": choose_scoring_text,
    "prepare_articles": project_base,
    "filter_scorable": filter_scorable,
    "dedup_keys": dedup_keys,
    "dedup_survivor": dedup_survivor,
    "score_sentiment": score_sentiment,
    "score_category": score_category,
    "match_scores": match_replies,
    "route_empty_text": route_empty_text,
    "error_rows": count_errors,
    "join_identity": join_identity,
    "join_sentiment": join_sentiment,
    "join_both": join_both,
    "batch_stats": count_batch,
    "kafka_payload": kafka_records,
    "parquet_sink_roundtrip": parquet_sink_roundtrip,
    "console_projection": console_projection,
    "enrich_articles": enrich_articles,
    "failed_requests": failed_requests,
    "dedup_default": dedup_default,
    "stream_enrich": stream_enrich,
    "stream_batches": stream_batches,
    "stream_sink_failure": stream_sink_failure,
    "stream_skipped_batch": stream_skipped_batch,
    "stream_bounded": stream_bounded,
    "stream_delivered_once": stream_delivered_once,
    "stream_empty_batch": stream_empty_batch,
    "stream_replayed_batch": stream_replayed_batch,
    "score_requests": score_requests,
    "score_tally": score_tally,
}
