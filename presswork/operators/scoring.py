"""The scoring operator: rows in chunks through a scorer, one answer per row.

Only the key and the scoring text go to Python, as Arrow batches, which Spark bounds in
bytes as well as in rows (``spark.sql.execution.arrow.maxBytesPerBatch``); the article itself stays in the JVM and is lined up with the answers by
position. No shuffle and no join is needed to bring the answers back.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial
from itertools import chain, compress
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from presswork.operators.scorers import Scorer, ScorerFactory
from presswork.schemas import IDENTITY, answer_schema

# The error texts, answer keys and chunk size consumers rely on.
EMPTY_TEXT = "empty_text_for_inference"
CHUNK_SIZE = 25


@dataclass(frozen=True)
class ScoreSpec:
    """What a scorer answers with and how its answer columns are called."""

    prefix: str
    label_key: str
    score_key: str
    missing_error: str


SENTIMENT = ScoreSpec(
    "sentiment", "sentiment_label", "sentiment_score", "missing sentiment result"
)
CATEGORY = ScoreSpec(
    "category", "topic_label", "topic_score", "missing classification result"
)


class Answer(NamedTuple):
    label: str | None
    score: float | None
    inferred_at: str
    error: str | None


def utc_now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"


def score(
    df: DataFrame,
    spec: ScoreSpec,
    scorer: ScorerFactory,
    *,
    chunk_size: int = CHUNK_SIZE,
    chunk_bytes: int | None = None,
    max_in_flight: int = 1,
    clock: Callable[[], str] = utc_now,
    tally: Tally | None = None,
) -> DataFrame:
    """``df`` plus ``<prefix>_label, _score, _inferred_at, _error``, row for row.

    ``df`` needs ``url_hash`` and ``text_for_inference``. ``scorer`` is called once
    per partition, or once for each thread that asks there, and returns the scorer for it
    (a connection or a loaded model).
    Requests hold up to ``chunk_size`` consecutive rows of a partition, and at most
    ``max_in_flight`` of them are open at a time per task, so the load on a remote
    scorer is bounded by that times the running tasks. ``chunk_bytes`` bounds the UTF-8
    bytes of a request's texts too: a request ends before the text that would exceed it, and a text
    that is larger alone is a request of its own. ``tally`` counts scorers and requests.
    """
    return score_all(
        df,
        {spec: scorer},
        chunk_size=chunk_size,
        chunk_bytes=chunk_bytes,
        max_in_flight=max_in_flight,
        clock=clock,
        tally=tally,
    )


class Tally:
    """Scorers made and requests sent, over all tasks; known when an action has ended. A
    task that is repeated counts again: it does make and send again."""

    def __init__(self, spark: SparkSession) -> None:
        self.scorers = spark.sparkContext.accumulator(0)
        self.requests = spark.sparkContext.accumulator(0)


def score_all(
    df: DataFrame,
    scorers: Mapping[ScoreSpec, ScorerFactory],
    *,
    chunk_size: int = CHUNK_SIZE,
    chunk_bytes: int | None = None,
    max_in_flight: int = 1,
    clock: Callable[[], str] = utc_now,
    tally: Tally | None = None,
) -> DataFrame:
    """``score`` for several scorers: the text goes to Python once, and a task waits for
    the scorers at the same time instead of one after the other. ``max_in_flight``
    counts for each of them."""
    if chunk_size < 1 or max_in_flight < 1 or (chunk_bytes is not None and chunk_bytes < 1):
        raise ValueError("chunk_size, chunk_bytes and max_in_flight must be at least 1")
    answer = _answer_udf(dict(scorers), chunk_size, chunk_bytes, max_in_flight, clock, tally)
    scored = df.withColumn("_answer", answer("url_hash", "text_for_inference"))
    return scored.select(*df.columns, "_answer.*")


def score_table(df: DataFrame, spec: ScoreSpec, scorer: ScorerFactory, **options) -> DataFrame:
    """The answers on their own: the row's identity, as far as ``df`` has it, and the four
    answer columns."""
    identity = [name for name in IDENTITY if name in df.columns]
    asked = df.select(*identity, "text_for_inference")
    return score(asked, spec, scorer, **options).drop("text_for_inference")


def _answer_udf(scorers, chunk_size, chunk_bytes, max_in_flight, clock, tally):
    schema = StructType([field for spec in scorers for field in answer_schema(spec.prefix)])
    names = schema.fieldNames()
    threads = max_in_flight if max_in_flight > 1 or len(scorers) > 1 else 0

    @F.arrow_udf(schema)
    def answer(
        batches: Iterator[tuple[pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        with ExitStack() as stack:
            asking = []
            for spec, factory in scorers.items():
                factory = factory if tally is None else _counted(factory, tally)
                scorer = _PerThread(factory) if threads else factory()
                ask = partial(answer_chunk, scorer=scorer, spec=spec, clock=clock)
                if threads:
                    pool = ThreadPoolExecutor(threads)
                    # Requests nobody waits for any more, as under a limit, are dropped.
                    stack.callback(pool.shutdown, wait=False, cancel_futures=True)
                asking.append(partial(pool.map if threads else map, ask))
            for chunks in _chunks(batches, chunk_size, chunk_bytes):
                # Every pool has its requests before the first answer is waited for.
                pending = [ask_all(chunks) for ask_all in asking]
                columns = [column for answers in pending for column in _to_arrow(answers)]
                yield pa.StructArray.from_arrays(columns, names=names)

    # An answer may differ from one call to the next. Saying so also keeps Catalyst
    # from copying the call into a filter on its result, which would ask twice.
    return answer.asNondeterministic()


class _PerThread:
    """A scorer for each thread that asks, so none has to bear two callers at once."""

    def __init__(self, factory: ScorerFactory) -> None:
        self._own, self._factory = threading.local(), factory

    def get(self) -> Scorer:
        if not hasattr(self._own, "scorer"):
            self._own.scorer = self._factory()
        return self._own.scorer


def _counted(factory: ScorerFactory, tally: Tally) -> ScorerFactory:
    scorers, requests = tally.scorers, tally.requests

    def make() -> Scorer:
        scorer = factory()
        scorers.add(1)

        def ask(items):
            requests.add(1)
            return scorer(items)

        ask.positional = getattr(scorer, "positional", False)
        return ask

    return make


def _chunks(batches, size: int, size_bytes: int | None) -> Iterator[list[list[tuple[str, str]]]]:
    """Lists of full chunks, in row order. Chunks run on across Arrow batches: only the
    last chunk of a partition may be short."""
    rows: list[tuple[str, str]] = []
    held = 0
    for ids, texts in batches:
        full = []
        for row in zip(ids.to_pylist(), texts.to_pylist()):
            extra = _sent_bytes(row[1]) if size_bytes is not None else 0
            if len(rows) == size or (held and extra and held + extra > size_bytes):
                full.append(rows)
                rows, held = [], 0
            rows.append(row)
            held += extra
        if len(rows) == size:
            full.append(rows)
            rows, held = [], 0
        if full:
            yield full
    if rows:
        yield [rows]


def _is_sent(text: str | None) -> bool:
    return bool(text and text.strip())


def _sent_bytes(text: str | None) -> int:
    """Blank texts stay in their chunk, without a byte."""
    return len(text.encode()) if _is_sent(text) else 0


def answer_chunk(
    rows: list[tuple[str, str]], scorer: Scorer, spec: ScoreSpec, clock: Callable[[], str]
) -> list[Answer]:
    """One answer per row of a chunk, whatever the scorer does.

    Blank texts are not sent. If the request fails, every row sent gets the message.
    """
    sent = [_is_sent(text) for _, text in rows]
    asked = list(compress(rows, sent))
    answers = iter(_ask(asked, scorer, spec, clock) if asked else [])
    return [
        next(answers) if was_sent else Answer(None, None, clock(), EMPTY_TEXT)
        for was_sent in sent
    ]


def _ask(asked, scorer, spec, clock) -> list[Answer]:
    # A scorer that cannot be made fails the task, whichever thread it is for.
    scorer = scorer.get() if isinstance(scorer, _PerThread) else scorer
    at = clock()
    try:
        replies = scorer([{"url_hash": key, "text": text} for key, text in asked])
        if getattr(scorer, "positional", False):
            found = list(replies)
            if len(found) != len(asked):
                raise ValueError(f"{len(found)} answers to {len(asked)} texts")
        else:
            usable = (reply for reply in replies if isinstance(reply, dict))
            latest = {reply.get("url_hash"): reply for reply in usable}
            latest.pop(None, None)
            found = [latest.get(key) for key, _ in asked]
        return [_read(reply, spec, at) for reply in found]
    except Exception as failure:  # a failed request is a result, not a failed task
        at = clock()
        return [Answer(None, None, at, str(failure)) for _ in asked]


def _read(reply: dict | None, spec: ScoreSpec, at: str) -> Answer:
    if not reply:
        return Answer(None, None, at, spec.missing_error)
    label, value = reply.get(spec.label_key), reply.get(spec.score_key)
    try:
        number = None if value is None else float(value)
    except (TypeError, ValueError) as failure:
        return Answer(None, None, at, str(failure))
    return Answer(None if label is None else str(label), number, at, None)


def _to_arrow(chunks: Iterable[list[Answer]]) -> list[pa.Array]:
    types = [pa.string(), pa.float64(), pa.string(), pa.string()]
    fields = zip(*chain.from_iterable(chunks))
    return [pa.array(values, kind) for values, kind in zip(fields, types)]
