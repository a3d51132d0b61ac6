"""The micro-batch function: gate, enrich, count, write to every sink."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession

from presswork.operators.articles import filter_parsed
from presswork.operators.scorers import ScorerFactory
from presswork.operators.stats import batch_stats, stat_columns
from presswork.plans.enrich import enrich
from presswork.sinks import Sink
from presswork.storage import as_table, exists, new_folder, remove
from presswork.streaming.ledger import KEPT_BATCHES, Ledger, sink_keys

logger = logging.getLogger(__name__)


class ScorerNotReady(RuntimeError):
    """The scorer did not report ready when a batch was due."""


class SinkFailure(RuntimeError):
    """One or more sinks failed on a batch that all of them were offered."""


class Receiver(NamedTuple):
    """A sink, what messages call it, and what the ledger does."""

    sink: Sink
    name: str
    key: str


def batch_writer(
    sinks: Sequence[Sink],
    sentiment: ScorerFactory,
    category: ScorerFactory,
    *,
    ready: Callable[[], bool] = lambda: True,
    on_not_ready: str = "fail",
    wait_limit_s: float = 300,
    wait_interval_s: float = 5,
    on_error: str = "fail",
    reuse: str = "table",
    work_dir: str | None = None,
    ledger: Ledger | None = None,
    **enriching,
) -> Callable[[DataFrame, int], None]:
    """The function to give to ``foreachBatch`` over parsed articles.

    ``on_error`` and ``on_not_ready``: ``"fail"`` raises, so that the batch's offsets
    are not committed and a restart repeats it; ``"skip"`` logs and goes on, giving the
    batch (or the failed sink's share of it) up. Either way every sink is tried. A
    readiness test that raises says no. ``on_not_ready="wait"`` asks it again every
    ``wait_interval_s`` seconds and raises after ``wait_limit_s``. A batch without an
    article to score is neither scored nor offered to the sinks.

    ``reuse`` says how the scored rows are kept for the counts and the sinks, which
    must all see the same answers:

    * ``"table"`` writes them once, to a table under ``work_dir`` (by default in the
      cluster's shared folder), counting on the way, and removes it when the batch is done.
      Nothing is scored again if an executor is lost.
    * ``"sink"`` does the same without the extra copy: the first sink, a ``ParquetSink``
      with ``per_batch``, is written first and read by the others. If it fails, the others
      get a table after all, for which the batch is scored again.
    * ``"persist"`` caches them: less to write, but lost blocks are scored again.
    * ``"none"`` keeps nothing: for one sink alone that reads its rows once, such as
      those for Parquet and Kafka. The counts, which are logged only, are taken while it
      writes; where the sink shuffles (dates that vary), a repeated stage counts twice.

    With a ``ledger`` a replay offers a batch only to the sinks that have not taken it yet, and
    where the table or the first sink's batch is there from before, these get the same
    answers from it. Without one a replay offers it to all sinks again.

    ``enriching`` goes to ``enrich``.
    """
    _check("on_not_ready", on_not_ready, ("fail", "skip", "wait"))
    _check("on_error", on_error, ("fail", "skip"))
    _check("reuse", reuse, ("table", "sink", "persist", "none"))
    if reuse == "sink" and not (sinks and getattr(sinks[0], "per_batch", False)):
        raise ValueError("reuse='sink' needs a ParquetSink with per_batch as first sink")
    if reuse == "none" and [getattr(s, "single_pass", False) for s in sinks] != [True]:
        raise ValueError("reuse='none' needs exactly one sink, and one with single_pass")

    receivers = [
        Receiver(sink, f"sink {position} ({type(sink).__name__})", key)
        for position, (sink, key) in enumerate(zip(sinks, sink_keys(sinks), strict=True))
    ]

    def table_folder(spark: SparkSession, batch_id: int) -> str:
        nonlocal work_dir
        if work_dir is None:
            work_dir = new_folder(spark, "batch")
        return f"{work_dir.rstrip('/')}/{batch_id}"

    def process(batch: DataFrame, batch_id: int) -> None:
        if filter_parsed(batch).isEmpty():
            _report(batch_id, 0, 0, 0)
            return
        log = _BatchLog(ledger, batch, batch_id)
        waiting = [r for r in receivers if r.key not in log.entered]
        if receivers and not waiting:
            logger.info("batch %s: every sink has it already", batch_id)
            return
        enriched = enrich(batch, sentiment, category, **enriching)
        if reuse == "persist":
            rows = enriched.persist()
            try:
                deliver(rows, batch_id, waiting, log)
            finally:
                rows.unpersist()
        elif reuse == "none":
            counts = Observation()
            sinks[0].write(enriched.observe(counts, *stat_columns()), batch_id)
            log.enter(receivers[0].key)
            _report(batch_id, **counts.get)
        elif reuse == "sink":
            first, *others = receivers
            failed = _write_all([first], enriched, batch_id, log) if first in waiting else {}
            others = [r for r in others if r in waiting]
            if failed:
                by_table(enriched, batch_id, others, log, failed)
            else:
                deliver(sinks[0].written(enriched, batch_id), batch_id, others, log)
        else:
            by_table(enriched, batch_id, waiting, log)

    def by_table(
        enriched: DataFrame,
        batch_id: int,
        waiting: Sequence[Receiver],
        log: _BatchLog,
        failed: dict[str, Exception] | None = None,
    ) -> None:
        spark = enriched.sparkSession
        folder = table_folder(spark, batch_id)
        kept = False
        try:
            if _SCORED in log.entered and exists(spark, f"{folder}/_SUCCESS"):
                rows = spark.read.schema(enriched.schema).parquet(folder)
                counted = None
            else:
                # The answers are made in the stage that writes, which no stage repeats once
                # a task of it is done: so they are counted there.
                counts = Observation()
                rows = as_table(enriched.observe(counts, *stat_columns()), folder)
                log.enter(_SCORED)
                counted = counts.get
            try:
                deliver(rows, batch_id, waiting, log, failed, counted)
            except Exception:
                kept = ledger is not None
                raise
        finally:
            if not kept:
                remove(spark, folder)

    def deliver(
        rows: DataFrame,
        batch_id: int,
        waiting: Sequence[Receiver],
        log: _BatchLog,
        failed: dict[str, Exception] | None = None,
        counted: dict[str, int] | None = None,
    ) -> None:
        _report(batch_id, **(counted or batch_stats(rows).first().asDict()))
        failures = {**(failed or {}), **_write_all(waiting, rows, batch_id, log)}
        if failures and on_error == "fail":
            names = ", ".join(failures)
            raise SinkFailure(f"batch {batch_id}: {names}") from next(iter(failures.values()))

    def is_ready(batch_id: int) -> bool:
        until = time.monotonic() + (wait_limit_s if on_not_ready == "wait" else 0)
        while True:
            try:
                if ready():
                    return True
            except Exception:
                logger.warning("batch %s: readiness test failed", batch_id, exc_info=True)
            if time.monotonic() + wait_interval_s > until:
                return False
            time.sleep(wait_interval_s)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if not is_ready(batch_id):
            if on_not_ready != "skip":
                raise ScorerNotReady(f"batch {batch_id}: scorer not ready")
            logger.warning("batch %s: scorer not ready, batch skipped", batch_id)
            return
        try:
            process(batch, batch_id)
        except Exception:
            if on_error == "fail":
                raise
            logger.exception("batch %s failed and is skipped", batch_id)

    return write_batch


def _report(batch_id: int, total: int, sentiment_errors: int, category_errors: int) -> None:
    if total == 0:
        logger.info("batch %s: nothing to score", batch_id)
        return
    logger.info(
        "batch %s: %s articles scored, %s without sentiment, %s without category",
        batch_id,
        total,
        sentiment_errors,
        category_errors,
    )


def _check(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


# The ledger's entry for a batch whose scored rows are in their table.
_SCORED = "scored"


class _BatchLog:
    """The ledger's page of one batch; without a ledger there is nothing on it."""

    def __init__(self, ledger: Ledger | None, batch: DataFrame, batch_id: int) -> None:
        self._ledger, self._batch_id = ledger, batch_id
        self.entered: set[str] = set()
        if ledger is not None:
            context = batch.sparkSession.sparkContext
            self._stream = context.getLocalProperty("sql.streaming.queryId")
            if not self._stream:
                raise ValueError("a ledger is for batches of a stream")
            self.entered = ledger.entered(self._stream, batch_id)
            ledger.forget(self._stream, batch_id - KEPT_BATCHES)

    def enter(self, key: str) -> None:
        if self._ledger is not None:
            self._ledger.enter(self._stream, self._batch_id, key)


def _write_all(
    receivers: Sequence[Receiver], rows: DataFrame, batch_id: int, log: _BatchLog
) -> dict[str, Exception]:
    failures: dict[str, Exception] = {}
    for sink, name, key in receivers:
        try:
            sink.write(rows, batch_id)
        except Exception as failure:
            logger.exception("batch %s: %s failed", batch_id, name)
            failures[name] = failure
        else:
            log.enter(key)
    return failures
