"""What a stream holds in the shared folder goes when its query ends."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


class AtEnd(StreamingQueryListener):
    """Calls ``release`` once when the watched query has ended without a failure, stopped or
    finished. After a failure a restart goes on with what there is. Then it listens no
    more."""

    def __init__(self, spark: SparkSession, release: Callable[[], None]) -> None:
        self._spark, self._release, self._lock = spark, release, threading.Lock()
        self._run: str | None = None
        self._ended: dict[str, bool] = {}
        spark.streams.addListener(self)

    def watch(self, query: StreamingQuery) -> None:
        """The query may have ended before this is called."""
        with self._lock:
            self._run = str(query.runId)
            failed = self._ended.get(self._run)
        if failed is not None:
            self._leave(failed)

    def _leave(self, failed: bool) -> None:
        if not failed:
            self._release()
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run, failed = str(event.runId), event.exception is not None
        with self._lock:
            if self._run is None:
                self._ended[run] = failed
            mine = run == self._run
        if mine:
            self._leave(failed)
