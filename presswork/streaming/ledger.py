"""Which sinks have taken which micro-batch, as files beside the stream's checkpoint.

A batch that fails at one of several sinks is replayed as a whole. The ledger has an entry
for each sink that has taken it, so a replay passes those by. An entry is made right after
the sink's write returned. A driver that dies between the two leaves none: the
sink is then offered the batch again, as it would be without a ledger, and one that
overwrites its batch (``ParquetSink`` with ``per_batch``) closes that gap too.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import is_dataclass

from pyspark.sql import SparkSession

from presswork.sinks import Sink

# Batches whose entries stay: as many as Spark keeps of its own logs by default.
KEPT_BATCHES = 100


def sink_keys(sinks: Sequence[Sink]) -> list[str]:
    """A name for each sink that a restart finds again. A sink's own ``name`` comes first; else
    dataclasses, such as the built-in sinks, go by their type and fields, so they may
    change places, and others by their type. Of sinks with one name the order counts."""
    keys, seen = [], Counter()
    for sink in sinks:
        key = getattr(sink, "name", None)
        if not isinstance(key, str):
            key = type(sink).__name__
            if is_dataclass(sink):
                key += "-" + hashlib.sha1(repr(sink).encode()).hexdigest()[:12]
        seen[key] += 1
        keys.append(f"{key}-{seen[key]}")
    return [hashlib.sha1(key.encode()).hexdigest()[:8] + "-" + _plain(key) for key in keys]


def _plain(key: str) -> str:
    return "".join(c if c.isalnum() or c in "-." else "-" for c in key)[:80]


class Ledger:
    """Entries ``<folder>/<stream id>/<batch id>/<key>``. The stream's id is the one Spark keeps in
    its checkpoint: a stream that starts anew has a new one, and no entry."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._folder, self._spark = folder.rstrip("/"), spark

    def entered(self, stream: str, batch_id: int) -> set[str]:
        path = self._path(stream, str(batch_id))
        files = self._files(path)
        if not files.exists(path):
            return set()
        names = {status.getPath().getName() for status in files.listStatus(path)}
        return {name for name in names if not name.startswith((".", "_"))}

    def enter(self, stream: str, batch_id: int, key: str) -> None:
        """Written under another name first, then renamed: an entry is there as a whole or not
        at all."""
        path = self._path(stream, str(batch_id), key)
        draft = self._path(stream, str(batch_id), f".{key}-{uuid.uuid4().hex}")
        files = self._files(path)
        files.create(draft, True).close()
        if not files.rename(draft, path) and not files.exists(path):
            raise OSError(f"no entry for batch {batch_id} in {self._folder}")

    def forget(self, stream: str, before: int) -> None:
        """Entries of batches below ``before`` go: no restart replays these."""
        path = self._path(stream)
        files = self._files(path)
        if files.exists(path):
            for status in files.listStatus(path):
                name = status.getPath().getName()
                if name.isdigit() and int(name) < before:
                    files.delete(status.getPath(), True)

    def _path(self, *parts: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path("/".join([self._folder, *parts]))

    def _files(self, path):
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration())
