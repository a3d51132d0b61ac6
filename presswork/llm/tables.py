"""Inputs of the operators, and small helpers they share."""

from __future__ import annotations

import ctypes
import pickle
import sys
import types
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, so that the tasks it runs one
    after the other share what is in it. Only what can be computed again belongs here:
    a lost worker takes its dict along."""
    module = sys.modules.setdefault("_presswork_worker", types.ModuleType("_presswork_worker"))
    return module.__dict__.setdefault(name, {})


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """A batch in parts that share its memory. What is made of a part can go before the
    next one is looked at."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def tidy(run: Callable) -> Callable:
    """The function over batches, which gives memory it no longer uses back to the system
    at its end. Workers wait for their next task beside the executor, in the same limit."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


def ship(context: SparkContext, value: object) -> Broadcast:
    """A broadcast of ``value`` together with its class, which executors need not have.
    Only for what has a stated bound."""
    return context.broadcast(cloudpickle.dumps(value))


def unpack(shared: Broadcast) -> object:
    return pickle.loads(shared.value)
