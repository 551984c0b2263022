"""Models of bounded size for the tasks: pickled with their code, unpacked once per worker process."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession


class Memo(dict):
    """Values made once per key; `trim` forgets all of them beyond a limit, so that memory stays bounded."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value

    def trim(self) -> None:
        if len(self) > self.limit:
            self.clear()


def ship(spark: SparkSession, model: object) -> Broadcast:
    """Arrays go beside the pickled rest, so neither side holds a second copy of them as bytes."""
    buffers: list[pickle.PickleBuffer] = []
    pickled = cloudpickle.dumps(model, protocol=pickle.HIGHEST_PROTOCOL, buffer_callback=buffers.append)
    return spark.sparkContext.broadcast({"pickled": pickled, "buffers": buffers})


def unpack(shipped: Broadcast):
    """The model; a worker process that runs several tasks unpacks it once, so a cache in it outlives a task."""
    holder = shipped.value
    if "model" not in holder:
        holder["model"] = pickle.loads(holder.pop("pickled"), buffers=holder.pop("buffers"))
    return holder["model"]


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs meanwhile sends Python workers at most so many rows at a time; a batch is held by Spark and by the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)
