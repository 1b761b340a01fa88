"""UDF-7: the user's own function over event-time windows of a stream.

A ``WindowFunction`` has an accumulator per key and window: ``zero``, ``add`` (a row), ``merge`` (two accumulators)
and ``result``, which is called once, when the watermark passes the window's end. The rows of a micro-batch are
folded to an accumulator per key and window first; Spark's own window aggregate keeps these in one
state row per key and window, and they are merged when it closes. So state is read and written by the JVM alone, and its size
follows the micro-batches that had rows of a window, not its rows. Rows of windows that the watermark
has closed are dropped, rows of open windows are taken however late (the rule of Spark's own window aggregates).
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.conversion import LocalDataToArrowConversion

cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["*"]))

WINDOWS_AT_ONCE = 50_000         # keys and windows that a task holds before it passes their accumulators on


class WindowFunction(ABC):
    """A user's window function; ``accumulator`` and ``output`` are DDL strings of their columns."""

    accumulator: str
    output: str

    @abstractmethod
    def zero(self) -> tuple:
        """The accumulator of no row."""

    @abstractmethod
    def add(self, acc: tuple, row: Row) -> tuple:
        """``acc`` with one more input row."""

    @abstractmethod
    def merge(self, a: tuple, b: tuple) -> tuple:
        """Both accumulators as one; the order of arguments must not matter."""

    @abstractmethod
    def result(self, key: Any, start_ms: int, end_ms: int, acc: tuple) -> tuple:
        """Values of ``output`` of a closed window."""


def _fold(batches: Iterator[pa.RecordBatch], fn: WindowFunction, out: T.StructType) -> Iterator[pa.RecordBatch]:
    """An accumulator per key and window of the task's rows, and the latest time among them."""
    held: dict[tuple, list] = {}

    def folded() -> list[pa.RecordBatch]:
        rows = [(k, us, tuple(acc)) for (k, _), (us, acc) in held.items()]
        held.clear()
        return LocalDataToArrowConversion.convert(rows, out, False).to_batches()

    for rb in batches:
        names = [f.name for f in rb.schema.field("row").type]
        values = zip(*(c.to_pylist() for c in rb.column("row").flatten()))
        for k, end, us, row in zip(*(rb.column(c).to_pylist() for c in ("key", "end", "us")), values):
            last = held.get((k, end))
            if last is None:
                held[k, end] = [us, fn.add(fn.zero(), dict(zip(names, row)))]
            else:
                last[0], last[1] = max(last[0], us), fn.add(last[1], dict(zip(names, row)))
        if len(held) >= WINDOWS_AT_ONCE:
            yield from folded()
    if held:
        yield from folded()


def window_aggregate(stream: DataFrame, key: str, fn: WindowFunction, length: str, delay: str, buckets: int | None = None,
                     time: str = "event_time") -> DataFrame:
    """``(window_start, window_end, key, fn's output)``: each closed tumbling window of each key, once (append).

    Null keys are left out. ``buckets`` has no effect any more: state is spread over the shuffle's partitions by key and window.
    """
    partial = T.StructType([T.StructField("key", stream.schema[key].dataType), T.StructField("us", T.LongType()),
                            T.StructField("acc", T.StructType.fromDDL(fn.accumulator))])

    def result(k, start_ms: int, end_ms: int, accs: list[Row]) -> tuple:
        return fn.result(k, start_ms, end_ms, reduce(fn.merge, map(tuple, accs)))

    rows = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("key"), F.unix_micros(F.window(time, length)["end"]).alias("end"), F.unix_micros(time).alias("us"),
        F.struct(*[F.col(f"`{c}`") for c in stream.columns if c != time]).alias("row"))
    # The latest time of a window's rows lies in the window and carries the watermark on.
    held = rows.repartition("key", "end").mapInArrow(lambda batches: _fold(batches, fn, partial), partial) \
        .withColumn("time", F.timestamp_micros("us")).withWatermark("time", delay) \
        .groupBy(F.window("time", length), "key").agg(F.collect_list("acc").alias("accs"))
    closed = held.withColumn("out", F.udf(result, T.StructType.fromDDL(fn.output), useArrow=True)(
        "key", F.unix_millis("window.start"), F.unix_millis("window.end"), "accs"))
    return closed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         F.col("key").alias(key), "out.*")
