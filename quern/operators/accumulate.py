"""AGG-9, AGG-10, UDF-2: aggregates by user functions whose partials merge in several steps.

``aggregate_by_key(zero, seq, comb)`` takes the functions of the reference's ``aggregateByKey``: every
scan task folds its values into one typed accumulator a key (``seq``), the partials of a key are merged in
``salts`` tasks (``comb``), and at last the ``salts`` results of each key are merged. A key that holds half of all
rows so costs a task no more than one accumulator per scan task over ``salts``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Accumulators that a task holds before it hands them to the shuffle.
HELD_KEYS = 500_000


def _record_batches(held: dict, schema: pa.Schema, rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    items = list(held.items())
    for k in range(0, len(items), rows):
        part = [(key, *acc) for key, acc in items[k:k + rows]]
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)


def _folded(batches: Iterator[pa.RecordBatch], zero: tuple, seq: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    for rb in batches:
        codes = rb.column(0).dictionary_encode(null_encoding="encode")
        keys, which = codes.dictionary.to_pylist(), codes.indices.to_numpy()
        order = np.argsort(which, kind="stable")
        values = rb.column(1).take(pa.array(order))
        cuts = np.searchsorted(which[order], np.arange(len(keys) + 1)).tolist()
        for key, a, b in zip(keys, cuts, cuts[1:]):
            held[key] = tuple(seq(held.get(key, zero), values.slice(a, b - a)))
        if len(held) >= HELD_KEYS:                          # many keys: pass on, the merge adds up
            yield from _record_batches(held, schema)
            held = {}
    yield from _record_batches(held, schema)


def _merged(batches: Iterator[pa.RecordBatch], comb: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    for rb in batches:
        columns = [c.to_pylist() for c in rb.columns]
        for key, *acc in zip(*columns):
            before = held.get(key)
            held[key] = tuple(acc) if before is None else tuple(comb(before, tuple(acc)))
    yield from _record_batches(held, schema)


def aggregate_by_key(df: DataFrame, key: str, value: str, zero: tuple, seq: Callable[[tuple, pa.Array], tuple],
                     comb: Callable[[tuple, tuple], tuple], acc_schema: str, salts: int = 32) -> DataFrame:
    """``(key, accumulator columns)``: ``zero`` folded over the values of each key.

    * ``seq(acc, values) -> acc`` takes the key's values of one Arrow batch at once (an Arrow array, nulls included);
    * ``comb(acc, acc) -> acc`` merges two accumulators; it has to be associative and commutative;
    * ``acc_schema`` types the accumulator's columns, e.g. ``"n long, total decimal(38,2)"``.

    Null keys are a key. An empty table gives no rows. A merge task holds the accumulators of its
    share of the keys, so it grows with the number of distinct keys over the shuffle's partitions.
    """
    fields = [T.StructField(key, df.schema[key].dataType), *T.StructType.fromDDL(acc_schema).fields]
    out = T.StructType(fields)
    arrow = to_arrow_schema(out)
    partial = df.select(F.col(f"`{key}`"), F.col(f"`{value}`").alias("_value")) \
        .mapInArrow(lambda it: _folded(it, zero, seq, arrow), out)
    if salts > 1:
        # The salt is the partial's task, so that a hot key's partials go to ``salts`` tasks.
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        partial = partial.withColumn("_salt", salt).repartition(F.col(f"`{key}`"), "_salt").drop("_salt") \
            .mapInArrow(lambda it: _merged(it, comb, arrow), out)
    return partial.repartition(F.col(f"`{key}`")).mapInArrow(lambda it: _merged(it, comb, arrow), out)
