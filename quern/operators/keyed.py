"""UDF-1..UDF-3, AGG-10: keyed map/reduce with user functions.

``keyed_map_reduce`` is the reference's ``MapReduce(READER, MAP, REDUCE)`` and
``MapReduceDistributed(..., PARTITIONER, COMBINER)`` re-expressed on Spark:

* map      → ``mapInPandas`` (Arrow batches, vectorised user code),
* combine  → the same task folds its batches into partial rows per key
             before the shuffle (map-side combine),
* shuffle  → ``repartition(key)`` (hash, the default) or ``repartitionByRange``,
* reduce   → ``groupBy(key).applyInPandas``, on the shuffle above. For very many small
             groups, ``vectorized_reduce`` takes frames of many whole groups from
             sorted partitions: one Python call per frame, not one per key, and no
             more in memory than an Arrow batch and one key's partials.

With a combiner, a reduce group holds at most one partial per map partition, so
even a key that holds a third of all rows reaches the reducer as a bounded
group. Without one, a group is every value of its key: use only for keys of
bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame

BatchFn = Callable[[pd.DataFrame], pd.DataFrame]
ReduceFn = Callable[..., pd.DataFrame]
# Rows of a task's partials before they are combined, and handed to the shuffle if half of them stay.
PARTIAL_ROWS = 400_000
# Characters (list entries) of the rows of one call of a map function; a longer row goes alone.
MAP_CHARS = 1_000_000


def _slices(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows of an Arrow batch in runs of about ``MAP_CHARS``: what a map function makes of long texts stays bounded."""
    size = np.zeros(len(pdf))
    for i, dtype in enumerate(pdf.dtypes):
        if dtype == object:
            size += pdf.iloc[:, i].map(lambda v: len(v) if hasattr(v, "__len__") else 0).to_numpy(dtype=float)
    run = np.cumsum(size) // MAP_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), len(pdf)]
    if len(cuts) == 2:
        yield pdf
        return
    for a, b in zip(cuts, cuts[1:]):
        yield pdf.iloc[a:b].reset_index(drop=True)


def _map_and_combine(map_fn: BatchFn, combine_fn: BatchFn | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mapped = (map_fn(rows) for pdf in batches for rows in _slices(pdf))
        if combine_fn is None:
            yield from (out for out in mapped if len(out))
            return
        pile, rows = [], 0
        for out in mapped:
            if not len(out):
                continue
            pile.append(combine_fn(out))
            rows += len(pile[-1])
            if rows >= PARTIAL_ROWS:
                pile = [combine_fn(pd.concat(pile, ignore_index=True))]
                rows = len(pile[0])
                if rows >= PARTIAL_ROWS // 2:     # a wide vocabulary: pass it on, the reducer adds up
                    yield pile.pop()
                    rows = 0
        if pile:
            partial = combine_fn(pd.concat(pile, ignore_index=True))
            if len(partial):
                yield partial
    return run


def _reduce_frames(keys: list[str], reduce_fn: ReduceFn, out_cols: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carry = None
        for pdf in batches:
            if carry is not None and len(carry):
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if not len(pdf):
                continue
            last = pdf[keys].iloc[-1]
            tail = ((pdf[keys] == last) | (pdf[keys].isna() & last.isna())).all(axis=1)
            carry, done = pdf[tail], pdf[~tail]
            if len(done):
                out = reduce_fn(done)
                if len(out):
                    yield out[out_cols]
        if carry is not None and len(carry):
            out = reduce_fn(carry)
            if len(out):
                yield out[out_cols]
    return run


def keyed_map_reduce(df: DataFrame, map_fn: BatchFn, map_schema: str, key: str | list[str],
                     reduce_fn: ReduceFn, out_schema: str, combine_fn: BatchFn | None = None,
                     num_partitions: int | None = None, partitioner: str | Column = "hash",
                     vectorized_reduce: bool = False) -> DataFrame:
    """Run a user map/reduce job; DataFrame in, DataFrame out (chainable, UDF-3).

    * ``map_fn(batch) -> rows`` of ``map_schema`` (the ``(k2, v2)*`` of each input row);
    * ``combine_fn(rows) -> rows`` of ``map_schema``: associative partial
      aggregate, may be applied any number of times (AGG-10);
    * ``reduce_fn(key_tuple, group_rows) -> rows`` of ``out_schema``; with
      ``vectorized_reduce`` it is ``reduce_fn(rows_of_whole_groups) -> rows``;
    * ``num_partitions`` / ``partitioner`` (``hash`` | ``range`` | a column
      expression of the key, e.g. a bucket) choose the shuffle (UDF-2); without
      a count AQE sizes it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    mapped = df.mapInPandas(_map_and_combine(map_fn, combine_fn), map_schema)
    placed = keys
    if isinstance(partitioner, Column):
        # A user partitioner: its value (a function of the key) is the partition's number;
        # without a count Spark hashes it. As a column of the group it spares a second shuffle.
        mapped = mapped.withColumn("_part", partitioner.cast("int"))
        placed = ["_part", *keys]
        mapped = mapped.repartitionById(num_partitions, "_part") if num_partitions \
            else mapped.repartition("_part")
    elif partitioner == "hash":
        mapped = mapped.repartition(num_partitions, *keys) if num_partitions \
            else mapped.repartition(*keys)
    elif partitioner == "range":
        mapped = mapped.repartitionByRange(num_partitions, *keys) if num_partitions \
            else mapped.repartitionByRange(*keys)
    else:
        raise ValueError(f"unknown partitioner {partitioner!r}")
    out_cols = [f.strip().split(" ")[0] for f in out_schema.split(",")]
    columns = [c for c in mapped.columns if c != "_part"] if placed is not keys else mapped.columns
    if vectorized_reduce:
        return mapped.sortWithinPartitions(*keys).select(*columns).mapInPandas(
            _reduce_frames(keys, reduce_fn, out_cols), out_schema)

    def reduce_group(key, group):
        return reduce_fn(key[-len(keys):], group[columns])[out_cols]
    return mapped.groupBy(*placed).applyInPandas(reduce_group, out_schema)


def per_record(fn: Callable, schema_cols: list[str]) -> BatchFn:
    """Wrap a reference-style record function ``fn(k1, v1) -> iterable of tuples``
    into a batch function. Row-at-a-time Python: for small helpers only; prefer
    vectorised batch functions in hot paths.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rec in pdf.itertuples(index=False):
            out.extend(fn(rec[0], rec))
        return pd.DataFrame(out, columns=schema_cols)
    return run
