"""Pairing of two streams by ride id with a state row and a timer per ride id (JOIN-7, JOIN-8b, STR-6..9, UDF-8).

``SlotPairing`` holds at most one waiting row of a ride id (trap T11: latest wins, a match clears the
slot). Slots are entries of a map state, so Spark stores one row per waiting ride id with the
columns of ride or fare in their own types, and a micro-batch reads and writes the rows of the
ids that it touches. The map's own key is a hash bucket of the ride id: Spark calls the
processor once per bucket and micro-batch, and not once per id.

Without expiry a bucket's rows reach the processor as Arrow blocks (``BlockPairing``): what Python does for each row by itself
is the state call of an id that waits, or that finds a waiting one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

# The processor runs in processes that Spark starts on the driver and on executors: by value it needs no import there.
cloudpickle.register_pickle_by_value(__import__(__name__, fromlist=["*"]))

MATCHED, LONE_RIDE, LONE_FARE = "matched", "unmatched_ride", "unmatched_fare"
NO_TIME = -(1 << 62)             # rows without a time come before all others
PACK_ROWS, PACK_BYTES = 200_000, 1 << 26     # rows that a task holds before it passes them on as blocks, one a bucket


def payload(df: DataFrame) -> list[str]:
    """The columns beside id and time."""
    return [c for c in df.columns if c not in ("ride_id", "event_time")]


def _side(df: DataFrame) -> F.Column:
    """Time in microseconds and the further columns of one stream, as one struct."""
    return F.struct(F.unix_micros("event_time").alias("_us"), *[F.col(f"`{c}`") for c in payload(df)])


def tagged_union(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """STR-9: connect two streams of different type as one keyed stream, each in a struct of its own.

    Rows without a ride id pair with nothing and are left out.
    """
    types = {k: df.select(_side(df).alias("s")).schema["s"].dataType for k, df in (("ride", rides), ("fare", fares))}

    def tagged(df: DataFrame, kind: str) -> DataFrame:
        return df.where(F.col("ride_id").isNotNull()).select(
            "ride_id", "event_time", *[(_side(df) if k == kind else F.lit(None)).cast(t).alias(k) for k, t in types.items()])
    return tagged(rides, "ride").unionByName(tagged(fares, "fare"))


class SlotPairing(StatefulProcessor):
    """Two-slot state machine of one ride id, for all ride ids of a bucket.

    With ``expire``, a waiting row is due at its own event time, or just after the watermark
    when it is stored, as a timer may not lie behind it. Its timer is cancelled by a
    match and moved when a later row takes the slot; else it fires once the watermark passes it, and
    the row comes out unmatched. Timers are Spark's; one per bucket and due time, with the ids due then.
    """

    def __init__(self, ride_type: T.StructType, fare_type: T.StructType, expire: bool):
        self.expire = expire
        self.id_type = T.StructType([T.StructField("ride_id", T.LongType())])
        self.due_type = T.StructType([T.StructField("due_ms", T.LongType())])
        self.slot_type = T.StructType([T.StructField("due_ms", T.LongType()), T.StructField("ride", ride_type),
                                       T.StructField("fare", fare_type)])
        self.ids_type = T.StructType([T.StructField("ids", T.ArrayType(T.LongType()))])

    def init(self, handle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", self.id_type, self.slot_type)
        if self.expire:
            self.due = handle.getMapState("due", self.due_type, self.ids_type)
            self.fired: dict[tuple, bool] = {}        # buckets with a timer in this micro-batch; True: none waits in it any more

    @staticmethod
    def us(r: Row) -> int:
        us = (r.ride or r.fare)["_us"]
        return NO_TIME if us is None else us

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs() if self.expire else 0
        by_id: dict[int, list[Row]] = {}
        for r in rows:
            by_id.setdefault(r.ride_id, []).append(r)
        known = self.slots.exists()
        moves: dict[int, tuple[set[int], set[int]]] = {}
        for ride_id, events in by_id.items():
            stored = slot = self.slots.getValue((ride_id,)) if known else None
            if self.expire and slot is not None and slot[0] < watermark:
                yield self.lone(ride_id, slot)             # its timer was due before these rows came
                slot = None
            # Arrival order inside a micro-batch: event time, rides first.
            for r in sorted(events, key=lambda r: self.us(r) * 2 + (r.ride is None)):
                if slot is None or (slot[1] is None) == (r.ride is None):
                    slot = (max(self.us(r) // 1000, watermark + 1), r.ride, r.fare)
                else:
                    yield Row(ride_id=ride_id, status=MATCHED, ride=slot[1] or r.ride, fare=slot[2] or r.fare)
                    slot = None
            if slot is stored:
                continue
            if slot is not None:
                self.slots.updateValue((ride_id,), slot)
            elif stored is not None:
                self.slots.removeKey((ride_id,))
            if self.expire and (stored and stored[0]) != (slot and slot[0]):
                if stored is not None:
                    moves.setdefault(stored[0], (set(), set()))[0].add(ride_id)
                if slot is not None:
                    moves.setdefault(slot[0], (set(), set()))[1].add(ride_id)
        if moves:
            self.move_timers(moves)

    def move_timers(self, moves: dict[int, tuple[set[int], set[int]]]) -> None:
        known = self.due.exists()
        for due_ms, (gone, new) in moves.items():
            stored = self.due.getValue((due_ms,)) if known else None
            ids = (set(stored[0]) if stored else set()) - gone | new
            if ids:
                self.due.updateValue((due_ms,), (sorted(ids),))
                if not stored:
                    self.handle.registerTimer(due_ms)
            elif stored:
                self.due.removeKey((due_ms,))
                self.handle.deleteTimer(due_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        bucket = tuple(key)
        if bucket not in self.fired:
            watermark = timerValues.getCurrentWatermarkInMs()
            self.fired[bucket] = all(due[0] < watermark for due in self.due.keys())
            if self.fired[bucket]:                    # all that waits is due: read at once, not id by id
                for (ride_id,), slot in self.slots.iterator():
                    yield self.lone(ride_id, slot)
                self.slots.clear()
                self.due.clear()
        if self.fired[bucket]:
            return
        due_ms = expiredTimerInfo.getExpiryTimeInMs()
        for ride_id in (self.due.getValue((due_ms,)) or ([],))[0]:
            yield self.lone(ride_id, self.slots.getValue((ride_id,)))
            self.slots.removeKey((ride_id,))
        self.due.removeKey((due_ms,))

    @staticmethod
    def lone(ride_id: int, slot) -> Row:
        return Row(ride_id=ride_id, status=LONE_FARE if slot[1] is None else LONE_RIDE, ride=slot[1], fare=slot[2])

    def close(self) -> None:
        pass


def _block(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a ``_bucket`` as blocks of the other columns, one a bucket of each pile of rows."""
    def packed(pile: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(pile).combine_chunks()
        t = t.take(np.argsort(t["_bucket"].to_numpy(), kind="stable"))
        buckets, starts = np.unique(t["_bucket"].to_numpy(), return_index=True)
        rows = t.drop_columns(["_bucket"])
        return pa.record_batch([pa.array(buckets), pa.array([_block(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(t)])],
                                                            pa.binary())], names=["_bucket", "block"])
    pile, rows, size = [], 0, 0
    for rb in batches:
        pile.append(rb)
        rows, size = rows + rb.num_rows, size + rb.nbytes
        if rows >= PACK_ROWS or size >= PACK_BYTES:
            yield packed(pile)
            pile, rows, size = [], 0, 0
    if rows:
        yield packed(pile)


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks, and the rows that came as such."""
    for rb in batches:
        yield rb.filter(rb.column("block").is_null()).select(["ride_id", "ride", "fare"])
        for block in rb.column("block").drop_null():
            yield from pa.ipc.open_stream(block.as_buffer()).read_all().to_batches()


class BlockPairing(SlotPairing):
    """``SlotPairing`` without expiry over blocks of rows.

    An id whose rows of the micro-batch are one ride and one fare, and an id with one row, neither with
    a waiting row, are told apart by one sort of the bucket's rows; the rest goes the way of single rows.
    """

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        t = pa.concat_tables([pa.ipc.open_stream(r.block).read_all() for r in rows]).combine_chunks()
        ids, is_fare = t["ride_id"].to_numpy(), t["ride"].is_null().to_numpy()
        us = pc.fill_null(pc.coalesce(*(pc.struct_field(t[s], "_us") for s in ("ride", "fare"))), NO_TIME).to_numpy()
        order = np.lexsort((is_fare, us, ids))
        ids = ids[order]
        heads = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        sizes = np.diff(np.append(heads, len(ids)))
        free = np.ones(len(heads), bool)
        if self.slots.exists():
            free[:] = [self.slots.getValue((i,)) is None for i in ids[heads].tolist()]
        one, two = order[heads], order[np.minimum(heads + 1, len(ids) - 1)]
        pairs = free & (sizes == 2) & (is_fare[one] != is_fare[two])
        lone = free & (sizes == 1)
        others = t.take(order[np.repeat(~(pairs | lone), sizes)])
        yield from super().handleInputRows(key, (Row(**r) for r in others.to_pylist()), timerValues)
        if pairs.any():
            a, b = one[pairs], two[pairs]
            yield Row(block=_block(pa.table({"ride_id": t["ride_id"].take(a), "ride": t["ride"].take(np.where(is_fare[a], b, a)),
                                             "fare": t["fare"].take(np.where(is_fare[a], a, b))})))
        at = one[lone]
        for kind, some in ((1, at[~is_fare[at]]), (2, at[is_fare[at]])):
            waiting = t["ride" if kind == 1 else "fare"].take(some).combine_chunks()
            values = zip(*(c.to_pylist() for c in waiting.flatten()))
            for ride_id, ms, row in zip(t["ride_id"].take(some).to_pylist(), np.maximum(us[some] // 1000, 1).tolist(), values):
                self.slots.updateValue((ride_id,), (ms, row, None) if kind == 1 else (ms, None, row))


def pair_by_slots(union: DataFrame, buckets: int, expire: bool) -> DataFrame:
    """``(ride_id, status, ride_time, fare_time)`` and the structs ``ride`` and ``fare`` of the further columns."""
    ride, fare = union.schema["ride"].dataType, union.schema["fare"].dataType
    out = T.StructType([T.StructField("ride_id", T.LongType()), T.StructField("status", T.StringType()),
                        T.StructField("ride", ride), T.StructField("fare", fare)])
    bucketed = union.withColumn("_bucket", F.pmod(F.xxhash64("ride_id"), F.lit(buckets)))
    if expire:
        paired = bucketed.groupBy("_bucket").transformWithState(SlotPairing(ride, fare, True), out, "append", "EventTime")
    else:
        sides = T.StructType([f for f in out if f.name != "status"])
        blocks = bucketed.drop("event_time").mapInArrow(_pack, "_bucket long, block binary").groupBy("_bucket") \
            .transformWithState(BlockPairing(ride, fare, False), T.StructType([*sides, T.StructField("block", T.BinaryType())]), "append", "None")
        paired = blocks.mapInArrow(_unpack, sides).withColumn("status", F.lit(MATCHED))
    return paired.select(
        "ride_id", "status", *[F.timestamp_micros(f"{s}._us").alias(f"{s}_time") for s in ("ride", "fare")],
        *[F.when(F.col(s).isNotNull(), F.struct(*[F.col(f"{s}.`{f}`") for f in t.names[1:]])).alias(s)
          for s, t in (("ride", ride), ("fare", fare)) if len(t) > 1])


def waiting_ids(state: DataFrame) -> DataFrame:
    """STR-11: ``(ride_id, side)`` of every row that waits, from the state variable ``slots``."""
    return state.select(F.col("user_map_key.ride_id").alias("ride_id"),
                        F.when(F.col("user_map_value.ride").isNotNull(), "ride").otherwise("fare").alias("side"))
