"""State and timers per ride id, typed payload, and side outputs as tables (JOIN-7..9, STR-6..9, SNK-2)."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quern.sources.readers import read_stream
from quern.streaming import jobs
from quern.streaming.pairing import waiting_ids
from quern.streaming.runner import new_run, run_to_table, run_to_tables, sentinel_stream

RIDE = "ride_id long, event_time timestamp, customer_id long"
FARE = "ride_id long, event_time timestamp, tip double"
T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


class Feed:
    """Two folders that rows are added to between runs on one checkpoint."""

    def __init__(self, spark, path):
        self.spark, self.path, self.run = spark, str(path), new_run(spark, "feed")
        self.add([], [])

    def add(self, rides, fares):
        for name, rows, schema in (("rides", rides, RIDE), ("fares", fares, FARE)):
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")

    def streams(self):
        return [read_stream(self.spark, f"{self.path}/{n}", self.spark.read.schema(s).parquet(f"{self.path}/{n}").schema)
                for n, s in (("rides", RIDE), ("fares", FARE))]

    def keyed(self, expire=True):
        pair = jobs.pair_with_expiry if expire else jobs.pair_rides_fares
        return run_to_table(self.spark, pair(*self.streams(), buckets=1), self.run)

    def waiting(self):
        return {(r.ride_id, r.side) for r in waiting_ids(jobs.read_state(self.spark, self.run.checkpoint, variable="slots")).collect()}


@pytest.fixture
def changelog(spark):
    """State changes are kept per micro-batch, as CLUSTER_CONF asks for."""
    name = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    yield
    spark.conf.set(name, before)


def test_each_id_has_its_own_state_row_and_a_batch_touches_no_other(spark, tmp_path, changelog):
    feed = Feed(spark, tmp_path)
    feed.add([(i, at(0), 10 * i) for i in range(1, 51)], [])
    assert feed.keyed(expire=False).count() == 0 and feed.waiting() == {(i, "ride") for i in range(1, 51)}
    state = jobs.read_state(spark, feed.run.checkpoint, variable="slots")
    assert state.schema["user_map_value"].dataType["ride"].dataType["customer_id"].dataType.simpleString() == "bigint"
    done = spark.read.format("state-metadata").load(feed.run.checkpoint).agg(F.max("maxBatchId")).first()[0]
    feed.add([(60, at(1), 600)], [(7, at(2), 1.5)])
    rows = feed.keyed(expire=False).collect()
    assert [(r.ride_id, r.ride.customer_id, r.fare.tip) for r in rows] == [(7, 70, 1.5)]
    assert feed.waiting() == {(i, "ride") for i in [*range(1, 51), 60] if i != 7}
    # Rows of the state that the later micro-batches wrote: the two ids that had input.
    changed = spark.read.format("statestore").option("stateVarName", "slots").option("readChangeFeed", "true") \
        .option("changeStartBatchId", done + 1).load(feed.run.checkpoint)
    assert {(r.change_type, r.user_map_key.ride_id) for r in changed.collect()} == {("delete", 7), ("update", 60)}


def test_ids_of_one_bucket_expire_in_different_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, at(0), 1), (2, at(30), 2)], [(3, at(31), 0.5)])
    feed.keyed()                                             # the watermark follows after this batch
    feed.add([(4, at(60), 4)], [])
    first = {(r.ride_id, r.status) for r in feed.keyed().collect()}
    assert (1, "unmatched_ride") in first and (4, "unmatched_ride") not in first
    assert first == {(1, "unmatched_ride"), (2, "unmatched_ride"), (3, "unmatched_fare")} and feed.waiting() == {(4, "ride")}
    feed.add([], [(5, at(120), 1.0)])
    assert {(r.ride_id, r.status) for r in feed.keyed().collect()} == first | {(4, "unmatched_ride")}


def test_only_the_id_that_is_due_expires(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, at(0), 1), (2, at(10), 2)], [])
    # Watermark = latest event less a minute: id 1 is due, id 2 is not.
    first = {(r.ride_id, r.status) for r in feed.keyed().collect()}
    assert first == {(1, "unmatched_ride")} and feed.waiting() == {(2, "ride")}


def test_a_match_cancels_the_timer_and_a_later_row_moves_it(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, at(10), 1), (2, at(10), 2)], [])
    feed.keyed()
    feed.add([(2, at(10.5), 22)], [(1, at(10.2), 3.5)])       # 1 is matched, 2 gets a newer row
    assert [(r.ride_id, r.status, r.fare.tip) for r in feed.keyed().collect()] == [(1, "matched", 3.5)]
    assert feed.waiting() == {(2, "ride")}
    due = jobs.read_state(spark, feed.run.checkpoint, variable="due")
    assert [r.user_map_value.ids for r in due.collect()] == [[2]]
    feed.add([], [(9, at(60), 1.0)])
    rows = {(r.ride_id, r.status, r.ride and r.ride.customer_id) for r in feed.keyed().collect()}
    assert rows == {(1, "matched", 1), (2, "unmatched_ride", 22)}


def test_payload_keeps_types_and_large_numbers(spark, tmp_path):
    schema = "ride_id long, event_time timestamp, big long, price decimal(20,2), tags array<string>, inner struct<x:int>"
    row = (1, at(0), 2 ** 60 + 1, __import__("decimal").Decimal("123456789012345678.91"), ["a", None], (5,))
    for name in ("r", "f"):
        spark.createDataFrame([row, (None, at(0), None, None, None, None)], schema).write.parquet(f"{tmp_path}/{name}")
    r, f = (read_stream(spark, f"{tmp_path}/{n}", spark.read.parquet(f"{tmp_path}/{n}").schema) for n in ("r", "f"))
    got = run_to_table(spark, jobs.pair_rides_fares(r, f), new_run(spark, "types")).collect()
    assert len(got) == 1 and got[0].ride == got[0].fare
    assert (got[0].ride.big, got[0].ride.price, got[0].ride.tags, got[0].ride.inner.x) == (row[2], row[3], row[4], 5)


def _sides(spark, path, fail_at=None, monkeypatch=None):
    """Side tables of a join run; with ``fail_at``, that write fails once and the run starts again."""
    feed = Feed(spark, path)
    feed.add([(i, at(i), i) for i in range(20)], [(i, at(i), 1.0) for i in range(10, 30)])
    rides, fares = feed.streams()
    ends = [sentinel_stream(spark, feed.run, s.schema, {"ride_id": k, "event_time": dt.datetime(2100, 1, 1)}, f"end{-k}")
            for k, s in ((-1, rides), (-2, fares))]
    stream = jobs.expiring_join(rides.unionByName(ends[0]), fares.unionByName(ends[1]), "1 hour")
    if fail_at:
        calls, write = [], DataFrameWriter.parquet

        def broken(self, target, *a, **k):
            if "/batch_id=" in target:
                calls.append(target)
                if len(calls) == fail_at:
                    raise OSError("disk is gone")
            return write(self, target, *a, **k)
        monkeypatch.setattr(DataFrameWriter, "parquet", broken)
        with pytest.raises(RuntimeError):
            run_to_tables(spark, stream, feed.run, jobs.side_outputs())
    return run_to_tables(spark, stream, feed.run, jobs.side_outputs())


@pytest.mark.parametrize("fail_at", [None, 2, 5])
def test_side_tables_after_a_fault_between_two_writes(spark, tmp_path, monkeypatch, fail_at):
    tables = _sides(spark, tmp_path, fail_at, monkeypatch)
    got = {name: sorted(r.ride_id for r in t.where("ride_id >= 0").collect()) for name, t in tables.items()}
    assert got == {"matched": list(range(10, 20)), "unmatched_rides": list(range(10)), "unmatched_fares": list(range(20, 30))}
    assert "batch_id" not in tables["matched"].columns


def test_unmatched_fares_store_no_other_row(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(i, at(i), i) for i in range(20)], [(i, at(i), 1.0) for i in range(10, 30)])
    rides, fares = feed.streams()
    ends = [sentinel_stream(spark, feed.run, s.schema, {"ride_id": k, "event_time": dt.datetime(2100, 1, 1)}, f"end{-k}")
            for k, s in ((-1, rides), (-2, fares))]
    out = run_to_table(spark, jobs.unmatched_fares(rides.unionByName(ends[0]), fares.unionByName(ends[1]), "1 hour"), feed.run)
    assert sorted(r.ride_id for r in spark.read.parquet(feed.run.sink).collect() if r.ride_id >= 0) == list(range(20, 30))
    assert isinstance(out, DataFrame) and "ride" not in out.columns


def test_time_limit_stops_a_run_with_markers(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([(1, at(0), 1)], [])
    rides, fares = feed.streams()
    end = sentinel_stream(spark, feed.run, rides.schema, {"ride_id": -1, "event_time": dt.datetime(2100, 1, 1)})
    with pytest.raises(TimeoutError):
        run_to_table(spark, jobs.expiring_join(rides.unionByName(end), fares), feed.run, timeout_s=0.01)


def test_processor_needs_no_import_path():
    """The state processor reaches Spark's Python processes by value, so any working folder does."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
import __spark_entry__ as E
from quern.session import get_session
print("ROWS", E.queries()["ride_fare_pairs"](get_session("local[2]", shuffle_partitions=2), {SF_SMALL!r}).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout and int(out.stdout.split("ROWS")[1].split()[0]) > 0, out.stderr[-2000:]


def test_a_bucket_that_is_wholly_due_is_read_at_once():
    """No state call per waiting id when all that waits in a bucket expires; else only the ids due are taken."""
    from types import SimpleNamespace

    from pyspark.sql import types as T

    from quern.streaming.pairing import SlotPairing

    class Held(dict):
        calls = 0

        def iterator(self):
            return iter(list(self.items()))

        def getValue(self, key):
            self.calls += 1
            return self.get(key)

        def removeKey(self, key):
            self.calls += 1
            self.pop(key, None)

    def expire(watermark):
        slots = Held({(i,): (10 * (i % 3 + 1), ("ride", i), None) for i in range(30)})
        due = Held({(10 * (k + 1),): ([i for i in range(30) if i % 3 == k],) for k in range(3)})
        p = SlotPairing(T.StructType([]), T.StructType([]), True)
        p.init(SimpleNamespace(getMapState=lambda name, *_: {"slots": slots, "due": due}[name]))
        out = [r.ride_id for t in (10, 20, 30) if t < watermark for r in p.handleExpiredTimer(
            (0,), SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark), SimpleNamespace(getExpiryTimeInMs=lambda: t))]
        return sorted(out), sorted(i for i, in slots), slots.calls

    assert expire(31) == (list(range(30)), [], 0)
    assert expire(25) == ([i for i in range(30) if i % 3 < 2], [i for i in range(30) if i % 3 == 2], 40)
