"""What the findings of round 3 asked for: state and Python calls of the streams that grew too fast."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Row
from pyspark.sql import types as T

from conftest import SF_SMALL
from quern.plans.streams import TipTotal
from quern.sources.readers import read_stream
from quern.streaming import jobs
from quern.streaming.pairing import BlockPairing, _pack, _unpack
from quern.streaming.runner import new_run, run_to_table
from quern.streaming.windows import _fold, window_aggregate

T0 = dt.datetime(2024, 1, 1)


def test_user_windows_keep_one_state_row_per_key_and_window(spark, tmp_path):
    # no state call from Python per window; the JVM holds an accumulator per micro-batch, not the rows.
    schema, src, run = "driver_id long, tip decimal(38,18), event_time timestamp", str(tmp_path / "in"), new_run(spark, "f5")
    for minute in (0, 20):
        rows = [(d, d + i / 4, T0 + dt.timedelta(minutes=minute, seconds=i)) for d in (1, 2, 3) for i in range(10)]
        spark.createDataFrame([(d, Decimal(t), at) for d, t, at in rows] + [(None, None, T0), (4, None, None)],
                              schema).coalesce(1).write.mode("append").parquet(src)
        stream = window_aggregate(read_stream(spark, src, spark.read.parquet(src).schema), "driver_id", TipTotal(), "1 hour", "60 seconds")
        assert run_to_table(spark, stream, run).count() == 0
    state = jobs.read_state(spark, run.checkpoint).select("key.*").collect()
    assert sorted(r.key for r in state) == [1, 2, 3] and {r.window.start for r in state} == {T0}
    # A task passes on one accumulator per key and window, with the latest time among its rows.
    rows = pa.table({"key": [1, 1, 2], "end": [60, 60, 60], "us": [5, 9, 7],
                     "row": pa.array([{"tip": Decimal(x)} for x in (1, 2, 4)], pa.struct([("tip", pa.decimal128(38, 18))]))})
    out = T.StructType.fromDDL("key long, us long, acc struct<total: decimal(38,18)>")
    folded = pa.Table.from_batches(list(_fold(iter(rows.to_batches()), TipTotal(), out)))
    assert folded.to_pylist() == [{"key": 1, "us": 9, "acc": {"total": 3}}, {"key": 2, "us": 7, "acc": {"total": 4}}]
    spark.createDataFrame([(9, None, T0 + dt.timedelta(days=1))], schema).write.mode("append").parquet(src)
    got = run_to_table(spark, stream, run).collect()
    assert {(r.driver_id, r.window_start, r.window_end, float(r.tips)) for r in got} == \
        {(d, T0, T0 + dt.timedelta(hours=1), 20 * d + 22.5) for d in (1, 2, 3)} and len(got) == 3


def _slots(held, rows):
    """What ``BlockPairing`` makes of a bucket's rows ``(ride_id, side, us, n)``: pairs, the slots after it, and its state calls."""
    from types import SimpleNamespace
    side = pa.struct([("_us", pa.int64()), ("n", pa.int64())])
    calls = []

    class Slots(dict):
        def exists(self):
            return bool(self)

        def getValue(self, key):
            calls.append(("get", key[0]))
            return self.get(key)

        def updateValue(self, key, value):
            calls.append(("put", key[0]))
            self[key] = value

        def removeKey(self, key):
            calls.append(("del", key[0]))
            self.pop(key)

    table = pa.table({"ride_id": pa.array([r[0] for r in rows], pa.int64()),
                      **{k: pa.array([{"_us": r[2], "n": r[3]} if r[1] == k else None for r in rows], side) for k in ("ride", "fare")},
                      "_bucket": pa.array([0] * len(rows), pa.int64())})
    blocks = pa.Table.from_batches(list(_pack(iter(table.to_batches(max_chunksize=3))))).to_pylist()
    assert [b["_bucket"] for b in blocks] == [0]
    slots, p = Slots(held), BlockPairing(T.StructType([]), T.StructType([]), False)
    p.init(SimpleNamespace(getMapState=lambda *_: slots))
    out = [r.asDict(True) for r in p.handleInputRows((0,), (Row(**b) for b in blocks), None)]
    schema = pa.schema([("ride_id", pa.int64()), ("ride", side), ("fare", side), ("block", pa.binary())])
    got = pa.Table.from_batches(list(_unpack([pa.RecordBatch.from_pylist(out, schema)])), pa.schema(list(schema)[:3])).to_pylist()
    n = lambda s: s and (s["n"] if isinstance(s, dict) else s[1])
    return sorted((r["ride_id"], n(r["ride"]), n(r["fare"])) for r in got), {k[0]: (n(v[1]), n(v[2])) for k, v in slots.items()}, calls


def test_pairs_of_one_micro_batch_need_no_state_call():
    # F7, F8: rows come in blocks; only an id that waits, or finds a waiting row, is a call of its own.
    rows = [(1, "ride", 5, 10), (2, "fare", 5, 20), (1, "fare", 1, 11), (3, "ride", 1, 30), (3, "ride", 2, 31), (3, "fare", 3, 32),
            (4, "ride", 1, 40), (4, "fare", 2, 41), (4, "fare", None, 42), (2 ** 60 + 1, "ride", 1, 50)]
    # Rows without a time come first: fare 42 meets ride 40 and fare 41 waits; of two rides the later one wins.
    pairs, slots, calls = _slots({}, rows)
    assert pairs == [(1, 10, 11), (3, 31, 32), (4, 40, 42)]
    assert slots == {2: (None, 20), 4: (None, 41), 2 ** 60 + 1: (50, None)}
    assert sorted(calls) == [("put", 2), ("put", 4), ("put", 2 ** 60 + 1)]


def test_rows_that_wait_are_met_by_later_blocks():
    waits = Row(_us=1, n=70)
    pairs, slots, _ = _slots({(7,): (1, waits, None), (8,): (1, None, waits)},
                             [(7, "fare", 9, 71), (8, "fare", 9, 80), (9, "ride", 3, 90), (9, "fare", 2, 91)])
    assert pairs == [(7, 70, 71), (9, 90, 91)] and slots == {8: (None, 80)}


def test_distinct_words_become_texts_in_one_go():
    # op10: turning a block's distinct words into Python texts one by one took longer than all the rest of the step.
    import time

    from quern.llm.wordwise import ids_of_lists
    words = pa.array([f"word{i:x}" for i in range(400_000)], pa.large_string())
    lists, took = pa.LargeListArray.from_arrays(pa.array([0, len(words)], pa.int64()), words), []
    for step in (lambda: words.dictionary_encode().dictionary.to_pylist(), lambda: ids_of_lists(lists, lambda w: [b"\1\0\0\0"] * len(w))):
        times = []
        for _ in range(3):
            start = time.process_time()
            got = step()
            times.append(time.process_time() - start)
        took.append(min(times))
    assert got == [b"\1\0\0\0" * len(words)] and took[1] < took[0]


RIDE, FARE = "ride_id long, event_time timestamp, customer_id long", "ride_id long, event_time timestamp, tip double"


def _fares_in_runs(spark, path, large):
    """``unmatched_fares`` and ``expiring_join`` after each of three runs on one checkpoint; ``large``: the runs with large state."""
    def at(minutes):
        return T0 + dt.timedelta(minutes=minutes)

    feeds = [([(1, at(0), 10), (2, at(50), 20), (2, at(55), 21), (3, at(0), 30), (None, at(1), 0)],
              [(1, at(30), 1.0), (1, at(31), 1.5), (3, at(61), 3.0), (4, at(0), 4.0), (4, at(0), 4.0), (None, at(2), 0.5), (8, at(90), 8.0)]),
             ([(4, at(10), 40), (8, at(200), 80), (5, at(300), 50)], [(2, at(100), 2.0), (2, at(5), 2.5), (5, at(299), 5.0), (6, at(280), 6.0)]),
             ([(5, at(310), 51), (7, at(900), 70)], [(7, at(300), 7.0), (6, at(341), 6.5), (9, at(900), 9.0)])]
    jobs_of = {"fares": (jobs.unmatched_fares, new_run(spark, "f9")), "all": (jobs.expiring_join, new_run(spark, "f9-all"))}
    seen = {name: [] for name in jobs_of}
    for (rides, fares), some in zip(feeds, large):
        for name, rows, schema in (("rides", rides, RIDE), ("fares", fares, FARE)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")
        for name, (job, run) in jobs_of.items():
            sides = [read_stream(spark, f"{path}/{n}", T.StructType.fromDDL(s)) for n, s in (("rides", RIDE), ("fares", FARE))]
            run.large_state = some
            seen[name].append(sorted(map(str, run_to_table(spark, job(*sides, "1 hour"), run).collect())))
    return seen, jobs_of["fares"][1].checkpoint


def test_large_state_of_a_join_is_one_store_a_partition(spark, tmp_path):
    # four stores a partition were loaded and committed in each micro-batch, and each row written was looked up for its count.
    plain, old = _fares_in_runs(spark, tmp_path / "plain", [False] * 3)
    new, checkpoint = _fares_in_runs(spark, tmp_path / "large", [True] * 3)
    mixed, kept = _fares_in_runs(spark, tmp_path / "mixed", [False, True, True])
    assert new == plain == mixed and len({len(x) for x in plain["fares"]}) == 3     # a checkpoint of before is read on
    stores = {c: {r.stateStoreName for r in spark.read.format("state-metadata").load(c).collect()} for c in (old, checkpoint, kept)}
    assert len(stores[checkpoint]) == 1 and len(stores[old]) == len(stores[kept]) == 4
    waiting = [{s: jobs.read_state(spark, c, join_side=s).count() for s in ("left", "right")} for c in (old, checkpoint)]
    assert waiting[0] == waiting[1] and waiting[0]["left"] > 0
    assert spark.conf.get("spark.sql.streaming.join.stateFormatVersion") == "2"       # set for the run alone


def test_queries_of_the_expiring_join_keep_large_state(spark, monkeypatch):
    # F9; expiring_pairs runs the same join.
    from quern.plans import streams
    runs = []
    monkeypatch.setattr(streams, "new_run", lambda *a, **k: runs.append(new_run(*a, **k)) or runs[-1])
    for query in (streams.unmatched_fares, streams.expiring_pairs):
        assert query(spark, SF_SMALL).count() > 0
        assert {r.stateStoreName for r in spark.read.format("state-metadata").load(runs[-1].checkpoint).collect()} == {"default"}
