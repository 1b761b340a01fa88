"""Stream semantics: late rows, slot overwrite, expiry, restart from a checkpoint."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.session import scratch_path
from quern.sources.readers import read_stream
from quern.streaming import jobs
from quern.streaming.runner import StreamRun, run_to_table

FARE = T.StructType([T.StructField("driver_id", T.LongType()), T.StructField("tip", T.DoubleType()),
                     T.StructField("event_time", T.TimestampType())])
KEYED = T.StructType([T.StructField("ride_id", T.LongType()),
                      T.StructField("event_time", T.TimestampType())])
END = dt.datetime(2100, 1, 1)


def _t(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def _write(spark, directory, rows, schema, name):
    """One Parquet file per call, with an increasing modification time."""
    tmp = f"{directory}/_tmp_{name}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp)
    part = [f for f in os.listdir(tmp) if f.endswith(".parquet")][0]
    target = f"{directory}/{name}.parquet"
    os.rename(f"{tmp}/{part}", target)
    stamp = time.time() + len(os.listdir(directory))
    os.utime(target, (stamp, stamp))


def _run(spark, kind):
    base = scratch_path(spark, kind)
    return StreamRun(sink=f"{base}/sink", checkpoint=f"{base}/checkpoint"), base


def _hourly(spark, src):
    s = read_stream(spark, src, FARE, file_glob="*.parquet", files_per_trigger=1)
    h = jobs.hourly_tips(s).select(F.col("window.end").alias("window_end"), "driver_id", "tips")
    return h


def test_late_row_is_dropped_from_closed_window(spark):
    # STR-1, STR-3, STR-5, SRC-12
    run, base = _run(spark, "late")
    src = f"{base}/in"
    os.makedirs(src)
    _write(spark, src, [(1, 1.0, _t(0, 10)), (1, 2.0, _t(1, 30)), (2, 1.0, _t(3, 0))], FARE, "a")
    # Spark drops a row as late against the previous batch's watermark: this
    # batch emits hours 0 and 1, so the next file's hour-0 row comes too late.
    _write(spark, src, [(2, 1.0, _t(3, 30))], FARE, "a2")
    _write(spark, src, [(1, 5.0, _t(0, 20))], FARE, "b")       # late: hour 0 closed
    _write(spark, src, [(-1, 0.0, END)], FARE, "c")            # end of input
    out = run_to_table(spark, _hourly(spark, src), run).filter("driver_id >= 0")
    got = {(r.window_end.hour, r.driver_id): float(r.tips) for r in out.collect()}
    assert got == {(1, 1): 1.0, (2, 1): 2.0, (4, 2): 2.0}


def test_restart_from_checkpoint_gives_same_rows(spark):
    # STR-10
    run, base = _run(spark, "restart")
    src = f"{base}/in"
    os.makedirs(src)
    _write(spark, src, [(1, 1.0, _t(0, 10)), (2, 3.0, _t(0, 50))], FARE, "a")
    first = run_to_table(spark, _hourly(spark, src), run)
    assert first.count() == 0          # nothing closed yet; state is in the checkpoint
    _write(spark, src, [(1, 2.0, _t(0, 40)), (1, 4.0, _t(2, 0))], FARE, "b")
    _write(spark, src, [(-1, 0.0, END)], FARE, "c")
    resumed = run_to_table(spark, _hourly(spark, src), run).filter("driver_id >= 0")
    one_run, _ = _run(spark, "restart-one")
    single = run_to_table(spark, _hourly(spark, src), one_run).filter("driver_id >= 0")
    key = lambda r: (r.window_end, r.driver_id, float(r.tips))
    assert sorted(map(key, resumed.collect())) == sorted(map(key, single.collect()))
    assert sorted((r.driver_id, float(r.tips)) for r in single.collect()) == [(1, 3.0), (1, 4.0), (2, 3.0)]


def test_hourly_max_picks_smallest_driver_on_tie(spark):
    # STR-4, UDF-7
    run, base = _run(spark, "max")
    src = f"{base}/in"
    os.makedirs(src)
    _write(spark, src, [(5, 2.0, _t(0, 10)), (3, 2.0, _t(0, 20)), (4, 1.0, _t(0, 30)),
                        (4, 9.0, _t(1, 30))], FARE, "a")
    _write(spark, src, [(-1, 0.0, END)], FARE, "b")
    s = read_stream(spark, src, FARE, file_glob="*.parquet")
    out = run_to_table(spark, jobs.hourly_max(jobs.hourly_tips(s)), run).filter("driver_id >= 0")
    got = sorted((r.window_end.hour, r.driver_id, float(r.tips)) for r in out.collect())
    assert got == [(1, 3, 2.0), (2, 4, 9.0)]


def _pair_inputs(spark, base, rides, fares):
    rdir, fdir = f"{base}/rides", f"{base}/fares"
    os.makedirs(rdir)
    os.makedirs(fdir)
    _write(spark, rdir, rides + [(-1, END)], KEYED, "r")
    _write(spark, fdir, fares + [(-2, END)], KEYED, "f")
    return read_stream(spark, rdir, KEYED), read_stream(spark, fdir, KEYED)


def test_pairing_latest_ride_wins(spark):
    # JOIN-7, STR-6, STR-9, STR-11, UDF-8, SRC-11
    run, base = _run(spark, "pair")
    r, f = _pair_inputs(spark, base, [(1, _t(0)), (1, _t(1))], [(1, _t(2))])
    out = run_to_table(spark, jobs.pair_rides_fares(r, f), run)
    rows = [x for x in out.collect() if x.ride_id == 1]
    assert [(x.status, x.ride_time.hour, x.fare_time.hour) for x in rows] == [("matched", 1, 2)]
    # STR-11: the unmatched end markers are still held in the keyed state
    state = jobs.read_state(spark, run.checkpoint)
    assert state.count() >= 1


def test_expiry_statuses_keyed_and_join(spark):
    # JOIN-8, JOIN-9, STR-7, STR-8
    rides = [(2, _t(0)), (3, _t(1))]
    fares = [(1, _t(0)), (3, _t(2))]
    run, base = _run(spark, "expire")
    r, f = _pair_inputs(spark, base, rides, fares)
    keyed = run_to_table(spark, jobs.pair_with_expiry(r, f), run).filter("ride_id >= 0")
    want = {(1, "unmatched_fare"), (2, "unmatched_ride"), (3, "matched")}
    assert {(x.ride_id, x.status) for x in keyed.collect()} == want
    run2, base2 = _run(spark, "expire-join")
    r2, f2 = _pair_inputs(spark, base2, rides, fares)
    joined = run_to_table(spark, jobs.expiring_join(r2, f2, "1 hour"), run2).filter("ride_id >= 0")
    assert {(x.ride_id, x.status) for x in joined.collect()} == want


def test_cleansing_box(spark):
    # FIL-10, UDF-6
    rows = [(1, 0.0, 0.0, 0.05, 0.05), (2, 0.0, 0.0, 0.5, 0.0), (3, -0.1, 0.1, 0.1, -0.1)]
    df = spark.createDataFrame(rows, "ride_id long, start_lon double, start_lat double, "
                                     "end_lon double, end_lat double")
    out = jobs.cleanse_rides(df, (-0.1, 0.1, -0.1, 0.1))
    assert sorted(r.ride_id for r in out.collect()) == [1, 3]


def test_memory_sink_and_processing_time_trigger(spark):
    # SNK-2, STR-10
    from quern.streaming.runner import start_stream
    run, base = _run(spark, "mem")
    src = f"{base}/in"
    os.makedirs(src)
    _write(spark, src, [(1, 1.0, _t(0, 10)), (2, 2.0, _t(0, 20))], FARE, "a")
    s = read_stream(spark, src, FARE, file_glob="*.parquet")
    q = start_stream(jobs.cleanse_rides(
        s.select(F.col("driver_id").alias("ride_id"), F.lit(0.0).alias("start_lon"),
                 F.lit(0.0).alias("start_lat"), F.col("tip").alias("end_lon"),
                 F.lit(0.0).alias("end_lat")), (-1.5, 1.5, -1.0, 1.0)),
        run, fmt="memory", processing_time="1 second", query_name="cleansed_mem")
    try:
        q.processAllAvailable()
        assert [r.ride_id for r in spark.sql("SELECT ride_id FROM cleansed_mem").collect()] == [1]
    finally:
        q.stop()
    assert os.path.isdir(run.checkpoint)      # kept after stop (STR-10)


def test_pairing_join_form_equals_state_form_on_unique_keys(spark):
    # JOIN-7, FIL-11, STR-2
    rides = [(1, _t(0)), (2, _t(1)), (4, _t(2))]
    fares = [(1, _t(3)), (2, _t(0)), (3, _t(1))]
    got = {}
    for method in ("state", "join"):
        run, base = _run(spark, f"pair-{method}")
        r, f = _pair_inputs(spark, base, rides, fares)
        out = run_to_table(spark, jobs.pair_rides_fares(r, f, method=method), run)
        got[method] = sorted((x.ride_id, x.ride_time, x.fare_time) for x in out.collect()
                             if x.ride_id >= 0 and x.status == "matched")
    assert got["state"] == got["join"] and [g[0] for g in got["join"]] == [1, 2]


def test_expiry_with_one_state_bucket_mixes_statuses_in_one_frame(spark):
    # JOIN-8, STR-7
    # all ride ids share one bucket, so matched and unmatched rows (with missing
    # times) leave the state function in the same frame
    rides = [(2, _t(0)), (3, _t(1)), (5, _t(1))]
    fares = [(1, _t(0)), (3, _t(2)), (6, _t(3))]
    run, base = _run(spark, "expire-one-bucket")
    r, f = _pair_inputs(spark, base, rides, fares)
    out = run_to_table(spark, jobs.pair_with_expiry(r, f, buckets=1), run).filter("ride_id >= 0")
    got = {(x.ride_id, x.status, x.ride_time is None, x.fare_time is None) for x in out.collect()}
    assert got == {(1, "unmatched_fare", True, False), (2, "unmatched_ride", False, True),
                   (3, "matched", False, False), (5, "unmatched_ride", False, True),
                   (6, "unmatched_fare", True, False)}


def test_join_state_is_readable_per_side(spark):
    # STR-11: the end markers still wait in the join state after the run
    run, base = _run(spark, "join-state")
    r, f = _pair_inputs(spark, base, [(1, _t(0))], [(1, _t(1))])
    out = run_to_table(spark, jobs.expiring_join(r, f, "1 hour"), run)
    assert {(x.ride_id, x.status) for x in out.collect()} == {(1, "matched")}
    left = jobs.read_state(spark, run.checkpoint, join_side="left")
    right = jobs.read_state(spark, run.checkpoint, join_side="right")
    assert left.count() >= 1 and right.count() >= 1
