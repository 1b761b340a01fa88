"""Registered stream queries: real ``availableNow`` runs over file streams of the
fixture tables, returned as the batch table of their sink.

Every run gets a fresh sink and checkpoint under the shared checkpoint folder.
A one-row end-of-input marker (key −1 / −2, far-future event time) closes the
last windows and expires the last join state; it is filtered from the result.
Event times are TIMESTAMP inside the stream and NTZ again in the result, as in
the tables.
"""

from __future__ import annotations

import datetime as dt
from decimal import Context, Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.columns import not_every_nth
from quern.sources.readers import read_stream, write_parquet
from quern.sources import fixtures as fx
from quern.streaming import jobs
from quern.streaming.pairing import waiting_ids
from quern.streaming.windows import WindowFunction, window_aggregate
from quern.streaming.runner import (drain, fixture_stream, new_run, run_to_table, run_to_tables, sentinel_stream,
                                    state_buckets)

# Fixed parameters of the registered stream queries.
_EXACT = Context(prec=60)                # sums of decimal(38,18) without rounding
BOX = (-0.1, 0.1, -0.1, 0.1)            # west, east, south, north
PAIRING_BOUND = "60 days"
END_OF_INPUT = dt.datetime(2100, 1, 1)

_FARE = T.StructType([T.StructField("driver_id", T.LongType()), T.StructField("tip", T.DoubleType()),
                      T.StructField("event_time", T.TimestampType())])
_RIDE = T.StructType([T.StructField("ride_id", T.LongType()), T.StructField("event_time", T.TimestampType()),
                      T.StructField("customer_id", T.LongType())])
_FARE_OF_RIDE = T.StructType([T.StructField("ride_id", T.LongType()), T.StructField("event_time", T.TimestampType()),
                              T.StructField("driver_id", T.LongType()), T.StructField("tip", T.DoubleType())])


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


def _fare_stream(spark, sf, run):
    ev = fixture_stream(spark, sf, "events")
    fares = ev.select(F.col("user_id").alias("driver_id"), F.col("value").alias("tip"),
                      F.col("ts").cast("timestamp").alias("event_time"))
    end = sentinel_stream(spark, run, _FARE, {"driver_id": -1, "tip": 0.0, "event_time": END_OF_INPUT})
    return fares.unionByName(end)


def ride_cleansing(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-10 (Cleansing): rides starting and ending inside the box."""
    run = new_run(spark, "cleansing")
    e = F.col("embedding")
    pts = fixture_stream(spark, sf, "embeddings").select(
        F.col("vec_id").alias("ride_id"), e[0].cast("double").alias("start_lon"),
        e[1].cast("double").alias("start_lat"), e[2].cast("double").alias("end_lon"),
        e[3].cast("double").alias("end_lat"))
    return run_to_table(spark, jobs.cleanse_rides(pts, BOX), run, query_name=None)


def hourly_tips(spark: SparkSession, sf: str) -> DataFrame:
    """STR-1..3 (Tips, first stage): tips per driver and hour."""
    run = new_run(spark, "hourly-tips")
    h = jobs.hourly_tips(_fare_stream(spark, sf, run))
    h = h.select(F.col("window.end").alias("window_end"), "driver_id", "tips")
    out = run_to_table(spark, h, run)
    return out.filter(F.col("driver_id") >= 0).select(
        _ntz("window_end"), "driver_id", F.col("tips").cast("double").alias("tips"))


def hourly_max_tip(spark: SparkSession, sf: str) -> DataFrame:
    """STR-4 (Tips, both stages): the driver with the most tips in each hour."""
    run = new_run(spark, "hourly-max")
    m = jobs.hourly_max(jobs.hourly_tips(_fare_stream(spark, sf, run)))
    out = run_to_table(spark, m, run)
    return out.filter(F.col("driver_id") >= 0).select(
        _ntz("window_end"), "driver_id", F.col("tips").cast("double").alias("tips"))


class TipTotal(WindowFunction):
    """The tips of a driver's window, added up exactly."""

    accumulator = "total decimal(38,18)"
    output = "tips decimal(38,18)"

    def zero(self) -> tuple:
        return (Decimal(0),)

    def add(self, acc: tuple, row) -> tuple:
        return acc if row["tip"] is None else self.merge(acc, (row["tip"],))

    def merge(self, a: tuple, b: tuple) -> tuple:
        return (_EXACT.add(a[0], b[0]),)

    def result(self, key, start_ms: int, end_ms: int, acc: tuple) -> tuple:
        return acc


def hourly_tips_user_window(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-7 + STR-3: tips per driver and hour through a user's window function, closed by the watermark."""
    run = new_run(spark, "hourly-user", large_state=True)
    fares = _fare_stream(spark, sf, run).withColumn("tip", F.col("tip").try_cast("decimal(38,18)"))
    h = window_aggregate(fares, "driver_id", TipTotal(), "1 hour", jobs.MAX_EVENT_DELAY)
    out = run_to_table(spark, h, run)
    return out.filter(F.col("driver_id") >= 0).select(
        _ntz("window_end"), "driver_id", F.col("tips").cast("double").alias("tips"))


def _tips_of_halves(spark, sf, name: str, early_first: bool) -> DataFrame:
    """Hourly tips of a stream whose first half is drained before the second arrives.

    The fares are cut at the middle of their time span; the second half lands in the
    stream's folder after the first run ended, and the job starts again on its checkpoint.
    """
    run = new_run(spark, name)
    folder = f"{run.sink.rsplit('/', 1)[0]}/halves"
    ev = fx.fares(spark, sf)
    us = F.unix_micros("event_time")
    cut = ev.select(F.min(us).alias("lo"), F.max(us).alias("hi")) \
            .select(F.floor((F.col("lo") + F.col("hi")) / 2).alias("cut")).scalar()
    halves = [ev.filter(us < cut), ev.filter(us >= cut)]
    first, second = halves if early_first else halves[::-1]
    write_parquet(first, folder)
    end = sentinel_stream(spark, run, _FARE, {"driver_id": -1, "tip": 0.0, "event_time": END_OF_INPUT})
    h = jobs.hourly_tips(read_stream(spark, folder, _FARE).unionByName(end)) \
            .select(F.col("window.end").alias("window_end"), "driver_id", "tips")
    drain(h, run)
    write_parquet(second, folder, mode="append")
    out = run_to_table(spark, h, run)
    return out.filter(F.col("driver_id") >= 0).select(
        _ntz("window_end"), "driver_id", F.col("tips").cast("double").alias("tips"))


def hourly_tips_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """STR-10: hourly tips over two runs on one checkpoint; the hour cut in two is whole again."""
    return _tips_of_halves(spark, sf, "hourly-resumed", early_first=True)


def hourly_tips_late(spark: SparkSession, sf: str) -> DataFrame:
    """STR-5: the earlier half arrives late; rows of hours the watermark has closed are dropped."""
    return _tips_of_halves(spark, sf, "hourly-late", early_first=False)


def _ride_stream(spark, sf, drop_every: int | None = None):
    o = fixture_stream(spark, sf, "orders")
    r = o.filter(F.col("o_orderstatus") == "F")                     # FIL-11: isStart
    if drop_every:
        r = r.filter(not_every_nth("o_orderkey", drop_every))      # FIL-12, FN-8
    return r.select(F.col("o_orderkey").alias("ride_id"),
                    F.col("o_orderdate").cast("timestamp").alias("event_time"),
                    F.col("o_custkey").cast("long").alias("customer_id"))


# Ids that a status row may lack, as text: a missing integer has no one form in client frames.
def _ids() -> list[F.Column]:
    return [F.col(c).cast("string").alias(c.split(".")[1]) for c in ("ride.customer_id", "fare.driver_id")]


def _staged_fares(spark, sf, run):
    """Fares stream over a staged table that Spark derives from ``lineitem``
    (one fare per ride), written once next to the run's sink."""
    path = f"{run.sink.rsplit('/', 1)[0]}/fares"
    write_parquet(fx.fares_of_ride(spark, sf), path)
    return read_stream(spark, path, _FARE_OF_RIDE)


def ride_fare_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-7 (Pairing): rides paired with their fare, keyed state without expiry."""
    run = new_run(spark, "pairing")
    pairs = jobs.pair_rides_fares(_ride_stream(spark, sf), _staged_fares(spark, sf, run),
                                  buckets=state_buckets(spark, run))
    out = run_to_table(spark, pairs, run, query_name=None)
    return out.select("ride_id", _ntz("ride_time"), _ntz("fare_time"), "ride.customer_id", "fare.driver_id", "fare.tip")


def _expiring_inputs(spark, sf, run):
    rides = _ride_stream(spark, sf, drop_every=1000).unionByName(
        sentinel_stream(spark, run, _RIDE, {"ride_id": -1, "event_time": END_OF_INPUT}, "end-rides"))
    fares = _staged_fares(spark, sf, run).unionByName(
        sentinel_stream(spark, run, _FARE_OF_RIDE, {"ride_id": -2, "event_time": END_OF_INPUT}, "end-fares"))
    return rides, fares


def expiring_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-11 + FIL-12 + JOIN-8a + STR-8: pairs, unmatched rides and unmatched fares
    within a 60-day bound, each from its own table."""
    run = new_run(spark, "expiring", large_state=True)
    rides, fares = _expiring_inputs(spark, sf, run)
    tables = run_to_tables(spark, jobs.expiring_join(rides, fares, PAIRING_BOUND), run, jobs.side_outputs())
    out = tables["matched"].unionByName(tables["unmatched_rides"]).unionByName(tables["unmatched_fares"])
    return out.filter(F.col("ride_id") >= 0).select("ride_id", "status", *_ids(), "fare.tip")


def unmatched_fares(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-9: the side output the reference prints — fares without a ride, the only rows this run stores."""
    run = new_run(spark, "unmatched-fares", large_state=True)
    rides, fares = _expiring_inputs(spark, sf, run)
    out = run_to_table(spark, jobs.unmatched_fares(rides, fares, PAIRING_BOUND), run)
    return out.filter(F.col("ride_id") >= 0).select("ride_id", "fare.driver_id", "fare.tip")


def expiring_pairs_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-8b: arrival-order pairing with a state row and an event-time timer per ride id."""
    run = new_run(spark, "expiring-keyed")
    rides, fares = _expiring_inputs(spark, sf, run)
    out = run_to_table(spark, jobs.pair_with_expiry(rides, fares, buckets=state_buckets(spark, run)), run)
    return out.filter(F.col("ride_id") >= 0).select("ride_id", "status", *_ids(), "fare.tip")


def waiting_rides(spark: SparkSession, sf: str) -> DataFrame:
    """STR-11: the pairing's state read from its checkpoint: ids that wait for their other side."""
    run = new_run(spark, "waiting")
    pairs = jobs.pair_rides_fares(_ride_stream(spark, sf), _staged_fares(spark, sf, run),
                                  buckets=state_buckets(spark, run))
    run_to_table(spark, pairs, run, query_name=None)
    return waiting_ids(jobs.read_state(spark, run.checkpoint, variable="slots"))
