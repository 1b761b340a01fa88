"""Stream operators (STR-*, FIL-10..12, JOIN-7..9, UDF-7/8).

Each function takes streaming DataFrames and returns a streaming DataFrame;
nothing starts here (see ``runner.run_to_table``). Every stateful operator is
keyed, so its state is hash-partitioned over ``spark.sql.shuffle.partitions``
tasks and grows with the number of open keys, not with the input.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.columns import exact_sum
from quern.streaming.pairing import pair_by_slots, payload, tagged_union

# Fixed values of the reference's stream jobs.
MAX_EVENT_DELAY = "60 seconds"
CHECKPOINT_INTERVAL = "10 seconds"


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """FIL-10 helper (UDF-6): point inside ``(west, east, south, north)``."""
    w, e, s, n = box
    return lon.between(w, e) & lat.between(s, n)


def cleanse_rides(rides: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """FIL-10: keep rides whose start *and* end lie inside the box (stateless)."""
    return rides.filter(in_box(F.col("start_lon"), F.col("start_lat"), box)
                        & in_box(F.col("end_lon"), F.col("end_lat"), box))


def hourly_tips(fares: DataFrame, delay: str = MAX_EVENT_DELAY) -> DataFrame:
    """STR-1..3, STR-5, UDF-7: tip sum per driver and event-time hour.

    Watermark = max event time − ``delay``; a window is emitted once (append)
    when the watermark passes its end, and later rows for it are dropped
    (no allowed lateness, as in the reference). Sums do not depend on order (``exact_sum``).
    """
    return (fares.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", "1 hour"), "driver_id")
            .agg(exact_sum("tip").alias("tips")))


def hourly_max(hourly: DataFrame) -> DataFrame:
    """STR-4: per hour, the driver row with the largest sum (ties: smallest driver).

    Chained event-time aggregation: the first window's ``window_time`` is the
    event time of the second. One group per hour, whose input is one row per
    driver and hour.
    """
    best = F.max_by(F.struct(F.col("driver_id"), F.col("tips")),
                    F.struct(F.col("tips"), -F.col("driver_id")))
    return (hourly.groupBy(F.window(F.window_time("window"), "1 hour").alias("hour"))
            .agg(best.alias("best"))
            .select(F.col("hour.end").alias("window_end"), F.col("best.driver_id").alias("driver_id"),
                    F.col("best.tips").alias("tips")))


# The bucket is the state's key, so the count must not change between runs on one
# checkpoint: it is a constant or the caller's, never taken from a session setting
# (see ``runner.state_buckets`` for a count stored with the run).
STATE_BUCKETS = 1024


def _payload_struct(df: DataFrame, name: str) -> list[Column]:
    """The columns beside id and time as one struct (none: no column)."""
    rest = payload(df)
    return [F.struct(*[F.col(f"`{c}`") for c in rest]).alias(name)] if rest else []


def _kept(*sides: tuple[DataFrame, str]) -> list[str]:
    return [name for df, name in sides if payload(df)]


def pair_rides_fares(rides: DataFrame, fares: DataFrame, method: str = "state",
                     buckets: int = STATE_BUCKETS) -> DataFrame:
    """JOIN-7 / STR-6 / UDF-8: one-to-one pairing by ride id, either side first,
    state kept until matched (trap T12: unmatched keys stay forever, as in the
    reference). Only ``matched`` rows are produced. The other columns of ride and fare come
    out as the structs ``ride`` and ``fare``, where there are any. Rows without a ride id pair with nothing.

    ``state``: exact slot semantics ("latest wins" on a repeated side, T11) with one
    state row per waiting ride id. ``join``: a stream-stream inner join (JVM only), the same
    result when each side has at most one row per ride id.
    """
    if method == "join":
        r = rides.select("ride_id", F.col("event_time").alias("ride_time"), *_payload_struct(rides, "ride"))
        f = fares.select(F.col("ride_id").alias("f_id"), F.col("event_time").alias("fare_time"),
                         *_payload_struct(fares, "fare"))
        j = r.join(f, F.col("ride_id") == F.col("f_id"), "inner")
        return j.select("ride_id", F.lit("matched").alias("status"), "ride_time", "fare_time",
                        *_kept((rides, "ride"), (fares, "fare")))
    return pair_by_slots(tagged_union(rides, fares), buckets, expire=False)


def pair_with_expiry(rides: DataFrame, fares: DataFrame, delay: str = MAX_EVENT_DELAY,
                     buckets: int = STATE_BUCKETS) -> DataFrame:
    """JOIN-8b / STR-7 / STR-8: arrival-order pairing with an event-time timer per ride id.

    A waiting row expires when the watermark passes its own event time; it
    is then emitted as ``unmatched_ride`` / ``unmatched_fare``. Rows older than
    the watermark are dropped before the function sees them, so ``delay`` is
    also the pairing horizon. Expiry has micro-batch granularity.
    """
    return pair_by_slots(tagged_union(rides, fares).withWatermark("event_time", delay), buckets, expire=True)


def _timed(df: DataFrame, name: str, delay: str) -> DataFrame:
    s = name[0]
    return df.select(F.col("ride_id").alias(f"{s}_id"), F.col("event_time").alias(f"{s}_time"),
                     *_payload_struct(df, name)).withWatermark(f"{s}_time", delay)


def _within(bound: str) -> Column:
    return ((F.col("r_id") == F.col("f_id"))
            & (F.col("f_time") >= F.col("r_time") - F.expr(f"INTERVAL {bound}"))
            & (F.col("f_time") <= F.col("r_time") + F.expr(f"INTERVAL {bound}")))


def expiring_join(rides: DataFrame, fares: DataFrame, bound: str = "60 days",
                  delay: str = MAX_EVENT_DELAY) -> DataFrame:
    """JOIN-8a: deterministic expiring pairing as a full outer
    stream-stream join: matched iff the fare lies within ``bound`` of the ride.

    State on both sides is evicted by the watermark plus the time bound; rows
    that found no partner by then come out as ``unmatched_ride`` /
    ``unmatched_fare``. ``side_outputs`` cuts the result into the tables of the three statuses.
    """
    j = _timed(rides, "ride", delay).join(_timed(fares, "fare", delay), _within(bound), "full_outer")
    status = (F.when(F.col("r_id").isNotNull() & F.col("f_id").isNotNull(), "matched")
              .when(F.col("r_id").isNotNull(), "unmatched_ride").otherwise("unmatched_fare"))
    return j.select(F.coalesce("r_id", "f_id").alias("ride_id"), status.alias("status"),
                    F.col("r_time").alias("ride_time"), F.col("f_time").alias("fare_time"),
                    *_kept((rides, "ride"), (fares, "fare")))


def unmatched_fares(rides: DataFrame, fares: DataFrame, bound: str = "60 days",
                    delay: str = MAX_EVENT_DELAY) -> DataFrame:
    """JOIN-9: the fares that no ride within ``bound`` met, as an outer join from their side alone.

    Pairs leave the plan where the join makes them, and rides without a fare are never emitted.
    """
    j = _timed(fares, "fare", delay).join(_timed(rides, "ride", delay), _within(bound), "left_outer")
    return j.where(F.col("r_id").isNull()).select(F.col("f_id").alias("ride_id"), F.col("f_time").alias("fare_time"),
                                                  *_kept((fares, "fare")))


def side_outputs() -> dict[str, Column]:
    """STR-8: a table for each status of a pairing, as ``runner.run_to_tables`` takes them."""
    return {"matched": F.col("status") == "matched", "unmatched_rides": F.col("status") == "unmatched_ride",
            "unmatched_fares": F.col("status") == "unmatched_fare"}


def read_state(spark, checkpoint: str, operator_id: int = 0, join_side: str | None = None,
               variable: str | None = None) -> DataFrame:
    """STR-11: read a stateful operator's state from its checkpoint (batch).

    Of an operator with state variables, one is read: ``variable``, else the first.
    """
    if variable is None:
        stores = spark.read.format("state-metadata").load(checkpoint).where(F.col("operatorId") == operator_id)
        held = json.loads(stores.first()["operatorProperties"] or "{}").get("stateVariables")
        variable = held[0]["stateName"] if held else None
    reader = spark.read.format("statestore").option("operatorId", str(operator_id))
    if join_side:
        reader = reader.option("joinSide", join_side)
    if variable:
        reader = reader.option("stateVarName", variable)
    return reader.load(checkpoint)
