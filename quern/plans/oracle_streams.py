"""DuckDB SQL equivalents of the registered stream queries (their batch form)."""

from __future__ import annotations

from quern.plans import streams as S

_W, _E, _SO, _N = S.BOX
_BOUND_DAYS = int(S.PAIRING_BOUND.split()[0])

_HOURLY = """SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, user_id AS driver_id,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS tips
FROM events GROUP BY 1, 2"""

_FARES = """SELECT l_orderkey AS f_id, min(l_shipdate) AS f_time,
       CAST(min(l_suppkey) AS BIGINT) AS driver_id, CAST(max(l_extendedprice) AS DOUBLE) AS tip FROM lineitem
GROUP BY l_orderkey"""

_RIDES = """SELECT o_orderkey AS r_id, o_orderdate AS r_time, CAST(o_custkey AS BIGINT) AS customer_id FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey % 1000 <> 0"""


def _expiring(cond: str) -> str:
    return f"""WITH r AS ({_RIDES}), f AS ({_FARES})
SELECT coalesce(r_id, f_id) AS ride_id,
       CASE WHEN r_id IS NOT NULL AND f_id IS NOT NULL THEN 'matched'
            WHEN r_id IS NOT NULL THEN 'unmatched_ride' ELSE 'unmatched_fare' END AS status,
       CAST(customer_id AS VARCHAR) AS customer_id, CAST(driver_id AS VARCHAR) AS driver_id, tip
FROM r FULL OUTER JOIN f ON {cond}"""


_EXPIRING = _expiring(f"r_id = f_id AND f_time BETWEEN r_time - INTERVAL {_BOUND_DAYS} DAY "
                      f"AND r_time + INTERVAL {_BOUND_DAYS} DAY")

STREAM_ORACLE_SQL: dict[str, str] = {
    "ride_cleansing": f"""
SELECT * FROM (
  SELECT vec_id AS ride_id, CAST(embedding[1] AS DOUBLE) AS start_lon,
         CAST(embedding[2] AS DOUBLE) AS start_lat, CAST(embedding[3] AS DOUBLE) AS end_lon,
         CAST(embedding[4] AS DOUBLE) AS end_lat FROM embeddings)
WHERE start_lon BETWEEN {_W} AND {_E} AND start_lat BETWEEN {_SO} AND {_N}
  AND end_lon BETWEEN {_W} AND {_E} AND end_lat BETWEEN {_SO} AND {_N}""",
    "hourly_tips": _HOURLY,
    "hourly_tips_user_window": _HOURLY,
    "hourly_max_tip": f"""WITH h AS ({_HOURLY})
SELECT window_end, driver_id, tips FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY tips DESC, driver_id) AS rn FROM h)
WHERE rn = 1""",
    "ride_fare_pairs": f"""
SELECT o_orderkey AS ride_id, o_orderdate AS ride_time, f.f_time AS fare_time,
       CAST(o_custkey AS BIGINT) AS customer_id, f.driver_id, f.tip
FROM orders JOIN ({_FARES}) f ON o_orderkey = f.f_id WHERE o_orderstatus = 'F'""",
    "expiring_pairs": _EXPIRING,
    "hourly_tips_resumed": _HOURLY,
    # What the first run's watermark left open: hours that end after the last fare less the delay.
    "hourly_tips_late": f"""WITH b AS (SELECT max(ts) AS hi, epoch_us(min(ts)) AS lo_us, epoch_us(max(ts)) AS hi_us FROM events)
SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, user_id AS driver_id,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS tips
FROM events, b
WHERE epoch_us(ts) >= (lo_us + hi_us) // 2
   OR date_trunc('hour', ts) + INTERVAL 1 HOUR > hi - INTERVAL {S.jobs.MAX_EVENT_DELAY}
GROUP BY 1, 2""",
    "waiting_rides": f"""
SELECT coalesce(r.o_orderkey, f.f_id) AS ride_id, CASE WHEN f.f_id IS NULL THEN 'ride' ELSE 'fare' END AS side
FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') r
FULL OUTER JOIN ({_FARES}) f ON r.o_orderkey = f.f_id
WHERE r.o_orderkey IS NULL OR f.f_id IS NULL""",
    "unmatched_fares": f"SELECT ride_id, driver_id, tip FROM ({_EXPIRING}) WHERE status = 'unmatched_fare'",
    # All input lands in one micro-batch here, so arrival order pairs every key
    # that has both sides; the rest times out unmatched.
    "expiring_pairs_keyed": _expiring("r_id = f_id"),
}
