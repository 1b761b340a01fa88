"""Views over the fixed tables that stand in for the reference's inputs.

Each view reads whole tables and only renames/derives columns, so its work
grows with the data; the mapping is spelled out in FIXTURES.md part B.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.sources.readers import FEW_SPLITS, coo_from_arrays, read_table, spread


def users(spark: SparkSession, sf: str) -> DataFrame:
    """User(id, age, social_contacts, gender) over ``customer``."""
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("age"),
        F.col("c_acctbal").alias("social_contacts"), F.col("c_mktsegment").alias("gender"))


def set_r(spark: SparkSession, sf: str) -> DataFrame:
    """R = customers of finished orders (a bag of keys)."""
    o = read_table(spark, sf, "orders")
    return o.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("key"))


def set_s(spark: SparkSession, sf: str) -> DataFrame:
    """S = customers of urgent orders (a bag of keys)."""
    o = read_table(spark, sf, "orders")
    return o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("key"))


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    """All embeddings as a COO matrix M(i = vec_id, j = dimension, v).

    v = round(x * 10000) as bigint, so products and sums are exact integers.
    """
    emb = spread(read_table(spark, sf, "embeddings").select("vec_id", "embedding"), FEW_SPLITS)
    return coo_from_arrays(emb, "vec_id", "embedding",
                           F.round(F.col("x").cast("double") * 10000).cast("bigint"))


def label_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Small matrix C(i = label, j, v = max of M over the label's vectors).

    Its size is labels × dimensions, independent of the row count.
    """
    emb = read_table(spark, sf, "embeddings")
    m = coo_from_arrays(emb.select(F.col("label").cast("long").alias("label"), "embedding"),
                        "label", "embedding",
                        F.round(F.col("x").cast("double") * 10000).cast("bigint"))
    return m.groupBy("i", "j").agg(F.max("v").alias("v"))


def vector(spark: SparkSession, sf: str) -> DataFrame:
    """Vector (j, v = j + 1) over the embedding dimensions, as many as the data has."""
    width = read_table(spark, sf, "embeddings").agg(F.max(F.size("embedding")).alias("n")).where("n > 0")
    j = width.select(F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("j"))
    return j.select(F.col("j").cast("long").alias("j"), (F.col("j") + 1).cast("long").alias("v"))


def trips(spark: SparkSession, sf: str) -> DataFrame:
    """Bike trips over ``lineitem`` (durations are whole numbers)."""
    li = read_table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("bike_id"),
                     F.col("l_partkey").alias("start_station_id"),
                     F.col("l_linenumber").cast("long").alias("end_station_id"),
                     F.col("l_quantity").cast("bigint").alias("duration"),
                     F.col("l_partkey").alias("zip_code"))


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Stations (id, lat, long) over ``embeddings`` (first two components)."""
    emb = read_table(spark, sf, "embeddings")
    return emb.select(F.col("vec_id").alias("id"),
                      F.col("embedding")[0].cast("double").alias("lat"),
                      F.col("embedding")[1].cast("double").alias("long"))


def geo_stations(spark: SparkSession, sf: str) -> DataFrame:
    """Stations scaled to degrees on the globe (lat × 90, long × 180)."""
    s = stations(spark, sf)
    return s.select("id", (F.col("lat") * 90.0).alias("lat"), (F.col("long") * 180.0).alias("long"))


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts (creation_date, tags) over ``lineitem`` ⋈ ``part``.

    ``part`` is joined on its key; the join is left to Catalyst/AQE (broadcast
    only when the runtime size is under the threshold, shuffle join beyond).
    """
    li = spread(read_table(spark, sf, "lineitem").select("l_partkey", "l_shipdate"), FEW_SPLITS)
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(F.col("l_shipdate").alias("creation_date"),
                    F.concat(F.lit("<"), F.lower("p_brand"), F.lit("><"), F.lower("p_type"),
                             F.lit(">")).alias("tags"))


def languages(spark: SparkSession, sf: str) -> DataFrame:
    """Language list (name, ordinal): distinct brands; list order is name order.

    The ordinal only has to order the list, so the name itself serves as it
    (no global numbering pass through one task).
    """
    b = read_table(spark, sf, "part").select(F.col("p_brand").alias("name")).distinct()
    return b.select("name", F.col("name").alias("ordinal"))


def fares(spark: SparkSession, sf: str) -> DataFrame:
    """Taxi fares (driver_id, tip, event_time) over ``events``."""
    ev = read_table(spark, sf, "events")
    return ev.select(F.col("user_id").alias("driver_id"), F.col("value").alias("tip"),
                     F.col("ts").cast("timestamp").alias("event_time"))


def fares_of_ride(spark: SparkSession, sf: str) -> DataFrame:
    """One fare per ride, over all line items of an order: the earliest ship date, the
    smallest supplier as driver and the largest price as tip."""
    li = read_table(spark, sf, "lineitem")
    return (li.groupBy(F.col("l_orderkey").alias("ride_id"))
              .agg(F.min("l_shipdate").cast("timestamp").alias("event_time"),
                   F.min("l_suppkey").cast("long").alias("driver_id"),
                   F.max("l_extendedprice").cast("double").alias("tip")))
