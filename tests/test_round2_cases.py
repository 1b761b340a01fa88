"""Conditions the fixture tables do not have: folders, several micro-batches, nulls, constants."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.functions.columns import equal_width_bucket
from quern.operators import geo, keyed, matrix, relational
from quern.plans import streams
from quern.sources.readers import read_stream
from quern.streaming import jobs, runner
from quern.streaming.runner import new_run, run_to_table, state_buckets


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    """``events`` of the smallest tables as four files in time order."""
    base = tmp_path_factory.mktemp("folder")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    cuts = [None, *ev.select(F.col("ts").cast("timestamp").cast("double").alias("t")).approxQuantile("t", [0.25, 0.5, 0.75], 0.0), None]
    t = F.col("ts").cast("timestamp").cast("double")
    for low, high in zip(cuts, cuts[1:]):        # one after the other: a stream reads files by age
        part = ev.where((F.lit(True) if low is None else t > low) & (F.lit(True) if high is None else t <= high))
        part.coalesce(1).write.mode("append").parquet(f"{base}/events.parquet")
    return str(base)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_stream_reads_folder_and_single_file_alike(spark, folder_tables):
    assert _rows(streams.hourly_tips(spark, folder_tables)) == _rows(streams.hourly_tips(spark, "/root/testdata/sf0.001"))


def test_end_marker_waits_for_every_micro_batch(spark, folder_tables, monkeypatch):
    whole = _rows(streams.hourly_tips(spark, folder_tables))
    plain = runner.fixture_stream
    monkeypatch.setattr(streams, "fixture_stream", lambda s, sf, t: plain(s, sf, t, files_per_trigger=1))
    split = _rows(streams.hourly_tips(spark, folder_tables))
    assert len(split) == len(whole) and split == whole


def test_time_limit_raises(spark, folder_tables):
    run = runner.new_run(spark, "limit")
    slow = runner.fixture_stream(spark, folder_tables, "events", files_per_trigger=1)
    with pytest.raises(TimeoutError):
        runner.run_to_table(spark, slow, run, timeout_s=0.01)


def test_null_keys_are_a_group(spark):
    df = spark.createDataFrame([("a",), (None,), (None,), ("b",)], "k string")

    def count(key, pdf):
        return pd.DataFrame({"k": [key[0] if isinstance(key[0], str) else None], "n": [len(pdf)]})

    out = keyed.keyed_map_reduce(df, lambda p: p, "k string", "k", count, "k string, n long")
    assert sorted(((r.k or "", r.n) for r in out.collect())) == [("", 2), ("a", 1), ("b", 1)]


def test_constant_column_has_one_bucket(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.b for r in df.select(equal_width_bucket("v", F.lit(3.0), F.lit(3.0), 5).alias("b")).collect()] == [0, 0]


def test_mean_keeps_small_and_large_values(spark):
    def mean(values):
        return relational.global_mean(spark.createDataFrame([(v,) for v in values], "v double"), "v").first().mean
    assert mean([0.001, 0.004, 0.004]) == 0.009 / 3
    assert mean([1e17, 3e17]) == 2e17
    assert mean([1e30, 3e30]) == 2e30


def test_dense_rows_of_zeros(spark):
    p = spark.createDataFrame([(0, 1, 5), (2, 0, 7)], "i long, k long, p long")
    rows = {r.i: list(r.cells) for r in matrix.to_dense(p).collect()}
    assert rows == {0: [0, 5], 1: [0, 0], 2: [7, 0]}
    assert matrix.to_dense(p.limit(0)).count() == 0
    shape = spark.createDataFrame([(4, 3)], "rows long, width long")
    wide = {r.i: r.cells for r in matrix.to_dense(p, as_text=True, shape=shape).collect()}
    assert wide == {0: "0,5,0", 1: "0,0,0", 2: "7,0,0", 3: "0,0,0"}


def test_farthest_pair_round_the_globe(spark):
    rng = np.random.default_rng(5)
    n = 3000
    lat, lon = np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    pdf = pd.DataFrame({"id": np.arange(n), "lat": lat, "long": lon})
    got = geo.farthest_pair(spark.createDataFrame(pdf), metric="haversine").first()
    best = max((geo._great_circle(lat[i], lon[i], lat[i + 1:], lon[i + 1:]).max(), -i) for i in range(n - 1))
    i = -best[1]
    j = i + 1 + int(np.argmax(geo._great_circle(lat[i], lon[i], lat[i + 1:], lon[i + 1:])))
    assert (got.station_a, got.station_b) == (i, j)


def test_user_partitioner_is_the_partition_number(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("k"), F.lit(1).alias("n"))
    out = keyed.keyed_map_reduce(df, lambda p: p, "k long, n int", "k", lambda p: p.groupby("k", as_index=False)["n"].sum(),
                                 "k long, n int", num_partitions=3, partitioner=F.col("k") % 3, vectorized_reduce=True)
    rows = out.select("k", "n", F.spark_partition_id().alias("part")).collect()
    assert len(rows) == 10 and all(r.part == r.k % 3 and r.n == 10 for r in rows)


def test_wide_partials_are_handed_on(spark, monkeypatch):
    monkeypatch.setattr(keyed, "PARTIAL_ROWS", 3)
    fold = keyed._map_and_combine(lambda p: p, lambda p: p.groupby("k", as_index=False)["n"].sum())
    frames = [pd.DataFrame({"k": [i, i + 1], "n": [1, 1]}) for i in range(8)]
    out = list(fold(iter(frames)))
    assert len(out) > 1 and pd.concat(out)["n"].sum() == 16


def test_keyed_pairing_restarts_under_other_settings(spark, tmp_path):
    schema = "ride_id long, event_time timestamp, note string"
    t = dt.datetime(2024, 1, 1)
    rides, fares = str(tmp_path / "rides"), str(tmp_path / "fares")
    spark.createDataFrame([(i, t, f"r{i}") for i in range(200)], schema).write.parquet(rides)
    spark.createDataFrame([], schema).write.parquet(fares)
    run = new_run(spark, "restart")
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def once():
        streams = [read_stream(spark, p, spark.read.parquet(p).schema) for p in (rides, fares)]
        return run_to_table(spark, jobs.pair_rides_fares(*streams, buckets=state_buckets(spark, run)), run)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert once().count() == 0
        spark.createDataFrame([(i, t, f"f{i}") for i in range(200)], schema).write.mode("append").parquet(fares)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        out = once()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got = out.select("ride_id", F.col("ride.note").alias("r"),
                     F.col("fare.note").alias("f")).collect()
    assert len(got) == 200 and all(r.r == f"r{r.ride_id}" and r.f == f"f{r.ride_id}" for r in got)


def test_grouped_map_reduces_hot_null_and_placed_keys(spark):
    # UDF-1, UDF-2: one key holds most rows; a user partitioner needs one shuffle only
    df = spark.createDataFrame([("a", 1)] * 900 + [(None, 1)] * 60 + [("b", 1)] * 40, "k string, v long")

    def total(key, g):
        return pd.DataFrame({"k": [key[0]], "v": [g["v"].sum()]})

    for partitioner in ("hash", "range", F.when(F.col("k") == "a", 0).otherwise(1)):
        out = keyed.keyed_map_reduce(df, lambda p: p, "k string, v long", "k", total, "k string, v long",
                                     num_partitions=3, partitioner=partitioner)
        assert {r.k: r.v for r in out.collect()} == {"a": 900, None: 60, "b": 40}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1


def test_report_and_bikes_come_in_order(spark):
    # SRT-1, SRT-2
    from quern.plans import batch
    rep = [(r.year, r.n_posts, -r["rank"]) for r in batch.top_languages_report(spark, "/root/testdata/sf0.001").collect()]
    assert rep == sorted(rep, reverse=True) and len({y for y, _, _ in rep}) > 1
    bikes = [(r.duration, r.bike_id) for r in batch.bikes_by_total(spark, "/root/testdata/sf0.001").collect()]
    assert bikes == sorted(bikes, reverse=True)


def test_readers_take_inference_and_timestamp_format(spark, tmp_path):
    # SRC-7, SRC-8
    from quern.sources.readers import read_csv, read_xml_rows
    (tmp_path / "a.csv").write_text("id,at\n7,31/12/2020 10:05\n")
    row = read_csv(spark, str(tmp_path / "a.csv"), infer_schema=True, timestamp_format="dd/MM/yyyy HH:mm").first()
    assert (row.id, row.at) == (7, dt.datetime(2020, 12, 31, 10, 5))
    (tmp_path / "a.xml").write_text('<rows><row At="31/12/2020 10:05"/></rows>')
    got = read_xml_rows(spark, str(tmp_path / "a.xml"), "_At timestamp", timestamp_format="dd/MM/yyyy HH:mm").first()
    assert got[0] == dt.datetime(2020, 12, 31, 10, 5)
