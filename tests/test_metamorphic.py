"""Plan-independence checks: partitioning, combiner, broadcast vs shuffle, pruning."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quern.operators import geo, keyed, matrix

RNG = np.random.default_rng(7)


def _coo(spark, arr, name="v"):
    rows = [(int(i), int(j), float(arr[i, j])) for i in range(arr.shape[0])
            for j in range(arr.shape[1]) if arr[i, j] != 0]
    return spark.createDataFrame(rows, f"i long, j long, {name} double").withColumnRenamed(name, "v")


def _dense(df, shape, col="p"):
    out = np.zeros(shape)
    for r in df.collect():
        out[r.i, r.k] = r[col]
    return out


@pytest.mark.parametrize("strategy", ["broadcast", "broadcast_left", "join"])
def test_matmul_matches_numpy(spark, strategy):
    # MAT-3, MAT-4, MAT-5, JOIN-4, JOIN-5
    a, b = RNG.random((3, 4)), RNG.random((4, 5))
    a[0, 1] = 0.0                                 # sparse cell left out
    p = matrix.matmul(_coo(spark, a), matrix.as_right(_coo(spark, b)), strategy)
    assert np.allclose(_dense(p, (3, 5)), a @ b)


def test_matmul_scattered_and_salted_equal(spark):
    # MAT-6, MAT-7
    a, b = RNG.random((6, 3)), RNG.random((3, 4))
    ca, cb = _coo(spark, a).repartition(7), matrix.as_right(_coo(spark, b)).repartition(5)
    p1 = matrix.matmul(ca, cb, "join")
    p2 = matrix.matmul(ca, cb, "join", salts=3)
    assert matrix.allclose(p1, p2).first().ok
    assert np.allclose(_dense(p2, (6, 4)), a @ b)


def test_matvec_broadcast_equals_shuffle(spark):
    # MAT-1, MAT-2, JOIN-3
    m, v = RNG.random((5, 4)), RNG.random(4)
    cm = _coo(spark, m)
    cv = spark.createDataFrame([(j, float(v[j])) for j in range(4)], "j long, v double")
    s1 = {r.i: r.s for r in matrix.matvec(cm, cv, "broadcast").collect()}
    s2 = {r.i: r.s for r in matrix.matvec(cm, cv, "shuffle", salts=3).collect()}
    want = m @ v
    assert all(math.isclose(s1[i], want[i]) and math.isclose(s2[i], want[i]) for i in range(5))


def test_dense_and_allclose(spark):
    # AGG-11, MAT-7
    p = spark.createDataFrame([(0, 0, 1), (0, 2, 3), (1, 1, 4)], "i long, k long, p long")
    rows = {r.i: r.cells for r in matrix.to_dense(p).collect()}
    assert rows == {0: [1, 0, 3], 1: [0, 4, 0]}
    q = spark.createDataFrame([(0, 0, 1), (0, 2, 3), (1, 1, 5)], "i long, k long, p long")
    assert matrix.allclose(p, p).first().ok
    assert not matrix.allclose(p, q).first().ok


def _brute(pts, metric):
    best = (-1.0, None)
    for (ia, la, oa), (ib, lb, ob) in itertools.combinations(sorted(pts), 2):
        if metric == "degrees":
            d = math.sqrt((la - lb) ** 2 + (oa - ob) ** 2)
        else:
            p1, p2 = math.radians(la), math.radians(lb)
            h = (math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2)
                 * math.sin((math.radians(ob) - math.radians(oa)) / 2) ** 2)
            d = 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))
        if d > best[0] + 1e-12:
            best = (d, (min(ia, ib), max(ia, ib)))
    return best


@pytest.mark.parametrize("metric,scale", [("degrees", 1.0), ("haversine", 60.0)])
def test_farthest_pair_matches_brute_force(spark, metric, scale):
    # GEO-1, JOIN-2, FN-6, FN-7, AGG-13, FIL-5
    n = 300
    lat = RNG.normal(0, 1, n) * scale
    lon = RNG.normal(0, 1, n) * scale * 2
    pts = [(i, float(lat[i]), float(lon[i])) for i in range(n)]
    pts.append((n, pts[5][1], pts[5][2]))        # duplicate coordinates
    df = spark.createDataFrame(pts, "id long, lat double, long double").repartition(16)
    r = geo.farthest_pair(df, metric=metric).first()
    d, pair = _brute(pts, metric)
    assert (r.station_a, r.station_b) == pair
    assert math.isclose(r.distance, round(d, 6), rel_tol=1e-9)


def _wc_map(pdf):
    w = pdf["text"].str.split(" ", regex=False).explode()
    return pd.DataFrame({"word": w.astype(str).values, "n": 1})


def _wc_combine(pdf):
    return pdf.groupby("word", as_index=False)["n"].sum()


def _wc_reduce(key, pdf):
    return pd.DataFrame({"word": [key[0]], "n": [int(pdf["n"].sum())]})


@pytest.mark.parametrize("combine,partitioner", [(None, "hash"), (_wc_combine, "hash"),
                                                 (_wc_combine, "range"),
                                                 (_wc_combine, "expr")])
def test_keyed_map_reduce_plan_independent(spark, combine, partitioner):
    # UDF-1, UDF-2, UDF-3, AGG-10, PAR-1, PAR-2
    words = ["a", "b", "c", "a", "a", "d"] * 50
    docs = spark.createDataFrame([(i, " ".join(words[i:i + 7])) for i in range(0, 300, 7)],
                                 "doc_id long, text string").repartition(5)
    if partitioner == "expr":                  # a user partitioner over the key
        partitioner = F.length("word") % 2
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")   # groups cut by batches
    try:
        out = keyed.keyed_map_reduce(docs, _wc_map, "word string, n long", "word", _wc_reduce,
                                     "word string, n long", combine_fn=combine, num_partitions=3,
                                     partitioner=partitioner)
        got = {r.word: r.n for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for i in range(0, 300, 7):
        for w in " ".join(words[i:i + 7]).split(" "):
            want[w] = want.get(w, 0) + 1
    assert got == want


def test_checked_broadcast_falls_back(spark):
    # JOIN-3
    from quern.operators.joins import checked_broadcast
    small = spark.range(5)
    big = spark.range(50)
    plan_small = big.join(checked_broadcast(small, 100), "id")._jdf.queryExecution().toString()
    assert "broadcast" in plan_small.lower()
    beyond = small.join(checked_broadcast(big, 100).withColumnRenamed("id", "j"), F.col("id") == F.col("j"))
    assert "ResolvedHint" not in beyond._jdf.queryExecution().logical().toString()
    wide = spark.createDataFrame([("x" * 500,)], "s string")       # few rows, many bytes
    assert checked_broadcast(wide, 100).count() == 1
    assert "ResolvedHint" not in checked_broadcast(wide, 100)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("spread_deg", [20.0, 150.0])
def test_farthest_haversine_hemisphere_and_wide(spark, spread_deg):
    # GEO-1, FN-7
    """Regional data takes the projected-hull path, world-wide data the bounds path."""
    n = 250
    lat = np.clip(RNG.normal(10, 1, n) * spread_deg / 3, -89, 89)
    lon = RNG.uniform(-spread_deg, spread_deg, n)
    pts = [(i, float(lat[i]), float(lon[i])) for i in range(n)]
    df = spark.createDataFrame(pts, "id long, lat double, long double").repartition(9)
    r = geo.farthest_pair(df, metric="haversine").first()
    d, pair = _brute(pts, "haversine")
    assert (r.station_a, r.station_b) == pair
    assert math.isclose(r.distance, round(d, 6), rel_tol=1e-9)


def test_farthest_pair_large_hull_uses_calipers(spark):
    # GEO-1: every point on a circle, so the global hull is the whole input;
    # the rotating-calipers path must agree with brute force
    n = 4500
    ang = np.sort(RNG.uniform(0, 2 * np.pi, n))
    pts = [(i, float(np.cos(a) * 3), float(np.sin(a) * 2)) for i, a in enumerate(ang)]
    df = spark.createDataFrame(pts, "id long, lat double, long double").repartition(4)
    r = geo.farthest_pair(df, metric="degrees").first()
    arr = np.array([(p[1], p[2]) for p in pts])
    d2 = ((arr[:, None, :] - arr[None, :, :]) ** 2).sum(-1)
    i, j = np.unravel_index(np.argmax(d2), d2.shape)
    assert (r.station_a, r.station_b) == tuple(sorted((int(i), int(j))))
    assert math.isclose(r.distance, round(math.sqrt(d2[i, j]), 6), rel_tol=1e-9)
