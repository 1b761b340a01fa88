"""Distributed row numbers, blocked lists, quantiles, exact sums, merged accumulators and user windows."""

import datetime as dt
import random
import statistics
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions.columns import exact_mean, exact_sum
from quern.operators import ordering, relational, text
from quern.operators.accumulate import _merged, aggregate_by_key
from quern.plans.streams import TipTotal
from quern.sources.readers import file_lines, read_stream
from quern.streaming import jobs
from quern.streaming.runner import new_run, run_to_table
from quern.streaming.windows import window_aggregate


# --- row numbers (PAR-3, SRC-3) ---------------------------------------------------------------
def test_row_numbers_per_group_with_a_hot_group_ties_and_nulls(spark):
    r = random.Random(1)
    rows = [(r.choice(["hot", "hot", "hot", None, "b"]), r.choice([None, 1, 2, 3]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, _at int").repartition(7)
    out = ordering.number_rows(df, ["v", "_at"], ["g"])
    assert out.columns == ["g", "v", "_at", "row_no", "group_rows"]
    want = defaultdict(list)
    for g, v, i in rows:
        want[g].append((v is not None, v or 0, i))
    places = {(g, x[2]): n for g, xs in want.items() for n, x in enumerate(sorted(xs))}
    assert {(x.g, x["_at"]): x.row_no for x in out.collect()} == places
    assert {(x.g, x.group_rows) for x in out.collect()} == {(g, len(xs)) for g, xs in want.items()}
    equal = ordering.number_rows(spark.range(1000).select(F.lit(7).alias("v")), ["v"])
    assert sorted(x.row_no for x in equal.collect()) == list(range(1000))
    assert ordering.number_rows(df.where("false"), ["v"], ["g"]).count() == 0


def test_row_numbers_have_no_single_task_window(spark):
    plan = ordering.number_rows(spark.range(10), ["id"], number="n")._jdf.queryExecution().executedPlan().toString()
    # The window runs over the ranges' counts, behind their aggregate.
    assert plan.index("Window") < plan.index("HashAggregate") and plan.count("+- Window") + plan.count("Window [") >= 1


@pytest.mark.parametrize("rows,maps", [(10, 3), (10, 4), (3, 5), (0, 2), (12, 4)])
def test_even_chunks_are_contiguous(spark, rows, maps):
    got = ordering.even_chunks(spark.range(rows).select((F.lit(100) - F.col("id")).alias("v")), ["v"], maps).orderBy("v").collect()
    size = -(-rows // maps) if rows else 1
    assert [x.chunk for x in got] == [i // size for i in range(rows)]


def test_lines_of_files_with_many_splits(spark, tmp_path):
    r = random.Random(3)
    files = {"a.txt": ["line %d %s" % (i, "x" * r.randrange(60)) if i % 5 else "" for i in range(2000)], "b.txt": ["one"], "c.txt": []}
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + ("\n" if lines else ""))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "16")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 5
        got = file_lines(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((x.file.rsplit("/", 1)[1], x.line_no, x.line) for x in got) == \
        [(n, i, line) for n, lines in sorted(files.items()) for i, line in enumerate(lines)]
    assert all(x.key == f"{x.file}:{x.line_no}" for x in got)


# --- lists (AGG-4, TXT-3) ---------------------------------------------------------------------
def test_blocks_in_order_are_the_whole_list(spark):
    r = random.Random(4)
    rows = [(r.choice(["hot"] * 8 + ["b", None]), r.choice([None, *range(20)])) for _ in range(1500)]
    got = relational.grouped_lists(spark.createDataFrame(rows, "k string, v int"), "k", "v", 64).collect()
    lists = defaultdict(list)
    for x in sorted(got, key=lambda x: x.block_no):
        assert len(x["values"]) <= 64
        lists[x.key] += x["values"]
    want = defaultdict(list)
    for k, v in rows:
        want[k].append(v)
    assert lists == {k: sorted(vs, key=lambda v: (v is not None, v or 0)) for k, vs in want.items()}
    blocks = Counter(x.key for x in got)
    assert all(blocks[k] == -(-len(vs) // 64) for k, vs in want.items())


def test_posting_blocks_are_the_reference_lists(spark):
    docs = [(i, " ".join(random.Random(i).choices(["a", "b", "", "c\nd"], k=6)) if i % 9 else None) for i in range(60)]
    got = text.inverted_index_blocks(spark.createDataFrame(docs, "doc_id long, text string"), block_ids=7).collect()
    lists = defaultdict(list)
    for x in sorted(got, key=lambda x: x.block_no):
        lists[x.word] += x.doc_ids
    want = defaultdict(set)
    for i, t in docs:
        for w in (t.split(" ") if t is not None else []):
            want[w].add(str(i))
    assert lists == {w: sorted(ids) for w, ids in want.items()}


# --- quantiles and sums (SNK-5, AGG-3) ----------------------------------------------------------
def test_order_statistics_equal_numpy(spark):
    r = np.random.default_rng(5)
    a, b = r.normal(size=1001).tolist(), r.integers(0, 4, 1001).tolist()
    df = spark.createDataFrame([(x if i % 10 else None, y, None) for i, (x, y) in enumerate(zip(a, b))], "a double, b int, c int")
    shares = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(x.column_name, x.share): x.value for x in ordering.order_statistics(df, ["a", "b", "c"], shares).collect()}
    kept = [x for i, x in enumerate(a) if i % 10]
    assert len(got) == 18 and all(got["c", q] is None for q in shares)
    for q in shares:
        assert got["a", q] == pytest.approx(np.quantile(kept, q), abs=1e-12) and got["b", q] == np.quantile(b, q)


@pytest.mark.parametrize("values", [
    [1e-19, 3e-19], [1.5e-18, 1.5e-18], [1e21, 1.0, 2.0], [0.1] * 10, [1e25, -1e25, 5.0], [123.45, -0.05, None], [7e-30, 1e-3]])
def test_sums_of_small_and_large_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    some = [Fraction(repr(v)) for v in values if v is not None]
    row = df.agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).first()
    assert row.s == pytest.approx(float(sum(some)), rel=1e-15) and row.m == pytest.approx(float(sum(some) / len(some)), rel=1e-15)


def test_sums_do_not_depend_on_order_and_take_odd_values(spark):
    r = random.Random(6)
    values = [r.uniform(-1, 1) * 10.0 ** r.randrange(-25, 25) for _ in range(400)]
    got = set()
    for k in range(4):
        r.shuffle(values)
        got.add(spark.createDataFrame([(v,) for v in values], "v double").repartition(k + 1).agg(exact_sum("v")).first()[0])
    assert len(got) == 1
    one = lambda vs: spark.createDataFrame([(v,) for v in vs], "v double").agg(exact_sum("v"), exact_mean("v", 0.0)).first()
    assert tuple(one([])) == (None, 0.0) and tuple(one([None])) == (None, 0.0)
    assert one([float("inf"), 1.0])[0] == float("inf") and one([1e300, 1e300])[0] == 2e300


# --- accumulators (AGG-9, AGG-10, UDF-2) --------------------------------------------------------
def _moments(acc, values):
    some = [v for v in values.to_pylist() if v is not None]
    return acc[0] + len(values), acc[1] + sum(some), max([acc[2], *some]) if some else acc[2]


def _join(a, b):
    return a[0] + b[0], a[1] + b[1], max(a[2], b[2])


@pytest.mark.parametrize("salts", [1, 5])
def test_user_accumulators_with_a_hot_key_and_null_keys(spark, salts):
    r = random.Random(7)
    rows = [(r.choice(["hot"] * 5 + ["b", "c", None]), r.choice([None, *range(-5, 5)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(9)
    out = aggregate_by_key(df, "k", "v", (0, 0, -99), _moments, _join, "n long, total long, top int", salts=salts)
    want = defaultdict(list)
    for k, v in rows:
        want[k].append(v)
    assert {x.k: (x.n, x.total, x.top) for x in out.collect()} == {
        k: (len(vs), sum(v for v in vs if v is not None), max(v for v in vs if v is not None)) for k, vs in want.items()}
    assert aggregate_by_key(df.where("false"), "k", "v", (0, 0, -99), _moments, _join, "n long, total long, top int").count() == 0


def test_a_hot_key_reaches_a_task_as_bounded_partials(spark, monkeypatch):
    # 40 scan tasks hold the key; no merge task sees more than its share of the 40 partials.
    df = spark.range(0, 40_000, 1, 40).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    seen = spark.sparkContext.accumulator(0)
    most = spark.sparkContext.accumulator(0, _Max())

    def counted(batches):
        n = 0
        for rb in batches:
            n += rb.num_rows
            yield rb
        seen.add(n)
        most.add(n)
    monkeypatch.setattr("quern.operators.accumulate._merged", lambda it, comb, schema: _merged(counted(it), comb, schema))
    # Spark joins small shuffle partitions again; here each of the salts' keeps its own task.
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = aggregate_by_key(df, "k", "v", (0,), lambda a, v: (a[0] + sum(v.to_pylist()),), lambda a, b: (a[0] + b[0],), "s long", salts=8)
        assert [tuple(x) for x in out.collect()] == [(1, sum(range(40_000)))]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert most.value <= 20 and 40 < seen.value <= 48        # 40 partials dealt by salt, then at most one for each salt


class _Max:
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


# --- user windows (UDF-7) -------------------------------------------------------------------------
def test_user_window_equals_the_built_in_one_with_late_rows(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    r = random.Random(8)
    schema = "driver_id long, tip double, event_time timestamp"
    batches = [[(r.choice([1, 2, None]), r.choice([0.1, 0.2, None, 5.0]), t0 + dt.timedelta(minutes=60 * b + r.randrange(-90, 60)))
                for _ in range(80)] for b in range(4)] + [[(9, 0.0, t0 + dt.timedelta(days=9))], [(1, 7.0, t0)]]
    src, got = str(tmp_path / "in"), {}
    runs = {name: new_run(spark, name) for name in ("own", "built")}
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        s = read_stream(spark, src, spark.read.parquet(src).schema).where("driver_id IS NOT NULL")
        own = window_aggregate(s.withColumn("tip", F.col("tip").cast("decimal(38,18)")), "driver_id", TipTotal(), "1 hour", "60 seconds", 3)
        built = jobs.hourly_tips(s).select(F.col("window.end").alias("window_end"), "driver_id", "tips")
        for name, stream in (("own", own), ("built", built)):
            rows_now = run_to_table(spark, stream, runs[name]).collect()
            got[name] = {(x.window_end, x.driver_id): float(x.tips or 0) for x in rows_now}
            assert len(rows_now) == len(got[name])
    assert got["own"] == got["built"] and len(got["own"]) > 5
    assert statistics.fmean(got["own"].values()) > 0


def test_a_huge_tip_does_not_stop_the_stream(spark, tmp_path):
    schema = "driver_id long, tip double, event_time timestamp"
    t0, src = dt.datetime(2024, 1, 1), str(tmp_path / "in")
    spark.createDataFrame([(1, 1e21, t0), (1, 1.0, t0), (2, 0.5, t0), (9, 0.0, t0 + dt.timedelta(days=1))], schema).write.parquet(src)
    s = read_stream(spark, src, spark.read.parquet(src).schema)
    out = run_to_table(spark, jobs.hourly_tips(s).select("driver_id", "tips"), new_run(spark, "huge")).collect()
    assert {x.driver_id: x.tips for x in out} == {1: 1e21, 2: 0.5}


def test_map_calls_see_a_bounded_length_of_text_and_every_row():
    import pandas as pd

    from quern.operators import keyed
    seen = []

    def map_fn(pdf):
        seen.append(int(pdf["text"].dropna().str.len().sum()))
        return pd.DataFrame({"word": pdf["text"].dropna().str.split(" ").explode().to_numpy(), "n": 1})

    def add(pdf):
        return pdf.groupby("word", as_index=False, sort=False)["n"].sum()

    texts = ["a bb " + "c" * 95] * 30_000 + [None, "", "d" * 3_000_000] + ["a e"] * 5
    batches = [pd.DataFrame({"text": texts}), pd.DataFrame({"text": texts[:0]}, dtype=object)]
    out = list(keyed._map_and_combine(map_fn, add)(iter(batches)))
    whole = add(pd.concat(out)).set_index("word")["n"].to_dict()
    assert whole == {"a": 30_005, "bb": 30_000, "c" * 95: 30_000, "": 1, "d" * 3_000_000: 1, "e": 5}
    # A call takes a million characters and the row that passes them.
    assert max(n for n in seen if n < 3_000_000) <= keyed.MAP_CHARS + 100 and len(seen) > 3


def test_partials_are_handed_on_before_they_grow(monkeypatch):
    import pandas as pd

    from quern.operators import keyed
    monkeypatch.setattr(keyed, "PARTIAL_ROWS", 1000)

    def add(pdf):
        return pdf.groupby("word", as_index=False, sort=False)["n"].sum()

    batches = [pd.DataFrame({"word": [f"w{i}" for i in range(k, k + 300)], "n": 1}) for k in range(0, 6000, 150)]
    out = list(keyed._map_and_combine(lambda pdf: pdf, add)(iter(batches)))
    assert max(len(p) for p in out) < 1300 and len(out) > 3
    assert pd.concat(out)["n"].sum() == 300 * len(batches) and pd.concat(out)["word"].nunique() == 6150


def test_posting_lists_over_many_ranges_with_repeated_and_null_ids(spark):
    """Words that span ranges, blocks that span Arrow batches, ids that repeat or are missing."""
    rows = [(i % 2900 if i % 7 else None, f"hot warm{i % 3} w{i} \n") for i in range(3000)] + [(5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = defaultdict(set)
    for i, t in rows:
        for w in (t.split(" ") if t is not None else []):
            want[w].add(None if i is None else str(i))
    order = {w: sorted(ids, key=lambda v: (v is not None, v or "")) for w, ids in want.items()}
    conf = {"spark.sql.shuffle.partitions": "13", "spark.sql.execution.arrow.maxRecordsPerBatch": "100"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        flat = [(r.word, r.doc_id) for r in text.inverted_index(docs).collect()]
        blocks = text.inverted_index_blocks(docs, block_ids=250).collect()
        plan = text.inverted_index(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert flat == [(w, i) for w in sorted(order, key=lambda w: w.encode()) for i in order[w]]
    got = defaultdict(dict)
    for b in blocks:
        assert b.block_no not in got[b.word]
        got[b.word][b.block_no] = b.doc_ids
    assert {w: [i for k in sorted(bs) for i in bs[k]] for w, bs in got.items()} == order
    assert all(sorted(bs) == list(range(-(-len(order[w]) // 250))) and all(len(bs[k]) == 250 for k in sorted(bs)[:-1])
               for w, bs in got.items())
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan     # the postings move once
