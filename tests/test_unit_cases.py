"""Exact small cases from the reference's own inputs (FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.functions.columns import inclusive_day_end
from quern.operators import ordering, relational, text

USERS = [(0, 55, 20, "male"), (1, 25, 240, "female"), (2, 25, 500, "female"),
         (3, 33, 800, "female")]
USER_SCHEMA = "id long, age int, social_contacts long, gender string"

DOCS3 = ["it is what it is", "what is it", "it is a banana"]
DOCS_LINES = ["\nit is what it is\nit is what it is\nit is what it is",
              "\nwhat is it\nwhat is it", "\nit is a banana"]


def test_filtered_average(spark):
    # FIL-1, AGG-1, SRC-1, SRC-9
    u = spark.createDataFrame(USERS, USER_SCHEMA)
    out = relational.filtered_group_mean(u, F.col("gender") == "female", "age", "social_contacts")
    assert sorted(map(tuple, out.collect())) == [(25, 370.0), (33, 800.0)]


def test_inverted_index(spark):
    # TXT-3, SRC-2, FN-1, FN-2
    d = spark.createDataFrame(list(enumerate(DOCS3)), "doc_id long, text string")
    rows = text.inverted_index(d).collect()
    got = {}
    for r in rows:
        got.setdefault(r.word, []).append(r.doc_id)
    assert got == {"a": ["2"], "banana": ["2"], "is": ["0", "1", "2"], "it": ["0", "1", "2"],
                   "what": ["0", "1"]}
    # posting rows come back in list order
    assert [(r.word, r.doc_id) for r in rows] == sorted((r.word, r.doc_id) for r in rows)


def test_word_count_keeps_empty_words(spark):
    # TXT-1, TXT-2, SRC-3, UDF-5
    d = spark.createDataFrame(list(enumerate(DOCS_LINES)), "doc_id long, text string")
    got = {r.word: r.n for r in text.word_count(d).collect()}
    assert got == {"": 3, "it": 9, "is": 9, "what": 5, "a": 1, "banana": 1}


def test_distinct_words(spark):
    # SET-1
    d = spark.createDataFrame(list(enumerate(DOCS_LINES)), "doc_id long, text string")
    assert {r.word for r in text.distinct_words(d).collect()} == {"", "it", "is", "what", "a",
                                                                  "banana"}


def test_range_buckets_and_dedup(spark):
    # SRT-3, PAR-2
    v = spark.createDataFrame([(x,) for x in [0.0, 0.5, 0.5, 0.50001, 1.0]], "v double")
    out = ordering.range_sort(v, "v", 2, lo=0.0, hi=1.0).collect()
    assert [r.bucket for r in out] == [0, 0, 0, 1, 1]
    assert [r.value for r in out] == [0.0, 0.5, 0.5, 0.50001, 1.0]
    assert ordering.range_sort(v, "v", 2, lo=0.0, hi=1.0, dedup=True).count() == 4
    # bounds from the data, non-zero minimum
    w = spark.createDataFrame([(x,) for x in [10.0, 12.0, 15.0, 20.0]], "v double")
    assert [r.bucket for r in ordering.range_sort(w, "v", 2).collect()] == [0, 0, 0, 1]


def test_mean_of_nothing_is_zero(spark):
    # AGG-3
    e = spark.createDataFrame([], "v double")
    assert relational.global_mean(e, "v").first().mean == 0.0
    assert relational.global_mean(e, "v", exact=False).first().mean == 0.0


def test_global_max_last_label_wins(spark):
    # AGG-2
    d = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, 1.0)], "label long, v double")
    r = relational.global_max(d, "label", "v").first()
    assert (r.label, r.value) == (3, 9.0)


def test_set_operations(spark):
    # SET-2, SET-3, SET-4
    r = spark.createDataFrame([("t",), ("t",), ("u",)], "key string")
    s = spark.createDataFrame([("u",), ("v",)], "key string")
    assert [x.key for x in relational.intersect(r, s).collect()] == ["u"]
    assert [x.key for x in relational.subtract(r, s).collect()] == ["t"]
    assert relational.difference_once(r, s).count() == 0
    assert sorted(x.key for x in relational.union_distinct(r, s).collect()) == ["t", "u", "v"]


def test_selection_keeps_duplicates_projection_removes_them(spark):
    # FIL-2, PRJ-1, PRJ-2
    d = spark.createDataFrame([(60, 1), (60, 1), (10, 2)], "a int, b int")
    assert relational.select_rows(d, F.col("a") > 50).count() == 2
    assert relational.project(d, "a").count() == 2


def test_natural_join_bag(spark):
    # JOIN-1
    r = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "a int, b int")
    s = spark.createDataFrame([(0, 7), (0, 8)], "b int, c int")
    out = relational.natural_join(r, s)
    assert out.columns == ["a", "b", "c"]
    assert sorted(map(tuple, out.collect())) == [(1, 0, 7), (1, 0, 8), (2, 0, 7), (2, 0, 8)]


def test_group_aggregate_theta(spark):
    # AGG-6
    d = spark.createDataFrame([(1, 2, 0), (1, 5, 0), (2, 3, 0)], "a int, b int, c int")
    assert sorted(map(tuple, relational.group_aggregate(d, "a", "b", "SUM").collect())) == \
        [(1, 7), (2, 3)]
    assert sorted(map(tuple, relational.group_aggregate(d, "a", "b", "max").collect())) == \
        [(1, 5), (2, 3)]
    with pytest.raises(ValueError):
        relational.group_aggregate(d, "a", "b", "AVG")


def test_time_bounds(spark):
    # FIL-6
    d = spark.createDataFrame([(dt.datetime(2020, 12, 31, 0, 0),), (dt.datetime(2020, 12, 31, 10, 0),)],
                              "ts timestamp")
    plain = d.filter(F.col("ts").between(F.lit("2010-01-01"), F.lit("2020-12-31"))).collect()
    assert [r.ts.hour for r in plain] == [0]
    incl = d.filter(F.col("ts").between(F.to_timestamp(F.lit("2010-01-01")),
                                        inclusive_day_end("2020-12-31"))).count()
    assert incl == 2


def test_tag_lookup_list_order_and_default(spark):
    # JOIN-6, FIL-7, FN-3, FN-9
    items = spark.createDataFrame([(1, None), (2, "<java><c#>"), (3, "<Rust>"), (4, "<javascript>")],
                                  "id long, tags string")
    vocab = spark.createDataFrame([("C#", 0), ("Java", 1), ("rust", 2)], "name string, ordinal int")
    for bound in (100, 1):     # map lookup, and the shuffle-join form beyond the bound
        got = {r.id: r.language for r in
               text.first_listed_match(items, "tags", vocab).collect()}
        assert got == {1: "No", 2: "C#", 3: "rust", 4: "No"}
        only = text.first_listed_match(items, "tags", vocab, default=None)
        assert sorted(r.id for r in only.collect()) == [2, 3]


def test_top_n_per_group_ties_by_name(spark):
    # TOP-3, SRT-2
    d = spark.createDataFrame([(2020, "b", 5), (2020, "a", 5), (2020, "c", 1), (2019, "x", 2)],
                              "year int, language string, n long")
    out = ordering.top_n_per_group(d, "year", [F.col("n").desc(), F.col("language")], 2)
    assert sorted(map(tuple, out.collect())) == [(2019, "x", 2), (2020, "a", 5), (2020, "b", 5)]


def test_grouped_bag_is_clustered_and_sorted(spark):
    # AGG-4, SRT-4, PAR-1
    d = spark.createDataFrame([(k % 3, float(k)) for k in range(30)], "k long, v double")
    out = relational.grouped_bag(d, "k", "v", num_partitions=4)
    parts = out.rdd.glom().collect()
    flat = [(r.key, r.value) for p in parts for r in p]
    assert flat == sorted(flat) and len(flat) == 30


def test_row_functions_as_columns(spark):
    # UDF-4
    from quern.functions.udf import row_map, vectorized
    d = spark.createDataFrame([(1.0, 2.0), (3.0, 4.0)], "a double, b double")
    add = vectorized(lambda a, b: a + b, "double")
    fmt = row_map(lambda a, b: f"{a:.0f}-{b:.0f}", "string")
    rows = d.select(add("a", "b").alias("s"), fmt("a", "b").alias("t")).collect()
    assert [(r.s, r.t) for r in rows] == [(3.0, "1-2"), (7.0, "3-4")]


def test_scalar_helpers(spark):
    # FN-2, FN-5, FN-8, FN-10, PRJ-4, SNK-4
    from quern.functions.columns import (distinct_sorted, format_line, not_every_nth, to_long)
    from quern.sources.readers import schema_report
    d = spark.createDataFrame([(["b", "a", "b"], "12", 2000, "x"), (["c"], "x", 1000, None)],
                              "arr array<string>, num string, rid long, name string")
    rows = d.select(distinct_sorted("arr").alias("s"), to_long("num").alias("n"),
                    not_every_nth("rid", 1000).alias("keep"),
                    format_line("ID: %s, name: %s", "rid", "name").alias("line")).collect()
    assert [(r.s, r.n, r.keep, r.line) for r in rows] == [
        (["a", "b"], 12, False, "ID: 2000, name: x"), (["c"], None, False, "ID: 1000, name: null")]
    assert "num: string" in schema_report(d)


def test_rename_sort_take_and_row_factory(spark):
    # PRJ-3, SRT-1, TOP-4, FIL-4, SRC-10, SNK-3
    from pyspark.sql import Row
    from quern.sources.readers import from_rows
    row = Row("Year", "Language", "Count")
    d = from_rows(spark, [row(2020, "java", 5), row(2020, "go", 7), row(2019, "c", 1)],
                  "Year int, Language string, Count long")
    r = relational.rename(d, "Year as year", "Language as language", "Count as n")
    assert r.columns == ["year", "language", "n"]
    assert [x.n for x in ordering.sort_desc(r, "n").collect()] == [7, 5, 1]
    assert ordering.take(r, 2).count() == 2
    assert relational.select_rows(r, F.col("year") == F.lit(2019)).first().language == "c"


def test_spread_only_when_scan_has_few_splits(spark):
    from quern.sources.readers import spread
    target = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    assert spread(one) is one                              # off unless asked for
    assert spread(one, 1).rdd.getNumPartitions() == target
    some = spark.range(100).repartition(2)
    assert spread(some, 1) is some                         # a scan of more splits is never moved


def test_checkpoint_folder_comes_from_the_session(spark):
    from quern.session import ensure_checkpoint_dir, scratch_path
    base = ensure_checkpoint_dir(spark)
    assert base == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(base.rstrip("/") + "/x-")
