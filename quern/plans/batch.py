"""Registered batch queries: each is ``(spark, sf_dir) -> DataFrame`` over whole tables.

columns carry the same aliases as the oracle SQL in ``quern.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.columns import distinct_sorted, event_year, format_line, to_long, words
from quern.functions.udf import flat_map, vectorized
from quern.operators.accumulate import aggregate_by_key
from quern.operators import geo, keyed, matrix, ordering, relational, text
from quern.sources import fixtures as fx
from quern.session import scratch_path
from quern.sources.readers import (FEW_SPLITS, document_lines, documents, moments, profile, read_csv, read_table,
                                   read_xml_rows, split_malformed, spread, write_csv, write_xml_rows)

# Parameters of the registered queries (fixed values of the test queries).
FLAGSHIP_SEGMENT = "BUILDING"
SELECTION_MIN_CONTACTS = 5000.0
LIST_BLOCK = 1000          # values of one block of a list
CHUNKS = 16                # input splits
TERASORT_BUCKETS = 8
TRIP_THRESHOLD = 900
POSTS_FROM, POSTS_TO = "1995-01-01", "2000-12-31"
TOP_LANGUAGES = 10
# Cells of one inner index that a task of a product takes.
CELLS_PER_TASK = 2_000_000


# --- relational -------------------------------------------------------------

def group_avg_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-1 + AGG-1 (flagship): mean contacts per age of one segment."""
    u = fx.users(spark, sf)
    return relational.filtered_group_mean(u, F.col("gender") == FLAGSHIP_SEGMENT, "age",
                                          "social_contacts", out="avg_contacts", exact=True)


def selection(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-2: σ_{social_contacts > 5000}(users), bag."""
    return relational.select_rows(fx.users(spark, sf),
                                  F.col("social_contacts") > SELECTION_MIN_CONTACTS)


def projection_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-1: π_{status, priority}(orders) with duplicate removal."""
    return relational.project(read_table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


def set_union(spark: SparkSession, sf: str) -> DataFrame:
    """SET-2."""
    return relational.union_distinct(fx.set_r(spark, sf), fx.set_s(spark, sf))


def set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    """SET-3."""
    return relational.intersect(fx.set_r(spark, sf), fx.set_s(spark, sf))


def set_difference(spark: SparkSession, sf: str) -> DataFrame:
    """SET-4."""
    return relational.subtract(fx.set_r(spark, sf), fx.set_s(spark, sf))


def difference_once(spark: SparkSession, sf: str) -> DataFrame:
    """SET-4b."""
    return relational.difference_once(fx.set_r(spark, sf), fx.set_s(spark, sf))


def natural_join(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-1: nation(a, b) ⋈ region(b, c)."""
    r = read_table(spark, sf, "nation").select(F.col("n_name").alias("a"),
                                               F.col("n_regionkey").alias("b"))
    s = read_table(spark, sf, "region").select(F.col("r_regionkey").alias("b"),
                                               F.col("r_name").alias("c"))
    return relational.natural_join(r, s, "b")


def natural_join_orders(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-1 + PRJ-3 on tables that grow: lineitem(a, b) ⋈ orders(b, c) on the order key."""
    r = relational.rename(read_table(spark, sf, "lineitem"), "l_partkey as a", "l_orderkey as b")
    s = relational.rename(read_table(spark, sf, "orders"), "o_orderkey as b", "o_custkey as c")
    return relational.natural_join(r, s)


def typed_events(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-3 + FN-5 + FIL-9: the number in each event's text, as a long; events without one go.

    The text between colon and brace is cast as it stands; what is no number is null.
    """
    ev = relational.rename(read_table(spark, sf, "events"), "event_id as id", "event_type as kind",
                           "split_part(split_part(props, ': ', 2), '}', 1) as raw")
    return relational.drop_null_rows(ev.select("id", "kind", to_long("raw").alias("k")))


def largest_order(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-13: the whole row of the order with the largest total price (ties: smallest key)."""
    return relational.argmax_row(read_table(spark, sf, "orders"), "o_totalprice", ["o_orderkey"])


def _quantities(spark, sf):
    return read_table(spark, sf, "lineitem").select("l_returnflag", "l_quantity")


def group_sum(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-6 with θ = SUM."""
    return relational.group_aggregate(_quantities(spark, sf), "l_returnflag", "l_quantity", "SUM")


def group_max(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-6 with θ = MAX."""
    return relational.group_aggregate(_quantities(spark, sf), "l_returnflag", "l_quantity", "MAX")


def global_max(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-2: the order with the largest total price."""
    return relational.global_max(read_table(spark, sf, "orders"), "o_orderkey", "o_totalprice")


def global_mean(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-3: mean order total price (0 when empty)."""
    return relational.global_mean(read_table(spark, sf, "orders"), "o_totalprice")


def group_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-4 / SRT-4: events grouped by user as a clustered, sorted bag."""
    return relational.grouped_bag(read_table(spark, sf, "events"), "user_id", "value")


def group_by_key_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-5: count and mean per user, ordered by key."""
    return relational.group_count_mean(read_table(spark, sf, "events"), "user_id", "value")


def profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5: count/min/max of each numeric orders column in one scan."""
    return profile(read_table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


def profile_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5: the exact 25, 50 and 75 % of orders' numeric columns (interpolated, rounded to 6 places)."""
    q = ordering.order_statistics(read_table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], [0.25, 0.5, 0.75])
    return q.select("column_name", "share", F.round("value", 6).alias("value"))


def group_lists(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-4: the events of each user as sorted lists of ids, in blocks, each as text."""
    lists = relational.grouped_lists(read_table(spark, sf, "events"), "user_id", "event_id", LIST_BLOCK)
    return lists.select("key", "block_no", F.size("values").cast("long").alias("n"),
                        F.array_join(F.transform("values", lambda v: v.cast("string")), ",").alias("ids"))


def order_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """PAR-3: orders in contiguous chunks of ``ceil(rows / CHUNKS)`` by key."""
    return ordering.even_chunks(read_table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], CHUNKS)


def profile_moments(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5: count, mean and standard deviation of orders' numeric columns in one scan.

    The deviation is rounded: its last digits depend on the order of summation.
    """
    m = moments(read_table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return m.select("column_name", "count", "mean", F.round("stddev", 4).alias("stddev"))


# --- text -------------------------------------------------------------------

def _docs(spark, sf):
    return spread(read_table(spark, sf, "documents").select("doc_id", "text"), FEW_SPLITS)


def distinct_words(spark: SparkSession, sf: str) -> DataFrame:
    """SET-1."""
    return text.distinct_words(_docs(spark, sf))


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    """TXT-1 / TXT-2."""
    return text.word_count(_docs(spark, sf))


def word_count_table_function(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-5 + TXT-1: word count whose words come from a user's table function."""
    return flat_map(_docs(spark, sf), words_of_lines, ["text"], "word string").groupBy("word").agg(F.count("*").alias("n"))


def words_of_lines(text: str | None):
    """The words of each line of a text, empty ones included."""
    for line in text.split("\n") if text is not None else ():
        for word in line.split(" "):
            yield (word,)


def orders_through_csv(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-6 / SRC-7: the orders written as CSV and read back with types, malformed rows set apart."""
    orders, path = read_table(spark, sf, "orders"), scratch_path(spark, "orders-csv")
    write_csv(orders, path)
    good, _, _, _ = split_malformed(read_csv(spark, path, orders.schema, corrupt="_corrupt", null_text="\\N"), "_corrupt")
    return good


def orders_through_xml(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-8: the orders written as XML rows and read back with types, malformed rows set apart."""
    orders, path = read_table(spark, sf, "orders"), scratch_path(spark, "orders-xml")
    write_xml_rows(orders, path)
    schema = T.StructType([T.StructField(f"_{f.name}", f.dataType) for f in orders.schema])
    good, _, _, _ = split_malformed(read_xml_rows(spark, path, schema, corrupt="_corrupt"), "_corrupt")
    return good.toDF(*orders.columns)


def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    """TXT-3: posting rows (word, doc_id) in list order."""
    return text.inverted_index(_docs(spark, sf))


def inverted_index_lists(spark: SparkSession, sf: str) -> DataFrame:
    """TXT-3: posting lists as blocks, each as text in list order."""
    blocks = text.inverted_index_blocks(_docs(spark, sf), block_ids=LIST_BLOCK)
    return blocks.select("word", "block_no", F.array_join("doc_ids", ",").alias("doc_ids"))


def lines_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-3: every line of every document under its ``docid:lineid`` key."""
    return document_lines(_docs(spark, sf)).select("key", "line")


def distinct_words_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-2 + FN-1 + FN-2: per document (id as text), its sorted distinct words: count and MD5."""
    w = distinct_sorted(words("text"))
    return documents(_docs(spark, sf)).select("doc_id", w.alias("w")).where("w is not null") \
        .select("doc_id", F.size("w").cast("long").alias("n_words"), F.md5(F.concat_ws(" ", "w")).alias("words_md5"))


# --- ordering ---------------------------------------------------------------

def _prices(spark, sf):
    return read_table(spark, sf, "orders").select("o_totalprice")


def terasort_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """SRT-3 / PAR-2: globally sorted prices with their equal-width bucket."""
    return ordering.range_sort(_prices(spark, sf), "o_totalprice", TERASORT_BUCKETS)


def terasort_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """SRT-3 with the reference's one row per distinct value."""
    return ordering.range_sort(_prices(spark, sf), "o_totalprice", TERASORT_BUCKETS, dedup=True)


def bikes_by_total(spark: SparkSession, sf: str) -> DataFrame:
    """SRT-1 + AGG-7: all bikes with their total duration, largest first (ties: larger id)."""
    return ordering.sort_desc(_bike_totals(spark, sf), "duration", "bike_id")


# --- matrices ---------------------------------------------------------------

def matvec_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-1 / JOIN-3: embeddings × vector, vector broadcast (size checked)."""
    return matrix.matvec(fx.matrix(spark, sf), fx.vector(spark, sf), "broadcast")


def matvec_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-2: the same product when the vector does not fit: shuffle join, salted."""
    m = fx.matrix(spark, sf)
    return matrix.matvec(m, fx.vector(spark, sf), "shuffle", salts=_salts(m))


def _salts(m) -> int:
    """Tasks of one inner index: about ``CELLS_PER_TASK`` cells each."""
    n, keys = m.agg(F.count("*"), F.approx_count_distinct("j")).first()
    return max(1, -(-n // (CELLS_PER_TASK * max(1, keys))))


def _scores(spark, sf, strategy):
    c = fx.label_profile(spark, sf)
    m = fx.matrix(spark, sf)
    # The embeddings hold few values of j: each one's cells are spread over many tasks.
    return matrix.matmul(m, matrix.as_right(matrix.transpose(c)), strategy, salts=_salts(m)) \
        .select(F.col("k").alias("i"), F.col("i").alias("k"), "p") if strategy == "join" \
        else matrix.matmul(c, matrix.as_right(matrix.transpose(m)), strategy)


def matmul_broadcast(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-3 / JOIN-4: label profiles (small, broadcast) × all embeddingsᵀ."""
    return _scores(spark, sf, "broadcast_left")


def _gram(spark, sf, scatter: int | None = None):
    m = fx.matrix(spark, sf)
    if scatter:
        m = ordering.even_splits(m, scatter)
    return matrix.matmul(matrix.transpose(m), matrix.as_right(m), "join")


def matmul_join(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-5 / JOIN-5 (and MAT-4): Gram matrix Mᵀ·M, reduce-side join on the vector id."""
    return _gram(spark, sf)


def matmul_scattered(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-6 + PAR-3: the same product with cells scattered over many readers."""
    return _gram(spark, sf, scatter=16)


def matrix_dense(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-11: the Gram matrix as dense text rows."""
    shape = fx.matrix(spark, sf).agg((F.max("j") + 1).alias("rows"), (F.max("j") + 1).alias("width"))
    return matrix.to_dense(_gram(spark, sf), "p", as_text=True, shape=shape)


def matrix_allclose(spark: SparkSession, sf: str) -> DataFrame:
    """MAT-7: broadcast and shuffle plans of the same product agree."""
    return matrix.allclose(_scores(spark, sf, "broadcast_left"), _scores(spark, sf, "join"))


# --- trips ------------------------------------------------------------------

def _bike_totals(spark, sf):
    t = relational.drop_null_rows(fx.trips(spark, sf), ["duration"])
    return relational.sum_by(t, "bike_id", "duration", "duration")


def bike_max_total(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-3 + AGG-7 + TOP-1: bike with the largest total duration (ties: smallest id)."""
    return ordering.top1(_bike_totals(spark, sf), F.col("duration").desc(), F.col("bike_id").asc())


def bike_longest_trip(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-2 chained on TOP-1 (FIL-4 as a semi-join on the bike id): the
    longest trip of the top bike.

    The top bike is a one-row DataFrame (``limit 1``), so broadcasting it is
    bounded by construction; the trip scan is never collected.
    """
    top = bike_max_total(spark, sf).select("bike_id")
    t = fx.trips(spark, sf).join(F.broadcast(top), "bike_id", "left_semi")
    t = t.select("id", "bike_id", "start_station_id", "end_station_id", "duration")
    return ordering.top1(t, F.col("duration").desc(), F.col("id"), F.col("start_station_id"),
                         F.col("end_station_id"))


def bike_count(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-12 / SET-5: number of distinct bikes."""
    return relational.count_distinct(fx.trips(spark, sf), "bike_id", out="n_bikes")


def users_over_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-8 + FIL-8: zip codes whose total duration reaches the threshold."""
    totals = relational.sum_by(fx.trips(spark, sf), "zip_code", "duration", "total_duration")
    return relational.having(totals, F.col("total_duration") >= TRIP_THRESHOLD)


def users_over_threshold_count(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-8: how many zip codes reach the threshold (the reference's ``count()``)."""
    return users_over_threshold(spark, sf).agg(F.count(F.lit(1)).alias("n_users"))


def bike_trip_report(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-4 + FN-10: the longest trip of the top bike as one formatted text line."""
    t = bike_longest_trip(spark, sf)
    return t.select(format_line("trip %d: start station %d, end station %d, duration %d s",
                                "id", "start_station_id", "end_station_id", "duration")
                    .alias("report"))


# --- stations ---------------------------------------------------------------

def farthest_pair_degrees(spark: SparkSession, sf: str) -> DataFrame:
    """GEO-1 with FN-6: farthest pair of stations in planar degrees (hull-pruned)."""
    return geo.farthest_pair(fx.stations(spark, sf), metric="degrees")


def farthest_pair_haversine(spark: SparkSession, sf: str) -> DataFrame:
    """GEO-1 with FN-7: farthest pair by great-circle distance in km (bound-pruned)."""
    return geo.farthest_pair(fx.geo_stations(spark, sf), metric="haversine")


# --- languages --------------------------------------------------------------

def _post_languages(spark, sf, lo=None, hi=None, default="No"):
    p = fx.posts(spark, sf)
    if lo is not None:
        p = p.filter(F.col("creation_date").between(F.lit(lo), F.lit(hi)))
    out = text.first_listed_match(p, "tags", fx.languages(spark, sf), default=default)
    return out.select("creation_date", "language")


def post_language(spark: SparkSession, sf: str) -> DataFrame:
    """JOIN-6: (creation_date, first listed language or 'No') per post."""
    return _post_languages(spark, sf)


def top_languages_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-6 + JOIN-6 + FIL-7 + FN-4 + AGG-9 + TOP-3: top languages per year."""
    pl = _post_languages(spark, sf, POSTS_FROM, POSTS_TO, default=None)
    counts = pl.groupBy(event_year("creation_date").alias("year"), "language") \
               .agg(F.count(F.lit(1)).alias("n_posts"))
    return ordering.top_n_per_group(counts, "year", [F.col("n_posts").desc(), F.col("language")],
                                    TOP_LANGUAGES)


def top_languages_report(spark: SparkSession, sf: str) -> DataFrame:
    """SRT-2 + TOP-3: the top languages with their rank, years and counts descending."""
    pl = _post_languages(spark, sf, POSTS_FROM, POSTS_TO, default=None)
    counts = pl.groupBy(event_year("creation_date").alias("year"), "language") \
               .agg(F.count(F.lit(1)).alias("n_posts"))
    top = ordering.top_n_per_group(counts, "year", [F.col("n_posts").desc(), F.col("language")],
                                   TOP_LANGUAGES, rank_col="rank")
    return ordering.sort_desc(top, "year", "n_posts", -F.col("rank"))


# --- user functions ---------------------------------------------------------

def mapreduce_group_avg(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-1/2 + AGG-10: the flagship query through user map/combine/reduce functions.

    Values travel as integer cents so partial sums are exact.
    """
    import pandas as pd

    def map_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        f = pdf[pdf["gender"] == FLAGSHIP_SEGMENT]
        return pd.DataFrame({"age": f["age"].astype("int32"),
                             "cents": (f["social_contacts"] * 100).round().astype("int64"),
                             "cnt": 1})

    def combine_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("age", as_index=False)[["cents", "cnt"]].sum()

    def reduce_fn(key, pdf: pd.DataFrame) -> pd.DataFrame:
        total, n = int(pdf["cents"].sum()), int(pdf["cnt"].sum())
        return pd.DataFrame({"age": [key[0]], "avg_contacts": [(total / 100.0) / n if n else 0.0]})

    return keyed.keyed_map_reduce(fx.users(spark, sf), map_fn, "age int, cents long, cnt long",
                                  "age", reduce_fn, "age int, avg_contacts double",
                                  combine_fn=combine_fn)


def mapreduce_word_count(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-1/2/5 + AGG-10: word count through user functions with a combiner."""
    import pandas as pd

    def map_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = pdf["text"].dropna().str.split("\n", regex=False).explode()
        w = lines.str.split(" ", regex=False).explode()
        return pd.DataFrame({"word": w.astype(str).values, "n": 1})

    def combine_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("word", as_index=False, sort=False)["n"].sum()

    def reduce_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("word", as_index=False, sort=False)["n"].sum()

    return keyed.keyed_map_reduce(_docs(spark, sf), map_fn, "word string, n long", "word",
                                  reduce_fn, "word string, n long", combine_fn=combine_fn,
                                  vectorized_reduce=True)


def mapreduce_chain(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-3: two map/reduce jobs in a chain: word counts, then how many words have each count."""
    import pandas as pd

    def map_fn(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": pdf["n"], "n_words": 1})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.groupby("n", as_index=False, sort=False)["n_words"].sum()

    def reduce_fn(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"n": [key[0]], "n_words": [pdf["n_words"].sum()]})

    return keyed.keyed_map_reduce(mapreduce_word_count(spark, sf), map_fn, "n long, n_words long", "n",
                                  reduce_fn, "n long, n_words long", combine_fn=add)


def count_languages_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-9 / AGG-10: posts per language by the user's ``zero``, ``seq`` and ``comb``, merged in salted steps."""
    posts = _post_languages(spark, sf, POSTS_FROM, POSTS_TO, default=None)
    return aggregate_by_key(posts.select("language", "creation_date"), "language", "creation_date", (0,),
                            lambda acc, posts: (acc[0] + len(posts),), lambda a, b: (a[0] + b[0],), "n_posts long")


def row_function_totals(spark: SparkSession, sf: str) -> DataFrame:
    """UDF-4: a user row function as a vectorised column: discounted cents per line, summed by flag."""
    cents = vectorized(_discounted_cents, "long")
    li = read_table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_discount")
    return li.select("l_returnflag", cents("l_extendedprice", "l_discount").alias("c")) \
        .groupBy("l_returnflag").agg(F.sum("c").alias("cents"))


def _discounted_cents(price, discount):
    """``price`` in whole cents times the whole per cent left of it."""
    return (price * 100).round().astype("int64") * (100 - (discount * 100).round().astype("int64"))
