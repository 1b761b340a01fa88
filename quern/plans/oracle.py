"""DuckDB SQL equivalents of the registered queries (same column names and types).

Tables are the pre-registered views ``region nation customer supplier part
orders lineitem events documents embeddings pages benchmark labels
conversations``.
"""

from __future__ import annotations

from quern.plans import batch as B

_R = "SELECT o_custkey AS key FROM orders WHERE o_orderstatus = 'F'"
_S = "SELECT o_custkey AS key FROM orders WHERE o_orderpriority = '1-URGENT'"

_M = """M AS (
  SELECT vec_id AS i, CAST(pos - 1 AS BIGINT) AS j,
         CAST(round(CAST(x AS DOUBLE) * 10000) AS BIGINT) AS v
  FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
        FROM embeddings))"""

_C = """C AS (
  SELECT CAST(label AS BIGINT) AS i, CAST(pos - 1 AS BIGINT) AS j,
         max(CAST(round(CAST(x AS DOUBLE) * 10000) AS BIGINT)) AS v
  FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos
        FROM embeddings)
  GROUP BY 1, 2)"""

_SCORES = f"""WITH {_M}, {_C},
P AS (SELECT C.i AS i, M.i AS k, CAST(sum(C.v * M.v) AS BIGINT) AS p
      FROM C JOIN M ON C.j = M.j GROUP BY C.i, M.i)"""

_GRAM = f"""WITH {_M},
G AS (SELECT a.j AS i, b.j AS k, CAST(sum(a.v * b.v) AS BIGINT) AS p
      FROM M a JOIN M b ON a.i = b.i GROUP BY a.j, b.j)"""

_WORDS = """(SELECT unnest(string_split(line, ' ')) AS word
   FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))"""

_TERA = f"""WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(greatest(ceil((o_totalprice - lo) / ((hi - lo) / CAST({B.TERASORT_BUCKETS} AS DOUBLE))) - 1, 0),
                  {B.TERASORT_BUCKETS - 1}) AS INTEGER) AS bucket,
       o_totalprice AS value
FROM orders, b"""

_POSTS = """WITH p AS (
  SELECT row_number() OVER () AS pid, l_shipdate AS creation_date,
         '<' || lower(p_brand) || '><' || lower(p_type) || '>' AS tags
  FROM lineitem JOIN part ON l_partkey = p_partkey),
L AS (SELECT DISTINCT p_brand AS name FROM part),
m AS (SELECT pid, min(name) AS language FROM p JOIN L
      ON contains(lower(p.tags), '<' || lower(L.name) || '>') GROUP BY pid)"""

_EXACT_MEAN = "CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c})"


ORACLE_SQL: dict[str, str] = {
    "group_avg_filtered": f"""
SELECT c_nationkey AS age, {_EXACT_MEAN.format(c='c_acctbal')} AS avg_contacts
FROM customer WHERE c_mktsegment = '{B.FLAGSHIP_SEGMENT}' GROUP BY c_nationkey""",
    "selection": f"""
SELECT c_custkey AS id, c_nationkey AS age, c_acctbal AS social_contacts, c_mktsegment AS gender
FROM customer WHERE c_acctbal > {B.SELECTION_MIN_CONTACTS}""",
    "projection_distinct": "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
    "set_union": f"{_R} UNION {_S}",
    "set_intersect": f"{_R} INTERSECT {_S}",
    "set_difference": f"{_R} EXCEPT {_S}",
    "difference_once": f"""
SELECT key FROM (SELECT key, 0 AS rel FROM ({_R}) UNION ALL SELECT key, 1 AS rel FROM ({_S}))
GROUP BY key HAVING count(*) = 1 AND max(rel) = 0""",
    "natural_join": """
SELECT n_name AS a, n_regionkey AS b, r_name AS c FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "group_sum": "SELECT l_returnflag AS a, sum(l_quantity) AS x FROM lineitem GROUP BY l_returnflag",
    "group_max": "SELECT l_returnflag AS a, max(l_quantity) AS x FROM lineitem GROUP BY l_returnflag",
    "global_max": """
SELECT o_orderkey AS label, o_totalprice AS value FROM orders
ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1""",
    "global_mean": f"SELECT coalesce({_EXACT_MEAN.format(c='o_totalprice')}, 0.0) AS mean FROM orders",
    "group_by_key": "SELECT user_id AS key, value FROM events",
    "group_by_key_sorted": f"""
SELECT user_id AS key, count(*) AS n, {_EXACT_MEAN.format(c='value')} AS mean
FROM events GROUP BY user_id""",
    "profile": """
SELECT 'o_orderkey' AS column_name, count(o_orderkey) AS count,
       CAST(min(o_orderkey) AS DOUBLE) AS min, CAST(max(o_orderkey) AS DOUBLE) AS max FROM orders
UNION ALL
SELECT 'o_custkey', count(o_custkey), CAST(min(o_custkey) AS DOUBLE), CAST(max(o_custkey) AS DOUBLE) FROM orders
UNION ALL
SELECT 'o_totalprice', count(o_totalprice), min(o_totalprice), max(o_totalprice) FROM orders""",
    "distinct_words": f"SELECT DISTINCT word FROM {_WORDS}",
    "word_count": f"SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word",
    "inverted_index": """
SELECT DISTINCT word, doc_id FROM (
  SELECT unnest(string_split(text, ' ')) AS word, CAST(doc_id AS VARCHAR) AS doc_id FROM documents)""",
    "terasort_buckets": _TERA,
    "terasort_dedup": f"SELECT DISTINCT bucket, value FROM ({_TERA})",
    "matvec_broadcast": f"WITH {_M} SELECT i, CAST(sum(v * (j + 1)) AS BIGINT) AS s FROM M GROUP BY i",
    "matvec_shuffle": f"WITH {_M} SELECT i, CAST(sum(v * (j + 1)) AS BIGINT) AS s FROM M GROUP BY i",
    "matmul_broadcast": f"{_SCORES} SELECT i, k, p FROM P",
    "matmul_join": f"{_GRAM} SELECT i, k, p FROM G",
    "matmul_scattered": f"{_GRAM} SELECT i, k, p FROM G",
    "matrix_dense": f"""{_GRAM}
SELECT r.i AS i, string_agg(CAST(coalesce(G.p, 0) AS VARCHAR), ',' ORDER BY t.k) AS cells
FROM range(0, (SELECT max(i) + 1 FROM G)) r(i)
CROSS JOIN range(0, (SELECT max(k) + 1 FROM G)) t(k)
LEFT JOIN G ON G.i = r.i AND G.k = t.k
GROUP BY r.i""",
    "matrix_allclose": f"""{_SCORES}
SELECT coalesce(bool_and(abs(coalesce(a.p, 0) - coalesce(b.p, 0))
                         <= 1e-08 + 1e-05 * abs(coalesce(b.p, 0))), true) AS ok,
       count(*) AS cells
FROM P a FULL OUTER JOIN P b ON a.i = b.i AND a.k = b.k""",
    "bike_max_total": """
SELECT l_suppkey AS bike_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS duration
FROM lineitem GROUP BY l_suppkey ORDER BY duration DESC, bike_id ASC LIMIT 1""",
    "bike_longest_trip": """
WITH top AS (SELECT l_suppkey AS bike_id FROM lineitem GROUP BY l_suppkey
             ORDER BY sum(CAST(l_quantity AS BIGINT)) DESC, l_suppkey ASC LIMIT 1)
SELECT l_orderkey AS id, l_suppkey AS bike_id, l_partkey AS start_station_id,
       CAST(l_linenumber AS BIGINT) AS end_station_id, CAST(l_quantity AS BIGINT) AS duration
FROM lineitem WHERE l_suppkey IN (SELECT bike_id FROM top)
ORDER BY duration DESC, id, start_station_id, end_station_id LIMIT 1""",
    "bike_count": "SELECT count(*) AS n_bikes FROM (SELECT DISTINCT l_suppkey FROM lineitem)",
    "users_over_threshold": f"""
SELECT l_partkey AS zip_code, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_duration
FROM lineitem GROUP BY l_partkey HAVING sum(CAST(l_quantity AS BIGINT)) >= {B.TRIP_THRESHOLD}""",
    "post_language": f"""{_POSTS}
SELECT p.creation_date AS creation_date, coalesce(m.language, 'No') AS language
FROM p LEFT JOIN m ON p.pid = m.pid""",
    "top_languages_by_year": f"""{_POSTS},
c AS (SELECT CAST(year(creation_date) AS INTEGER) AS year, language, count(*) AS n_posts
      FROM p JOIN m ON p.pid = m.pid
      WHERE creation_date BETWEEN TIMESTAMP '{B.POSTS_FROM}' AND TIMESTAMP '{B.POSTS_TO}'
      GROUP BY 1, 2)
SELECT year, language, n_posts FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY n_posts DESC, language) AS rn FROM c)
WHERE rn <= {B.TOP_LANGUAGES}""",
}

ORACLE_SQL.update({
    "count_languages_by_key": f"""{_POSTS}
SELECT language, count(*) AS n_posts FROM p JOIN m ON p.pid = m.pid
WHERE creation_date BETWEEN TIMESTAMP '{B.POSTS_FROM}' AND TIMESTAMP '{B.POSTS_TO}' GROUP BY language""",
    "natural_join_orders": """
SELECT l_partkey AS a, l_orderkey AS b, o_custkey AS c FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "typed_events": """
SELECT id, kind, k FROM (
  SELECT event_id AS id, event_type AS kind,
         TRY_CAST(regexp_extract(props, '^[^:]*: ([+-]?[0-9]+)[}]', 1) AS BIGINT) AS k FROM events)
WHERE id IS NOT NULL AND kind IS NOT NULL AND k IS NOT NULL""",
    "largest_order": "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
    "profile_moments": " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count,
       {_EXACT_MEAN.format(c=c)} AS mean,
       round(stddev_samp({c}), 4) AS stddev FROM orders""" for c in ("o_orderkey", "o_custkey", "o_totalprice")),
    "profile_quartiles": " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, {q} AS share, round(CAST(quantile_cont(CAST({c} AS DOUBLE), {q}) AS DOUBLE), 6) AS value
FROM orders""" for c in ("o_orderkey", "o_custkey", "o_totalprice") for q in ("CAST(0.25 AS DOUBLE)", "CAST(0.5 AS DOUBLE)",
                                                                            "CAST(0.75 AS DOUBLE)")),
    "group_lists": """
SELECT key, block_no, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids FROM (
  SELECT user_id AS key, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 1000 AS block_no
  FROM events) GROUP BY key, block_no""",
    "order_chunks": """
SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // CAST(ceil(count(*) OVER () / 16.0) AS BIGINT) AS INTEGER)
  AS chunk FROM orders""",
    "inverted_index_lists": """
SELECT word, block_no, string_agg(doc_id, ',' ORDER BY doc_id) AS doc_ids FROM (
  SELECT word, doc_id, (row_number() OVER (PARTITION BY word ORDER BY doc_id) - 1) // 1000 AS block_no FROM (
    SELECT DISTINCT unnest(string_split(text, ' ')) AS word, CAST(doc_id AS VARCHAR) AS doc_id FROM documents))
GROUP BY word, block_no""",
    "lines_of_documents": """
SELECT CAST(doc_id AS VARCHAR) || ':' || CAST(pos - 1 AS VARCHAR) AS key, line FROM (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))""",
    "distinct_words_of_documents": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, len(w) AS n_words, md5(array_to_string(w, ' ')) AS words_md5
FROM (SELECT doc_id, list_sort(list_distinct(string_split(text, ' '))) AS w FROM documents WHERE text IS NOT NULL)""",
    "bikes_by_total": """
SELECT l_suppkey AS bike_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS duration
FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_suppkey""",
    "top_languages_report": f"""{_POSTS},
c AS (SELECT CAST(year(creation_date) AS INTEGER) AS year, language, count(*) AS n_posts
      FROM p JOIN m ON p.pid = m.pid
      WHERE creation_date BETWEEN TIMESTAMP '{B.POSTS_FROM}' AND TIMESTAMP '{B.POSTS_TO}'
      GROUP BY 1, 2)
SELECT year, language, n_posts, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY n_posts DESC, language) AS rn FROM c)
WHERE rn <= {B.TOP_LANGUAGES}""",
    "mapreduce_chain": f"""
SELECT n, count(*) AS n_words FROM (SELECT word, count(*) AS n FROM {_WORDS} GROUP BY word) GROUP BY n""",
    "row_function_totals": """
SELECT l_returnflag, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                              * (100 - CAST(round(l_discount * 100) AS BIGINT))) AS BIGINT) AS cents
FROM lineitem GROUP BY l_returnflag""",
})

_ST = """WITH s AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) * {fa} AS lat,
                         CAST(embedding[2] AS DOUBLE) * {fo} AS long FROM embeddings),
d AS (SELECT a.id AS station_a, b.id AS station_b, {dist} AS dd FROM s a JOIN s b ON a.id < b.id)
SELECT station_a, station_b, round(dd, 6) AS distance FROM d
ORDER BY dd DESC, station_a, station_b LIMIT 1"""
_EUCLID = "sqrt(pow(a.lat - b.lat, 2) + pow(a.long - b.long, 2))"
_HAV = ("2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2)"
        " + cos(radians(a.lat)) * cos(radians(b.lat))"
        " * pow(sin((radians(b.long) - radians(a.long)) / 2), 2))))")
ORACLE_SQL["farthest_pair_degrees"] = _ST.format(fa="1.0", fo="1.0", dist=_EUCLID)
ORACLE_SQL["farthest_pair_haversine"] = _ST.format(fa="90.0", fo="180.0", dist=_HAV)

ORACLE_SQL["users_over_threshold_count"] = (
    f"SELECT count(*) AS n_users FROM ({ORACLE_SQL['users_over_threshold']})")
ORACLE_SQL["bike_trip_report"] = f"""
SELECT printf('trip %d: start station %d, end station %d, duration %d s',
              id, start_station_id, end_station_id, duration) AS report
FROM ({ORACLE_SQL['bike_longest_trip']})"""

ORACLE_SQL["mapreduce_group_avg"] = ORACLE_SQL["group_avg_filtered"]
ORACLE_SQL["orders_through_csv"] = ORACLE_SQL["orders_through_xml"] = "SELECT * FROM orders"
ORACLE_SQL["word_count_table_function"] = ORACLE_SQL["word_count"]
ORACLE_SQL["mapreduce_word_count"] = ORACLE_SQL["word_count"]
