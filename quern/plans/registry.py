"""Name → query callable for every registered query (``__spark_entry__.queries``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quern.plans import batch as B

QueryFn = Callable[[SparkSession, str], DataFrame]


def batch_queries() -> dict[str, QueryFn]:
    return {
        "group_avg_filtered": B.group_avg_filtered,
        "selection": B.selection,
        "projection_distinct": B.projection_distinct,
        "set_union": B.set_union,
        "set_intersect": B.set_intersect,
        "set_difference": B.set_difference,
        "difference_once": B.difference_once,
        "natural_join": B.natural_join,
        "group_sum": B.group_sum,
        "group_max": B.group_max,
        "global_max": B.global_max,
        "global_mean": B.global_mean,
        "group_by_key": B.group_by_key,
        "group_by_key_sorted": B.group_by_key_sorted,
        "profile": B.profile_orders,
        "distinct_words": B.distinct_words,
        "word_count": B.word_count,
        "inverted_index": B.inverted_index,
        "terasort_buckets": B.terasort_buckets,
        "terasort_dedup": B.terasort_dedup,
        "matvec_broadcast": B.matvec_broadcast,
        "matvec_shuffle": B.matvec_shuffle,
        "matmul_broadcast": B.matmul_broadcast,
        "matmul_join": B.matmul_join,
        "matmul_scattered": B.matmul_scattered,
        "matrix_dense": B.matrix_dense,
        "matrix_allclose": B.matrix_allclose,
        "bike_max_total": B.bike_max_total,
        "bike_longest_trip": B.bike_longest_trip,
        "bike_count": B.bike_count,
        "users_over_threshold": B.users_over_threshold,
        "users_over_threshold_count": B.users_over_threshold_count,
        "bike_trip_report": B.bike_trip_report,
        "farthest_pair_degrees": B.farthest_pair_degrees,
        "farthest_pair_haversine": B.farthest_pair_haversine,
        "post_language": B.post_language,
        "top_languages_by_year": B.top_languages_by_year,
        "mapreduce_group_avg": B.mapreduce_group_avg,
        "mapreduce_word_count": B.mapreduce_word_count,
        "natural_join_orders": B.natural_join_orders,
        "typed_events": B.typed_events,
        "largest_order": B.largest_order,
        "profile_moments": B.profile_moments,
        "word_count_table_function": B.word_count_table_function,
        "orders_through_csv": B.orders_through_csv,
        "orders_through_xml": B.orders_through_xml,
        "profile_quartiles": B.profile_quartiles,
        "group_lists": B.group_lists,
        "order_chunks": B.order_chunks,
        "inverted_index_lists": B.inverted_index_lists,
        "lines_of_documents": B.lines_of_documents,
        "distinct_words_of_documents": B.distinct_words_of_documents,
        "bikes_by_total": B.bikes_by_total,
        "top_languages_report": B.top_languages_report,
        "mapreduce_chain": B.mapreduce_chain,
        "count_languages_by_key": B.count_languages_by_key,
        "row_function_totals": B.row_function_totals,
    }


def stream_queries() -> dict[str, QueryFn]:
    from quern.plans import streams as S
    return {
        "ride_cleansing": S.ride_cleansing,
        "hourly_tips": S.hourly_tips,
        "hourly_tips_user_window": S.hourly_tips_user_window,
        "hourly_max_tip": S.hourly_max_tip,
        "ride_fare_pairs": S.ride_fare_pairs,
        "expiring_pairs": S.expiring_pairs,
        "unmatched_fares": S.unmatched_fares,
        "expiring_pairs_keyed": S.expiring_pairs_keyed,
        "hourly_tips_resumed": S.hourly_tips_resumed,
        "hourly_tips_late": S.hourly_tips_late,
        "waiting_rides": S.waiting_rides,
    }


def all_queries() -> dict[str, QueryFn]:
    return {**batch_queries(), **stream_queries()}
