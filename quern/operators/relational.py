"""Relational operators (FIL-*, PRJ-*, SET-*, JOIN-1, AGG-1..6, AGG-12, AGG-13).

Every operator is DataFrame in, DataFrame out, with no action inside; Catalyst
plans the physical strategy (partial + final aggregates, broadcast or
sort-merge joins, left-semi/anti joins for set operations).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.columns import col_, exact_mean
from quern.operators.ordering import number_rows


def select_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """FIL-1..FIL-5, FIL-2 (σ_C R): keep rows satisfying ``predicate``; duplicates kept (bag)."""
    return df.filter(predicate)


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """FIL-3 / FIL-9: drop rows with a null in ``subset`` (any column when omitted)."""
    return df.na.drop(how="any", subset=subset)


def project(df: DataFrame, *cols, distinct: bool = True) -> DataFrame:
    """PRJ-1 (π_S R with duplicate removal) and PRJ-2 (``distinct=False``)."""
    out = df.select(*cols)
    return out.distinct() if distinct else out


def rename(df: DataFrame, *exprs: str) -> DataFrame:
    """PRJ-3: rename/derive by SQL expressions (``"id as station_A"``)."""
    return df.selectExpr(*exprs)


def union_distinct(r: DataFrame, s: DataFrame) -> DataFrame:
    """SET-2: R ∪ S as a set."""
    return r.unionByName(s).distinct()


def intersect(r: DataFrame, s: DataFrame) -> DataFrame:
    """SET-3: R ∩ S as a set (trap T4: two inputs, not "seen exactly twice")."""
    return r.intersect(s)


def subtract(r: DataFrame, s: DataFrame) -> DataFrame:
    """SET-4: R − S as a set (left-anti join on all columns + distinct)."""
    return r.subtract(s)


def difference_once(r: DataFrame, s: DataFrame) -> DataFrame:
    """SET-4b: tuples that occur exactly once over R ⊎ S, and that once in R.

    The reference's reduce-side rule (values list is exactly ``[R]``), kept as a
    named variant. One aggregate over the tagged union: partial counts are
    combined map-side, so a hot tuple never holds more than a counter.
    """
    cols = r.columns
    tagged = (r.select(*cols, F.lit(0).alias("_rel"))
              .unionByName(s.select(*cols, F.lit(1).alias("_rel"))))
    g = tagged.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.max("_rel").alias("_max_rel"))
    return g.filter((F.col("_n") == 1) & (F.col("_max_rel") == 0)).select(*cols)


def natural_join(r: DataFrame, s: DataFrame, on: list[str] | str | None = None) -> DataFrame:
    """JOIN-1: R(a, b) ⋈ S(b, c) → (a, b, c), inner, bag semantics.

    ``on`` defaults to the common column names. Strategy (broadcast hash when a
    side is under the runtime size threshold, else sort-merge) is left to
    Catalyst and AQE.
    """
    if on is None:
        on = [c for c in r.columns if c in s.columns]
    on = [on] if isinstance(on, str) else list(on)
    rest_r = [c for c in r.columns if c not in on]
    rest_s = [c for c in s.columns if c not in on]
    return r.join(s, on, "inner").select(*rest_r, *on, *rest_s)


def group_aggregate(df: DataFrame, key: str, value: str, theta: str = "SUM",
                    out: str = "x") -> DataFrame:
    """AGG-6: γ_{key, θ(value)} with θ ∈ {SUM, MAX}; other θ raise ``ValueError``."""
    fns = {"SUM": F.sum, "MAX": F.max}
    t = theta.upper()
    if t not in fns:
        raise ValueError(f"theta must be SUM or MAX, not {theta!r}")
    return df.groupBy(F.col(key).alias("a")).agg(fns[t](value).alias(out))


def filtered_group_mean(df: DataFrame, predicate: Column, key: str, value: str,
                        out: str = "avg_value", exact: bool = False) -> DataFrame:
    """AGG-1 (flagship): ``SELECT key, avg(value) WHERE predicate GROUP BY key``.

    The filter runs before the shuffle (and reaches the Parquet scan); the
    aggregate is partial per map partition, then final per key. With ``exact``
    the mean is order-independent (exact decimal sum, one division).
    """
    mean = exact_mean(value) if exact else F.avg(value)
    return df.filter(predicate).groupBy(key).agg(mean.alias(out))


def global_max(df: DataFrame, label: str, value: str) -> DataFrame:
    """AGG-2: the (label, value) with the largest value; ties → largest label.

    One global aggregate (partial max per partition, one row per partition to
    the final) instead of a sort.
    """
    best = F.max_by(F.struct(F.col(label).alias("label"), F.col(value).alias("value")),
                    F.struct(F.col(value), F.col(label)))
    return df.agg(best.alias("_b")).select("_b.label", "_b.value")


def global_mean(df: DataFrame, value: str, exact: bool = True, out: str = "mean") -> DataFrame:
    """AGG-3: global mean; the mean of nothing is 0.0 (trap T22)."""
    m = exact_mean(value, empty_value=0.0) if exact \
        else F.coalesce(F.avg(value), F.lit(0.0))
    return df.agg(m.alias(out))


def grouped_bag(df: DataFrame, key: str, value: str, num_partitions: int | None = None) -> DataFrame:
    """AGG-4 / SRT-4: group-by-key as a clustered, sorted bag of (key, value).

    The reference builds ``key -> [values]`` lists. A list per key is unbounded
    (one hot key would land in one task and one row), so the group is kept as
    adjacent rows instead: range partitioning on (key, value) splits a hot key
    over several partitions, and each partition is sorted.
    """
    out = df.select(F.col(key).alias("key"), F.col(value).alias("value"),
                    F.monotonically_increasing_id().alias("_tie"))
    # The per-row tie-break lets a range cut fall inside a run of identical
    # (key, value) rows, so even one repeated pair spreads over tasks.
    order = ["key", "value", "_tie"]
    if num_partitions:
        out = out.repartitionByRange(num_partitions, *order)
    else:
        out = out.repartitionByRange(*order)
    return out.sortWithinPartitions(*order).drop("_tie")


def grouped_lists(df: DataFrame, key: str, value: str, block_rows: int = 10_000) -> DataFrame:
    """AGG-4: group-by-key into lists: ``(key, block_no, values)`` with the values in order, nulls first.

    A key's list comes in blocks of ``block_rows`` values, the last one shorter, so a hot key is many bounded rows;
    its blocks one after another are the whole list, repeated values included.
    """
    rows = number_rows(df.select(F.col(key).alias("key"), F.col(value).alias("value")), ["value"], ["key"])
    block = F.floor(F.col("row_no") / F.lit(block_rows))
    listed = F.array_sort(F.collect_list(F.struct("row_no", "value")))
    return rows.groupBy("key", block.alias("block_no")).agg(listed.alias("_l")) \
        .select("key", "block_no", F.col("_l.value").alias("values"))


def group_count_mean(df: DataFrame, key: str, value: str, exact: bool = True,
                     order: bool = True) -> DataFrame:
    """AGG-5: group by key (by sorting in the reference) then mean per key.

    Hash or sort aggregate is Catalyst's choice; output ordered by key.
    """
    mean = exact_mean(value) if exact else F.avg(value)
    out = df.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"), mean.alias("mean"))
    return out.orderBy("key") if order else out


def count_distinct(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """AGG-12: number of distinct values (a null counts as one value, as
    ``select(c).distinct().count()`` does)."""
    d = df.select(column).distinct()
    return d.agg(F.count(F.lit(1)).alias(out))


def argmax_row(df: DataFrame, by: str, tie_break: list[str] | None = None) -> DataFrame:
    """AGG-13: the whole row with the largest ``by`` (ties: smallest tie-break columns).

    ``TakeOrderedAndProject``: each partition keeps its best row, no full sort.
    """
    order = [F.col(by).desc()] + [F.col(c).asc() for c in (tie_break or [])]
    return df.orderBy(*order).limit(1)


def having(df: DataFrame, predicate: Column) -> DataFrame:
    """FIL-8: filter after aggregation."""
    return df.filter(predicate)


def sum_by(df: DataFrame, key: str, value, out: str) -> DataFrame:
    """AGG-7: sum per key (nulls skipped)."""
    return df.groupBy(key).agg(F.sum(col_(value)).alias(out))
