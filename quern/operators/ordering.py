"""Sorts, partitioning, limits and top-k (SRT-*, PAR-*, TOP-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.columns import col_, equal_width_bucket, unused
from quern.session import scratch_path


def hash_partition(df: DataFrame, num_partitions: int, *keys: str) -> DataFrame:
    """PAR-1: hash partitioning (Murmur3) of keys over ``num_partitions``; sorted inside (SRT-4)."""
    return df.repartition(num_partitions, *keys).sortWithinPartitions(*keys)


def range_partition(df: DataFrame, num_partitions: int, *keys: str) -> DataFrame:
    """PAR-2: range partitioning with sampled bounds; sorted inside each partition."""
    return df.repartitionByRange(num_partitions, *keys).sortWithinPartitions(*keys)


def even_splits(df: DataFrame, num_partitions: int) -> DataFrame:
    """PAR-3: even input splits (round-robin); ``even_chunks`` keeps the order."""
    return df.repartition(num_partitions)


def number_rows(df: DataFrame, order: list, group: list[str] | None = None, number: str = "row_no",
                size: str = "group_rows") -> DataFrame:
    """PAR-3 / SRC-3: each row's place (from 0) in ``order`` inside its group, and the group's row count.

    No window over the rows: they are range-sorted by (group, order) and written to the shared
    folder with the place that each has in its range, ranges are counted per group,
    and a row's number is its place plus the group's counts in the ranges before. The only window runs over
    these counts, one row per range and group in it, so one group may hold all rows. Rows equal in ``order``
    are numbered side by side in any order. Null groups are groups; nulls come first in ``order``
    unless it says otherwise. An empty table gives no rows.
    """
    group = group or []
    new = {n: unused(df, n) for n in ("_tie", "_at", "_range", "_first", "_n", "_shift")}
    keys = [*[F.col(f"`{g}`").asc_nulls_first() for g in group],
            *[o if isinstance(o, Column) else F.col(f"`{o}`").asc_nulls_first() for o in order], F.col(new["_tie"])]
    # The tie-break is a hash of the row's place in the input: equal rows spread over ranges.
    ranged = df.withColumn(new["_tie"], F.xxhash64(F.monotonically_increasing_id())) \
        .repartitionByRange(*keys).sortWithinPartitions(*keys).drop(new["_tie"]) \
        .withColumn(new["_at"], F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "numbered")
    ranged.write.parquet(path)
    held = df.sparkSession.read.schema(ranged.schema).parquet(path) \
        .withColumn(new["_range"], F.shiftright(new["_at"], 33))
    counts = held.groupBy(new["_range"], *group).agg(F.min(new["_at"]).alias(new["_first"]), F.count("*").alias(new["_n"]))
    one = Window.partitionBy(*[F.col(f"`{g}`") for g in group])
    before = F.sum(new["_n"]).over(one.orderBy(new["_range"]).rowsBetween(Window.unboundedPreceding, -1))
    sides = {c: f"{new['_shift']}{i}" for i, c in enumerate([new["_range"], *group])}
    counts = counts.select(*[F.col(f"`{c}`").alias(a) for c, a in sides.items()],
                           F.sum(new["_n"]).over(one).alias(size),
                           (F.coalesce(before, F.lit(0)) - F.col(new["_first"])).alias(new["_shift"]))
    on = [F.col(f"`{c}`").eqNullSafe(F.col(a)) for c, a in sides.items()]
    return held.join(counts, on).withColumn(number, F.col(new["_at"]) + F.col(new["_shift"])) \
        .select(*[F.col(f"`{c}`") for c in df.columns if c not in (number, size)], number, size)


def even_chunks(df: DataFrame, order: list, maps: int, chunk: str = "chunk") -> DataFrame:
    """PAR-3: contiguous chunks of ``ceil(rows / maps)`` rows in ``order``; the last ones may be short or missing."""
    no, rows = unused(df, "row_no"), unused(df, "group_rows")
    return number_rows(df, order, number=no, size=rows) \
        .withColumn(chunk, F.floor(F.col(no) / F.ceil(F.col(rows) / F.lit(maps))).cast("int")).drop(no, rows)


def order_statistics(df: DataFrame, columns: list[str], shares: list[float]) -> DataFrame:
    """SNK-5: ``(column_name, share, value)``: exact quantiles of numeric columns, interpolated between neighbours.

    Values of all columns are numbered together, one group per column, and the two neighbours
    of each wanted place are picked by their number. Nulls do not count; a column without values has null quantiles.
    """
    names = F.array(*[F.lit(c) for c in columns])
    values = F.array(*[F.col(f"`{c}`").cast("double") for c in columns])
    long = df.select(F.posexplode(values).alias("c", "v")).select(F.get(names, F.col("c")).alias("column_name"), "v")
    ranked = number_rows(long.where("v IS NOT NULL"), ["v"], ["column_name"])
    want = df.sparkSession.createDataFrame([(c, float(q)) for c in columns for q in shares], "column_name string, share double")
    place = F.col("share") * (F.col("group_rows") - 1)
    near = ranked.join(F.broadcast(want), "column_name").where(F.abs(F.col("row_no") - place) < 1)
    low, part = F.min_by("v", "row_no"), F.max(place - F.floor(place))
    found = near.groupBy("column_name", "share").agg(
        (low + (F.max_by("v", "row_no") - low) * part).alias("value"))
    return want.join(found, ["column_name", "share"], "left").select("column_name", "share", "value")


def range_sort(df: DataFrame, value: str, n_buckets: int, lo=None, hi=None,
               dedup: bool = False) -> DataFrame:
    """SRT-3 (TeraSort): globally sorted values with their equal-width bucket.

    ``bucket`` is the reference's partitioner (``n_buckets`` right-closed,
    equal-width buckets over [lo, hi]; bounds default to the data's min/max). The sort
    itself uses Spark's range exchange with *sampled* bounds, so skewed value
    ranges still split evenly over tasks. ``dedup=True`` gives the reference's
    one-row-per-distinct-value output (trap T3).
    """
    v = F.col(value)
    src = df.select(v.alias("value"))
    # Missing bounds come from one scalar subquery (a single min/max aggregate,
    # evaluated once and inlined as a literal).
    if lo is None or hi is None:
        b = src.select(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    lo_c = b["lo"] if lo is None else F.lit(lo)
    hi_c = b["hi"] if hi is None else F.lit(hi)
    out = src.select(equal_width_bucket("value", lo_c, hi_c, n_buckets).alias("bucket"), "value")
    if dedup:
        return out.distinct().orderBy("value", "bucket")
    # Identical values cannot be split by a range exchange on the value alone;
    # a per-row tie-break (position in the scan, deterministic for a given
    # input) lets the sampled bounds cut a very frequent value into many tasks.
    return (out.withColumn("_tie", F.monotonically_increasing_id())
            .orderBy("value", "bucket", "_tie").drop("_tie"))


def top1(df: DataFrame, *order: Column) -> DataFrame:
    """TOP-1 / TOP-2: first row by an ordering (``TakeOrderedAndProject``, no full sort)."""
    return df.orderBy(*order).limit(1)


def top_n_per_group(df: DataFrame, group: list[str] | str, order: list[Column], n: int,
                    rank_col: str | None = None) -> DataFrame:
    """TOP-3: the first ``n`` rows per group by ``order`` (ties broken by the order list).

    ``row_number() <= n`` is planned as ``WindowGroupLimit`` (partial before the
    shuffle, final after), so each task keeps at most n rows per group.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    name = rank_col or "_rn"
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def take(df: DataFrame, n: int) -> DataFrame:
    """TOP-4: ``limit(n)`` without order (which rows is not defined)."""
    return df.limit(n)


def sort_desc(df: DataFrame, *cols: str) -> DataFrame:
    """SRT-1 / SRT-2: global sort, all keys descending."""
    return df.orderBy(*[col_(c).desc() for c in cols])
