"""Mixing sources to target weights by systematic sampling (operator 4).

Every source has a target in words. Within a source the documents stand in a fixed
order, the expected copies (target by source size, in whole units of 2**-20) are
prefix-summed, one offset drawn from the seed is added, and a document is emitted once
per integer boundary its span crosses. Reruns agree: order and offset are hashes.

The order is by size, so that the words taken follow the copies taken. A source is cut
along it into size classes (decimal digits and the two leading ones) and hashed shares
of large classes; sums per share are prefix-summed over the shares, and rows only
within a share. So no task holds a whole source.

Defined results: a null text has size 0; a null source is a source of its own, last in
order. A source of size 0 has target 0. Repeated rows are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import prepare, small_side, staged, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
UNIT = 1 << 20
MAX_BROADCAST_ROWS = 50_000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from one row per source ``(source, source_size)``.

    Weights repeat along the sources by code point, null last. The total is shared by
    weight; no target passes ``most`` times its size, and the excess is shared again.
    In order of cap by weight, a source is capped while the level that the rest would
    get is above its own; the first level that is not holds for all after it.
    """
    # One row per source in these windows.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("place", F.row_number().over(order))
    free = F.min(F.when(F.col("cap") / F.col("w") >= F.col("level"), F.struct("place", "level"))).over(every)
    return s.withColumn("free", free["level"]).select(
        "source", "source_size", F.least("cap", F.coalesce(F.col("free") * F.col("w"), F.col("cap"))).alias("target"))


def size_class(size: Column) -> Column:
    text = size.cast("string")
    return (F.length(text) * 100 + F.substring(text, 1, 2).cast("int")).cast("int")


def hashed(text: Column, hex_digits: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, hex_digits), 16, 10).cast("long")


def plan(keys: DataFrame, seed: str = "mix", weights=WEIGHTS, share: float = SHARE,
         most: float = MOST) -> tuple[DataFrame, DataFrame]:
    """Sources with their rate, and every share with its prefix sum; from ``(doc_id, source, size)``."""
    rates = staged(targets(keys.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
                   .withColumn("units", F.when(F.col("source_size") > 0,
                                               F.floor(F.col("target") / F.col("source_size") * UNIT)).otherwise(0).cast("long"))
                   .withColumn("offset", hashed(F.concat(F.lit(seed + "|"), F.coalesce("source", F.lit("\0"))), 5)), "rates")
    classes = keys.groupBy("source", size_class(F.col("size")).alias("class")).agg(F.count("*").alias("rows"))
    classes = staged(classes, "classes")
    n = classes.agg(F.sum("rows")).first()[0] or 0
    per_share = max(100, int(n ** 0.5))                       # about as many shares as rows in one
    classes = staged(classes.select("source", "class", F.ceil(F.col("rows") / per_share).alias("shares")), "shares")
    return rates, classes


def with_copies(docs: DataFrame, keys: DataFrame, seed: str = "mix", weights=WEIGHTS, share: float = SHARE,
                most: float = MOST) -> DataFrame:
    """``docs`` (with ``doc_id``, ``source``, ``size``) plus its source's size and target, and ``copies``.

    ``keys`` holds the same rows' ``(doc_id, source, size)``; all sums are made from it.
    """
    rates, classes = plan(keys, seed, weights, share, most)
    n_rates, n_classes = rates.count(), classes.count()

    def placed(df: DataFrame) -> DataFrame:
        r = small_side(rates.select(F.col("source").alias("_rs"), "source_size", "target", "units", "offset"),
                       n_rates, MAX_BROADCAST_ROWS)
        c = small_side(classes.select(F.col("source").alias("_cs"), F.col("class").alias("_cc"), "shares"),
                       n_classes, MAX_BROADCAST_ROWS)
        df = df.withColumn("_class", size_class(F.col("size")))
        return df.join(c, df["source"].eqNullSafe(c["_cs"]) & (df["_class"] == c["_cc"])).drop("_cs", "_cc") \
            .join(r, df["source"].eqNullSafe(r["_rs"])).drop("_rs") \
            .withColumn("_share", F.pmod(hashed(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 8), "shares")) \
            .drop("shares")

    sums = placed(keys).groupBy("source", "_class", "_share").agg(F.sum("units").alias("units"))
    before = Window.partitionBy("source").orderBy("_class", "_share").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged(sums.withColumn("start", F.coalesce(F.sum("units").over(before), F.lit(0))).drop("units"), "starts")
    s = small_side(starts.select(F.col("source").alias("_ss"), F.col("_class").alias("_sc"),
                                 F.col("_share").alias("_sh"), "start"), starts.count(), MAX_BROADCAST_ROWS)
    rows = placed(docs)
    rows = rows.join(s, rows["source"].eqNullSafe(s["_ss"]) & (rows["_class"] == s["_sc"]) & (rows["_share"] == s["_sh"])) \
        .drop("_ss", "_sc", "_sh")
    within = Window.partitionBy("source", "_class", "_share").orderBy("size", "doc_id") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("start") + F.sum("units").over(within) + F.col("offset")
    return rows.withColumn("_end", end) \
        .withColumn("copies", F.floor(F.col("_end") / UNIT) - F.floor((F.col("_end") - F.col("units")) / UNIT)) \
        .drop("_class", "_share", "start", "units", "offset", "_end")


def document_keys(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count("text").alias("size"))


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it."""
    prepare(docs.sparkSession)
    names = docs.columns
    keys = staged(document_keys(docs), "keys")
    inner = docs.select(F.col("doc_id"), F.col("source"), word_count("text").alias("size"),
                        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    return with_copies(inner, keys, **settings) \
        .select(F.explode(F.array_repeat("_row", F.col("copies").cast("int"))).alias("_row")).select("_row.*")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    prepare(spark)
    keys = staged(document_keys(table(spark, sf_dir, "documents")), "keys")
    return with_copies(keys, keys).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP4_SQL = r"""
WITH k AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS w,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS place,
             (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
f AS (SELECT level FROM l WHERE cap / w >= level ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM f) * w, cap)) AS target FROM l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 1048576)::BIGINT ELSE 0 END AS units,
             ('0x' || substr(md5('mix|' || coalesce(source, chr(0))), 1, 5))::BIGINT AS offs FROM t),
c AS (SELECT *, length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::INT AS class FROM k),
n AS (SELECT source, class, ceil(count(*) / greatest(100, floor(sqrt((SELECT count(*) FROM k)))))::BIGINT AS shares FROM c GROUP BY ALL),
p AS (SELECT c.*, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % shares AS share, source_size, target, units, offs
      FROM c JOIN n ON c.source IS NOT DISTINCT FROM n.source AND c.class = n.class
             JOIN u ON c.source IS NOT DISTINCT FROM u.source),
e AS (SELECT *, sum(units) OVER (PARTITION BY source ORDER BY class, share, size, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING)::BIGINT + offs AS fin FROM p)
SELECT doc_id, size, source_size, target, ((fin // 1048576 - (fin - units) // 1048576) * size)::BIGINT AS taken FROM e
"""
