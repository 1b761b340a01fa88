"""Merkle-tree document fingerprints (operator 9), in DataFrame functions only.

A text is cut into sections (up to eight lines and the blank lines after them), a
section into paragraphs (lines), and a paragraph over ``PIECE_CHARS`` characters into
pieces of that length. Leaves are SHA-256 of the pieces, a section's hash is that of
its leaves, and the root that of the sections. Every character is part of one leaf.

The fingerprint string is ``root:section=leaf,leaf;section=leaf,...`` with 16 and 8 hex
digits of section and leaf hashes. Equal roots mean equal texts; unequal section hashes
name the branches to descend, and the leaves that differ locate an edit. The likeness of
two fingerprints is twice the number of distinct leaves they share by the sum of both.

Defined results: a null text is the empty text, with no section; two empty trees are
alike (1), an empty and another one not (0). Rows without doc_id come first in order,
equal ids by text hash; repeated rows follow one another. The only row of a table is
its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import prepare, table

PIECE_CHARS = 64
SECTION = r"(?:[^\n]++\n?+){1,8}+\n*+|\n++"
PIECE = rf"[^\n]{{1,{PIECE_CHARS}}}+\n?+|\n"
LOWEST = -(1 << 63)


def leaves(text: Column) -> Column:
    """Per section, the hashes of its pieces."""
    return F.transform(F.regexp_extract_all(text, F.lit(SECTION), F.lit(0)),
                       lambda s: F.transform(F.regexp_extract_all(s, F.lit(PIECE), F.lit(0)), lambda p: F.sha2(p, 256)))


def sections(tree: Column) -> Column:
    return F.transform(tree, lambda s: F.sha2(F.array_join(s, ","), 256))


def leaf_set(tree: Column) -> Column:
    """Distinct short leaf hashes."""
    return F.array_distinct(F.transform(F.flatten(tree), lambda h: F.substring(h, 1, 8)))


def fingerprint(tree: Column) -> Column:
    hashes = sections(tree)
    body = F.transform(F.arrays_zip(hashes.alias("h"), tree.alias("t")), lambda s: F.concat(
        F.substring(s["h"], 1, 16), F.lit("="), F.array_join(F.transform(s["t"], lambda x: F.substring(x, 1, 8)), ",")))
    return F.concat(F.sha2(F.array_join(hashes, ","), 256), F.lit(":"), F.array_join(body, ";"))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two leaf sets, 0 to 1."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def differing_sections(a: str, b: str) -> Column:
    """Positions (from 0) at which two fingerprint strings have unequal sections."""
    def part(c):
        return F.transform(F.split(F.element_at(F.split(c, ":"), 2), ";"), lambda s: F.substring(s, 1, 16))
    return F.filter(F.transform(F.arrays_zip(part(F.col(a)).alias("a"), part(F.col(b)).alias("b")),
                                lambda s, i: F.when(~s["a"].eqNullSafe(s["b"]), i)), lambda i: i.isNotNull())


def ranges(keys: DataFrame, n: int) -> list[int]:
    """At most ``n`` values of ``key``, ascending from the smallest, that cut it into like shares."""
    cuts = keys.agg(F.percentile_approx("key", [i / n for i in range(n)], 100 * n), F.min("key")).first()
    return sorted({*(cuts[0] or []), cuts[1]}) if cuts[1] is not None else []


def range_of(key: Column, cuts: list[int]) -> Column:
    """Position of the last cut at or below ``key``: a coarse step, then one within it."""
    step = max(1, int(len(cuts) ** 0.5))
    known = F.lit(cuts)
    coarse = F.size(F.filter(F.lit(cuts[::step]), lambda c: c <= key)) - 1
    return coarse * step + F.size(F.filter(F.slice(known, coarse * step + 1, F.lit(step)), lambda c: c <= key)) - 1


def with_next(docs: DataFrame, values: dict[str, Column]) -> DataFrame:
    """``docs(doc_id, text)`` with ``values`` and, as ``next_<name>``, those of the next row by doc_id.

    Rows are dealt by ranges of the id whose lower ends are ids of the table. The first
    row of a range is also sent to the range before it, as its last row's next one.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    n = max(1, min(4000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))   # several to a task
    cuts = ranges(docs.select(key.alias("key")), n)
    if not cuts:
        cuts = [LOWEST]
    at = range_of(F.col("_key"), cuts)
    before = F.pmod(F.col("_range") - 1, F.lit(len(cuts)))
    rows = docs.withColumn("_key", key).withColumn("_range", at)
    first = F.element_at(F.lit(cuts), F.col("_range") + 1) == F.col("_key")
    places = F.when(first, F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("extra")),
                                   F.struct(before.alias("r"), F.lit(True).alias("extra")))) \
        .otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("extra"))))
    rows = rows.withColumn("_place", F.explode(places)).select(
        "doc_id", "text", "_key", F.col("_place.r").alias("_range"), F.col("_place.extra").alias("_extra"))
    order = Window.partitionBy("_range").orderBy("_extra", "_key", F.xxhash64("text"))
    rows = rows.repartition("_range").withColumns(values)
    return rows.withColumns({f"next_{c}": F.lead(c).over(order) for c in values}).where("not _extra")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, with both likenesses."""
    text = F.coalesce("text", F.lit(""))
    rows = with_next(docs.select("doc_id", text.alias("text")), {"body": F.col("text"), "tree": leaves(F.col("text"))})
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - cut), F.substr("next_body", F.lit(1), cut))
    rows = rows.select("doc_id", "tree", F.col("next_tree"), n.cast("long").alias("n_chars"), edited.alias("edited")) \
        .withColumn("edited_tree", leaves(F.col("edited")))
    own = leaf_set(F.col("tree"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("tree")).alias("fingerprint"),
                       fingerprint(F.col("edited_tree")).alias("edited_fingerprint"),
                       likeness(own, leaf_set(F.col("edited_tree"))).alias("near_edited"),
                       likeness(own, leaf_set(F.col("next_tree"))).alias("near_next"))


def op9_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint, edited fingerprint and likenesses of every document."""
    prepare(spark)
    return edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))
