"""Merkle manifest of a data set: a leaf for each row, a tree for each source, a tree over sources (operator 12).

Rows are numbered inside their source, and every level is one self-join: a node's siblings are
the nodes whose numbers lie at the other slots of its run (its number XOR 1 in binary
trees), looked up by ``(tree, number)``. The joined row holds the hashes left and right
of the node, which is the node's step of the proof, and the slot-zero rows emit the parents.
Keys differ in every row, so a hot source is spread like any other. Levels are written tables, one third as long
each; on the way down each node takes its parent's steps, and a root takes those of its source
in the tree over sources.

A digest is lower-case hexadecimal sha256 of its inputs put together. A leaf hashes its fields in order:
``-`` for null, else the UTF-8 byte count, ``:`` and the value.

Defined results: null sources are a source of their own, the first. Null doc_ids come first in their source;
equal doc_ids follow by leaf, and repeated rows are neighbours with proofs of their own. A
source with one row is its own subroot, and one source alone its own root; without any
sibling the proof is empty. An empty table gives no rows. Columns that are neither fields nor kept are
not read; a kept column named as a result column is replaced. A row whose doc_id is null counts as
tampered (crc32 of nothing is 0).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import crc32_of_id, prepare, staged, table

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def hash_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(fields: Sequence[Column]) -> Column:
    """Digest of a row's fields, each with its length before it."""
    texts = [c.cast("string") for c in fields]
    return hash_of(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``tree`` (rises with ``group``, nulls first), ``idx`` (place in the group, from 0) and ``size``.

    ``rows`` is a written table. It is range-sorted, written with each row's place in its
    range, and a row's number is its place plus the group's counts in the ranges before.
    """
    tie = F.monotonically_increasing_id()                   # equal rows may be cut between ranges
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_tie")]
    ranged = staged(rows.withColumn("_tie", tie).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                    .withColumn("_at", F.monotonically_increasing_id()), "manifest-order") \
        .withColumn("_part", F.shiftright("_at", 33))
    runs = ranged.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    of_group = Window.partitionBy(group)
    before = F.sum("_n").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(F.col(group).alias("_of"), F.col("_part").alias("_run"),
                       F.min("_first").over(of_group).alias("tree"), F.sum("_n").over(of_group).alias("size"),
                       (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return ranged.join(runs, (F.col("_part") == F.col("_run")) & F.col(group).eqNullSafe(F.col("_of"))) \
        .withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_of", "_run", "_shift")


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes of trees with more than one, each with the hashes ``left`` and ``right`` of it in its run."""
    slot = F.col("idx") % arity
    out, found = nodes.where("size > 1"), []
    others = nodes.where("size > 1").select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), F.col("digest").alias("_d"))
    for shift in range(1, arity):
        sibling = F.col("idx").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("idx") - slot + (slot + shift) % arity
        names = {c: f"{c}{shift}" for c in others.columns}
        out = out.join(others.withColumnsRenamed(names), (F.col("tree") == F.col(f"_t{shift}"))
                       & (sibling == F.col(f"_i{shift}")), "left")
        found.append(F.struct(F.col(f"_i{shift}").alias("i"), F.col(f"_d{shift}").alias("d")))
    run = F.array_sort(F.filter(F.array(*found), lambda s: s.i.isNotNull()))

    def side(of):
        return F.array_join(F.transform(F.filter(run, of), lambda s: s.d), "")
    return out.select(*[F.col(f"`{c}`") for c in nodes.columns], side(lambda s: s.i < F.col("idx")).alias("left"),
                      side(lambda s: s.i > F.col("idx")).alias("right"))


def grow(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """Levels of all trees from the leaves up, and ``(tree, level, digest)`` of the roots.

    The number of levels follows from the largest tree, the one number that is fetched.
    """
    largest = nodes.agg(F.max("size")).first()[0] or 0
    levels, roots = [], None
    while True:
        top = nodes.where("size = 1").select("tree", F.lit(len(levels)).alias("level"), "digest")
        roots = top if roots is None else roots.unionByName(top)
        if largest <= 1:
            return levels, roots
        level = staged(with_siblings(nodes, arity), "manifest-level")
        levels.append(level)
        nodes = level.where(F.col("idx") % arity == 0).select(
            "tree", (F.col("idx") / arity).cast("long").alias("idx"), F.ceil(F.col("size") / arity).alias("size"),
            hash_of(F.col("digest"), F.col("right")).alias("digest"))
        largest = -(-largest // arity)


def descend(levels: list[DataFrame], roots: DataFrame, arity: int) -> DataFrame:
    """Leaves of the trees with ``subroot`` and ``steps`` to the top; ``roots`` have ``(tree, level, subroot, steps)``."""
    def of(level):
        return roots.where(F.col("level") == level).select(F.col("tree").alias("_t"), F.lit(0).cast("long").alias("_i"),
                                                           "subroot", "steps")
    above = of(len(levels))
    for k in range(len(levels) - 1, -1, -1):
        step = F.array(F.struct("left", "right"))
        here = levels[k].join(above, (F.col("tree") == F.col("_t")) & (F.floor(F.col("idx") / arity) == F.col("_i"))) \
            .withColumn("steps", F.concat(step, "steps"))
        if k == 0:
            return here.drop("_t", "_i", "left", "right")
        above = here.select(F.col("tree").alias("_t"), F.col("idx").alias("_i"), "subroot", "steps").unionByName(of(k))
    return None


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and the steps of its proof lead to."""
    return F.aggregate(steps, leaf, lambda acc, s: hash_of(s.left, acc, s.right))


def dataset_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id",
                     keep: Sequence[str] = ("doc_id",), arity: int = ARITY) -> DataFrame:
    """``keep`` columns with ``leaf``, ``subroot``, ``root`` and ``steps``: the hashes left and right of the path, level by level."""
    leaves = staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"), F.col(f"`{group}`").alias("_group"),
                                F.col(f"`{key}`").alias("_key"), leaf_hash([F.col(f"`{c}`") for c in fields]).alias("digest")),
                    "manifest-leaves")
    nodes = staged(numbered(leaves, "_group", [F.col("_key").asc_nulls_first(), F.col("digest").asc()])
                   .drop("_group", "_key"), "manifest-nodes")
    levels, roots = grow(nodes, arity)
    subroots = staged(roots, "manifest-subroots")
    # The tree over sources: one group, in the order of the trees' numbers.
    upper = staged(numbered(subroots.select(F.lit(0).alias("_all"), F.col("tree").alias("of"), "level", "digest"), "_all",
                            [F.col("of").asc()]).drop("_all"), "manifest-upper")
    high, top = grow(upper, arity)
    root = top.select("digest").first()
    no_steps = F.array().cast("array<struct<left:string,right:string>>")
    tops = top.select("tree", "level", F.col("digest").alias("subroot"), no_steps.alias("steps"))
    up = descend(high, tops, arity) if high else upper.withColumn("steps", no_steps)
    starts = staged(up.select(F.col("of").alias("tree"), "level", F.col("digest").alias("subroot"), "steps"), "manifest-starts")
    lone = nodes.where("size = 1").join(starts.where("level = 0"), "tree").drop("level")
    rows = lone.unionByName(descend(levels, starts, arity)) if levels else lone
    new = ("leaf", "subroot", "root", "steps")
    return rows.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep if c.lower() not in new], F.col("digest").alias("leaf"),
                       "subroot", F.lit(root[0] if root else None).alias("root"), "steps")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests, proof and outcome of the check of every document, half of them tampered with."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    deleted = leaf_hash([*map(F.col, FIELDS[:-1]), F.replace(F.col("text"), F.lit("\n"), F.lit(""))])
    tampered = F.when((crc32_of_id("doc_id") % 2 == 0) & F.col("text").contains("\n"), deleted)
    rows = dataset_manifest(docs.withColumn("tampered", tampered), keep=("doc_id", "tampered"))
    rows = rows.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("steps")))
    proof = F.array_join(F.transform("steps", lambda s: F.concat(s.left, s.right)), "")
    return rows.select("doc_id", "leaf", "subroot", "root", hash_of(proof).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(text: str) -> str:
    parts = [*(f"CAST({c} AS VARCHAR)" for c in FIELDS[:-1]), text]
    return "sha256(" + " || ".join(f"CASE WHEN {p} IS NULL THEN '-' ELSE strlen({p}) || ':' || {p} END" for p in parts) + ")"


def _sql_steps(nodes: str, group: str) -> str:
    """Siblings left and right of every node that has a parent."""
    return f"""SELECT a.{group}, a.lvl, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
                 coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
          FROM {nodes} a LEFT JOIN {nodes} b ON a.{group} IS NOT DISTINCT FROM b.{group} AND a.lvl = b.lvl
               AND a.idx // 3 = b.idx // 3 AND a.idx <> b.idx WHERE a.size > 1 GROUP BY ALL"""


# crc32 of an id's digits, eight shifts a byte (fixed value: the polynomial 3988292384).
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, range(8 * length(digits))::BIGINT[]), lambda a, k:
    CASE WHEN xor(a, CASE WHEN k % 8 = 0 THEN ascii(substr(digits, k // 8 + 1, 1)) ELSE 0 END) % 2 = 1
    THEN xor(xor(a, CASE WHEN k % 8 = 0 THEN ascii(substr(digits, k // 8 + 1, 1)) ELSE 0 END) >> 1, 3988292384)
    ELSE xor(a, CASE WHEN k % 8 = 0 THEN ascii(substr(digits, k // 8 + 1, 1)) ELSE 0 END) >> 1 END))"""
OP12_SQL = f"""WITH RECURSIVE
docs AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') AS digits FROM documents),
hashed AS (SELECT doc_id, source, {_sql_leaf('text')} AS leaf, CASE WHEN digits = '' OR {_CRC} % 2 = 0
    THEN {_sql_leaf("replace(text, chr(10), '')")} ELSE {_sql_leaf('text')} END AS changed FROM docs),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY source) AS size FROM hashed),
nodes AS (SELECT source, 0 AS lvl, idx, size, leaf AS digest FROM leaves UNION ALL
    SELECT source, lvl + 1, idx // 3, (any_value(size) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE size > 1 GROUP BY source, lvl, idx // 3),
subs AS (SELECT 0 AS one, 0 AS lvl, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS size,
    source, digest FROM nodes WHERE size = 1),
tops AS (SELECT one, lvl, idx, size, digest FROM subs UNION ALL
    SELECT one, lvl + 1, idx // 3, (any_value(size) + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE size > 1 GROUP BY one, lvl, idx // 3),
steps AS ({_sql_steps('nodes', 'source')}),
top_steps AS ({_sql_steps('tops', 'one')}),
paths AS (SELECT doc_id, leaf, source, idx AS leaf_idx, 0 AS lvl, idx, size, changed AS folded, '' AS proof FROM leaves UNION ALL
    SELECT p.doc_id, p.leaf, p.source, p.leaf_idx, p.lvl + 1, p.idx // 3, (p.size + 2) // 3, sha256(s.l || p.folded || s.r),
    p.proof || s.l || s.r FROM paths p JOIN steps s ON p.source IS NOT DISTINCT FROM s.source AND p.lvl = s.lvl AND p.idx = s.idx),
ups AS (SELECT p.doc_id, p.leaf, p.source, p.leaf_idx, s.digest AS subroot, 0 AS lvl, s.idx, s.size, p.folded, p.proof
    FROM paths p JOIN subs s ON p.source IS NOT DISTINCT FROM s.source WHERE p.size = 1 UNION ALL
    SELECT p.doc_id, p.leaf, p.source, p.leaf_idx, p.subroot, p.lvl + 1, p.idx // 3, (p.size + 2) // 3,
    sha256(s.l || p.folded || s.r), p.proof || s.l || s.r FROM ups p JOIN top_steps s ON p.lvl = s.lvl AND p.idx = s.idx)
SELECT doc_id, leaf, subroot, (SELECT digest FROM tops WHERE size = 1) AS root, sha256(proof) AS proof_sha256,
    folded AS folded_root, folded = (SELECT digest FROM tops WHERE size = 1) AS verified FROM ups WHERE size = 1"""
