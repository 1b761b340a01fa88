"""SimHash near-dedup by multi-index hashing (operator 8).

Fingerprints are 64-bit SimHashes of word shingles. Two different fingerprints at
``max_bits`` = 3 or fewer differing bits agree, up to one bit, in one of their two
32-bit segments. So each fingerprint is stored under its two segments, looks up all
33 values of each segment's Hamming ball of radius 1, and the full distance of every
match is verified. Only distinct fingerprints take part, so a group of copies of any
size costs as much as one document; a fingerprint's links are bounded by its ball.

Defined results: a null or empty text has no words and fingerprint zero, which links
like any other. Rows without doc_id take part, but a component is named by its
smallest doc_id (null if it has none). Repeated rows give repeated result rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import prepare, staged, table, unused

SEED = 42


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of a text's word shingles, as a signed 64-bit integer."""
    w = (text or "").encode().lower().split()          # bytes: ASCII case and white space only
    if not w:
        return 0
    if len(w) < words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words))))
    n = max(1, len(w) - words + 1)
    h = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.int64)[0])


def add_fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row; the text itself goes no further."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words) for t in b["text"]), np.int64, len(b))
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": fp})

    ids = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash")) \
        .mapInArrow(_arrow(run, ids), f"doc_id {ids}, text_hash long, fp long")


def _arrow(run, ids: str):
    """Keep ids exact (nullable integers) on the way through pandas."""
    import pyarrow as pa

    def mapped(batches):
        for rb in batches:
            t = rb.column("text").to_pylist()
            part = pd.DataFrame({"text": t, "doc_id": 0, "text_hash": 0})
            for out in run(iter([part])):
                yield pa.record_batch([rb.column("doc_id"), rb.column("text_hash"),
                                       pa.array(out["fp"].to_numpy())],
                                      names=["doc_id", "text_hash", "fp"])
    return mapped


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of distinct fingerprints at ``max_bits`` or fewer bits.

    ``fps`` holds each fingerprint once. Two 32-bit segments; by the pigeonhole
    principle one of them differs in at most ``max_bits // 2`` bits.
    """
    radius = max_bits // 2
    if radius > 1:
        raise ValueError("two segments with balls of radius 1 cover 3 bits at most")
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    segments = F.array(F.struct(F.lit(0).alias("seg"), low.alias("key")),
                       F.struct(F.lit(1).alias("seg"), high.alias("key")))
    tables = fps.select(F.col("fp").alias("b"), F.inline(segments))
    flips = F.array(F.lit(0).cast("long"), *([F.lit(1 << i).cast("long") for i in range(32)] if radius else []))
    probes = fps.select(F.col("fp").alias("a"), F.inline(segments)) \
        .select("a", "seg", F.col("key").alias("own"), F.explode(flips).alias("flip")) \
        .select("a", "seg", F.col("own").bitwiseXOR(F.col("flip")).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return probes.join(tables.hint("shuffle_hash"), ["seg", "key"]) \
        .where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge: root is the component's smallest node.

    Alternates large-star and small-star steps; each round is written to the shared
    folder, and rounds stop when the edge set no longer changes.
    """
    e = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u <> v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(m.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        e = staged(small, "edges")
        after = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def near_components(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id)`` per row of ``docs``."""
    prepare(docs.sparkSession)
    rows = staged(add_fingerprints(docs, words), "fingerprints")
    fps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(links(fps.select("fp"), max_bits))
    named = fps.join(roots, fps["fp"] == roots["node"], "left") \
        .select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_fp = staged(named.join(least, "root").select("fp", "component_id"), "components")
    return rows.join(per_fp, "fp").select("doc_id", "text_hash", "fp", "component_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    prepare(spark)
    return near_components(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each component stays: that with the smallest (doc_id, text hash)."""
    rows = near_components(docs, words, max_bits)
    # Rows without any id in their component are held together by the fingerprint.
    group = F.when(F.col("component_id").isNull(), F.col("fp"))
    first = rows.groupBy("component_id", group.alias("_g")) \
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k")) \
        .select(F.col("k.doc_id").alias("_id"), F.col("k.text_hash").alias("_th"))
    first = staged(first, "kept").distinct()
    th = unused(docs, "_th0")
    out = docs.withColumn(th, F.xxhash64("text"))
    kept = out.join(first, out["doc_id"].eqNullSafe(first["_id"]) & (out[th] == first["_th"]), "left_semi")
    return kept.dropDuplicates(["doc_id", th]).drop(th)
