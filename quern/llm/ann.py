"""Approximate nearest neighbours by a forest of random-projection trees (operator 7).

Each tree splits the vectors at the median of their projections on the line through two
of them, until a node is small. The forest is fitted on a bounded sample (``FIT_ROWS``
vectors with the smallest hash); every vector is indexed, that is, routed to one leaf per
tree. A query searches all trees through one shared priority queue, ordered by the
smallest margin on the way: a leaf is opened, the far sides of the nodes above it wait.
It stops when the opened leaves hold ``SEARCH`` vectors of the sample. Every indexed
vector in an opened leaf is then compared exactly, in double precision.

Queries go in blocks of ``QUERY_BLOCK``: a block's vectors and opened leaves are shared
with the tasks, which route their rows, compare candidates and keep the nearest per
query. So vectors never move; a task's result has at most k rows per query.

Equal vectors: beyond k + 1 different ids of one vector, larger ids can't be among the
nearest (ties go to the smaller id), so they are left out before the search by a cut per
vector, which is exact and keeps thousands of copies from meeting each other.

Defined results: vectors that are null, empty, zero, or hold null or non-finite parts,
rows without vec_id, and vectors of another length than most have take no part. A
repeated row is a candidate of its own; rows with the query's id are not. A query id on
several rows is searched with its smallest vector.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import prepare, scratch_path, small_side, staged, table

FIT_ROWS = 32_768
TREES, LEAF, SEARCH = 16, 32, 16_000
QUERY_BLOCK = 4096
BLOCKS_A_JOB = 16              # further blocks go into a job of their own, so no plan grows with the queries
MAX_BROADCAST_ROWS = 100_000


class Tree:
    """One random-projection tree in arrays; node i has children ``kids[i]`` (negative: leaf ~x)."""

    def __init__(self, points: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals, self.cuts, self.kids, self.sizes = [], [], [], []
        self.root = self._grow(points, np.arange(len(points)), leaf, rng)
        dims = points.shape[1]
        self.normals = np.array(self.normals, np.float32).reshape(-1, dims)
        self.cuts = np.array(self.cuts, np.float32)
        self.kids = np.array(self.kids, np.int64).reshape(-1, 2)
        self.sizes = np.array(self.sizes, np.int64)

    def _leaf(self, n: int) -> int:
        self.sizes.append(n)
        return ~(len(self.sizes) - 1)

    def _grow(self, points, rows, leaf, rng) -> int:
        if len(rows) <= leaf:
            return self._leaf(len(rows))
        for _ in range(3):
            a, b = points[rng.choice(rows, 2, replace=False)]
            normal = a - b
            length = np.linalg.norm(normal)
            if length == 0:
                continue
            normal = normal / length
            along = points[rows] @ normal
            cut = np.median(along)
            left = along < cut
            if left.any():
                node = len(self.cuts)
                self.normals.append(normal)
                self.cuts.append(cut)
                self.kids.append((0, 0))
                self.kids[node] = self._grow(points, rows[left], leaf, rng), self._grow(points, rows[~left], leaf, rng)
                return node
        return self._leaf(len(rows))                     # equal points

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of every row of ``x``."""
        at = np.full(len(x), self.root)
        while (open_ := np.flatnonzero(at >= 0)).size:
            node = at[open_]
            right = np.einsum("ij,ij->i", x[open_], self.normals[node]) >= self.cuts[node]
            at[open_] = self.kids[node, right.astype(int)]
        return ~at


class Forest:
    def __init__(self, points: np.ndarray, trees: int = TREES, leaf: int = LEAF, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.trees = [Tree(points, leaf, rng) for _ in range(trees)]
        self.base = np.cumsum([0] + [len(t.sizes) for t in self.trees])     # leaf numbers over all trees
        self.sizes = np.concatenate([t.sizes for t in self.trees])

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row in every tree, numbered over the forest: rows x trees."""
        return np.stack([t.route(x) + b for t, b in zip(self.trees, self.base)], axis=1)

    def search(self, q: np.ndarray, search: int = SEARCH) -> list[int]:
        """Leaves to open for one query, from a priority queue shared by all trees."""
        sides = [t.normals @ q - t.cuts for t in self.trees]
        queue = [(-np.inf, k, t.root) for k, t in enumerate(self.trees)]
        heapq.heapify(queue)
        opened, seen = [], 0
        while queue and seen < search:
            margin, k, node = heapq.heappop(queue)
            tree, side = self.trees[k], sides[k]
            while node >= 0:
                d = side[node]
                near = int(d >= 0)
                heapq.heappush(queue, (max(margin, abs(d)), k, tree.kids[node, 1 - near]))
                node = tree.kids[node, near]
            leaf = int(~node + self.base[k])
            opened.append(leaf)
            seen += int(self.sizes[leaf])
        return opened


def exact_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of paired rows, in double precision."""
    d = a.astype(np.float64) - b
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Nearest:
    """The k nearest rows per query seen so far (distance, then id)."""

    def __init__(self, k: int):
        self.k = k
        self.q, self.ids, self.d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, q: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        q, ids, d = np.concatenate([self.q, q]), np.concatenate([self.ids, ids]), np.concatenate([self.d, d])
        order = np.lexsort((ids, d, q))
        q = q[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        keep = order[rank < self.k]
        self.q, self.ids, self.d = q[rank < self.k], ids[keep], d[keep]


def pairs_of(leaves: np.ndarray, opened: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, query) pairs that share a leaf; ``opened`` lists queries by leaf (starts, queries)."""
    starts, queries = opened
    flat = leaves.ravel()
    counts = starts[flat + 1] - starts[flat]
    rows = np.repeat(np.repeat(np.arange(len(leaves)), leaves.shape[1]), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts[flat], counts)
    n = int(queries.max(initial=0)) + 1
    pair = np.unique(rows * n + queries[at])
    return pair // n, pair % n


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, v, h)`` of the rows that take part."""
    v = F.col(vec_col).cast("array<double>")
    fit = v.isNotNull() & F.col(id_col).isNotNull() & (F.size(v) > 0) \
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.coalesce(fit, F.lit(False))) \
        .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0)) \
        .withColumn("h", F.md5(F.transform("v", lambda x: x + 0.0).cast("string").cast("binary")))


def without_far_copies(rows: DataFrame, k: int) -> DataFrame:
    """Rows less those of vectors with over k + 1 ids whose id is past the (k + 1)-th."""
    ids = rows.select("h", "vec_id").distinct()
    rank = F.row_number().over(Window.partitionBy("h").orderBy("vec_id"))
    cut = staged(ids.withColumn("n", rank).where(F.col("n") <= k + 1).where(F.col("n") == k + 1)
                 .select("h", F.col("vec_id").alias("last")), "copies")
    return rows.join(small_side(cut, cut.count(), MAX_BROADCAST_ROWS), "h", "left") \
        .where("last is null or vec_id <= last").drop("last", "h")


def fit_forest(rows: DataFrame, fit_rows: int = FIT_ROWS, **settings) -> Forest | None:
    """Forest over at most ``fit_rows`` vectors."""
    got = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(fit_rows).select("v").toArrow()["v"]
    if not len(got):
        return None
    points = got.combine_chunks().flatten().to_numpy().astype(np.float32).reshape(len(got), -1)
    return Forest(points, **settings)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            search: int = SEARCH, block: int = QUERY_BLOCK, **settings) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found for every row of ``queries``."""
    spark = vectors.sparkSession
    schema = "query_id long, vec_id long, score double"
    every = usable(vectors, id_col, vec_col)
    rows = without_far_copies(every, k)
    asked = staged(usable(queries, id_col, vec_col).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    forest = fit_forest(rows, **settings)
    n = asked.count() if forest else 0
    shared = spark.sparkContext.broadcast(forest)            # bounded by fit_rows and trees
    found, path, waiting = spark.createDataFrame([], schema), None, 0
    blocks = -(-n // block)
    # Near cuts: a block differs by a tenth at most, and the summary holds a small part of the ids.
    cuts = asked.stat.approxQuantile("vec_id", [i / blocks for i in range(1, blocks)], 0.05 / blocks) if blocks > 1 else []
    edges = [None, *sorted({int(c) for c in cuts}), None]
    for low, high in zip(edges, edges[1:]) if n else []:
        part = asked.where((F.lit(True) if low is None else F.col("vec_id") > low)
                           & (F.lit(True) if high is None else F.col("vec_id") <= high))
        found, waiting = found.unionByName(_block(rows, part, shared, k, search, schema)), waiting + 1
        if waiting == BLOCKS_A_JOB and high is not None:
            path = path or scratch_path(spark, "nearest")
            _ranked(found, k).write.mode("append").parquet(path)
            found, waiting = spark.createDataFrame([], schema), 0
    out = _ranked(found, k)
    return out.unionByName(spark.read.schema(out.schema).parquet(path)) if path else out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _block(rows: DataFrame, part: DataFrame, forest, k: int, search: int, schema: str) -> DataFrame:
    """Nearest rows, per task, of one bounded block of queries."""
    spark = rows.sparkSession

    def open_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            opened = [forest.value.search(np.array(v, np.float32), search) for v in rb.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(opened, pa.list_(pa.int64()))],
                                             names=["vec_id", "v", "leaves"])

    got = part.select("vec_id", "v").repartition(spark.sparkContext.defaultParallelism) \
        .mapInArrow(open_leaves, "vec_id long, v array<double>, leaves array<long>").toArrow()
    order = np.argsort(got["vec_id"].to_numpy())
    ids = got["vec_id"].to_numpy()[order]
    vecs = got["v"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order]
    opened = [got["leaves"][int(i)].as_py() for i in order]
    leaf = np.concatenate([np.array(x, np.int64) for x in opened])
    query = np.repeat(np.arange(len(ids)), [len(x) for x in opened])
    by_leaf = np.argsort(leaf, kind="stable")
    starts = np.searchsorted(leaf[by_leaf], np.arange(len(forest.value.sizes) + 1))
    shared = spark.sparkContext.broadcast((ids, vecs, starts, query[by_leaf]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_vecs, starts, by_leaf = shared.value
        best = Nearest(k)
        for rb in batches:
            own = rb.column("vec_id").to_numpy()
            x = rb.column("v").flatten().to_numpy().reshape(len(own), -1)
            leaves = forest.value.route(x.astype(np.float32))
            for i in range(0, len(own), 256):
                r, q = pairs_of(leaves[i:i + 256], (starts, by_leaf))
                other = own[i + r] != q_ids[q]
                r, q = i + r[other], q[other]
                for j in range(0, len(r), 100_000):
                    rr, qq = r[j:j + 100_000], q[j:j + 100_000]
                    best.add(qq, own[rr], exact_distance(q_vecs[qq], x[rr]))
        yield pa.record_batch([pa.array(q_ids[best.q]), pa.array(best.ids), pa.array(best.d)],
                              names=["query_id", "vec_id", "score"])

    return rows.select("vec_id", "v").mapInArrow(compare, schema)


def op7_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest found for every vector whose id is divisible by 100."""
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
