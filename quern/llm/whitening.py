"""Whitening of embeddings by polarisation covariance (operator 11).

Vectors become integers, ``x = floor(256 * c)``, and each distinct one counts once. With
``n`` vectors and sums ``S``, the centred values ``t = n * x - S`` are integers too.
Tasks add up the exact squares of ``t`` for every dimension and of ``t_i + t_j`` for
every pair of dimensions; half of what a pair's sum exceeds its two dimensions' is their
cross-covariance, times ``n`` cubed. The matrix is assembled from these exact integers on the driver and goes to ``eigh``.

A task sends one row per dimension and pair (width * (width + 1) / 2 rows, in two
halves so that sums stay exact at every size), and so does the cluster to the driver: that grows
with the width of the vectors, not with their number.

Defined results: vectors that are null or hold null or non-finite entries are dropped. Shorter
vectors than the widest are filled up with zeros. Entries beyond the range of a long are
its ends. Repeated rows count once in the fit and each gets its result rows; null ids are kept. Directions
without variance beyond rounding have null ``whitened`` (so has a single distinct
vector), and ``explained`` is null where there is no variance at all. Empty tables and empty vectors give no result rows.
A deviation beyond 38 digits is null, in the query beyond a long. Other columns are kept; columns
named as a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import prepare, staged, table, unused

SCALE = 256
COMPONENTS = 4
LIMB = 10 ** 18                  # sums travel as a high and a low part of this base
EXACT = 2 ** 62                  # 64-bit arithmetic is used while results stay below
DDL = "i int, j int, high decimal(38,0), low decimal(38,0)"


# --- exact integers -----------------------------------------------------------------------
def usable(vector: str) -> Column:
    """The vector is there and holds finite numbers only."""
    v = F.col(f"`{vector}`")
    return F.coalesce(v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf")))), F.lit(False))


def integers(vector: str) -> Column:
    return F.transform(F.col(f"`{vector}`"), lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of longs, short ones filled up with zeros."""
    lens = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lens), width), np.int64)
    out[np.arange(width) < lens[:, None]] = lists.flatten().to_numpy()
    return out


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``; Python integers where a long could overflow."""
    if n * largest(x) + max(map(abs, sums), default=0) < EXACT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(t: np.ndarray, axis: int) -> np.ndarray:
    """Exact sums of squares along an axis."""
    if t.dtype != object and largest(t) ** 2 * max(1, t.shape[axis]) >= EXACT:
        t = t.astype(object)
    return (t * t).sum(axis=axis)


def _sums_by_task(fit: DataFrame, measure) -> dict[tuple[int, int], int]:
    """``measure(x) -> {(i, j): exact integers}`` of each batch, added up by tasks, then by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], int] = {}
        for rb in batches:
            for key, value in measure(rb.column("x")):
                held[key] = held.get(key, 0) + int(value)
        keys = list(held)
        parts = [divmod(held[k], LIMB) for k in keys]
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                               pa.array([p[0] for p in parts], pa.decimal128(38, 0)),
                               pa.array([p[1] for p in parts], pa.decimal128(38, 0))], names=["i", "j", "high", "low"])

    rows = fit.mapInArrow(run, DDL).groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r["i"], r["j"]): int(r["high"]) * LIMB + int(r["low"]) for r in rows.collect()}


# --- fit ----------------------------------------------------------------------------------
@dataclass
class Whitening:
    """``axes``: unit eigenvectors as columns, by falling eigenvalue; ``covariance`` of the integers."""
    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    axes: np.ndarray

    @property
    def width(self) -> int:
        return len(self.sums)

    def scale(self, components: int) -> np.ndarray:
        """Standard deviations along the first components; NaN where there is none beyond rounding."""
        e = self.values[:components]
        floor = self.width * np.finfo(float).eps * max(float(self.values[0]), 0.0) if len(e) else 0.0
        return np.sqrt(np.where(e > floor, e, np.nan))

    def explained(self) -> np.ndarray:
        total = float(np.trace(self.covariance))
        return self.values / total if total > 0 else np.full(self.width, np.nan)

    def project(self, t: np.ndarray, components: int) -> np.ndarray:
        """Whitened coordinates of centred rows."""
        return (t / self.n).astype(np.float64) @ self.axes[:, :components] / self.scale(components)


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns."""
    if not len(covariance):
        return np.zeros(0), np.zeros((0, 0))
    values, axes = np.linalg.eigh(covariance)
    return values[::-1], axes[:, ::-1]


def fit_whitening(fit: DataFrame) -> Whitening:
    """Fit on a written table of distinct integer vectors ``x``."""
    n, width = fit.agg(F.count("*"), F.max(F.size("x"))).first()
    width = width or 0

    def add_up(lists):
        x = matrix(lists, width)
        x = x if largest(x) * max(1, len(x)) < EXACT else x.astype(object)
        return [((i, i), s) for i, s in enumerate(x.sum(axis=0))]
    got = _sums_by_task(fit, add_up) if width else {}
    sums = [got.get((i, i), 0) for i in range(width)]

    def polarise(lists):
        t = centred(matrix(lists, width), n, sums)
        out = [((i, i), s) for i, s in enumerate(squares(t, 0))]
        for i in range(width - 1):
            out += [((i, i + 1 + k), s) for k, s in enumerate(squares(t[:, i:i + 1] + t[:, i + 1:], 0))]
        return out
    q = _sums_by_task(fit, polarise) if width else {}
    cov = np.zeros((width, width))
    for i in range(width):
        cov[i, i] = q[i, i] / n ** 3                        # division of integers, rounded once
        for j in range(i + 1, width):
            cov[i, j] = cov[j, i] = (q[i, j] - q[i, i] - q[j, j]) / (2 * n ** 3)
    return Whitening(n, sums, cov, *eigen(cov))


def identity_error(fit: DataFrame, model: Whitening, components: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity (None: no component varies)."""
    k = int(np.isfinite(model.scale(components)).sum())
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whitened rows are centred by S / n already; their means are taken off once more below.
        held = np.zeros((k + 1, k))
        for rb in batches:
            w = model.project(centred(matrix(rb.column("x"), model.width), model.n, model.sums), k)
            held += np.vstack([w.T @ w, w.sum(axis=0)])
        yield pa.record_batch([pa.array(np.repeat(np.arange(k + 1), k), pa.int32()), pa.array(np.tile(np.arange(k), k + 1), pa.int32()),
                               pa.array(held.ravel())], names=["i", "j", "s"])
    got = fit.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    m = np.zeros((k + 1, k))
    for r in got:
        m[r["i"], r["j"]] = r["s"] / model.n
    return float(np.abs(m[:k] - np.outer(m[k], m[k]) - np.eye(k)).max())


def add_whitened(rows: DataFrame, model: Whitening, vector: str, components: int) -> DataFrame:
    """Usable ``rows`` with ``deviation`` decimal(38,0) and ``whitened`` array<double> (null where a component has no variance)."""
    x = unused(rows, "_x")
    kept = [c for c in rows.columns if c.lower() not in ("deviation", "whitened")]
    k = min(components, model.width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            t = centred(matrix(rb.column(x), model.width), model.n, model.sums)
            far = [int(d) if d < 10 ** 38 else None for d in squares(t, 1).tolist()]
            flat = model.project(t, k).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(t) + 1) * k, pa.int32()), pa.array(flat, mask=np.isnan(flat)))
            yield pa.record_batch([*[rb.column(c) for c in kept], pa.array(far, pa.decimal128(38, 0)), lists],
                                  names=[*kept, "deviation", "whitened"])

    some = rows.where(usable(vector)).select(*[F.col(f"`{c}`") for c in kept], integers(vector).alias(x))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in some.schema if f.name != x)
    return some.mapInArrow(run, f"{ddl}, deviation decimal(38,0), whitened array<double>")


def distinct_integers(vectors: DataFrame, vector: str) -> DataFrame:
    """The fit list, written: each distinct integer vector once (partial distincts before the shuffle)."""
    return staged(vectors.where(usable(vector)).select(integers(vector).alias("x")).distinct(), "whitening-fit")


def op11_polar_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviation and whitened coordinates of every usable vector, a row for each component."""
    prepare(spark)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    fit = distinct_integers(vectors, "embedding")
    model = fit_whitening(fit)
    error = identity_error(fit, model, COMPONENTS)
    shares = [float(s) if np.isfinite(s) else None for s in model.explained()[:COMPONENTS]]
    rows = add_whitened(vectors, model, "embedding", COMPONENTS) \
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                       F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                       F.get(F.lit(shares).cast("array<double>"), F.col("at")).alias("explained"),
                       F.lit(error).cast("double").alias("identity_error"))
