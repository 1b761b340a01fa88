"""Matrix jobs on COO relations (MAT-*, JOIN-3..5, AGG-11).

A matrix is a DataFrame ``(i, j, v)``; zeros may be left out. A product is a
join on the shared index followed by a grouped sum — Spark's partial aggregate
collapses products per (i, k) inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators.joins import BROADCAST_BYTES, checked_broadcast, salted_join


def matvec(m: DataFrame, vec: DataFrame, strategy: str = "broadcast",
           max_bytes: int = BROADCAST_BYTES, salts: int = 1) -> DataFrame:
    """MAT-1 / MAT-2: s_i = Σ_j m_ij · vec_j → ``(i, s)``.

    ``broadcast`` (MAT-1, JOIN-3): the vector sits in every task's memory, but
    only when it provably takes ≤ ``max_bytes``; otherwise (and for
    ``shuffle``, MAT-2) both sides shuffle on j. With few distinct j the matrix
    side of each j is large; ``salts`` > 1 spreads each j over that many tasks,
    and AQE's skew-join split covers the rest.
    """
    mv = m.select("i", "j", F.col("v").alias("_mv"))
    vv = vec.select("j", F.col("v").alias("_vv"))
    if strategy == "broadcast":
        joined = mv.join(checked_broadcast(vv, max_bytes), "j")
    elif strategy == "shuffle":
        joined = salted_join(mv, vv, ["j"], salts, strategy="merge") if salts > 1 \
            else mv.join(vv.hint("merge"), "j")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return joined.groupBy("i").agg(F.sum(F.col("_mv") * F.col("_vv")).alias("s"))


def matmul(a: DataFrame, b: DataFrame, strategy: str = "join",
           max_bytes: int = BROADCAST_BYTES, salts: int = 1) -> DataFrame:
    """MAT-3..MAT-6: P = A·B for A(i, j, v), B(j, k, v) → ``(i, k, p)``.

    ``broadcast`` (MAT-3, JOIN-4): the smaller operand is broadcast when it provably
    takes ≤ ``max_bytes``; else the plan falls back to the
    shuffle join. ``join`` (MAT-5, JOIN-5; also MAT-4, whose one-pass cell
    replication buys nothing here): both shuffle on j. The result does not
    depend on how cells are spread over files or partitions (MAT-6).
    """
    av = a.select("i", "j", F.col("v").alias("_av"))
    bv = b.select("j", F.col("k"), F.col("v").alias("_bv"))
    if strategy == "broadcast":
        joined = av.join(checked_broadcast(bv, max_bytes), "j")
    elif strategy == "broadcast_left":
        joined = checked_broadcast(av, max_bytes).join(bv, "j")
    elif strategy == "join":
        joined = salted_join(av, bv, ["j"], salts) if salts > 1 else av.join(bv, "j")
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return joined.groupBy("i", "k").agg(F.sum(F.col("_av") * F.col("_bv")).alias("p"))


def transpose(m: DataFrame) -> DataFrame:
    """(i, j, v) → (j, i, v), renamed back to (i, j, v)."""
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def as_right(m: DataFrame) -> DataFrame:
    """Rename a matrix (i, j, v) to the right-operand shape (j, k, v)."""
    return m.select(F.col("i").alias("j"), F.col("j").alias("k"), "v")


def to_dense(p: DataFrame, value: str = "p", as_text: bool = False, shape: DataFrame | None = None) -> DataFrame:
    """AGG-11: COO (i, k, value) → the rows 0..max(i), each of ``max(k)+1`` cells, missing = 0.

    ``shape`` is a one-row DataFrame ``(rows, width)``, for instance of the factors; without
    it both are taken from ``p``. A row of zeros has no cell in ``p`` and comes out all the
    same. A row holds one matrix row only (bounded by the matrix width): its sorted cells,
    with the zeros of the gap before each one.
    """
    if shape is None:
        shape = p.agg((F.max("i") + 1).alias("rows"), (F.max("k") + 1).alias("width"))
    block = 4096
    every = shape.where("rows > 0").select("rows", "width", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("rows").cast("long") - 1, F.lit(block).cast("long"))).alias("_from")) \
        .select("width", F.explode(F.sequence("_from", F.least(F.col("_from") + block, F.col("rows")) - 1)).alias("i"))
    held = p.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("k", F.col(value).alias("v")))).alias("_c"))
    rows = every.join(held, "i", "left")
    kind = p.schema[value].dataType
    zero = F.lit(0).cast(kind)
    cells = F.coalesce("_c", F.array().cast(held.schema["_c"].dataType))
    before = F.transform(cells, lambda c, n: F.concat(
        F.array_repeat(zero, (c["k"] - F.when(n > 0, F.element_at(cells, n)["k"]).otherwise(-1) - 1).cast("int")),
        F.array(c["v"])))
    last = F.when(F.size(cells) > 0, F.element_at(cells, -1)["k"]).otherwise(-1)
    dense = F.concat(F.flatten(before), F.array_repeat(zero, (F.col("width") - last - 1).cast("int")))
    out = rows.select("i", dense.alias("cells"))
    if as_text:
        out = out.select("i", F.concat_ws(",", F.transform("cells", lambda c: c.cast("string")))
                         .alias("cells"))
    return out


def allclose(a: DataFrame, b: DataFrame, value_a: str = "p", value_b: str = "p",
             rtol: float = 1e-05, atol: float = 1e-08) -> DataFrame:
    """MAT-7: ``np.allclose`` of two COO matrices → one row ``(ok, cells)``.

    Full outer join on (i, k); a missing cell counts as 0.
    """
    x = a.select("i", "k", F.col(value_a).cast("double").alias("_a"))
    y = b.select("i", "k", F.col(value_b).cast("double").alias("_b"))
    j = x.join(y, ["i", "k"], "full_outer")
    av, bv = F.coalesce("_a", F.lit(0.0)), F.coalesce("_b", F.lit(0.0))
    close = F.abs(av - bv) <= F.lit(atol) + F.lit(rtol) * F.abs(bv)
    return j.agg(F.coalesce(F.bool_and(close), F.lit(True)).alias("ok"),
                 F.count(F.lit(1)).alias("cells"))
