"""Join helpers: size-checked broadcast and salted shuffle joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Largest side, in bytes of its values, that a join may broadcast.
BROADCAST_BYTES = 64 << 20
_FIXED_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4, "double": 8,
                "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def value_bytes(df: DataFrame) -> Column:
    """Bytes of one row's values: fixed widths by type, others by the length of their text."""
    sizes = [F.lit(_FIXED_BYTES[f.dataType.typeName()]) if f.dataType.typeName() in _FIXED_BYTES
             else F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
             for f in df.schema.fields]
    return sum(sizes, F.lit(8)).cast("long")


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its values provably take at most ``max_bytes``.

    One job writes ``df`` to the shared checkpoint folder; its size and the join are both
    read from there, so ``df`` is computed once. Beyond the bound the join falls back to a
    shuffle join (sort-merge, with AQE skew splitting).
    """
    held = df.checkpoint()
    size = held.agg(F.sum(value_bytes(held))).first()[0] or 0
    return F.broadcast(held) if size <= max_bytes else held


def salted_join(big: DataFrame, small: DataFrame, on: list[str], salts: int,
                how: str = "inner", strategy: str | None = None) -> DataFrame:
    """Equi-join where ``big`` may hold a few very hot keys.

    Each ``big`` row gets a salt in [0, salts) from a hash of all its columns
    (deterministic, so a retried task reproduces it whatever the row order);
    ``small`` is replicated once per salt by an ``explode``, so one hot key is
    spread over ``salts`` tasks. Result rows are the same as the unsalted join.
    ``strategy`` (e.g. ``"merge"``, ``"shuffle_hash"``) pins the join strategy
    when the small side must not be broadcast.
    """
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int"))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if strategy:
        s = s.hint(strategy)
    return b.join(s, on + ["_salt"], how).drop("_salt")
