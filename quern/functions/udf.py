"""UDF-4, UDF-5: user row functions as columns, user table functions as lateral joins.

The reference maps Python lambdas over RDD rows. Here a row function is first
a column expression (built-in functions, JVM-side, inside whole-stage codegen);
only logic no built-in covers becomes a vectorised pandas UDF (Arrow batches,
never row-at-a-time pickling).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def vectorized(fn: Callable[..., pd.Series], return_type: T.DataType | str) -> Callable[..., Column]:
    """Wrap ``fn(*series) -> series`` as a pandas UDF usable on columns."""
    return F.pandas_udf(fn, returnType=return_type)


def row_map(fn: Callable, return_type: T.DataType | str) -> Callable[..., Column]:
    """Apply a scalar Python ``fn(*values)`` per row, vectorised over Arrow batches.

    For small helpers with no column-expression equivalent; prefer built-ins.
    """
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*vals) for vals in zip(*cols)])
    return F.pandas_udf(run, returnType=return_type)


def flat_map(df: DataFrame, fn: Callable[..., Iterable[tuple]], columns: list[str], schema: str,
             keep: list[str] | None = None) -> DataFrame:
    """UDF-5: ``fn(*values of columns)`` yields any number of rows of ``schema`` for each row of ``df``.

    A table function in a lateral join, its rows sent in Arrow batches. ``keep`` names the columns of
    ``df`` that stand before them; where a name is in both, the result has it twice. Rows for which ``fn`` yields nothing are gone.
    """
    class Rows:
        def eval(self, *values):
            yield from fn(*values)

    table = F.udtf(Rows, returnType=schema, useArrow=True)
    made = T.StructType.fromDDL(schema).names
    names = [f"_made{i}" for i in range(len(made))]
    out = df.lateralJoin(table(*[F.col(f"`{c}`").outer() for c in columns]).toDF(*names))
    return out.select(*[F.col(f"`{c}`") for c in keep or []], *[F.col(n).alias(m) for n, m in zip(names, made)])
