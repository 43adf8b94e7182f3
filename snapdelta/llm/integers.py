"""Vectors as whole numbers: what the exact vector operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole numbers beyond this are refused: a long could not hold what is made of them.
LARGEST = 2.0**62


def finite_vectors(rows: DataFrame, vector_col: str, **columns: Column) -> DataFrame:
    """``columns`` and ``v`` (doubles) of the rows whose vector is there and has finite components only.

    Vectors of another length than most (ties: than the longest) have no distance to the
    others and are left out, empty ones too.
    """
    v = F.col("v")
    rows = rows.select(*[c.alias(n) for n, c in columns.items()], F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(v.isNotNull() & finite & (F.size(v) > 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.filter(F.size("v") == (most["n"] if most else 0))


def floors(column: pa.Array, scale: int) -> np.ndarray:
    """A row of whole numbers per vector, rounded down after scaling."""
    flat = np.asarray(column.flatten(), np.float64)
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale).reshape(len(column), -1)
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise OverflowError(f"a component times {scale} is beyond what a long holds")
    return scaled.astype(np.int64)


def peak(numbers: np.ndarray) -> int:
    """Largest size of a number; an exact Python integer."""
    return max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))
