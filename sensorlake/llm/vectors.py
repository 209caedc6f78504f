"""Vectors as integers, with which sums and products are exact."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: Components are scaled by this before they are rounded down.
SCALE = 256


def with_integers(rows, column="embedding"):
    """``rows`` with ``x``, floor(256 c) of each component; rows whose vector is null, is
    empty or has a null or non-finite component are left out.

    A component beyond 2^53 / 256 is an error, as its product by 256 would not be exact.
    """
    bad = F.exists(
        column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    )
    rows = rows.where(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad)
    huge = F.raise_error(F.lit("a vector has a component beyond 2^53 / 256"))

    def whole(c):
        scaled = c.cast("double") * SCALE
        return F.when(F.abs(scaled) <= float(1 << 53), F.floor(scaled)).otherwise(huge.cast("long"))

    return rows.withColumn("x", F.transform(column, whole))


def common_size(rows):
    """The number of components that most rows have, of equally many the largest; 0 if none."""
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    first = most.select("d").first()
    return first[0] if first else 0


def matrix(column, d):
    """An Arrow column of lists of ``d`` longs as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def product(a, b):
    """a @ b of integer matrices without rounding; Python's integers where longs are too small."""
    top = [int(np.abs(m).max(initial=0)) for m in (a, b)]
    bound = top[0] * top[1] * a.shape[1]
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return (a if bound < 1 << 63 else a.astype(object)) @ b
