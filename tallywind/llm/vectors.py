"""What the operators on vectors share: which vectors take part, and blocks of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def finite_vectors(
    df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """`vec_id, vec` (doubles) of the rows whose vector is not null and has no null,
    NaN or infinite entry. An empty vector counts as having none."""
    vec = F.col("vec")
    unfit = F.exists(
        vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    )
    rows = df.select(
        F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vec")
    )
    return rows.where(vec.isNotNull() & ~unfit & (F.size(vec) > 0))


def common_size(vectors: DataFrame) -> int:
    """The number of entries most vectors have; of several the larger, 0 of none."""
    sizes = vectors.groupBy(F.size("vec").alias("size")).agg(F.count("*").alias("n"))
    first = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    return first["size"] if first else 0


def matrix(column: pa.ListArray) -> np.ndarray:
    """A list column of one size as a matrix, without copying its values."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
