"""Data-quality counts and row checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls and empty strings, all from one pass."""
    measures = [F.count("*").alias("row_count")]
    for i, name in enumerate(columns):
        measures.append(F.count_if(F.col(name).isNull()).alias(f"null_{i}"))
        measures.append(F.count_if(F.col(name) == "").alias(f"empty_{i}"))
    lines = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col("row_count"),
                F.col(f"null_{i}").alias("null_count"),
                F.col(f"empty_{i}").alias("empty_count"),
            )
            for i, name in enumerate(columns)
        )
    )
    return df.agg(*measures).select(F.inline(lines))


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in each of the columns."""
    return df.dropna(subset=list(columns))


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first `n` rows by a key, so that every run shows the same ones."""
    return df.orderBy(*order_by).limit(n)
