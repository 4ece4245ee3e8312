"""Labelled rows for the classifiers, and the split that holds some of them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def training_labels(
    labels: DataFrame,
    label: str,
    parts: int,
    held: int,
    doc_id: str = "doc_id",
    bound: int | None = None,
) -> DataFrame:
    """`label_id, label` (0 or 1) of the rows that may be learned from: ids whose
    remainder is not the held-out one, null ids and labels left out, one row per id
    (1 if any says 1). With a bound, about so many ids, those with the lowest hash."""
    rows = (
        labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("label"))
        .where("label_id is not null and label is not null")
        .where(remainder(F.col("label_id"), parts) != held)
        .groupBy("label_id")
        .agg(F.max("label").alias("label"))
    )
    if bound is None:
        return rows
    count = rows.count()
    if count <= bound:
        return rows
    part = F.pmod(F.xxhash64(F.lit("sample"), "label_id"), F.lit(1_000_000))
    return rows.where(part < int(1_000_000 * bound / count))
