"""Helpers the corpus operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.session import new_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column) -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(column: str | Column) -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("long")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(
        column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: whatever reads them again
    does not compute them again, and a lost executor loses nothing."""
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


#: Rows of a batch that goes to Python: texts are long.
ROWS_PER_BATCH = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready_for_python(df: DataFrame) -> None:
    """Settings of the session for work on texts in Python tasks; both stay.

    Batches are cut to ROWS_PER_BATCH rows where the session allows more, since a task
    holds a batch several times over. And the workers of a local session may import
    this package from where the driver found it, whatever its working folder; on a
    cluster the package is installed, or shipped with `--py-files`.
    """
    spark = df.sparkSession
    most = int(spark.conf.get(_BATCH_SETTING))
    if not 0 < most <= ROWS_PER_BATCH:
        spark.conf.set(_BATCH_SETTING, str(ROWS_PER_BATCH))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def bounded_broadcast(small: DataFrame, rows: int, bound: int) -> DataFrame:
    """The frame marked for broadcast if it has at most `bound` rows; otherwise
    as it is, so that the join shuffles and skewed keys are split."""
    return F.broadcast(small) if rows <= bound else small
