"""Quality of predictions, computed where the predictions are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Share of rows whose prediction is the label."""
    right = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("int")
    return df.agg(F.count("*").alias("row_count"), F.avg(right).alias("accuracy"))


def confusion_matrix(
    df: DataFrame, label: str, prediction: str, classes: Sequence[str], other: str = "other"
) -> DataFrame:
    """One row per true class, one column per predicted class, counts in the
    cells. The classes are given, so this is one aggregate; predictions that are none
    of them, and null ones, count in the column `other`, so that a row adds up to all
    rows of its class."""
    made = F.col(prediction)
    cells = [F.count_if(made == name).alias(name) for name in classes]
    rest = F.count_if(~F.coalesce(made.isin(list(classes)), F.lit(False)))
    return df.groupBy(label).agg(*cells, rest.alias(other))


def recall_by_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Per true class its rows, and the share of them predicted right."""
    right = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("int")
    return df.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("row_count"), F.avg(right).alias("recall")
    )


def against_constant(
    df: DataFrame, label: str, prediction: str, probability: str
) -> DataFrame:
    """One row that compares predictions with the best guess that ignores the text:
    `accuracy` and the `majority_share` of the commonest class, `log_loss` of the
    `probability` given to the true class and that of the classes' own shares.

    Sums per class first, so what meets in the last step is a row per class."""
    right = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("long")
    per_class = df.groupBy(label).agg(
        F.count("*").alias("n"),
        F.sum(right).alias("right"),
        F.sum(-F.log(F.greatest(probability, F.lit(1e-15)))).alias("loss"),
    )
    total = F.sum("n")
    return per_class.agg(
        total.alias("row_count"),
        (F.sum("right") / total).alias("accuracy"),
        (F.max("n") / total).alias("majority_share"),
        (F.sum("loss") / total).alias("log_loss"),
        (F.log(total) - F.sum(F.col("n") * F.log("n")) / total).alias("constant_log_loss"),
    )
