"""Labels and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class labels by prediction index of the original model.
LABEL_BY_INDEX = ("Negative", "Positive", "Neutral", "Irrelevant")
UNKNOWN = "Unknown"


def label_of(prediction: Column | str) -> Column:
    """Prediction index to class label, anything else (or null) to 'Unknown'."""
    column = F.col(prediction) if isinstance(prediction, str) else prediction
    label = F.lit(UNKNOWN)
    for i, name in enumerate(LABEL_BY_INDEX):
        label = F.when(column == float(i), name).otherwise(label)
    return label


def net_score(positive: Column, negative: Column, total: Column) -> Column:
    """Share of positive minus share of negative, 0 where nothing was counted."""
    return F.when(total > 0, (positive - negative) / total).otherwise(F.lit(0.0))
