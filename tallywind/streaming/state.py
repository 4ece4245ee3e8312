"""What a stopped query keeps: its state and watermark, read from its checkpoint."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query, with the batches whose state is readable."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_rows(
    spark: SparkSession, checkpoint: str, *, operator: int = 0, batch: int | None = None
) -> DataFrame:
    """`key` and `value` of an operator's state behind a batch, by default the last."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def window_state(
    spark: SparkSession, checkpoint: str, *, batch: int | None = None
) -> DataFrame:
    """The windows a windowed query still holds open: `window_start, window_end, topic`
    and the counts it would go on from."""
    rows = state_rows(spark, checkpoint, batch=batch)
    # The key is the window and the topic. The value may repeat them; it ends with the
    # three sums, which are told apart by their places only.
    key, value = (rows.schema[name].dataType for name in ("key", "value"))
    places = T.StructType(
        [T.StructField(f"at_{i}", field.dataType) for i, field in enumerate(value.fields)]
    )
    sums = places.names[-3:]
    span, topic = (F.col("key")[name] for name in key.names[:2])
    return rows.withColumn("value", F.col("value").cast(places)).select(
        span["start"].alias("window_start"),
        span["end"].alias("window_end"),
        topic.alias("topic"),
        *(
            F.col("value")[place].alias(label)
            for place, label in zip(sums, ("positive", "neutral", "negative"))
        ),
    )


def watermark_of(spark: SparkSession, checkpoint: str) -> datetime:
    """The watermark the last planned batch began with."""
    lines = spark.read.text(f"{checkpoint}/offsets").select(
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1).alias("batch"),
        F.get_json_object("value", "$.batchWatermarkMs").cast("long").alias("millis"),
    )
    last = lines.where("millis is not null and batch <> ''").agg(
        F.max_by("millis", F.col("batch").cast("long"))
    )
    return datetime.fromtimestamp(last.first()[0] / 1000, timezone.utc)
