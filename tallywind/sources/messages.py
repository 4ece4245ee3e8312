"""JSON messages: publishing rows, and reading them from a broker or from files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywind.functions.text import clean_text
from tallywind.functions.times import event_timestamp
from tallywind.schemas import ENVELOPE, MESSAGE


def to_messages(
    labelled: DataFrame, event_time: Column | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """One JSON message per row, without the label. The event time is the moment
    of publishing unless given. Columns to `carry` (a message key, say) follow."""
    published_at = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(
        F.col("id").cast("string").alias("id"),
        F.col("Topic").alias("topic"),
        F.col("Text").alias("Text"),
        (published_at if event_time is None else event_time).alias("event_time"),
    )
    return labelled.select(
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"), *carry
    )


def publish(messages: DataFrame, fmt: str, **options: str) -> None:
    """Send messages with any batch writer: `kafka` with its options, or
    `parquet` with a `path`."""
    messages.write.format(fmt).mode("append").options(**options).save()


def start_publishing(
    messages: DataFrame,
    fmt: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    trigger: str | None = None,
    **options: str,
) -> StreamingQuery:
    """The same for a stream of messages, with any streaming sink. A broker may see the
    messages of a batch twice after a failure; files are written once."""
    writer = messages.writeStream.format(fmt).outputMode("append").options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def kafka_options(
    servers: str,
    topic: str,
    *,
    starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Source options. A new query starts at the latest message by default; a
    bound on the offsets keeps a catch-up batch to a size the cluster can hold."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The stream of a broker topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load().select("value")


def file_stream(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream from Parquet files of published messages."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parse_messages(envelopes: DataFrame) -> DataFrame:
    """The fields of each message, all null where it is not valid JSON."""
    text = F.col("value").cast("string")
    return envelopes.select(F.from_json(text, MESSAGE).alias("data")).select("data.*")


def ready_to_score(envelopes: DataFrame) -> DataFrame:
    """Parsed messages with clean text and a timestamp."""
    return parse_messages(envelopes).withColumns(
        {"Text": clean_text("Text"), "event_time_ts": event_timestamp("event_time")}
    )
