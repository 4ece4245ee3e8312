"""The append-only archive of scored posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywind.functions.times import utc_date
from tallywind.schemas import ARCHIVE, SCORED_POST
from tallywind.sources.files import read_archive


# A Bloom filter per row group, by which a lookup by id skips nearly all of them. A stream
# takes the settings of Parquet not from its options but from the session it starts in.
_ID_FILTER = "parquet.bloom.filter.enabled#id"


def start_archive(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    trigger: str | None = None,
    tasks_per_date: int | None = None,
) -> StreamingQuery:
    """Append scored posts as Parquet, one folder per event date.

    Every task of a batch writes a file per date it has rows of. `trigger`, the time
    between batches, keeps the number of batches down, and `tasks_per_date` the number
    of files: the rows of a date then go to so many tasks, by the hash of their id,
    before they are written. Leave it out where batches are large.
    """
    dated = scored.select(*SCORED_POST.names, utc_date("event_time_ts").alias("event_date"))
    if tasks_per_date is not None:
        dated = dated.repartition("event_date", F.pmod(F.xxhash64("id"), F.lit(tasks_per_date)))
    writer = dated.writeStream.outputMode("append").format("parquet").partitionBy("event_date")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    settings = scored.sparkSession.conf
    before = settings.get(_ID_FILTER, None)
    settings.set(_ID_FILTER, "true")
    try:
        return writer.start()
    finally:
        settings.unset(_ID_FILTER) if before is None else settings.set(_ID_FILTER, before)


def archive_stream(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The archive as a stream, so that posts are scored once and every window
    query reads three columns of the stored result."""
    reader = spark.readStream.schema(ARCHIVE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select(*SCORED_POST.names)


def lookup_posts(
    spark: SparkSession, path: str, ids: Sequence[str], *, date_range=None
) -> DataFrame:
    """The archived posts with one of the ids, from the row groups whose Bloom filter may
    hold one; a (first, last) pair of dates leaves out folders as well. The ids are those
    of a request: they become part of the plan."""
    posts = read_archive(spark, path, date_range=date_range)
    return posts.filter(F.col("id").isin(list(ids)))


def start_console(
    df: DataFrame, checkpoint: str, *, rows: int = 20, output_mode: str = "append"
) -> StreamingQuery:
    """Print each batch, for debugging."""
    writer = df.writeStream.format("console").outputMode(output_mode)
    writer = writer.option("truncate", False).option("numRows", rows)
    return writer.option("checkpointLocation", checkpoint).start()
