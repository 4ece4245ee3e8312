"""The upsert sink of windowed results.

Results are a Parquet table with one row per window and topic, laid out by date. Files
can't be changed in place, so a micro-batch writes the dates it touches anew:

1. its changes are staged;
2. with the stored rows of their dates, the newest per key, they are staged as these
   dates' new contents, and marked ready;
3. the staged contents overwrite the dates (dynamic partition overwrite);
4. a marker commits the batch, and what was staged is removed.

A batch that is replayed behind its marker is left alone. One that was cut off after it
was marked ready goes on from what is staged: overwriting a date twice with the same
contents changes nothing, and stored rows, some of which may be replaced or gone by then,
are not read again. One cut off earlier has changed nothing.

Either way the changes are computed: a stateful query keeps its state in the tasks that do.

Markers belong to a checkpoint. A new one, whose batches are numbered from zero again,
has markers of its own, and its rows replace those of the keys they have.

One query writes a table. A reader that opens a date while it is replaced can miss a file
and has to try again; where that matters, keep the results in a table format with
transactions and use its MERGE here.
"""

from __future__ import annotations

import math
import re
import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallywind.functions.times import utc_date
from tallywind.schemas import WINDOWED_RESULT
from tallywind.session import mark, marked, remove_folder

_KEY = ("window_date", "window_start", "window_end", "topic")
_VALUES = [n for n in WINDOWED_RESULT.names if n not in _KEY]
COUNTS = ("total_mentions", "positive", "neutral", "negative")

#: A stored row also has the number of batches that wrote it, and its date.
STORED = T.StructType(
    [
        *WINDOWED_RESULT.fields,
        T.StructField("revision", T.LongType()),
        T.StructField("window_date", T.DateType()),
    ]
)


_DAY = re.compile(r"/window_date=(\d{4}-\d\d-\d\d)/")

#: A row of the hourly or daily sums.
ROLLED_UP = T.StructType(
    [f for f in STORED.fields if f.name in ("window_start", "topic", *COUNTS, "window_date")]
)

#: Rows of a file, and files that a task writes one after the other.
ROWS_PER_FILE = 250_000
FILES_PER_TASK = 50


def _read(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """A folder of Parquet files; no rows where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _rows(path: str) -> str:
    return f"{path}/rows"


def _staged(path: str, sink: str, batch_id: int) -> str:
    return f"{path}/staged/{sink}-{batch_id}"


def _committed(path: str, sink: str, batch_id: int) -> str:
    return f"{path}/commits/{sink}-{batch_id}"


def _consume(changes: DataFrame) -> None:
    """Compute the rows of a replayed batch, so that its state is kept, and drop them."""
    changes.write.format("noop").mode("overwrite").save()


def sink_of(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a checkpoint's batches are marked, kept beside its files."""
    folder = f"{checkpoint}/sink"
    named = _read(spark, folder, T.StructType([T.StructField("name", T.StringType())])).first()
    if named is not None:
        return named["name"]
    name = uuid.uuid4().hex
    spark.range(1).select(F.lit(name).alias("name")).write.mode("overwrite").parquet(folder)
    return name


def stage(
    spark: SparkSession, changes: DataFrame, path: str, sink: str, batch_id: int
) -> str | None:
    """Stage the new contents of the dates that the changes touch, and return their
    folder; None without changes. The changes are computed once. Their dates, which are
    collected, are as many as a batch has; only their folders are read."""
    folder = _staged(path, sink, batch_id)
    if marked(spark, f"{folder}/ready"):
        _consume(changes)
        return folder
    typed = changes.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in WINDOWED_RESULT.fields),
        F.lit(1).cast("long").alias("revision"),
        utc_date("window_start").alias("window_date"),
    )
    typed.write.mode("overwrite").parquet(f"{folder}/changes")
    changed = spark.read.schema(STORED).parquet(f"{folder}/changes")
    days = [row["window_date"] for row in changed.select("window_date").distinct().collect()]
    if not days:
        remove_folder(spark, folder)
        return None
    stored = read_results(spark, path).where(F.col("window_date").isin(days))
    # Fixed-width values and ranks: a hash aggregate, combined before its shuffle.
    both = stored.withColumn("rank", F.lit(0)).unionByName(changed.withColumn("rank", F.lit(1)))
    newest = both.groupBy(*_KEY).agg(
        *(F.max_by(name, "rank").alias(name) for name in _VALUES),
        F.sum("revision").alias("revision"),
    )
    newest.select(*STORED.names).write.mode("overwrite").parquet(f"{folder}/contents")
    mark(spark, f"{folder}/ready")
    return folder


def publish(
    spark: SparkSession,
    folder: str,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    rollups: bool = False,
) -> None:
    """Overwrite dates with their staged contents, and with `rollups` their sums per hour
    and per day, which follow from a date's rows alone."""
    contents = spark.read.schema(STORED).parquet(f"{folder}/contents")
    _overwrite(contents, _rows(path), rows_per_file)
    for width, name in (ROLLUPS if rollups else {}).items():
        _overwrite(rolled_up(contents, width), f"{path}/{name}", rows_per_file)


#: Widths that sums are kept for, each a multiple of the one before, and their folders.
ROLLUPS = {"hour": "hours", "day": "days"}


def rolled_up(rows: DataFrame, width: str) -> DataFrame:
    """Sums per topic of the windows that start in an hour or a day (of UTC)."""
    seconds = {"hour": 3_600, "day": 86_400}[width]
    start = F.timestamp_seconds(F.floor(F.unix_seconds("window_start") / seconds) * seconds)
    return rows.groupBy(start.alias("window_start"), "topic", "window_date").agg(
        *(F.sum(name).alias(name) for name in COUNTS)
    )


def _overwrite(contents: DataFrame, target: str, rows_per_file: int) -> None:
    """Overwrite the dates of the contents. A large date is cut into parts of
    about `rows_per_file` rows, for each of which there is a task; small dates share
    tasks, some FILES_PER_TASK each. The parts per date are a small frame that is joined;
    nothing in the plan grows with the dates."""
    parts = contents.groupBy("window_date").agg(
        F.ceil(F.count("*") / F.lit(rows_per_file)).alias("parts")
    )
    load = F.when(F.col("parts") > 1, F.col("parts")).otherwise(1 / FILES_PER_TASK)
    tasks = max(1, math.ceil(parts.agg(F.sum(load)).first()[0]))
    part = F.pmod(F.xxhash64("window_start", "topic"), F.col("parts"))
    dealt = contents.join(F.broadcast(parts), "window_date").repartition(
        tasks, "window_date", part
    )
    writer = dealt.select(*contents.columns).write.mode("overwrite")
    writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("window_date").parquet(target)


def commit(spark: SparkSession, path: str, sink: str, batch_id: int) -> None:
    """Mark a batch as done and remove what it staged. Only the last batch can be
    replayed, so older markers go."""
    mark(spark, _committed(path, sink, batch_id))
    remove_folder(spark, _staged(path, sink, batch_id))
    remove_folder(spark, _committed(path, sink, batch_id - 2))


def upsert(
    spark: SparkSession,
    changes: DataFrame,
    path: str,
    sink: str,
    batch_id: int,
    rows_per_file: int = ROWS_PER_FILE,
    rollups: bool = False,
) -> None:
    """Bring the changes of a batch into the table, once however often it is called."""
    if marked(spark, _committed(path, sink, batch_id)):
        _consume(changes)
        return
    folder = stage(spark, changes, path, sink, batch_id)
    if folder is not None:
        publish(spark, folder, path, rows_per_file, rollups)
        commit(spark, path, sink, batch_id)


def start_upsert(
    windowed: DataFrame,
    path: str,
    checkpoint: str,
    *,
    available_now: bool = False,
    trigger: str | None = None,
    rollups: bool = False,
) -> StreamingQuery:
    """Keep a table up to date with a windowed stream (update mode), with `rollups` its
    hourly and daily sums too. `trigger` is the time between batches; a batch costs its
    dates' rows, so let it gather some."""
    # The session a batch arrives in has runtime re-planning switched off.
    spark = windowed.sparkSession
    sink = sink_of(spark, checkpoint)
    writer = windowed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(
        lambda rows, batch: upsert(spark, rows, path, sink, batch, rollups=rollups)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()


def read_results(spark: SparkSession, *paths: str, since: date | None = None) -> DataFrame:
    """The rows of result tables with their `revision` and `window_date`, of the dates
    from `since` on; nothing where a table does not exist yet."""
    found = spark.createDataFrame([], STORED) if not paths else None
    for path in paths:
        own = _read(spark, _rows(path), STORED)
        found = own if found is None else found.unionByName(own)
    return found if since is None else found.where(F.col("window_date") >= F.lit(since))


def read_rollup(spark: SparkSession, path: str, width: str) -> DataFrame:
    """The sums per hour or day that a table keeps."""
    return _read(spark, f"{path}/{ROLLUPS[width]}", ROLLED_UP)


def newest_rows(spark: SparkSession, path: str, n: int = 20) -> DataFrame:
    """The newest windows of a table, ties by topic. Dates are opened from the newest
    on, twice as many each time, until they have enough rows: a window starts on its date,
    so no older date can hold a newer one."""
    stored = read_results(spark, path)
    days = sorted({m[1] for m in map(_DAY.search, stored.inputFiles()) if m}, reverse=True)
    opened, taken = stored.limit(0), 0
    while taken < len(days):
        taken = min(len(days), max(1, 2 * taken))
        opened = stored.where(F.col("window_date") >= F.lit(days[taken - 1]).cast("date"))
        if len(opened.select("window_date").head(n)) == n:
            break
    return opened.orderBy(F.desc("window_start"), F.asc_nulls_last("topic")).limit(n)
