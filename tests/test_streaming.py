from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallywind.operators.windows import WATERMARK_BY_WIDTH, windowed_sentiment
from tallywind.plans import scoring
from tallywind.plans.panels import current_range, panels
from tallywind.schemas import SCORED_POST, WINDOWED_RESULT
from tallywind.session import marked, new_folder, remove_folder
from tallywind.sources.files import read_archive
from tallywind.streaming import archive, results
from tests.helpers import plan, rows

T0 = datetime(2024, 5, 1, 12)
LABELS = ["Positive", "Neutral", "Negative", "Irrelevant", "Unknown"]


def posts(spark, *parts):
    """Rows from (minute, topic, label number)."""
    data = [
        (str(i), topic, "x", T0 + timedelta(minutes=minute), LABELS[label])
        for i, (minute, topic, label) in enumerate(parts)
    ]
    return spark.createDataFrame(data, SCORED_POST)


def deliver(spark, root, rows_, width="5 minutes", checkpoint="checkpoint"):
    rows_.write.mode("append").parquet(f"{root}/source")
    stream = spark.readStream.schema(SCORED_POST).parquet(f"{root}/source")
    windows = windowed_sentiment(stream, width, watermark=WATERMARK_BY_WIDTH[width])
    query = results.start_upsert(
        windows, f"{root}/table", f"{root}/{checkpoint}", available_now=True
    )
    query.awaitTermination()


def stored(spark, *paths):
    return rows(results.read_results(spark, *paths).select(*WINDOWED_RESULT.names))


EVENT = st.tuples(st.integers(0, 29), st.sampled_from(["a", "b", None]), st.integers(0, 4))


@settings(
    max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(EVENT, min_size=2, max_size=30), st.data())
def test_stream_equals_batch_for_any_split(spark, events, data):
    events.sort(key=lambda e: e[0])
    cut = data.draw(st.integers(1, len(events) - 1))
    root = new_folder(spark, "split")
    deliver(spark, root, posts(spark, *events[:cut]))
    deliver(spark, root, posts(spark, *events[cut:]))
    assert stored(spark, f"{root}/table") == rows(
        windowed_sentiment(posts(spark, *events), "5 minutes")
    )


def test_changed_windows_are_replaced_and_others_kept(spark):
    root = new_folder(spark, "update")
    deliver(spark, root, posts(spark, (0, "a", 0), (6, "a", 0), (14, "b", 0)))
    deliver(spark, root, posts(spark, (7, "a", 2)))
    kept = results.read_results(spark, f"{root}/table").orderBy("window_start").collect()
    assert [r["revision"] for r in kept] == [1, 2, 1]
    assert [r["negative"] for r in kept] == [0, 1, 0]


def test_late_rows_are_dropped(spark):
    root = new_folder(spark, "late")
    deliver(spark, root, posts(spark, (0, "a", 0)))
    deliver(spark, root, posts(spark, (60, "a", 0)))
    deliver(spark, root, posts(spark, (1, "a", 0), (50, "a", 0)))  # the first one is too late
    got = {r[0]: r[3] for r in stored(spark, f"{root}/table")}
    assert got == {T0: 1, T0 + timedelta(minutes=50): 1, T0 + timedelta(minutes=60): 1}


def batch_of(spark, *parts):
    return windowed_sentiment(posts(spark, *parts), "5 minutes")


def contents(spark, path):
    return rows(results.read_results(spark, path))


def test_a_batch_counts_once_however_often_it_is_delivered(spark):
    path = new_folder(spark, "replay")
    first = batch_of(spark, (0, "a", 0), (0, None, 2), (9, "b", 1))
    second = batch_of(spark, (0, "a", 0), (1, "a", 0), (1500, "a", 2))
    results.upsert(spark, first, path, "s", 0)
    results.upsert(spark, first, path, "s", 0)
    assert len(stored(spark, path)) == 3
    results.upsert(spark, second, path, "s", 1)
    after = contents(spark, path)
    results.upsert(spark, second, path, "s", 1)
    assert contents(spark, path) == after
    assert {r[-2] for r in after} == {1, 2} and len(after) == 4


@pytest.mark.parametrize("at", ["changes", "ready", "half", "published"])
def test_a_batch_that_was_cut_off_is_finished(spark, at, monkeypatch):
    """Cut off before it was ready, before it was published, halfway through, and
    before it was committed."""
    path, whole = new_folder(spark, "cut-off"), new_folder(spark, "whole")
    first = batch_of(spark, (0, "a", 0), (1, "b", 0), (1500, "a", 1), (3000, "c", 1))
    second = batch_of(spark, (0, "a", 2), (1500, "d", 2))
    for table in (path, whole):
        results.upsert(spark, first, table, "s", 0)
    results.upsert(spark, second, whole, "s", 1)
    before = contents(spark, path)
    with monkeypatch.context() as broken:
        if at == "changes":
            broken.setattr(results, "mark", None)
            with pytest.raises(TypeError):
                results.stage(spark, second, path, "s", 1)
        else:
            folder = results.stage(spark, second, path, "s", 1)
            if at == "half":  # one date is replaced, the folder of another is gone
                results.publish(spark, folder, path)
                remove_folder(spark, f"{path}/rows/window_date=2024-05-01")
            if at == "published":
                results.publish(spark, folder, path)
    if at in ("changes", "ready"):
        assert contents(spark, path) == before
    results.upsert(spark, second, path, "s", 1)
    assert contents(spark, path) == contents(spark, whole)
    third = batch_of(spark, (0, "a", 0))
    for table in (path, whole):
        results.upsert(spark, third, table, "s", 2)
    assert contents(spark, path) == contents(spark, whole)
    assert not marked(spark, f"{path}/staged/s-1")


def test_a_failing_write_does_not_commit(spark, monkeypatch):
    root = new_folder(spark, "failing")
    deliver(spark, root, posts(spark, (0, "a", 0)))

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as broken:
        broken.setattr(results, "publish", fail)
        with pytest.raises(StreamingQueryException):
            deliver(spark, root, posts(spark, (1, "a", 0)))
    assert stored(spark, f"{root}/table")[0][3] == 1
    deliver(spark, root, posts(spark, (2, "a", 0)))
    assert stored(spark, f"{root}/table")[0][3] == 3


def test_a_lost_checkpoint_replaces_what_it_reads_again(spark):
    root = new_folder(spark, "lost")
    deliver(spark, root, posts(spark, (0, "a", 0)))
    deliver(spark, root, posts(spark, (1, "a", 0)))
    assert stored(spark, f"{root}/table")[0][3] == 2
    deliver(spark, root, posts(spark, (2, "a", 0)), checkpoint="another")
    assert stored(spark, f"{root}/table")[0][3] == 3  # the source was read from its start


def days_of(spark, days, per_day=1):
    """Windows on consecutive dates from 1971 on, `per_day` topics each."""
    start = F.timestamp_seconds(F.lit(31_536_000) + F.floor(F.col("id") / per_day) * 86_400)
    return spark.range(days * per_day).select(
        start.alias("window_start"),
        (start + F.expr("INTERVAL 5 MINUTES")).alias("window_end"),
        (F.col("id") % per_day).cast("string").alias("topic"),
        *(F.lit(1).alias(n) for n in WINDOWED_RESULT.names[3:]),
    )


def test_thousands_of_dates_in_a_batch(spark):
    path = new_folder(spark, "backfill")
    results.upsert(spark, days_of(spark, 3000), path, "s", 0)
    results.upsert(spark, days_of(spark, 400, 2), path, "s", 1)
    kept = results.read_results(spark, path)
    assert kept.count() == 3400 and kept.select("window_date").distinct().count() == 3000
    assert kept.where("revision = 2").count() == 400


def test_only_touched_dates_are_rewritten(spark):
    path = new_folder(spark, "touched")
    results.upsert(spark, days_of(spark, 5), path, "s", 0)
    before = set(results.read_results(spark, path).inputFiles())
    results.upsert(spark, days_of(spark, 2), path, "s", 1)
    after = set(results.read_results(spark, path).inputFiles())
    assert len(before) == len(after) == 5 and len(before & after) == 3


def test_only_dates_of_the_range_are_opened(spark):
    path = new_folder(spark, "dates")
    for batch, minute in enumerate((0, 1440, 2880, 2885)):
        results.upsert(spark, batch_of(spark, (minute, "a", 0)), path, "s", batch)
    now = T0 + timedelta(minutes=2890)
    opened = current_range(spark, [path], now, 60, None)
    assert opened.count() == 2
    assert plan(opened).count("PartitionFilters: [isnotnull(window_date") == 1
    assert len(results.read_results(spark, path).inputFiles()) == 3


def test_a_large_date_is_several_tasks(spark):
    path = new_folder(spark, "large")
    results.upsert(spark, days_of(spark, 1, 60_000), path, "s", 0, rows_per_file=9_000)
    kept = results.read_results(spark, path)
    sizes = kept.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 7 and max(r["count"] for r in sizes) <= 9_000
    tasks = kept.select(F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1)).distinct()
    assert tasks.count() > 2


def test_results_of_nothing(spark):
    assert stored(spark) == [] and stored(spark, new_folder(spark, "missing")) == []
    path = new_folder(spark, "nothing")
    results.upsert(spark, spark.createDataFrame([], WINDOWED_RESULT), path, "s", 0)
    assert stored(spark, path) == []


def test_stored_types(spark):
    path = new_folder(spark, "types")
    batch = windowed_sentiment(posts(spark, (0, "a", 0)), "1 hour")
    narrow = batch.withColumn("positive", F.col("positive").cast("int"))
    results.upsert(spark, narrow, path, "s", 0)
    kept = {f.name: f.dataType for f in results.read_results(spark, path).schema.fields}
    assert {f.name: f.dataType for f in WINDOWED_RESULT.fields}.items() <= kept.items()


def test_a_range_is_read_without_a_shuffle(spark):
    path = new_folder(spark, "plan")
    batch = windowed_sentiment(posts(spark, (0, "a", 0), (3000, "a", 0)), "1 hour")
    results.upsert(spark, batch, path, "s", 0)
    text = plan(current_range(spark, [path], T0 + timedelta(minutes=3000), 60, None))
    assert "Exchange" not in text and "Aggregate" not in text
    assert "GreaterThanOrEqual(window_start" in text


def test_stored_dates_do_not_depend_on_the_session_zone(spark):
    path = new_folder(spark, "zone")
    batch = windowed_sentiment(posts(spark, (0, "a", 0), (-700, "a", 0)), "5 minutes")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        results.upsert(spark, batch, path, "s", 0)
        moved = results.read_results(spark, path).select("window_date").distinct().collect()
        found = current_range(spark, [path], T0 + timedelta(minutes=10), 720, None).count()
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert current_range(spark, [path], T0 + timedelta(minutes=10), 720, None).count() == found
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == 2 and [r[0] for r in moved] == [T0.date()]


def test_archive_keeps_rows_without_a_time(spark):
    root = new_folder(spark, "archive")
    rows_ = posts(spark, (0, "a", 0), (3000, None, 4))
    untimed = rows_.withColumn("event_time_ts", F.lit(None).cast("timestamp"))
    rows_.unionByName(untimed).write.parquet(f"{root}/source")
    stream = spark.readStream.schema(SCORED_POST).parquet(f"{root}/source")
    for _ in range(2):  # the second run finds nothing new
        archive.start_archive(
            stream, f"{root}/posts", f"{root}/checkpoint", available_now=True
        ).awaitTermination()
    assert rows(read_archive(spark, f"{root}/posts")) == rows(rows_.unionByName(untimed))
    one_day = read_archive(spark, f"{root}/posts", date_range=(T0.date(), T0.date()))
    assert one_day.count() == 1


def test_job_from_archive_and_direct_agree(spark):
    events = [(m % 90, "ab"[m % 2], m % 5) for m in range(200)]
    source = new_folder(spark, "source")
    posts(spark, *sorted(events)).write.parquet(source)
    scored = spark.readStream.schema(SCORED_POST).parquet(source)
    one, other = new_folder(spark, "one"), new_folder(spark, "other")
    scoring.run_from_archive(scored, one)
    for query in scoring.start_direct(scored, other, available_now=True):
        query.awaitTermination()
    for width in WATERMARK_BY_WIDTH:
        expected = rows(windowed_sentiment(posts(spark, *events), width))
        assert stored(spark, scoring.results_path(one, width)) == expected
        assert stored(spark, scoring.results_path(other, width)) == expected


def test_continuous_job_feeds_windows_from_the_archive(spark):
    source, root = new_folder(spark, "source"), new_folder(spark, "continuous")
    events = [(m, "a", m % 5) for m in range(12)]
    posts(spark, *events).write.parquet(source)
    scored = spark.readStream.schema(SCORED_POST).parquet(source)
    started = scoring.start_from_archive(scored, root)
    try:
        for query in started:
            query.processAllAvailable()
        assert len(started) == 3
        expected = rows(windowed_sentiment(posts(spark, *events), "5 minutes"))
        assert stored(spark, scoring.results_path(root, "5 minutes")) == expected
    finally:
        for query in started:
            query.stop()


def test_console(spark):
    source = new_folder(spark, "source")
    posts(spark, (0, "a", 0)).write.parquet(source)
    stream = spark.readStream.schema(SCORED_POST).parquet(source)
    query = archive.start_console(stream, new_folder(spark, "checkpoint"))
    query.processAllAvailable()
    sink = query.recentProgress[0]
    query.stop()
    assert sink.numInputRows == 1 and "ConsoleTable" in sink.sink.description


@pytest.mark.parametrize("topic", [None, "a"])
def test_panels_over_the_table(spark, topic):
    root = new_folder(spark, "panels")
    deliver(spark, root, posts(spark, (0, "a", 0), (1, "b", 2), (20, "a", 1)))
    now = T0 + timedelta(minutes=30)
    current = current_range(spark, [f"{root}/table"], now, 30, topic)
    frames = panels(current, 30)
    assert set(frames) == {"kpi", "trend", "share", "top_topics", "recent"}
    assert frames["kpi"].first()["total_mentions"] == (3 if topic is None else 2)
    assert frames["trend"].count() == 5
