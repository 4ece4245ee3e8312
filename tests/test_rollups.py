"""Hourly and daily sums, the newest rows by date, and lookups in the archive."""

import random
import re
from datetime import timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tallywind.operators import serving
from tallywind.operators.windows import windowed_sentiment
from tallywind.plans.panels import range_sums, stored_kpi_all_ranges, stored_panels
from tallywind.schemas import SCORED_POST
from tallywind.session import new_folder
from tallywind.streaming import archive, results
from tests.helpers import plan, rows
from tests.test_streaming import T0, posts

DICE = random.Random(4)
EVENTS = [
    (DICE.randint(0, 11_000), DICE.choice(["a", "b", None]), DICE.randint(0, 4))
    for _ in range(400)
]


@pytest.fixture(scope="module")
def table(spark):
    """Two batches, of which the second changes dates of the first."""
    path = new_folder(spark, "rollups")
    for batch, events in enumerate((EVENTS[:250], EVENTS)):
        windows = windowed_sentiment(posts(spark, *events), "5 minutes")
        results.upsert(spark, windows, path, "s", batch, rollups=True)
    return path


@pytest.mark.parametrize(
    "now", [T0 + timedelta(minutes=m) for m in (10_700, 10_080, 10_860, 10_903, 11_520, 30_000)]
)
def test_all_ranges_from_sums(spark, table, now):
    stored = results.read_results(spark, table)
    found = stored_kpi_all_ranges(spark, table, now)
    assert rows(found) == rows(serving.kpi_all_ranges(stored, now))
    zoned = now.replace(tzinfo=timezone.utc).astimezone(timezone(timedelta(hours=7)))
    for minutes, topic in ((15, None), (480, "a"), (10080, "b")):
        found = stored_panels(spark, table, zoned, minutes, topic)
        plain = serving.in_range(stored, now, minutes, topic)
        assert rows(found["kpi"]) == rows(serving.kpi_summary(plain))
        assert rows(found["share"]) == rows(serving.sentiment_share(plain))
        assert rows(found["top_topics"]) == rows(serving.top_topics(plain))


def test_a_week_opens_few_five_minute_rows(spark, table):
    now = T0 + timedelta(minutes=11_011)
    sums = range_sums(spark, table, now, [10080])
    start = now - timedelta(minutes=10_080)
    text = plan(sums)
    assert text.count("Scan parquet") >= 3 and "Exchange" not in text
    stored, at = results.read_results(spark, table), F.col("window_start")
    first, hour = (
        F.lit(t.isoformat()).cast("timestamp") for t in (start, T0 + timedelta(minutes=960))
    )
    edge = stored.where((at >= first) & (at < hour)).count()
    hours = results.read_rollup(spark, table, "hour").where(at >= hour)
    hours = hours.where("window_date = '2024-05-02'").count()
    days = results.read_rollup(spark, table, "day").where("window_date > '2024-05-02'").count()
    assert sums.count() == edge + hours + days
    assert 4 * sums.count() < stored.where(at >= first).count()


def test_sums_of_a_missing_table(spark):
    missing = new_folder(spark, "missing")
    assert stored_kpi_all_ranges(spark, missing, T0).count() == 11
    assert rows(stored_panels(spark, missing, T0, 60)["kpi"]) == [(0, 0, 0, 0, 0.0)]


@pytest.mark.parametrize("n", [1, 3, 20, 10_000])
def test_newest_rows_by_date(spark, table, n):
    whole = serving.recent_rows(results.read_results(spark, table), n)
    assert [tuple(r) for r in results.newest_rows(spark, table, n).collect()] == [
        tuple(r) for r in whole.collect()
    ]


def test_one_date_is_opened_where_it_suffices(spark, table):
    newest = results.newest_rows(spark, table, 3)
    last = results.read_results(spark, table).agg(F.max("window_date")).first()[0]
    assert re.search(rf"PartitionFilters: .*window_date#\d+ >= {last}", plan(newest))
    assert results.newest_rows(spark, new_folder(spark, "none")).count() == 0


def scanned(df):
    """Rows that the scan of a collected frame gave out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_a_lookup_skips_row_groups(spark):
    # Enough ids that they don't fit a dictionary, which would do without the filter.
    root = new_folder(spark, "lookup")
    ids = spark.range(80_000).select(F.md5(F.col("id").cast("string")).alias("id"))
    made = ids.select(
        "id",
        F.lit("t").alias("topic"),
        F.lit("x").alias("Text"),
        F.lit(T0.isoformat()).cast("timestamp").alias("event_time_ts"),
        F.lit("Neutral").alias("sentiment_label"),
    )
    made.select(*SCORED_POST.names).coalesce(1).write.parquet(f"{root}/source")
    stream = spark.readStream.schema(SCORED_POST).parquet(f"{root}/source")
    archive.start_archive(
        stream, f"{root}/posts", f"{root}/checkpoint", available_now=True
    ).awaitTermination()
    wanted = [r["id"] for r in made.limit(2).collect()]
    found = archive.lookup_posts(spark, f"{root}/posts", [*wanted, "nobody"])
    assert sorted(r["id"] for r in found.collect()) == sorted(wanted)
    hadoop = spark._jsc.hadoopConfiguration()
    absent = ["7" * 31 + "g", "9" * 31 + "g"]  # within every row group's least and greatest
    hadoop.set("parquet.filter.dictionary.enabled", "false")
    try:
        assert scanned(archive.lookup_posts(spark, f"{root}/posts", absent)) == 0
        hadoop.set("parquet.filter.bloom.enabled", "false")
        assert scanned(archive.lookup_posts(spark, f"{root}/posts", absent)) > 0
    finally:
        hadoop.unset("parquet.filter.dictionary.enabled")
        hadoop.unset("parquet.filter.bloom.enabled")
