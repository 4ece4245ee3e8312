"""Print the panels over the stored results.

    spark-submit -m tallywind.plans.panels --results /shared/sentiment/results_5_minutes \\
        --minutes-back 60
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.functions.times import instant, utc_date
from tallywind.operators import serving
from tallywind.session import build_session, new_folder
from tallywind.streaming.results import COUNTS, read_results, read_rollup


def current_range(
    spark: SparkSession, paths: list[str], as_of: datetime, minutes_back: int, topic: str | None
) -> DataFrame:
    """The stored rows of the range: date folders outside of it are not opened, and
    row groups are skipped by the start of the window."""
    since = serving.range_start(as_of, minutes_back)
    if since.tzinfo is not None:
        since = since.astimezone(timezone.utc)
    stored = read_results(spark, *paths, since=since.date())
    return serving.in_range(stored, as_of, minutes_back, topic)


def _pieces(cutoff: datetime) -> dict[str, tuple[datetime, datetime | None]]:
    """A range without an end as five-minute windows up to the next full hour, hours up
    to the next day, and days: `{width: (from, before)}`."""
    hour = cutoff.replace(minute=0, second=0, microsecond=0)
    hour += timedelta(hours=int(hour < cutoff))
    day = hour.replace(hour=0)
    day += timedelta(days=int(day < hour))
    return {"rows": (cutoff, hour), "hour": (hour, day), "day": (day, None)}


def _utc(moment: datetime) -> datetime:
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc)


def range_sums(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    ranges: Sequence[int],
    topic: str | None = None,
) -> DataFrame:
    """Sums from which the totals of ranges follow: `minutes_back, topic` and the counts.

    Five-minute rows are read only up to a range's first full hour, hourly sums up to its
    first full day, and daily ones from there: a week is seven daily rows per topic and
    less than a day of others. Each of the three tables is read once for all ranges.
    """
    cut = {m: _pieces(_utc(serving.range_start(as_of, m))) for m in ranges}
    found = None
    for width in ("rows", "hour", "day"):
        stored = read_results(spark, path) if width == "rows" else read_rollup(spark, path, width)
        start, own, parts = F.col("window_start"), F.lit(None).cast("long"), []
        within = F.lit(False)
        for minutes, pieces in cut.items():
            first, before = pieces[width]
            if first == before:
                continue
            part, dates = start >= instant(first), F.col("window_date") >= utc_date(instant(first))
            if before is not None:
                part &= start < instant(before)
                dates &= F.col("window_date") <= utc_date(instant(before))
            within |= part & dates
            parts.append(F.when(part, F.lit(minutes).cast("long")).otherwise(own))
        if not parts:
            continue
        rows = stored.where(within)
        if topic is not None:
            rows = rows.where(F.col("topic") == topic)
        rows = rows.select(
            F.explode(F.array_compact(F.array(*parts))).alias("minutes_back"), "topic", *COUNTS
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def stored_panels(
    spark: SparkSession, path: str, as_of: datetime, minutes_back: int, topic: str | None = None
) -> dict[str, DataFrame]:
    """The panels that need sums only, of a table with hourly and daily sums."""
    sums = range_sums(spark, path, as_of, [minutes_back], topic)
    return {
        "kpi": serving.kpi_summary(sums),
        "share": serving.sentiment_share(sums),
        "top_topics": serving.top_topics(sums),
    }


def stored_kpi_all_ranges(spark: SparkSession, path: str, as_of: datetime) -> DataFrame:
    """The totals of every range, one row each; zeros for a range without windows."""
    return serving.totals_per_range(range_sums(spark, path, as_of, serving.RANGE_MINUTES))


def panels(results: DataFrame, minutes_back: int) -> dict[str, DataFrame]:
    """All panels of a range."""
    return {
        "kpi": serving.kpi_summary(results),
        "trend": serving.trend(results, serving.bin_width(minutes_back)).orderBy("bin_start"),
        "share": serving.sentiment_share(results),
        "top_topics": serving.top_topics(results),
        "recent": serving.recent_rows(results),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description="Print the panels of a time range")
    parser.add_argument("--results", action="append", required=True)
    parser.add_argument("--minutes-back", type=int, default=serving.RANGE_MINUTES[0])
    parser.add_argument("--topic")
    args = parser.parse_args()
    spark = build_session("tallywind-panels")
    as_of = datetime.now(timezone.utc)
    serving.topic_list(read_results(spark, *args.results)).show(truncate=False)
    # Written once: the panels below read it some six times.
    path = new_folder(spark, "panel-range")
    current_range(spark, args.results, as_of, args.minutes_back, args.topic).write.parquet(path)
    results = spark.read.parquet(path)
    if results.isEmpty():
        print("no data in the chosen range")
        return
    for name, frame in panels(results, args.minutes_back).items():
        print(name)
        frame.show(truncate=False)


if __name__ == "__main__":
    main()
