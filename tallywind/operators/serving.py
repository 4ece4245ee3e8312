"""Panels over the windowed results.

Each takes a result frame (stored or computed) and returns a small frame. All
reductions are two-step aggregates; sorted panels keep only their top rows per
task.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywind.functions.scores import net_score
from tallywind.functions.times import instant, utc_date

# The ranges a reader may choose, in minutes.
RANGE_MINUTES = (15, 30, 45, 60, 120, 240, 480, 720, 1440, 2880, 10080)
ALL_TOPICS = None


def bin_width(minutes_back: int) -> str:
    """Bin size of the trend for a range."""
    if minutes_back <= 180:
        return "5 minutes"
    return "15 minutes" if minutes_back <= 1440 else "1 hour"


def range_start(as_of: datetime, minutes_back: int) -> datetime:
    if minutes_back not in RANGE_MINUTES:
        raise ValueError(f"minutes_back must be one of {RANGE_MINUTES}")
    return as_of - timedelta(minutes=minutes_back)


def in_range(
    results: DataFrame,
    as_of: datetime,
    minutes_back: int,
    topic: str | None = ALL_TOPICS,
) -> DataFrame:
    """Windows that start within the range (no upper bound), of one topic or all.

    A stored result table is laid out by `window_date`; where that column is
    present the cutoff prunes its folders too.
    """
    cutoff = instant(range_start(as_of, minutes_back))
    kept = results.filter(F.col("window_start") >= cutoff)
    if "window_date" in results.columns:
        kept = kept.filter(F.col("window_date") >= utc_date(cutoff))
    if topic is not ALL_TOPICS:
        kept = kept.filter(F.col("topic") == topic)
    return kept


def _with_net_score(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "net_score",
        F.round(net_score(F.col("positive"), F.col("negative"), F.col("total_mentions")), 3),
    )


_COUNTS = ("total_mentions", "positive", "neutral", "negative")


def kpi_summary(results: DataFrame) -> DataFrame:
    """One row of totals, and the net score as a ratio of sums."""
    sums = (F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in _COUNTS)
    return _with_net_score(results.agg(*sums))


def kpi_all_ranges(results: DataFrame, as_of: datetime) -> DataFrame:
    """The totals of every range, one row each, from one pass.

    A window counts in the shortest range that reaches back to it; only the totals
    of these at most eleven bands are then added to the longer ranges. Ranges
    without windows have zeros.
    """
    widest = in_range(results, as_of, max(RANGE_MINUTES))
    start = F.col("window_start")
    band = F.lit(None).cast("long")
    for minutes in sorted(RANGE_MINUTES, reverse=True):
        reached = start >= instant(range_start(as_of, minutes))
        band = F.when(reached, F.lit(minutes).cast("long")).otherwise(band)
    bands = widest.groupBy(band.alias("band")).agg(*(F.sum(n).alias(n) for n in _COUNTS))
    every = F.array(*(F.lit(m).cast("long") for m in RANGE_MINUTES))
    longer = F.filter(every, lambda minutes: minutes >= F.col("band"))
    return totals_per_range(bands.select(F.explode(longer).alias("minutes_back"), *_COUNTS))


def totals_per_range(added: DataFrame) -> DataFrame:
    """The totals of every range from rows with a range's `minutes_back` and counts."""
    every = F.array(*(F.lit(m).cast("long") for m in RANGE_MINUTES))
    zeros = (F.lit(0).cast("long").alias(name) for name in _COUNTS)
    empty = added.sparkSession.range(1).select(F.explode(every).alias("minutes_back"), *zeros)
    sums = (F.sum(name).alias(name) for name in _COUNTS)
    counted = added.select("minutes_back", *_COUNTS).unionByName(empty)
    return _with_net_score(counted.groupBy("minutes_back").agg(*sums))


def trend(results: DataFrame, width: str) -> DataFrame:
    """Mean score (unweighted over windows and topics) and mentions per bin.

    Bins between the first and the last one that hold no window appear with
    zeros: each bin also stands for the empty ones up to the next, so the results are
    read once and nothing is joined. The window runs over one row per bin.
    """
    bins = results.groupBy(F.window("window_start", width)["start"].alias("bin_start")).agg(
        F.avg("sentiment_score").alias("mean_score"),
        F.sum("total_mentions").alias("total_mentions"),
    )
    step = F.expr(f"INTERVAL {width}")
    own = F.col("bin_start")
    following = F.lead("bin_start").over(Window.orderBy("bin_start"))
    spans = bins.withColumn("until", F.coalesce(following - step, own))
    filled = spans.select("*", F.explode(F.sequence(own, F.col("until"), step)).alias("bin"))
    return filled.select(
        F.col("bin").alias("bin_start"),
        F.when(F.col("bin") == own, F.col("mean_score")).otherwise(0.0).alias("mean_score"),
        F.when(F.col("bin") == own, F.col("total_mentions"))
        .otherwise(F.lit(0).cast("long"))
        .alias("total_mentions"),
    )


def sentiment_share(results: DataFrame) -> DataFrame:
    """The three category totals as rows, with their share in percent."""
    kpi = kpi_summary(results)
    rows = kpi.select(
        "total_mentions",
        F.col("positive").alias("Positive"),
        F.col("neutral").alias("Neutral"),
        F.col("negative").alias("Negative"),
    ).unpivot("total_mentions", ["Positive", "Neutral", "Negative"], "sentiment", "mentions")
    share = F.when(F.col("total_mentions") > 0, 100 * F.col("mentions") / F.col("total_mentions"))
    return rows.select(
        "sentiment", "mentions", F.coalesce(share, F.lit(0.0)).alias("share_percent")
    )


def top_topics(results: DataFrame, n: int = 5) -> DataFrame:
    """Topics with the most mentions; rows without a topic are left out."""
    return (
        results.filter(F.col("topic").isNotNull())
        .groupBy("topic")
        .agg(F.sum("total_mentions").alias("total_mentions"))
        .orderBy(F.desc("total_mentions"), "topic")
        .limit(n)
    )


def recent_rows(results: DataFrame, n: int = 20) -> DataFrame:
    """The newest windows; ties by topic."""
    return results.orderBy(F.desc("window_start"), F.asc_nulls_last("topic")).limit(n)


def topic_list(results: DataFrame) -> DataFrame:
    """All topics ever seen, sorted."""
    return results.select("topic").filter(F.col("topic").isNotNull()).distinct().orderBy("topic")
