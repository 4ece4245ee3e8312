"""Tumbling sentiment totals, the same for a batch and for a stream."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.functions.scores import net_score
from tallywind.functions.times import instant
from tallywind.schemas import WINDOWED_RESULT

# Window width and the lateness it tolerates.
WATERMARK_BY_WIDTH = {"5 minutes": "15 minutes", "1 hour": "2 hours"}


def windowed_sentiment(
    scored: DataFrame,
    width: str,
    *,
    watermark: str | None = None,
    since: datetime | None = None,
) -> DataFrame:
    """Counts per (window, topic). Irrelevant and Unknown posts open a window but
    are not counted; posts without a time belong to no window; a null topic is a
    topic of its own.

    The counts are sums, so each task sends at most one row per (window, topic)
    it saw: a topic that holds a large share of all posts costs no more shuffle
    than any other. `since` keeps windows that start at or after it and drops
    earlier posts before they are aggregated.
    """
    posts = scored.select("event_time_ts", "topic", "sentiment_label")
    if since is not None:
        posts = posts.filter(F.col("event_time_ts") >= instant(since))
    if watermark is not None:
        posts = posts.withWatermark("event_time_ts", watermark)

    def posts_labelled(label: str):
        return F.sum(F.when(F.col("sentiment_label") == label, 1).otherwise(0))

    span = F.window("event_time_ts", width)
    if scored.isStreaming:
        # The watermark belongs to the window as a whole, and evicts by its end.
        keyed = posts.groupBy(span.alias("span"), "topic")
        start, end = F.col("span.start"), F.col("span.end")
    else:
        # A plain time is a cheaper key to hash than a pair of them.
        keyed = posts.groupBy(span["start"].alias("start"), "topic")
        start, end = F.col("start"), F.col("start") + F.expr(f"INTERVAL {width}")
    counts = keyed.agg(
        posts_labelled("Positive").alias("positive"),
        posts_labelled("Neutral").alias("neutral"),
        posts_labelled("Negative").alias("negative"),
    )
    totals = counts.withColumn(
        "total_mentions", F.col("positive") + F.col("neutral") + F.col("negative")
    ).withColumns(
        {
            "window_start": start,
            "window_end": end,
            "sentiment_score": net_score(
                F.col("positive"), F.col("negative"), F.col("total_mentions")
            ),
        }
    )
    if since is not None:
        totals = totals.filter(F.col("window_start") >= instant(since))
    return totals.select(*WINDOWED_RESULT.names)
