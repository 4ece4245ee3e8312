"""Statistics of a flat post table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.functions.times import instant
from tallywind.operators.posts import latest_users

_CLOCK = "yyyy-MM-dd HH:mm:ss"


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are left out."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("post_count"))
        .orderBy(F.desc("post_count"), column)
    )


def top_users(flat: DataFrame, n: int = 10) -> DataFrame:
    """The users with the most posts."""
    return value_counts(flat, "username").limit(n)


def top_authors(posts: DataFrame, users: DataFrame, order_column: str, n: int = 10) -> DataFrame:
    """The same from nested posts: counted per author before anything is joined, so
    an author costs a row per task, and summed per name (unknown ones are '')."""
    per_author = posts.groupBy("author_id").agg(F.count("*").alias("own"))
    names = latest_users(users, order_column, ["username"]).select(
        F.col("id").alias("author_key"), "username"
    )
    joined = per_author.join(names, F.col("author_id") == F.col("author_key"), "left")
    name = F.coalesce("username", F.lit("")).alias("username")
    counts = joined.groupBy(name).agg(F.sum("own").alias("post_count"))
    return counts.orderBy(F.desc("post_count"), "username").limit(n)


def language_counts(posts: DataFrame) -> DataFrame:
    """Posts per language, straight from nested posts; a missing one is ''."""
    language = F.coalesce("lang", F.lit("")).alias("language")
    return value_counts(posts.select(language), "language")


def collection_report(flat: DataFrame, as_of: datetime) -> DataFrame:
    """One row for the whole table. `verified_posts` counts posts, not users."""
    share = 100 * F.avg(F.col("is_retweet").cast("int"))
    report = flat.agg(
        F.count("*").alias("total_tweets"),
        F.count_distinct("username").alias("unique_users"),
        F.min("created_at").alias("first_post_at"),
        F.max("created_at").alias("last_post_at"),
        F.avg("like_count").alias("avg_likes"),
        F.avg("retweet_count").alias("avg_retweets"),
        F.count_if("user_verified").alias("verified_posts"),
        F.coalesce(share, F.lit(0.0)).alias("retweet_percentage"),
    )
    return report.select(
        "total_tweets",
        F.date_format(instant(as_of), _CLOCK).alias("date_collected"),
        "unique_users",
        F.concat_ws(
            " to ", F.date_format("first_post_at", _CLOCK), F.date_format("last_post_at", _CLOCK)
        ).alias("date_range_tweets"),
        "avg_likes",
        "avg_retweets",
        "verified_posts",
        "retweet_percentage",
    )
