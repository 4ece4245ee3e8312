"""Nested posts: author lookup, flattening, search, and the per-keyword union."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.functions.times import instant

DEFAULT_SEARCH_SPAN = timedelta(days=7)
# Rows of users that Spark may broadcast at most, if its own estimate says so.
BROADCAST_USERS = 20_000


def latest_users(
    users: DataFrame, order_column: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per user id: the one with the highest `order_column`, among equals the
    one whose values hash highest, so that every run keeps the same row. The rank is
    two fixed-width values; of the rest only `columns` (all by default) travel.

    Spark sorts the rows of a task before it combines them, and a file of one row group
    is one task however long it is. What a task has read is therefore dealt out by id
    first, and a user's rows of one task are combined before those of all tasks meet."""
    kept = [n for n in users.columns if n not in ("id", order_column)]
    wanted = [n for n in (kept if columns is None else columns) if n != "id"]
    tie = F.xxhash64(*(F.to_json(F.struct(n)) for n in sorted(kept)))
    ranked = users.select(
        "id",
        F.struct(*wanted).alias("values"),
        F.struct(F.col(order_column), tie).alias("rank"),
        F.spark_partition_id().alias("read_by"),
    )
    last = F.max_by("values", "rank").alias("last")
    dealt = ranked.repartition("id", "read_by")
    return dealt.groupBy("id").agg(last).select("id", "last.*")


def join_authors(
    posts: DataFrame, users: DataFrame, order_column: str, salts: int = 8
) -> DataFrame:
    """Posts with a `user` struct, null where the author is unknown.

    The larger side is the posts, and one author may have written a large share
    of them. Users are therefore repeated once per salt and a post meets only
    the copy of its own salt, which cuts every author's posts into `salts`
    parts; what is still too big is left to AQE. Posts without an author never
    match and take salts without bound, which spreads them over all tasks.

    Spark's own estimate of the users is of their compressed files and counts no
    copies, so it may decide on a broadcast of up to `BROADCAST_USERS` rows only;
    more users are always shuffled.
    """
    user = F.struct(*(F.col(n) for n in users.columns if n != order_column)).alias("user")
    keyed_users = latest_users(users, order_column).select(
        F.col("id").alias("author_key"),
        user,
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias(
            "salt_key"
        ),
    )
    if users.limit(BROADCAST_USERS + 1).count() > BROADCAST_USERS:
        keyed_users = keyed_users.hint("merge")
    spread = F.xxhash64("id")
    salt = F.when(F.col("author_id").isNull(), spread).otherwise(
        F.pmod(spread, F.lit(salts).cast("long"))
    )
    met = (F.col("author_id") == F.col("author_key")) & (F.col("salt") == F.col("salt_key"))
    return (
        posts.withColumn("salt", salt)
        .join(keyed_users, met, "left")
        .drop("author_key", "salt", "salt_key")
    )


def _joined(items: Column, field: str) -> Column:
    """Values of one field of an array of structs, without nulls and empty ones."""
    values = F.transform(items, lambda item: item[field])
    return F.coalesce(F.array_join(F.filter(values, lambda v: v != ""), ", "), F.lit(""))


def refers_to(kind: str) -> Column:
    """Whether the post refers to another one in the given way."""
    found = F.exists("referenced_tweets", lambda r: F.coalesce(r["type"] == kind, F.lit(False)))
    return F.coalesce(found, F.lit(False))


def has_media() -> Column:
    """True where a media list is present, even an empty one."""
    return F.col("attachments.media_keys").isNotNull()


def flatten_posts(
    posts: DataFrame,
    users: DataFrame,
    order_column: str,
    carry: Sequence[str] = (),
    salts: int = 8,
) -> DataFrame:
    """The flat 25-column table: metrics default to 0, texts to '', flags to false.
    Columns to `carry` follow unchanged."""

    def number(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(0)).cast("long")

    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))

    return join_authors(posts, users, order_column, salts).select(
        F.col("id").alias("tweet_id"),
        text("text").alias("text"),
        F.col("created_at"),
        text("lang").alias("language"),
        text("source").alias("source"),
        number("public_metrics.like_count").alias("like_count"),
        number("public_metrics.retweet_count").alias("retweet_count"),
        number("public_metrics.reply_count").alias("reply_count"),
        number("public_metrics.quote_count").alias("quote_count"),
        number("public_metrics.impression_count").alias("impression_count"),
        F.col("author_id").alias("user_id"),
        text("user.username").alias("username"),
        text("user.name").alias("user_name"),
        text("user.description").alias("user_description"),
        text("user.location").alias("user_location"),
        F.coalesce(F.col("user.verified"), F.lit(False)).alias("user_verified"),
        number("user.public_metrics.followers_count").alias("user_followers"),
        number("user.public_metrics.following_count").alias("user_following"),
        number("user.public_metrics.tweet_count").alias("user_tweet_count"),
        _joined(F.col("entities.hashtags"), "tag").alias("hashtags"),
        _joined(F.col("entities.mentions"), "username").alias("mentions"),
        _joined(F.col("entities.urls"), "expanded_url").alias("urls"),
        refers_to("retweeted").alias("is_retweet"),
        refers_to("replied_to").alias("is_reply"),
        has_media().alias("has_media"),
        *carry,
    )


def scrub_lines(flat: DataFrame) -> DataFrame:
    """Line breaks to spaces before a CSV is written; descriptions may keep
    carriage returns."""
    return flat.withColumns(
        {
            "text": F.translate("text", "\n\r", "  "),
            "user_description": F.translate("user_description", "\n", " "),
        }
    )


def searched(posts: DataFrame, since: datetime, until: datetime | None) -> DataFrame:
    found = posts.filter(F.col("created_at") >= instant(since))
    return found if until is None else found.filter(F.col("created_at") < instant(until))


def _mentions(keyword: str) -> Column:
    return F.contains(F.lower("text"), F.lit(keyword.lower()))


def search_posts(
    posts: DataFrame,
    keyword: str,
    *,
    as_of: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    newest: int | None = None,
) -> DataFrame:
    """Posts that contain the keyword, by default of the seven days before
    `as_of`; `newest` keeps the latest ones."""
    found = searched(posts, since or as_of - DEFAULT_SEARCH_SPAN, until)
    found = found.filter(_mentions(keyword))
    if newest is None:
        return found
    return found.orderBy(F.desc("created_at"), F.desc("id")).limit(newest)


def collect_by_keywords(
    posts: DataFrame,
    keywords: Sequence[str],
    *,
    as_of: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    newest: int | None = None,
    salts: int = 64,
) -> DataFrame:
    """One search per keyword, all results together with their `keyword`. A post
    that matches two keywords appears twice.

    All keywords are tried in one scan. `newest` keeps the latest posts of each
    keyword, in two steps whatever the number: a keyword's posts are ranked in
    `salts` parts, and only the newest of each part are ranked again together.
    """
    found = searched(posts, since or as_of - DEFAULT_SEARCH_SPAN, until)
    tried = [F.when(_mentions(k), F.lit(k)) for k in keywords]
    matched = F.array_compact(F.array(*tried).cast("array<string>"))
    found = found.withColumn("keyword", F.explode(matched))
    return found if newest is None else newest_per_keyword(found, newest, salts)


def newest_per_keyword(found: DataFrame, newest: int, salts: int = 64) -> DataFrame:
    """The latest posts of each keyword, ranked in `salts` parts and then together."""
    order = (F.desc("created_at"), F.desc("id"))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
    for keys in (("keyword", "salt"), ("keyword",)):
        latest = Window.partitionBy(*keys).orderBy(*order)
        salted = (
            salted.withColumn("place", F.row_number().over(latest))
            .filter(F.col("place") <= newest)
            .drop("place")
        )
    return salted.drop("salt")
