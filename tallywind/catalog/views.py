"""Posts, messages, scored posts and users, derived from the test tables.

Plain projections: every row of the table is used, and nulls, empty texts, tags
and malformed times are mixed in by rule so that their handling is checked.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.operators.windows import windowed_sentiment
from tallywind.sources.messages import to_messages

AS_OF = datetime(2024, 1, 30, 12)
POSTS_AS_OF = datetime(2024, 1, 10)
EPOCH_2024 = 1_704_067_200
LANGUAGES = ("en", "fr", "de", "es")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream. The pattern names this table alone and is read alike
    where it is one file and where it is a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`id, Topic, Label, Text, event_time` from the documents."""
    return messages_of(table(spark, sf_dir, "documents"))


def messages_of(documents: DataFrame) -> DataFrame:
    """The same from given documents, a batch or a stream."""
    doc = F.col("doc_id")
    text = (
        F.when(doc % 50 == 0, F.lit(None))
        .when(doc % 50 == 1, "")
        .when(
            doc % 10 == 2,
            F.concat(F.lit("#tag @user https://a.b/c www.d.e "), "text"),
        )
        .otherwise(F.col("text"))
    )
    moment = F.timestamp_seconds(F.lit(EPOCH_2024) + doc * 37)
    time = F.when(doc % 40 == 3, "bad").otherwise(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss"))
    return documents.select(
        doc.cast("string").alias("id"),
        F.col("source").alias("Topic"),
        F.col("lang").alias("Label"),
        text.alias("Text"),
        time.alias("event_time"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as JSON; some are not valid, some lack the time."""
    rows = messages(spark, sf_dir)
    kind = F.col("id").cast("long") % 30
    whole = to_messages(rows.withColumn("kind", kind), F.col("event_time"), carry=("kind",))
    text = F.col("value").cast("string")
    broken = (
        F.when(F.col("kind") == 7, F.concat(F.lit("oops "), text))
        .when(F.col("kind") == 8, F.regexp_replace(text, '"event_time"', '"other"'))
        .otherwise(text)
    )
    return whole.select(broken.cast("binary").alias("value"))


def scored_of(events: DataFrame) -> DataFrame:
    """Scored posts from the events, as a batch or as a stream."""
    event = F.col("event_type")
    label = (
        F.when(event == "purchase", "Positive")
        .when(event == "click", "Neutral")
        .when(event == "error", "Negative")
        .when(event == "signup", "Irrelevant")
        .otherwise("Unknown")
    )
    bucket = F.get_json_object("props", "$.k").cast("long") % 10
    topic = F.when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(
        F.concat(F.lit("topic_"), bucket.cast("string"))
    )
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        topic.alias("topic"),
        F.col("props").alias("Text"),
        F.col("ts").cast("timestamp").alias("event_time_ts"),
        label.alias("sentiment_label"),
    )


def scored(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    """Scored posts, optionally from a time on; the bound is put in the type of
    the stored column, so that the scan can skip row groups by it."""
    events = table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(F.col("ts") >= F.lit(since.isoformat()).cast("timestamp_ntz"))
    return scored_of(events)


def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_of(table_stream(spark, sf_dir, "events"))


def results(spark: SparkSession, sf_dir: str, since: datetime | None = None) -> DataFrame:
    """Five-minute results, of the windows that start at `since` or later."""
    return windowed_sentiment(scored(spark, sf_dir, since), "5 minutes", since=since)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested posts from the documents, with missing parts of every kind."""
    doc, size = F.col("doc_id"), F.col("n_chars")
    none = F.lit(None)
    words = F.slice(F.split("text", " "), 1, (doc % 4).cast("int"))
    tags = F.concat(words, F.when(doc % 6 == 0, F.array(F.lit(""))).otherwise(F.array()))
    author = F.when(doc % 41 != 0, doc * 7 % 2000)
    entities = F.struct(
        F.transform(tags, lambda w: F.struct(w.alias("tag"))).alias("hashtags"),
        F.when(
            doc % 3 == 0,
            F.array(
                F.struct(F.concat(F.lit("reader_"), doc.cast("string")).alias("username")),
                F.struct(F.lit("editor").alias("username")),
            ),
        ).alias("mentions"),
        F.array(
            F.struct(
                F.when(
                    size % 2 == 0, F.concat(F.lit("https://x.example/"), doc.cast("string"))
                ).alias("expanded_url")
            )
        ).alias("urls"),
    )
    return table(spark, sf_dir, "documents").select(
        doc.alias("id"),
        F.when(doc % 50 != 0, F.col("text")).alias("text"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + doc * 601).alias("created_at"),
        F.when(doc % 29 != 0, F.col("lang")).alias("lang"),
        F.col("source"),
        author.alias("author_id"),
        F.when(
            doc % 13 != 0,
            F.struct(
                F.when(doc % 7 != 3, size % 100).alias("like_count"),
                (size % 17).alias("retweet_count"),
                (size % 11).alias("reply_count"),
                (size % 5).alias("quote_count"),
                size.alias("impression_count"),
            ),
        ).alias("public_metrics"),
        F.when(doc % 11 != 0, entities).alias("entities"),
        _references(doc).alias("referenced_tweets"),
        F.when(
            doc % 3 != 0,
            F.struct(
                F.when(doc % 3 == 2, F.expr("array_repeat('m', int(n_chars % 2))")).alias(
                    "media_keys"
                )
            ),
        ).alias("attachments"),
    )


def _references(doc: Column) -> Column:
    def refs(*kinds: str) -> Column:
        items = (F.struct((doc + 1).alias("id"), F.lit(kind).alias("type")) for kind in kinds)
        return F.array(*items)

    return (
        F.when(doc % 5 == 1, F.array().cast("array<struct<id: bigint, type: string>>"))
        .when(doc % 5 == 2, refs("retweeted"))
        .when(doc % 5 == 3, refs("replied_to"))
        .when(doc % 5 == 4, refs("quoted", "retweeted"))
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from the customers; every tenth one is seen twice, the second time
    with another name."""
    key = F.col("c_custkey")
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    seen = F.explode(F.when(key % 10 == 0, twice).otherwise(once))
    rows = table(spark, sf_dir, "customer").withColumn("seen", seen)
    name = F.when(F.col("seen") == 1, F.col("c_name")).otherwise(F.concat("c_name", F.lit(" II")))
    return rows.select(
        key.alias("id"),
        F.when(key % 23 != 0, F.concat(F.lit("user_"), key.cast("string"))).alias("username"),
        name.alias("name"),
        F.concat(F.lit("about\n"), "c_name").alias("description"),
        F.when(key % 4 != 0, F.concat(F.lit("city "), (key % 9).cast("string"))).alias("location"),
        F.when(key % 31 != 0, F.col("c_acctbal") > 5000).alias("verified"),
        F.when(
            key % 17 != 0,
            F.struct(
                F.floor("c_acctbal").alias("followers_count"),
                (key % 300).alias("following_count"),
                F.when(key % 19 != 0, key % 70).alias("tweet_count"),
            ),
        ).alias("public_metrics"),
        F.col("seen"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a prediction made by rule: mostly right, some of each kind wrong,
    some outside of the classes, some missing."""
    doc = F.col("doc_id")
    guess = (
        F.when(doc % 7 == 0, "en")
        .when(doc % 11 == 0, "es")
        .when(doc % 13 == 5, "unheard")
        .when(doc % 17 != 3, F.col("lang"))
    )
    return table(spark, sf_dir, "documents").select(
        doc.alias("id"),
        F.col("lang").alias("label"),
        guess.alias("predicted"),
        (doc % 5).cast("double").alias("prediction"),
    )
