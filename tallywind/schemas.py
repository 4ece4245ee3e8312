"""Explicit schemas, so that no scan has to infer types."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _TEXT, _FLAG, _TIME = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampType()

LABELLED_TEXT = _struct(id=_LONG, Topic=_TEXT, Label=_TEXT, Text=_TEXT)

MESSAGE = _struct(id=_TEXT, topic=_TEXT, Text=_TEXT, event_time=_TEXT)

# What any message source delivers; other envelope columns are ignored.
ENVELOPE = _struct(value=T.BinaryType())

SCORED_POST = _struct(
    id=_TEXT, topic=_TEXT, Text=_TEXT, event_time_ts=_TIME, sentiment_label=_TEXT
)

# The archive is laid out by event date; rows without a time have a null date.
ARCHIVE = T.StructType(SCORED_POST.fields + [T.StructField("event_date", T.DateType())])

WINDOWED_RESULT = _struct(
    window_start=_TIME,
    window_end=_TIME,
    topic=_TEXT,
    total_mentions=_LONG,
    positive=_LONG,
    neutral=_LONG,
    negative=_LONG,
    sentiment_score=T.DoubleType(),
)

POST = _struct(
    id=_LONG,
    text=_TEXT,
    created_at=_TIME,
    lang=_TEXT,
    source=_TEXT,
    author_id=_LONG,
    public_metrics=_struct(
        like_count=_LONG,
        retweet_count=_LONG,
        reply_count=_LONG,
        quote_count=_LONG,
        impression_count=_LONG,
    ),
    entities=_struct(
        hashtags=T.ArrayType(_struct(tag=_TEXT)),
        mentions=T.ArrayType(_struct(username=_TEXT)),
        urls=T.ArrayType(_struct(expanded_url=_TEXT)),
    ),
    referenced_tweets=T.ArrayType(_struct(id=_LONG, type=_TEXT)),
    attachments=_struct(media_keys=T.ArrayType(_TEXT)),
)

USER = _struct(
    id=_LONG,
    username=_TEXT,
    name=_TEXT,
    description=_TEXT,
    location=_TEXT,
    verified=_FLAG,
    public_metrics=_struct(
        followers_count=_LONG, following_count=_LONG, tweet_count=_LONG
    ),
)
