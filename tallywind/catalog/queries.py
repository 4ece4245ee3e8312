"""Named queries: (session, folder of tables) to a frame.

Times come out without a zone and scores rounded, so that results compare with
those of an SQL database.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywind.catalog import views
from tallywind.catalog.views import AS_OF, LANGUAGES, POSTS_AS_OF
from tallywind.functions.scores import label_of
from tallywind.functions.text import clean_text, keyword_slug
from tallywind.functions.times import event_timestamp, zoneless_times
from tallywind.operators import (
    evaluation,
    keywords,
    post_index,
    posts,
    profile,
    report,
    serving,
    terms,
)
from tallywind.operators.windows import WATERMARK_BY_WIDTH, windowed_sentiment
from tallywind.plans import collecting, scoring, training
from tallywind.plans.panels import current_range, stored_kpi_all_ranges, stored_panels
from tallywind.schemas import ENVELOPE, SCORED_POST, WINDOWED_RESULT
from tallywind.session import new_folder, pin_utc
from tallywind.sources import files
from tallywind.sources.messages import (
    file_stream,
    parse_messages,
    publish,
    ready_to_score,
    start_publishing,
    to_messages,
)
from tallywind.streaming.archive import lookup_posts, start_archive
from tallywind.streaming.results import newest_rows, read_results, start_upsert, upsert
from tallywind.streaming.state import window_state

Query = Callable[[SparkSession, str], DataFrame]

KEYWORDS = ("the", "de la", "EAU", "ung")
SEARCH_KEYWORD = "tion"
# A thousand by rule: consonant, vowel, consonant, any of five letters.
MANY_KEYWORDS = [
    a + b + c + d for a in "BCDFLMNRST" for b in "aeio" for c in "lnrst" for d in "aent "
]
REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def keep(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless_times(build(pin_utc(spark), sf_dir))

        REGISTRY[name] = run
        return build

    return keep


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


def _lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(name.lower() for name in df.columns))


# Windows


@register("tumbling_5min")
def tumbling_5min(spark, sf_dir):
    windows = windowed_sentiment(views.scored(spark, sf_dir), "5 minutes")
    return _rounded(windows, "sentiment_score")


@register("tumbling_1hour")
def tumbling_1hour(spark, sf_dir):
    windows = windowed_sentiment(views.scored(spark, sf_dir), "1 hour")
    return _rounded(windows, "sentiment_score")


@register("scored_projection")
def scored_projection(spark, sf_dir):
    return _lower_names(views.scored(spark, sf_dir).select(*SCORED_POST.names))


# Panels


def _range(spark, sf_dir, minutes_back, topic=serving.ALL_TOPICS):
    since = serving.range_start(AS_OF, minutes_back)
    return serving.in_range(views.results(spark, sf_dir, since), AS_OF, minutes_back, topic)


@register("results_filter")
def results_filter(spark, sf_dir):
    return _rounded(_range(spark, sf_dir, 2880, "topic_3"), "sentiment_score")


@register("results_stored")
def results_stored(spark, sf_dir):
    """The same range of a stored table, where it prunes folders and row groups."""
    current = current_range(spark, [_stored_table(spark, sf_dir)], AS_OF, 2880, "topic_3")
    return _rounded(current.select(*WINDOWED_RESULT.names), "sentiment_score")


def _stored_table(spark, sf_dir, rollups=False):
    """All five-minute results as a table."""
    path = new_folder(spark, "stored")
    upsert(spark, views.results(spark, sf_dir), path, "load", 0, rollups=rollups)
    return path


@register("recent_stored")
def recent_stored(spark, sf_dir):
    return _rounded(
        newest_rows(spark, _stored_table(spark, sf_dir)).select(*WINDOWED_RESULT.names),
        "sentiment_score",
    )


@register("kpi_stored_ranges")
def kpi_stored_ranges(spark, sf_dir):
    """All ranges from daily, hourly and five-minute rows."""
    return stored_kpi_all_ranges(spark, _stored_table(spark, sf_dir, rollups=True), AS_OF)


@register("topics_stored")
def topics_stored(spark, sf_dir):
    path = _stored_table(spark, sf_dir, rollups=True)
    return stored_panels(spark, path, AS_OF, 10080)["top_topics"]


@register("share_stored")
def share_stored(spark, sf_dir):
    path = _stored_table(spark, sf_dir, rollups=True)
    return _rounded(stored_panels(spark, path, AS_OF, 2880)["share"], "share_percent")


@register("kpi_summary")
def kpi_summary(spark, sf_dir):
    return serving.kpi_summary(_range(spark, sf_dir, 10080))


@register("kpi_all_ranges")
def kpi_all_ranges(spark, sf_dir):
    since = serving.range_start(AS_OF, max(serving.RANGE_MINUTES))
    return serving.kpi_all_ranges(views.results(spark, sf_dir, since), AS_OF)


def _trend(spark, sf_dir, minutes_back):
    rows = _range(spark, sf_dir, minutes_back)
    return _rounded(serving.trend(rows, serving.bin_width(minutes_back)), "mean_score")


@register("trend_resample_5m")
def trend_resample_5m(spark, sf_dir):
    return _trend(spark, sf_dir, 120)


@register("trend_resample_15m")
def trend_resample_15m(spark, sf_dir):
    return _trend(spark, sf_dir, 1440)


@register("trend_resample_1h")
def trend_resample_1h(spark, sf_dir):
    return _trend(spark, sf_dir, 10080)


@register("sentiment_share")
def sentiment_share(spark, sf_dir):
    return _rounded(serving.sentiment_share(_range(spark, sf_dir, 10080)), "share_percent")


@register("top_topics")
def top_topics(spark, sf_dir):
    return serving.top_topics(_range(spark, sf_dir, 10080))


@register("recent_rows")
def recent_rows(spark, sf_dir):
    return _rounded(serving.recent_rows(_range(spark, sf_dir, 10080)), "sentiment_score")


@register("empty_range")
def empty_range(spark, sf_dir):
    """What each panel shows of a topic that nobody wrote about: its rows, and the
    mentions in them."""
    results = _range(spark, sf_dir, 10080, "no such topic")
    shown = {
        "kpi": serving.kpi_summary(results),
        "trend": serving.trend(results, "1 hour"),
        "share": serving.sentiment_share(results).withColumnRenamed("mentions", "total_mentions"),
        "top_topics": serving.top_topics(results),
        "recent": serving.recent_rows(results),
    }
    rows = None
    for panel, frame in shown.items():
        mentions = F.coalesce(F.sum(frame["total_mentions"]), F.lit(0)).cast("long")
        own = frame.agg(F.count("*").alias("row_count"), mentions.alias("total_mentions"))
        own = own.select(F.lit(panel).alias("panel"), "row_count", "total_mentions")
        rows = own if rows is None else rows.unionByName(own)
    return rows


@register("topic_list")
def topic_list(spark, sf_dir):
    return serving.topic_list(views.results(spark, sf_dir))


# Text and messages


@register("clean_text")
def clean_text_serve(spark, sf_dir):
    return views.messages(spark, sf_dir).select("id", clean_text("Text").alias("text"))


@register("clean_text_train")
def clean_text_train(spark, sf_dir):
    return views.messages(spark, sf_dir).select("id", clean_text("Text", "train").alias("text"))


@register("tokens")
def tokens(spark, sf_dir):
    rows = training.prepare(views.messages(spark, sf_dir), "train")
    split = terms.tokenize(rows.select("id", "Text"))
    return split.select("id", F.array_join("tokens", "|").alias("tokens"))


@register("tokens_filtered")
def tokens_filtered(spark, sf_dir):
    rows = training.prepare(views.messages(spark, sf_dir), "train")
    kept = terms.content_tokens(rows.select("id", "Text"))
    return kept.select("id", F.array_join("final_tokens", "|").alias("tokens"))


@register("vocabulary")
def vocabulary(spark, sf_dir):
    rows = training.prepare(views.messages(spark, sf_dir)).select("Text")
    return terms.vocabulary(terms.content_tokens(rows))


@register("vocabulary_top")
def vocabulary_top(spark, sf_dir):
    """The 500 commonest terms by way of hash buckets, over stored tokens."""
    path = new_folder(spark, "top-tokens")
    rows = training.prepare(views.messages(spark, sf_dir)).select("Text")
    terms.content_tokens(rows).select("final_tokens").write.parquet(path)
    return terms.frequent_terms(spark.read.parquet(path), size=500, buckets=1 << 12)


@register("publish_json")
def publish_json(spark, sf_dir):
    sent = to_messages(views.messages(spark, sf_dir), F.col("event_time"))
    return _lower_names(parse_messages(sent))


@register("parse_messages")
def parsed_messages(spark, sf_dir):
    return _lower_names(parse_messages(views.envelopes(spark, sf_dir)))


@register("parse_event_time")
def parse_event_time(spark, sf_dir):
    return views.messages(spark, sf_dir).select(
        "id", "event_time", event_timestamp("event_time").alias("event_time_ts")
    )


@register("label_case")
def label_case(spark, sf_dir):
    return views.predictions(spark, sf_dir).select(
        "id", "prediction", label_of("prediction").alias("sentiment_label")
    )


# Quality of the input


@register("null_profile")
def null_profile(spark, sf_dir):
    return profile.null_profile(views.messages(spark, sf_dir), ["Topic", "Label", "Text"])


@register("drop_null_text")
def drop_null_text(spark, sf_dir):
    kept = profile.drop_null_rows(views.messages(spark, sf_dir), ["Text"])
    return _lower_names(kept.select("id", "Label", "Text"))


@register("preview")
def preview(spark, sf_dir):
    rows = views.messages(spark, sf_dir).withColumn("id", F.col("id").cast("long"))
    return _lower_names(profile.preview(rows, 10, ["id"]))


def _written_csv(spark, sf_dir):
    path = new_folder(spark, "csv")
    rows = views.messages(spark, sf_dir).select("id", "Topic", "Label", "Text")
    files.write_headerless_csv(rows, path)
    return path


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    return _lower_names(files.read_labelled_csv(spark, _written_csv(spark, sf_dir)))


@register("csv_roundtrip_exact")
def csv_roundtrip_exact(spark, sf_dir):
    path = _written_csv(spark, sf_dir)
    return _lower_names(files.read_labelled_csv(spark, path, keep_empty=True))


@register("csv_split")
def csv_split(spark, sf_dir):
    """The same file, read by a task per split."""
    path = _written_csv(spark, sf_dir)
    return _lower_names(files.read_labelled_csv(spark, path, keep_empty=True, split=True))


# Collected posts


def _flat(spark, sf_dir):
    return posts.flatten_posts(views.posts(spark, sf_dir), views.users(spark, sf_dir), "seen")


def _collected(spark, sf_dir):
    return collecting.collect(
        views.posts(spark, sf_dir),
        views.users(spark, sf_dir),
        "seen",
        KEYWORDS,
        as_of=POSTS_AS_OF,
    )


def _text_user_id(flat):
    """A nullable id as text: some clients turn such a long column into floats."""
    return flat.withColumn("user_id", F.col("user_id").cast("string"))


@register("post_flatten")
def post_flatten(spark, sf_dir):
    return _text_user_id(posts.scrub_lines(_flat(spark, sf_dir)))


@register("post_author_join")
def post_author_join(spark, sf_dir):
    flat = _text_user_id(_flat(spark, sf_dir))
    return flat.select(
        "tweet_id",
        "user_id",
        *(name for name in flat.columns if name.startswith("user_") and name != "user_id"),
        "username",
    )


@register("post_flags")
def post_flags(spark, sf_dir):
    return views.posts(spark, sf_dir).select(
        F.col("id").alias("tweet_id"),
        posts.refers_to("retweeted").alias("is_retweet"),
        posts.refers_to("replied_to").alias("is_reply"),
        posts.has_media().alias("has_media"),
    )


@register("post_search")
def post_search(spark, sf_dir):
    found = posts.search_posts(
        views.posts(spark, sf_dir),
        SEARCH_KEYWORD,
        as_of=POSTS_AS_OF,
        until=POSTS_AS_OF - timedelta(days=4),
        newest=100,
    )
    return found.select(F.col("id").alias("tweet_id"), "created_at", "text")


@register("post_search_indexed")
def post_search_indexed(spark, sf_dir):
    """The same search of stored posts that have an index."""
    root = new_folder(spark, "indexed")
    views.posts(spark, sf_dir).repartitionByRange(16, "created_at").write.parquet(f"{root}/posts")
    post_index.build_index(spark, f"{root}/posts", f"{root}/index")
    found = post_index.search_stored(
        spark,
        f"{root}/posts",
        f"{root}/index",
        SEARCH_KEYWORD,
        as_of=POSTS_AS_OF,
        until=POSTS_AS_OF - timedelta(days=4),
        newest=100,
    )
    return found.select(F.col("id").alias("tweet_id"), "created_at", "text")


@register("collect_union")
def collect_union(spark, sf_dir):
    found = posts.collect_by_keywords(views.posts(spark, sf_dir), KEYWORDS, as_of=POSTS_AS_OF)
    return found.select(F.col("id").alias("tweet_id"), "created_at", "keyword")


def _newest(spark, sf_dir, newest):
    found = posts.collect_by_keywords(
        views.posts(spark, sf_dir), KEYWORDS, as_of=POSTS_AS_OF, newest=newest
    )
    return found.select(F.col("id").alias("tweet_id"), "created_at", "keyword")


@register("collect_newest")
def collect_newest(spark, sf_dir):
    return _newest(spark, sf_dir, 50)


@register("collect_newest_2000")
def collect_newest_2000(spark, sf_dir):
    return _newest(spark, sf_dir, 2000)


@register("collect_many")
def collect_many(spark, sf_dir):
    """A thousand keywords."""
    found = keywords.collect_by_many_keywords(
        views.posts(spark, sf_dir), MANY_KEYWORDS, as_of=POSTS_AS_OF
    )
    return found.select(F.col("id").alias("tweet_id"), "keyword")


@register("keyword_slug")
def keyword_slugs(spark, sf_dir):
    words = F.concat(F.lit("#"), "Topic", F.lit(" OR "), "Label", F.lit(" AND "), "Text")
    keywords = views.messages(spark, sf_dir).select("id", words.alias("keyword"))
    return keywords.select("id", keyword_slug("keyword").alias("slug"))


@register("count_by_language")
def count_by_language(spark, sf_dir):
    return report.language_counts(views.posts(spark, sf_dir))


@register("count_by_keyword")
def count_by_keyword(spark, sf_dir):
    found = posts.collect_by_keywords(views.posts(spark, sf_dir), KEYWORDS, as_of=POSTS_AS_OF)
    return report.value_counts(found, "keyword")


@register("top_users")
def top_users(spark, sf_dir):
    return report.top_authors(views.posts(spark, sf_dir), views.users(spark, sf_dir), "seen")


_REPORT_MEANS = ("avg_likes", "avg_retweets", "retweet_percentage")


@register("post_report")
def post_report(spark, sf_dir):
    return _rounded(report.collection_report(_flat(spark, sf_dir), POSTS_AS_OF), *_REPORT_MEANS)


@register("report_json")
def report_json(spark, sf_dir):
    path = new_folder(spark, "report")
    written = report.collection_report(_flat(spark, sf_dir), POSTS_AS_OF)
    files.write_json(written, path)
    return _rounded(spark.read.schema(written.schema).json(path), *_REPORT_MEANS)


@register("report_lists")
def report_lists(spark, sf_dir):
    """The lists of a written report, read back together."""
    path = new_folder(spark, "report-lists")
    collecting.write_report(_collected(spark, sf_dir), path, POSTS_AS_OF)
    lists = {"languages": "language", "top_users": "username", "top_keywords": "keyword"}
    rows = [
        spark.read.schema(f"{column} string, post_count long")
        .json(f"{path}/{name}")
        .select(F.lit(name).alias("list"), F.col(column).alias("name"), "post_count")
        for name, column in lists.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register("keyword_csv")
def keyword_csv(spark, sf_dir):
    path = new_folder(spark, "keyword-csv")
    collected = _collected(spark, sf_dir)
    files.write_csv_per_keyword(collected, path)
    schema = collected.schema.add("keyword_slug", "string")
    return files.read_csv(spark, path, schema).select(
        "tweet_id", "keyword", "keyword_slug", "text", "user_description", "like_count"
    )


@register("summary_csv")
def summary_csv(spark, sf_dir):
    path = new_folder(spark, "summary-csv")
    collected = _collected(spark, sf_dir)
    files.write_csv(collected, path)
    return files.read_csv(spark, path, collected.schema).select(
        "tweet_id", "keyword", "created_at", "hashtags", "user_verified", "is_reply", "username"
    )


# Predictions and the model


@register("accuracy")
def accuracy(spark, sf_dir):
    rows = views.predictions(spark, sf_dir)
    return _rounded(evaluation.accuracy(rows, "label", "predicted"), "accuracy")


@register("confusion_matrix")
def confusion_matrix(spark, sf_dir):
    rows = views.predictions(spark, sf_dir)
    return evaluation.confusion_matrix(rows, "label", "predicted", LANGUAGES)


@register("label_index")
def label_index(spark, sf_dir):
    rows = training.prepare(views.messages(spark, sf_dir)).select("Label")
    return training.label_mapping(rows, training.label_indexer(rows))


_models: dict[tuple[str, str], training.SentimentModel] = {}


# What a model has to reach: more than half of each label's rows, more than always guessing the
# commonest label would, and part of the loss of guessing by the labels' shares.
RECALL_BOUND = 0.5
ABOVE_MAJORITY = 0.2
LOSS_SHARE = 0.5


def _split(spark, sf_dir):
    """Four fifths to learn from and the rest, by the id: always the same rows."""
    rows = training.prepare(views.messages(spark, sf_dir).select("id", "Label", "Text"))
    fifth = F.col("id").cast("long") % 5
    return rows.filter(fifth != 0), rows.filter(fifth == 0)


def _model(spark, sf_dir) -> training.SentimentModel:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _models:
        _models[key] = training.fit(_split(spark, sf_dir)[0])
    return _models[key]


def _learned(rows):
    """Per label whether enough of its rows (`label`, `sentiment_label`) are predicted right."""
    recall = evaluation.recall_by_class(rows, "label", "sentiment_label")
    return recall.select("label", (F.col("recall") > RECALL_BOUND).alias("learned"))


def prediction_rows(spark, model, rows):
    """Each row with its label, and whether the model has learned that label. The
    predictions are written once; labels are few."""
    path = new_folder(spark, "predicted")
    scored = model.score(rows).select("id", F.col("Label").alias("label"), "sentiment_label")
    scored.write.parquet(path)
    kept = spark.read.schema(scored.schema).parquet(path)
    return kept.join(F.broadcast(_learned(kept)), "label").select("id", "label", "learned")


def model_report(spark, model, held_out):
    """Per label of held-out rows whether the model has learned it, and in the row of no
    label whether it beats guessing without the text, by its accuracy and by its loss."""
    path = new_folder(spark, "evaluated")
    scored = training.label_probability(training.predicted(model, held_out)).select(
        F.col("Label").alias("label"), "sentiment_label", "probability_of_label"
    )
    scored.write.parquet(path)
    rows = spark.read.schema(scored.schema).parquet(path)
    classes = evaluation.recall_by_class(rows, "label", "sentiment_label").select(
        "label", "row_count", (F.col("recall") > RECALL_BOUND).alias("learned")
    )
    better = (F.col("accuracy") > F.col("majority_share") + ABOVE_MAJORITY) & (
        F.col("log_loss") < LOSS_SHARE * F.col("constant_log_loss")
    )
    whole = evaluation.against_constant(
        rows, "label", "sentiment_label", "probability_of_label"
    ).select(F.lit(None).cast("string").alias("label"), "row_count", better.alias("learned"))
    return classes.unionByName(whole)


@register("predict")
def predict(spark, sf_dir):
    rows = training.prepare(views.messages(spark, sf_dir)).select("id", "Label", "Text")
    return prediction_rows(spark, _model(spark, sf_dir), rows)


@register("evaluate_model")
def evaluate_model(spark, sf_dir):
    return model_report(spark, _model(spark, sf_dir), _split(spark, sf_dir)[1])


@register("model_roundtrip")
def model_roundtrip(spark, sf_dir):
    path = new_folder(spark, "model")
    model = _model(spark, sf_dir)
    model.save(path)
    kept = training.SentimentModel.load(path)
    rows = training.prepare(views.messages(spark, sf_dir)).select("Text")
    both = kept.pipeline.transform(
        model.pipeline.transform(rows).select("Text", F.col("prediction").alias("before"))
    )
    return both.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col("before") == F.col("prediction")).alias("same_prediction"),
    )


# Streams


def _finish(*started: StreamingQuery) -> None:
    for query in started:
        query.awaitTermination()


def _stored(spark, path):
    windows = read_results(spark, path).select(*WINDOWED_RESULT.names)
    return _rounded(windows, "sentiment_score")


def _upserted(spark, sf_dir, width):
    root = new_folder(spark, "upsert")
    windows = windowed_sentiment(
        views.scored_stream(spark, sf_dir), width, watermark=WATERMARK_BY_WIDTH[width]
    )
    _finish(start_upsert(windows, f"{root}/table", f"{root}/checkpoint", available_now=True))
    return _stored(spark, f"{root}/table")


@register("stream_upsert_5min")
def stream_upsert_5min(spark, sf_dir):
    return _upserted(spark, sf_dir, "5 minutes")


@register("stream_upsert_1hour")
def stream_upsert_1hour(spark, sf_dir):
    return _upserted(spark, sf_dir, "1 hour")


@register("stream_archive")
def stream_archive(spark, sf_dir):
    root = new_folder(spark, "archive")
    scored = views.scored_stream(spark, sf_dir)
    _finish(start_archive(scored, f"{root}/posts", f"{root}/checkpoint", available_now=True))
    return _lower_names(files.read_archive(spark, f"{root}/posts"))


@register("archive_lookup")
def archive_lookup(spark, sf_dir):
    """Posts by their ids, every 997th of the first hundred thousand."""
    root = new_folder(spark, "archive")
    scored = views.scored_stream(spark, sf_dir)
    _finish(start_archive(scored, f"{root}/posts", f"{root}/checkpoint", available_now=True))
    ids = [str(k) for k in range(0, 100_000, 997)]
    return _lower_names(lookup_posts(spark, f"{root}/posts", ids))


def _delivered(spark, deliveries, width, watermark=None):
    """The folder of a table and its checkpoint after each of the runs, a delivery each."""
    root = new_folder(spark, "deliveries")
    for rows in deliveries:
        rows.write.mode("append").parquet(f"{root}/source")
        arriving = spark.readStream.schema(SCORED_POST).parquet(f"{root}/source")
        windows = windowed_sentiment(
            arriving, width, watermark=watermark or WATERMARK_BY_WIDTH[width]
        )
        _finish(start_upsert(windows, f"{root}/table", f"{root}/checkpoint", available_now=True))
        yield root


def _deliveries(spark, deliveries, width, watermark=None):
    """The table after all runs."""
    return f"{list(_delivered(spark, deliveries, width, watermark))[-1]}/table"


#: A watermark that lets rows of the whole time in.
LENIENT = "60 days"


def _interleaved(spark, sf_dir):
    """Three deliveries that each have a third of every window's posts: most windows
    are updated twice."""
    rows = views.scored(spark, sf_dir)
    third = F.col("id").cast("long") % 3
    return [rows.filter(third == k) for k in range(3)]


def _time(year, month, day):
    return F.lit(datetime(year, month, day).isoformat()).cast("timestamp")


@register("stream_restart")
def stream_restart(spark, sf_dir):
    """Hourly windows that go on from kept state: each run adds to windows of the last."""
    return _stored(spark, _deliveries(spark, _interleaved(spark, sf_dir), "1 hour", LENIENT))


@register("stream_updates")
def stream_updates(spark, sf_dir):
    """Daily windows with the number of batches that wrote each."""
    path = _deliveries(spark, _interleaved(spark, sf_dir), "1 day", LENIENT)
    kept = read_results(spark, path).withColumnRenamed("revision", "versions")
    return _rounded(kept.drop("window_date"), "sentiment_score")


@register("stream_compacted")
def stream_compacted(spark, sf_dir):
    """The same table's files: a date that was written three times holds each key once."""
    path = _deliveries(spark, _interleaved(spark, sf_dir), "1 day", LENIENT)
    return _stored(spark, path)


@register("state_restart")
def state_restart(spark, sf_dir):
    """What the state holds after each of three runs: it goes on from the run before."""
    held = []
    for run, root in enumerate(_delivered(spark, _interleaved(spark, sf_dir), "1 day", LENIENT)):
        state = window_state(spark, f"{root}/checkpoint")
        mentions = F.col("positive") + F.col("neutral") + F.col("negative")
        totals = state.agg(F.count("*").alias("windows"), F.sum(mentions).alias("mentions"))
        # Read now: the next run changes the state.
        held.append((run, *totals.first()))
    return spark.createDataFrame(held, "run long, windows long, mentions long")


@register("state_eviction")
def state_eviction(spark, sf_dir):
    """Every window of the table, and whether the query still holds it open."""
    parts = [views.scored(spark, sf_dir)]
    (root,) = _delivered(spark, parts, "1 hour")
    state = window_state(spark, f"{root}/checkpoint").withColumn("is_open", F.lit(True))
    stored = read_results(spark, f"{root}/table")
    key = ("window_start", "topic")
    met = [F.col(f"t.{name}").eqNullSafe(F.col(f"s.{name}")) for name in key]
    joined = stored.alias("t").join(state.alias("s"), met, "left")
    return joined.select(
        *(F.col(f"t.{name}") for name in key),
        F.coalesce("is_open", F.lit(False)).alias("is_open"),
        F.coalesce(F.col("s.positive") == F.col("t.positive"), F.col("is_open").isNull()).alias(
            "counts_agree"
        ),
    )


@register("stream_late_drop")
def stream_late_drop(spark, sf_dir):
    """Positive and neutral posts of the first nine days arrive with the last ones."""
    rows, at = views.scored(spark, sf_dir), F.col("event_time_ts")
    late = (at < _time(2024, 1, 10)) & F.col("sentiment_label").isin("Positive", "Neutral")
    first = (at < _time(2024, 1, 11)) & ~late
    second = (at >= _time(2024, 1, 11)) & (at < _time(2024, 1, 21))
    third = late | (at >= _time(2024, 1, 21))
    parts = [rows.filter(part) for part in (first, second, third)]
    return _stored(spark, _deliveries(spark, parts, "1 hour"))


@register("stream_job")
def stream_job(spark, sf_dir):
    root = new_folder(spark, "job")
    scored = views.scored_stream(spark, sf_dir)
    _finish(*scoring.start_direct(scored, root, available_now=True))
    sinks = {"archive": files.read_archive(spark, scoring.archive_path(root))}
    for width in WATERMARK_BY_WIDTH:
        sinks[width] = read_results(spark, scoring.results_path(root, width))
    counts = [
        rows.agg(F.lit(sink).alias("sink"), F.count("*").alias("row_count"))
        for sink, rows in sinks.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register("stream_job_from_archive")
def stream_job_from_archive(spark, sf_dir):
    root = new_folder(spark, "job-from-archive")
    scoring.run_from_archive(views.scored_stream(spark, sf_dir), root)
    return _stored(spark, scoring.results_path(root, "1 hour"))


def _published(spark, sf_dir, root):
    """The messages as files of a message stream."""
    publish(views.envelopes(spark, sf_dir), "parquet", path=f"{root}/messages")
    return file_stream(spark, f"{root}/messages")


@register("stream_publish")
def stream_publish(spark, sf_dir):
    """Documents as they arrive, published as messages, and parsed again."""
    root = new_folder(spark, "publish")
    arriving = views.messages_of(views.table_stream(spark, sf_dir, "documents"))
    sent = to_messages(arriving, F.col("event_time"))
    _finish(
        start_publishing(
            sent, "parquet", f"{root}/checkpoint", available_now=True, path=f"{root}/messages"
        )
    )
    return _lower_names(parse_messages(spark.read.schema(ENVELOPE).parquet(f"{root}/messages")))


@register("stream_ingest")
def stream_ingest(spark, sf_dir):
    root = new_folder(spark, "ingest")
    ready = ready_to_score(_published(spark, sf_dir, root))
    writer = ready.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    _finish(writer.trigger(availableNow=True).start())
    stored = spark.read.schema(ready.schema).parquet(f"{root}/out")
    return _lower_names(stored.select("id", "topic", "Text", "event_time_ts"))


@register("stream_score")
def stream_score(spark, sf_dir):
    root = new_folder(spark, "score")
    model = _model(spark, sf_dir)
    scored = scoring.score_messages(_published(spark, sf_dir, root), model)
    _finish(start_archive(scored, f"{root}/posts", f"{root}/checkpoint", available_now=True))
    stored = files.read_archive(spark, f"{root}/posts").withColumnRenamed(
        "sentiment_label", "of_stream"
    )
    agrees = (F.col("of_stream") == F.col("sentiment_label")).alias("agrees")
    both = model.score(stored).select("id", "topic", "Text", "event_time_ts", "of_stream", agrees)
    # The stream knows no labels: they come from where its messages did.
    told = views.messages(spark, sf_dir).select("id", F.col("Label").alias("label"))
    labelled = both.join(told, "id", "left")
    named = labelled.withColumnRenamed("of_stream", "sentiment_label")
    learned = F.broadcast(_learned(named.where("id is not null")))
    return _lower_names(named.join(learned, "label", "left").drop("label", "sentiment_label"))
