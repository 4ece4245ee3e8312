from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.operators import posts as ops
from tallywind.operators import report
from tallywind.plans.collecting import collect, write_report
from tallywind.schemas import POST, USER
from tallywind.sources import files
from tests.helpers import plan, rows

T0 = datetime(2024, 5, 1, 12)
RANKED_USER = T.StructType(USER.fields + [T.StructField("seen_at", T.LongType())])


def post(id, text="t", author=1, *, created=T0, metrics=None, entities=None, refs=None, media=None):
    return (id, text, created, "en", None, author, metrics, entities, refs, media)


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [
            (1, "ann", "Ann", "one\ntwo\r", "Here", True, (5, 6, 7), 1),
            (1, "ann", "Ann New", "one\ntwo\r", None, True, (8, None, 9), 2),
            (2, None, None, None, None, None, None, 1),
        ],
        RANKED_USER,
    )


@pytest.fixture(scope="module")
def posts(spark):
    data = [
        post(1, "a\nb\rc #Py", metrics=(1, 2, 3, 4, 5)),
        post(2, None, 2, entities=([("x",), ("",), (None,), ("y",)], [], None), media=([],)),
        post(3, "py and data", 99, refs=[(1, "quoted"), (2, "retweeted")], media=(None,)),
        post(4, "Data", None, refs=[(1, "replied_to")], created=T0 - timedelta(days=8)),
        post(5, "none", 1, refs=[(1, None)], entities=(None, [("m",), ("n",)], [("u",), (None,)])),
    ]
    return spark.createDataFrame(data, POST)


@pytest.fixture(scope="module")
def flat(posts, users):
    return {r.tweet_id: r for r in ops.flatten_posts(posts, users, "seen_at").collect()}


def test_columns(posts, users):
    assert len(ops.flatten_posts(posts, users, "seen_at").columns) == 25


def test_the_last_of_repeated_users_wins(flat):
    assert len(flat) == 5
    assert (flat[1].user_name, flat[1].user_location, flat[1].user_followers) == ("Ann New", "", 8)
    assert flat[1].user_following == 0


@pytest.mark.parametrize("id", [2, 3, 4])
def test_defaults_without_user_data(flat, id):
    row = flat[id]
    assert (row.username, row.user_description, row.user_verified) == ("", "", False)
    assert (row.user_followers, row.user_tweet_count) == (0, 0)


def test_metrics_default_to_zero(flat):
    assert (flat[1].like_count, flat[1].impression_count) == (1, 5)
    assert (flat[2].like_count, flat[2].impression_count) == (0, 0)


def test_entities(flat):
    assert (flat[1].hashtags, flat[2].hashtags, flat[2].mentions) == ("", "x, y", "")
    assert (flat[5].mentions, flat[5].urls) == ("m, n", "u")


def test_flags(flat):
    assert [i for i in flat if flat[i].is_retweet] == [3]
    assert [i for i in flat if flat[i].is_reply] == [4]
    assert [i for i in flat if flat[i].has_media] == [2]  # an empty list is a list


def test_scrub(posts, users):
    scrubbed = ops.scrub_lines(ops.flatten_posts(posts, users, "seen_at"))
    row = scrubbed.filter("tweet_id = 1").first()
    assert row.text == "a b c #Py"
    assert row.user_description == "one two\r"


def test_one_author_with_most_posts(spark, users):
    """Every post of a hot author, and of none, meets the same row as a plain join."""
    third = F.col("id") % 3
    author = F.when(third == 0, 1).when(third == 1, 7).cast("long")
    many = spark.range(5000).select("id", author.alias("author_id"))
    got = ops.join_authors(many, users, "seen_at")
    counts = got.groupBy("author_id", "user.name").count()
    wanted = [(1, "Ann New", 1667), (7, None, 1667), (None, None, 1666)]
    assert rows(counts) == sorted(wanted, key=repr)


def test_hot_author_is_split_over_tasks(spark, users):
    hot = spark.range(4000).select("id", F.lit(1).cast("long").alias("author_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = ops.join_authors(hot, users, "seen_at")
        tasks = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_users_are_broadcast_up_to_a_number_of_rows(spark):
    """Whatever Spark thinks their size is: they are copied, and files are compressed."""
    written = spark.range(10).select("id", F.col("id").alias("author_id"))

    def joined(n):
        users = spark.range(n).selectExpr("id", "concat('u', id) username", "1 seen_at")
        return ops.join_authors(written, users, "seen_at").select("id", "user.username")

    many = joined(ops.BROADCAST_USERS + 1)
    assert "SortMergeJoin" in plan(many) and "BroadcastExchange" not in plan(many)
    assert rows(many) == [(i, f"u{i}") for i in range(10)]
    few = joined(ops.BROADCAST_USERS)
    assert "BroadcastExchange" in plan(few)
    assert rows(few) == rows(many)


def test_latest_users_of_one_task_are_ranked_by_many(spark):
    """Each task of the first ranking gets a part of what one task has read, and rows of
    one user that several tasks have read still meet."""
    seen = spark.range(0, 3000, 1, 3).selectExpr(
        "id % 1000 id", "concat('u', id) username", "id % 7 name", "id div 1000 seen_at"
    )
    assert rows(ops.latest_users(seen, "seen_at")) == sorted(
        ((i, f"u{2000 + i}", (2000 + i) % 7) for i in range(1000)), key=repr
    )
    one = spark.range(0, 3000, 1, 1).selectExpr("id", "concat('u', id) username", "1 seen_at")
    dealt = plan(ops.latest_users(one, "seen_at")).split("\n\n")[0]
    assert "Exchange" in dealt.rsplit("Sort", 1)[1]


def test_search(posts):
    def found(**options):
        return [r.id for r in ops.search_posts(posts, "DATA", as_of=T0, **options).collect()]

    assert found() == [3]  # the other one is older than seven days
    assert sorted(found(since=T0 - timedelta(days=9))) == [3, 4]
    assert found(since=T0 - timedelta(days=9), newest=1) == [3]
    assert found(since=T0 - timedelta(days=9), until=T0) == [4]


def test_union_keeps_a_post_per_keyword(posts):
    got = ops.collect_by_keywords(posts, ["py", "data"], as_of=T0)
    assert rows(got.select("id", "keyword")) == [(1, "py"), (3, "data"), (3, "py")]
    newest = ops.collect_by_keywords(posts, ["py", "data"], as_of=T0, newest=1)
    assert rows(newest.select("id", "keyword")) == [(3, "data"), (3, "py")]
    assert ops.collect_by_keywords(posts, [], as_of=T0).count() == 0


def test_newest_is_ranked_in_two_steps_whatever_the_number(spark, posts):
    text = plan(ops.collect_by_keywords(posts, ["py"], as_of=T0, newest=5000))
    keys = [line for line in text.splitlines() if "hashpartitioning(keyword" in line]
    assert len(keys) == 2 and "salt" in keys[0] + keys[1]
    many = spark.range(3000).selectExpr(
        "id", "'py' text", f"timestamp'{T0}' - make_interval(0,0,0,0,0,0,id) created_at"
    )
    got = ops.collect_by_keywords(many, ["py"], as_of=T0, newest=2000, salts=7)
    assert sorted(r.id for r in got.select("id").collect()) == list(range(2000))


def test_counts_without_or_before_the_join(posts, users):
    assert "Join" not in plan(report.language_counts(posts))
    assert rows(report.language_counts(posts)) == [("en", 5)]
    top = report.top_authors(posts, users, "seen_at")
    assert [tuple(r) for r in top.collect()] == [("", 3), ("ann", 2)]
    flat = ops.flatten_posts(posts, users, "seen_at")
    assert [tuple(r) for r in report.top_users(flat).collect()] == [("", 3), ("ann", 2)]
    text = plan(top)
    assert text.index("HashAggregate") < text.index("Join")


def test_report(posts, users):
    flat = ops.flatten_posts(posts, users, "seen_at")
    row = report.collection_report(flat, T0).first()
    assert row.total_tweets == 5
    assert row.unique_users == 2  # 'ann' and the empty name
    assert row.verified_posts == 2  # posts, of one user
    assert row.retweet_percentage == 20.0
    assert row.date_collected == "2024-05-01 12:00:00"
    assert row.date_range_tweets == "2024-04-23 12:00:00 to 2024-05-01 12:00:00"
    assert [tuple(r) for r in report.top_users(flat, 1).collect()] == [("", 3)]


def test_report_of_nothing(spark, users):
    flat = ops.flatten_posts(spark.createDataFrame([], POST), users, "seen_at")
    row = report.collection_report(flat, T0).first()
    assert (row.total_tweets, row.retweet_percentage, row.avg_likes) == (0, 0.0, None)
    assert report.value_counts(flat, "language").count() == 0


def test_collect_and_write(spark, posts, users, tmp_path):
    flat = collect(posts, users, "seen_at", ["py", "data"], as_of=T0)
    files.write_csv_per_keyword(flat, str(tmp_path / "csv"))
    assert sorted(p.name for p in (tmp_path / "csv").glob("keyword_slug=*")) == [
        "keyword_slug=data",
        "keyword_slug=py",
    ]
    schema = flat.schema.add("keyword_slug", "string")
    back = files.read_csv(spark, str(tmp_path / "csv"), schema).drop("keyword_slug")
    assert rows(back) == rows(flat)
    write_report(flat, str(tmp_path / "report"), T0)
    counted = spark.read.json(str(tmp_path / "report" / "top_keywords"))
    assert rows(counted.select("keyword", "post_count")) == [("data", 1), ("py", 2)]
