from datetime import datetime, timedelta

import pytest

from tallywind.operators import serving
from tallywind.operators.evaluation import accuracy, confusion_matrix
from tallywind.operators.profile import drop_null_rows, null_profile, preview
from tallywind.schemas import WINDOWED_RESULT
from tests.helpers import plan, rows

NOW = datetime(2024, 5, 2, 12)


def window(minutes_ago, topic, positive, neutral, negative):
    start = NOW - timedelta(minutes=minutes_ago)
    total = positive + neutral + negative
    score = (positive - negative) / total if total else 0.0
    return (start, start + timedelta(minutes=5), topic, total, positive, neutral, negative, score)


@pytest.fixture(scope="module")
def results(spark):
    return spark.createDataFrame(
        [
            window(-5, "a", 1, 0, 0),  # later than now: ranges have no upper bound
            window(15, "a", 2, 1, 1),
            window(15, "b", 0, 0, 4),
            window(20, "c", 3, 0, 0),
            window(60, None, 9, 0, 0),
            window(120, "d", 0, 0, 0),
            window(600, "e", 1, 1, 1),
        ],
        WINDOWED_RESULT,
    )


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], WINDOWED_RESULT)


def test_range_includes_its_start_and_the_future(results):
    assert serving.in_range(results, NOW, 15).count() == 3
    assert serving.in_range(results, NOW, 15, "a").count() == 2
    assert serving.in_range(results, NOW, 60).count() == 5


def test_unknown_range(results):
    with pytest.raises(ValueError):
        serving.in_range(results, NOW, 17)


@pytest.mark.parametrize(
    "minutes, width",
    [(15, "5 minutes"), (120, "5 minutes"), (240, "15 minutes"), (1440, "15 minutes"),
     (2880, "1 hour"), (10080, "1 hour")],
)
def test_bin_width(minutes, width):
    assert serving.bin_width(minutes) == width


def test_kpi(results):
    assert rows(serving.kpi_summary(serving.in_range(results, NOW, 15))) == [(9, 3, 1, 5, -0.222)]


def test_all_ranges_equal_single_ones(results):
    every = {r[0]: tuple(r)[1:] for r in serving.kpi_all_ranges(results, NOW).collect()}
    assert set(every) == set(serving.RANGE_MINUTES)
    for minutes, values in every.items():
        single = serving.kpi_summary(serving.in_range(results, NOW, minutes))
        assert tuple(single.first()) == values


def test_trend_fills_gaps_and_weighs_windows_alike(results):
    got = rows(serving.trend(serving.in_range(results, NOW, 60), "5 minutes"))
    assert len(got) == 14
    filled = {start: (score, mentions) for start, score, mentions in got}
    assert filled[NOW - timedelta(minutes=15)] == ((0.25 - 1) / 2, 8)
    assert filled[NOW - timedelta(minutes=40)] == (0.0, 0)
    assert filled[NOW + timedelta(minutes=5)] == (1.0, 1)


def test_trend_reads_its_input_once(spark, tmp_path, results):
    results.write.parquet(str(tmp_path / "results"))
    text = plan(serving.trend(spark.read.parquet(str(tmp_path / "results")), "1 hour"))
    assert text.count("Scan parquet") == 2 and "Join" not in text  # in the tree and in the list


def test_share(results):
    got = {r[0]: r[1:] for r in rows(serving.sentiment_share(serving.in_range(results, NOW, 15)))}
    assert got["Positive"] == (3, pytest.approx(100 / 3))
    assert got["Neutral"][0] == 1 and got["Negative"][0] == 5


def test_top_topics_leave_out_null_and_break_ties_by_name(results):
    got = [tuple(r) for r in serving.top_topics(results, 4).collect()]
    assert got == [("a", 5), ("b", 4), ("c", 3), ("e", 3)]


def test_recent_rows(results):
    got = serving.recent_rows(results, 3).collect()
    assert [r.topic for r in got] == ["a", "a", "b"]


def test_topic_list_is_sorted(results):
    assert [r[0] for r in serving.topic_list(results).collect()] == ["a", "b", "c", "d", "e"]


def test_panels_of_nothing(nothing):
    assert rows(serving.kpi_summary(nothing)) == [(0, 0, 0, 0, 0.0)]
    assert rows(serving.trend(nothing, "1 hour")) == []
    assert {r[1:] for r in rows(serving.sentiment_share(nothing))} == {(0, 0.0)}
    assert rows(serving.top_topics(nothing)) == []
    assert rows(serving.recent_rows(nothing)) == []
    assert rows(serving.topic_list(nothing)) == []


def test_sorted_panels_keep_top_rows_per_task(results):
    for frame in (serving.top_topics(results), serving.recent_rows(results)):
        assert "TakeOrderedAndProject" in plan(frame)


def test_null_profile(spark):
    data = [("a", None), ("", "x"), (None, ""), (None, "")]
    df = spark.createDataFrame(data, "p string, q string")
    assert rows(null_profile(df, ["p", "q"])) == [("p", 4, 2, 1), ("q", 4, 1, 2)]
    assert rows(drop_null_rows(df, ["p"])) == [("", "x"), ("a", None)]
    assert [r.q for r in preview(df, 2, ["q"]).collect()] == [None, ""]


def test_accuracy_and_matrix(spark):
    df = spark.createDataFrame(
        [("x", "x"), ("x", "y"), ("y", "y"), ("y", None)], "label string, guess string"
    )
    assert rows(accuracy(df, "label", "guess")) == [(4, 0.5)]
    got = confusion_matrix(df, "label", "guess", ["x", "y", "z"])
    assert got.columns == ["label", "x", "y", "z", "other"]
    assert rows(got) == [("x", 1, 1, 0, 0), ("y", 0, 1, 0, 1)]
    strange = df.unionByName(spark.createDataFrame([("x", "q"), (None, "x")], df.schema))
    cells = rows(confusion_matrix(strange, "label", "guess", ["x"]))
    assert sum(sum(r[1:]) for r in cells) == strange.count()
