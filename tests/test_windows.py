from datetime import datetime

import pytest

from tallywind.operators.windows import windowed_sentiment
from tallywind.schemas import SCORED_POST, WINDOWED_RESULT
from tests.helpers import plan, rows


def at(hour, minute, second=0):
    return datetime(2024, 5, 1, hour, minute, second)


@pytest.fixture()
def scored(spark):
    data = [
        ("1", "a", "x", at(10, 0), "Positive"),
        ("1", "a", "x", at(10, 0), "Positive"),  # a repeated message counts twice
        ("2", "a", "x", at(10, 4, 59), "Negative"),
        ("3", "a", "x", at(10, 5), "Neutral"),
        ("4", None, "x", at(10, 1), "Negative"),
        ("5", "b", "x", at(10, 2), "Irrelevant"),
        ("6", "b", "x", at(10, 3), "Unknown"),
        ("7", "a", "x", None, "Positive"),
    ]
    return spark.createDataFrame(data, SCORED_POST)


def test_counts_and_scores(scored):
    got = rows(windowed_sentiment(scored, "5 minutes"))
    first, second = (at(10, 0), at(10, 5)), (at(10, 5), at(10, 10))
    assert got == sorted(
        [
            (*first, "a", 3, 2, 0, 1, 1 / 3),
            (*first, None, 1, 0, 0, 1, -1.0),
            (*first, "b", 0, 0, 0, 0, 0.0),  # only labels that are not counted
            (*second, "a", 1, 0, 1, 0, 0.0),
        ],
        key=repr,
    )


def test_schema(scored):
    fields = windowed_sentiment(scored, "1 hour").schema.fields
    assert [(f.name, f.dataType) for f in fields] == [
        (f.name, f.dataType) for f in WINDOWED_RESULT.fields
    ]


def test_since_equals_filter_afterwards(scored):
    since = at(10, 2)
    early = windowed_sentiment(scored, "5 minutes", since=since)
    late = windowed_sentiment(scored, "5 minutes")
    assert rows(early) == rows(late.filter(late.window_start >= since))


def test_empty_input(spark):
    assert rows(windowed_sentiment(spark.createDataFrame([], SCORED_POST), "1 hour")) == []


def test_rows_are_combined_before_the_shuffle(spark, tmp_path, scored):
    scored.write.parquet(str(tmp_path / "posts"))
    stored = spark.read.parquet(str(tmp_path / "posts"))
    text = plan(windowed_sentiment(stored, "5 minutes", since=at(9, 0)))
    assert text.count("Exchange (") == 1
    assert "partial_sum" in text
    assert "GreaterThanOrEqual(event_time_ts" in text
    read = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "Text" not in read and "id:" not in read
    assert "EvalPython" not in text
