import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallywind.functions.scores import label_of
from tallywind.functions.times import event_timestamp, instant
from tallywind.schemas import ENVELOPE, LABELLED_TEXT
from tallywind.sources import files, messages
from tests.helpers import rows

LABELLED = [
    (1, "a", "Positive", 'one "two"\nthree, four'),
    (1, "a", "", None),
    (2, None, "Negative", ""),
    (3, "b", "Neutral", " ünï #công "),
    (None, "b", None, "back\\slash"),
]


@pytest.fixture()
def labelled(spark):
    return spark.createDataFrame(LABELLED, LABELLED_TEXT)


def test_publish_drops_the_label_and_keeps_nulls(labelled):
    time = F.lit("2024-01-01T00:00:00")
    sent = [json.loads(bytes(r.value)) for r in messages.to_messages(labelled, time).collect()]
    assert sent[0] == {
        "id": "1",
        "topic": "a",
        "Text": 'one "two"\nthree, four',
        "event_time": "2024-01-01T00:00:00",
    }
    assert sent[2]["topic"] is None and sent[2]["Text"] == ""


def test_publishing_time_is_now(labelled):
    parsed = messages.parse_messages(messages.to_messages(labelled))
    times = parsed.select(event_timestamp("event_time").alias("t")).distinct().collect()
    assert len(times) == 1
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert abs((times[0].t - now).total_seconds()) < 600


def test_parse(spark):
    texts = ['{"id":"1","topic":"t","Text":"x","event_time":"e"}', "oops", "{}", '{"id":2}', None]
    df = spark.createDataFrame([(t.encode() if t else None,) for t in texts], ENVELOPE)
    assert rows(messages.parse_messages(df)) == sorted(
        [("1", "t", "x", "e"), (None,) * 4, (None,) * 4, ("2", None, None, None), (None,) * 4],
        key=repr,
    )


def test_ready_to_score(spark):
    body = '{"id":"1","topic":"t","event_time":"2024-01-01T10:00:00.5"}'
    df = spark.createDataFrame([(body.encode(),)], ENVELOPE)
    row = messages.ready_to_score(df).first()
    assert row.Text == "" and row.event_time_ts == datetime(2024, 1, 1, 10, 0, 0, 500000)


def test_times(spark):
    texts = ["2024-01-01T10:00:00", "2024-01-01 10:00:00", "bad", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    moment = datetime(2024, 1, 1, 10)
    got = [r[0] for r in df.select(event_timestamp("t")).collect()]
    assert got == [moment, moment, None, None, None]
    assert spark.range(1).select(instant(moment)).first()[0] == moment


def test_labels(spark):
    df = spark.createDataFrame([(float(i),) for i in range(5)] + [(None,)], "p double")
    assert [r[0] for r in df.select(label_of("p")).collect()] == [
        "Negative", "Positive", "Neutral", "Irrelevant", "Unknown", "Unknown",
    ]


def test_kafka_options():
    options = messages.kafka_options("h:1", "posts", max_offsets_per_trigger=10)
    assert options == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "posts",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }
    assert messages.kafka_options("h:1", "p", starting="earliest")["startingOffsets"] == "earliest"


def test_kafka_without_connector(spark):
    with pytest.raises(PySparkException):
        messages.kafka_stream(spark, messages.kafka_options("h:1", "posts"))


def test_csv_keeps_line_breaks_and_quotes(spark, labelled, tmp_path):
    path = str(tmp_path / "csv")
    files.write_headerless_csv(labelled, path)
    kept = files.read_labelled_csv(spark, path, keep_empty=True)
    assert rows(kept) == sorted(LABELLED, key=repr)
    plain = rows(files.read_labelled_csv(spark, path))
    assert plain == sorted([tuple(v if v != "" else None for v in r) for r in LABELLED], key=repr)


def test_csv_single_line_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,x,Positive,"he said ""hi"""\n2,y,Negative,plain\n')
    got = files.read_labelled_csv(spark, str(tmp_path / "a.csv"), multi_line=False)
    assert rows(got) == [(1, "x", "Positive", 'he said "hi"'), (2, "y", "Negative", "plain")]


def test_csv_types_may_be_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,x,2.5\n2,y,3\n")
    df = files.read_labelled_csv(
        spark, str(tmp_path / "a.csv"), columns=["n", "t", "v"], schema=None
    )
    assert dict(df.dtypes) == {"n": "int", "t": "string", "v": "double"}
