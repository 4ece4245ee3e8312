import math
import random

import pytest
from pyspark.ml.feature import StringIndexerModel

from tallywind.functions.stages import BlankTokenFilter
from tallywind.plans import training
from tallywind.schemas import LABELLED_TEXT
from tallywind.sources.files import write_headerless_csv
from tests.helpers import plan, rows

WORDS = {
    "Negative": ["bad", "awful", "broken"],
    "Positive": ["good", "great", "lovely"],
    "Neutral": ["table", "window", "street"],
}


def made_up(n, seed):
    dice = random.Random(seed)
    weights = [5, 3, 2]
    for i in range(n):
        label = dice.choices(list(WORDS), weights)[0]
        text = " ".join(dice.choices(WORDS[label] + ["the", "and"], k=8))
        yield i, "topic", label, f"@who {text}! https://a.b/c"


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(list(made_up(150, 3)), LABELLED_TEXT)


@pytest.fixture(scope="module")
def model(labelled):
    return training.fit(training.prepare(labelled))


def test_labels_by_frequency_then_name(spark):
    data = [("b",), ("a",), ("c",), ("c",)]
    df = spark.createDataFrame(data, "Label string")
    indexer = training.label_indexer(df)
    assert indexer.labels == ["c", "a", "b"]
    assert rows(training.label_mapping(df, indexer)) == [(0, "c", 2), (1, "a", 1), (2, "b", 1)]


def test_unseen_label_is_an_error(spark):
    indexer = training.label_indexer(spark.createDataFrame([("a",)], "Label string"))
    with pytest.raises(Exception, match="nseen label"):
        indexer.transform(spark.createDataFrame([("z",)], "Label string")).collect()


def test_learns_and_labels(spark, model):
    texts = spark.createDataFrame([("good great",), ("awful",), ("street",)], "Text string")
    got = [r.sentiment_label for r in model.score(texts).collect()]
    assert got == ["Positive", "Negative", "Neutral"]


def test_empty_text_is_scored(spark, model):
    scored = model.score(spark.createDataFrame([("",)], "Text string")).first()
    assert scored.sentiment_label in WORDS


def test_scoring_starts_no_python_worker(spark, model):
    scored = model.score(spark.createDataFrame([("good",)], "Text string"))
    assert "EvalPython" not in plan(scored.select("sentiment_label"))


def test_stage_parameters(model):
    tokens, stop, blank, counts, classifier = model.pipeline.stages
    assert isinstance(blank, BlankTokenFilter)
    assert (counts.getVocabSize(), counts.getMinDF()) == (10_000, 5.0)
    assert classifier.getMaxIter() == 10 and classifier.numClasses == 3


def test_save_overwrites_and_load(spark, model, labelled, tmp_path):
    path = str(tmp_path / "model")
    model.save(path)
    model.save(path)
    kept = training.SentimentModel.load(path)
    assert isinstance(kept.labels, StringIndexerModel)
    texts = training.prepare(labelled).select("id", "Text")
    before, after = (
        rows(m.score(texts).select("id", "prediction", "sentiment_label")) for m in (model, kept)
    )
    assert before == after


def test_predictions_follow_from_the_stored_coefficients(model, labelled):
    """Counts, margins and the choice of a label, worked out by hand."""
    import numpy as np

    from tallywind.functions.stopwords import ENGLISH

    counts, classifier = model.pipeline.stages[-2:]
    place = {term: i for i, term in enumerate(counts.vocabulary)}
    weights = classifier.coefficientMatrix.toArray()
    scored = model.score(training.prepare(labelled)).select("Text", "sentiment_label").collect()
    assert len(scored) == 150
    for row in scored:
        vector = np.zeros(len(place))
        for token in row.Text.split(" "):
            if token in place and token not in ENGLISH:
                vector[place[token]] += 1
        margins = weights @ vector + classifier.interceptVector.toArray()
        assert model.labels.labels[int(margins.argmax())] == row.sentiment_label


def test_evaluator_agrees_with_operator(model, labelled):
    from tallywind.operators.evaluation import accuracy

    predictions = training.predicted(model, training.prepare(labelled))
    own = accuracy(predictions, training.LABEL_INDEX, "prediction").first().accuracy
    assert training.accuracy_of(predictions) == pytest.approx(own)
    assert own > 0.95


def test_a_constant_model_fails_its_queries(spark, labelled, model, monkeypatch):
    from tallywind.catalog import queries

    rows_ = training.prepare(labelled)
    good = {r["label"]: r["learned"] for r in queries.model_report(spark, model, rows_).collect()}
    assert good == dict.fromkeys([*WORDS, None], True)
    assert {r["learned"] for r in queries.prediction_rows(spark, model, rows_).collect()} == {True}
    monkeypatch.setattr(training, "MAX_ITERATIONS", 0)
    guess = training.fit(rows_)
    assert guess.score(rows_).select("sentiment_label").distinct().count() == 1
    bad = {r["label"]: r["learned"] for r in queries.model_report(spark, guess, rows_).collect()}
    assert bad == {"Negative": True, "Positive": False, "Neutral": False, None: False}
    predicted = queries.prediction_rows(spark, guess, rows_)
    assert {(r["label"], r["learned"]) for r in predicted.collect()} == {
        ("Negative", True), ("Positive", False), ("Neutral", False)
    }


def test_against_constant(spark):
    from tallywind.operators.evaluation import against_constant

    data = [("a", "a", 0.9), ("a", "a", 0.8), ("a", "b", 0.2), ("b", None, 0.5)]
    df = spark.createDataFrame(data, "label string, made string, given double")
    got = against_constant(df, "label", "made", "given").first()
    assert (got.row_count, got.accuracy, got.majority_share) == (4, 0.5, 0.75)
    assert got.log_loss == pytest.approx(-math.log(0.9 * 0.8 * 0.2 * 0.5) / 4)
    shares = -(0.75 * math.log(0.75) + 0.25 * math.log(0.25))
    assert got.constant_log_loss == pytest.approx(shares)


def test_training_job(spark, tmp_path, capsys):
    for name, seed in (("train", 5), ("valid", 6)):
        df = spark.createDataFrame(list(made_up(120, seed)), LABELLED_TEXT)
        write_headerless_csv(df, str(tmp_path / name))
    matrix = training.run(
        spark, str(tmp_path / "train"), str(tmp_path / "valid"), str(tmp_path / "model")
    )
    assert "accuracy:" in capsys.readouterr().out
    cells = {r.Label: r for r in matrix.collect()}
    assert set(cells) == set(WORDS)
    assert sum(cells[label][label] for label in WORDS) > 110
