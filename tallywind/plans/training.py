"""Train, keep, load, apply and evaluate the sentiment model.

    spark-submit -m tallywind.plans.training --training train.csv \\
        --validation valid.csv --model /shared/model
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    CountVectorizer,
    IndexToString,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.functions.stages import BlankTokenFilter
from tallywind.functions.stopwords import ENGLISH
from tallywind.functions.text import clean_text
from tallywind.operators.evaluation import confusion_matrix
from tallywind.operators.profile import drop_null_rows, null_profile
from tallywind.session import build_session, new_folder, remove_folder
from tallywind.sources.files import read_labelled_csv

# Hyper-parameters of the classifier, the name of the label index, and
# the stage columns below, which belong to the processed table.
VOCABULARY_SIZE = 10_000
MIN_DOCUMENTS = 5
MAX_ITERATIONS = 10
LABEL_INDEX = "Label2"


@dataclass(frozen=True)
class SentimentModel:
    """The fitted pipeline and the label of each prediction index. Labels are
    indexed by frequency, so they belong to the fit and are kept with it."""

    pipeline: PipelineModel
    labels: StringIndexerModel

    def score(self, df: DataFrame) -> DataFrame:
        """Add `prediction` and `sentiment_label` to a batch or a stream that
        has clean `Text`."""
        to_label = IndexToString(
            inputCol="prediction", outputCol="sentiment_label", labels=self.labels.labels
        )
        return to_label.transform(self.pipeline.transform(df))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        self.labels.write().overwrite().save(f"{path}/labels")

    @classmethod
    def load(cls, path: str) -> SentimentModel:
        return cls(
            PipelineModel.load(f"{path}/pipeline"), StringIndexerModel.load(f"{path}/labels")
        )


def label_indexer(df: DataFrame, label: str = "Label") -> StringIndexerModel:
    """Labels by falling frequency, equal ones by name; an unseen label is an error."""
    return StringIndexer(inputCol=label, outputCol=LABEL_INDEX).fit(df)


def label_mapping(df: DataFrame, indexer: StringIndexerModel, label: str = "Label") -> DataFrame:
    """Index, label and rows of each label."""
    back = IndexToString(inputCol=LABEL_INDEX, outputCol="index_label", labels=indexer.labels)
    counts = indexer.transform(df).groupBy(label, LABEL_INDEX).agg(F.count("*").alias("row_count"))
    return back.transform(counts).select(
        F.col(LABEL_INDEX).cast("long").alias("label_index"),
        F.col("index_label").alias("label"),
        "row_count",
    )


def token_stages() -> list:
    """Text to tokens; nothing here is fitted."""
    return [
        Tokenizer(inputCol="Text", outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered_tokens", stopWords=ENGLISH),
        BlankTokenFilter(inputCol="filtered_tokens", outputCol="final_tokens"),
    ]


def fitted_stages() -> list:
    return [
        CountVectorizer(
            inputCol="final_tokens",
            outputCol="features",
            vocabSize=VOCABULARY_SIZE,
            minDF=MIN_DOCUMENTS,
        ),
        LogisticRegression(
            maxIter=MAX_ITERATIONS, labelCol=LABEL_INDEX, featuresCol="features"
        ),
    ]


def prepare(labelled: DataFrame, variant: str = "serve") -> DataFrame:
    """Rows with a text, and the text cleaned as it is when served."""
    return drop_null_rows(labelled, ["Text"]).withColumn("Text", clean_text("Text", variant))


def fit(labelled: DataFrame, tokens_path: str | None = None) -> SentimentModel:
    """Fit on prepared rows (`prepare`).

    Labels, term counts and the classifier's statistics and blocks each need a
    pass of their own. The tokens are therefore written once and read by all passes:
    texts are cleaned and split only once, and a lost executor costs a read. The
    classifier keeps its blocks itself, in memory and on disk. Without a given path
    the tokens go to a new folder of the shared root, which is removed after the fit.
    """
    spark = labelled.sparkSession
    path = tokens_path or new_folder(spark, "tokens")
    to_tokens = PipelineModel(token_stages())
    rows = to_tokens.transform(labelled.select("Label", "Text")).select("Label", "final_tokens")
    rows.write.parquet(path)
    written = spark.read.schema(rows.schema).parquet(path)
    labels = label_indexer(written)
    fitted = Pipeline(stages=fitted_stages()).fit(labels.transform(written))
    if tokens_path is None:
        remove_folder(spark, path)
    return SentimentModel(PipelineModel([*to_tokens.stages, *fitted.stages]), labels)


def predicted(model: SentimentModel, labelled: DataFrame) -> DataFrame:
    """Prepared rows with label index and prediction, for evaluation."""
    return model.score(model.labels.transform(labelled))


def label_probability(predictions: DataFrame) -> DataFrame:
    """Evaluated rows (`predicted`) with the `probability_of_label` the model gave."""
    given = vector_to_array("probability")[F.col(LABEL_INDEX).cast("int")]
    return predictions.withColumn("probability_of_label", given)


def accuracy_of(predictions: DataFrame) -> float:
    evaluator = MulticlassClassificationEvaluator(
        labelCol=LABEL_INDEX, predictionCol="prediction", metricName="accuracy"
    )
    return evaluator.evaluate(predictions)


def run(spark: SparkSession, training: str, validation: str, model_path: str) -> DataFrame:
    """Train on one file, save the model, and return the confusion matrix of the
    other file."""
    train, valid = (read_labelled_csv(spark, path) for path in (training, validation))
    null_profile(train, ["Label", "Text"]).show()
    null_profile(valid, ["Label", "Text"]).show()
    fit(prepare(train)).save(model_path)
    model = SentimentModel.load(model_path)
    predictions = predicted(model, prepare(valid))
    print("accuracy:", accuracy_of(predictions))
    return confusion_matrix(predictions, "Label", "sentiment_label", model.labels.labels)


def main() -> None:
    parser = argparse.ArgumentParser(description="Train and evaluate the sentiment model")
    parser.add_argument("--training", required=True)
    parser.add_argument("--validation", required=True)
    parser.add_argument("--model", required=True)
    args = parser.parse_args()
    spark = build_session("tallywind-training")
    run(spark, args.training, args.validation, args.model).show()


if __name__ == "__main__":
    main()
