"""A corpus pipeline: toxic documents go, one document of each near-duplicate group
stays, personal data is covered, sources are mixed to their weights, and the mix is
encoded.

Each stage takes a session, the documents its predecessor kept and the folder of
tables. Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.llm import bpe, mixing, pii, simhash, toxicity
from tallywind.llm.common import table, written
from tallywind.llm.queries import ranks_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.keep_one(docs)


def cover_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; `n_chars` follows the text."""
    redacted = pii.redact(docs)
    return redacted.withColumn(
        "n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document of the mix, with its source and language."""
    tokens = bpe.tokenize(docs, ranks_path(), carry=("source", "lang"))
    return tokens.select("doc_id", "source", "lang", "ids", "n_tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", cover_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL can express neither the classifier nor the encoder; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
