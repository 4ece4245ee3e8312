"""CSV, JSON and Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.functions.text import keyword_slug
from tallywind.schemas import ARCHIVE, LABELLED_TEXT, SCORED_POST
from tallywind.sources.split_csv import read_split_csv

# A quote inside a quoted field is written twice.
_QUOTING = {"quote": '"', "escape": '"', "encoding": "UTF-8"}
# A null field is written as nothing and a text of no characters as a pair of
# quotes; fields keep the blanks around them.
_WRITTEN = {
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
# A reader takes every text that equals the null text for a null, a pair of
# quotes included; with a null text no file holds, only nothing is a null.
_EMPTY_IS_TEXT = {"nullValue": "\0"}


def read_labelled_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    columns: Sequence[str] = tuple(LABELLED_TEXT.names),
    schema: T.StructType | None = LABELLED_TEXT,
    multi_line: bool = True,
    keep_empty: bool = False,
    split: bool = False,
) -> DataFrame:
    """Headerless CSV of labelled texts; columns are named by position. A quoted
    empty field is null, as Spark reads it, unless `keep_empty`. Without a schema
    Spark infers the types, which costs a pass over the files.

    Texts may hold line breaks. A file read that way is one task: `split=True` reads it
    by as many as it has splits, at the price of a shuffle of its lines, and
    `multi_line=False` reads files with one record per line, which Spark splits itself.
    """
    empties = _EMPTY_IS_TEXT if keep_empty else {}
    if split:
        if schema is None:
            raise ValueError("a split file needs a schema")
        return read_split_csv(spark, path, schema, {**_QUOTING, **empties}).toDF(*columns)
    reader = spark.read.option("header", False).option("multiLine", multi_line)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.options(**_QUOTING, **empties).csv(path).toDF(*columns)


def write_headerless_csv(df: DataFrame, path: str) -> None:
    """The form `read_labelled_csv` reads."""
    df.write.mode("overwrite").option("header", False).options(**_QUOTING, **_WRITTEN).csv(path)


def _csv_writer(df: DataFrame):
    return df.write.mode("overwrite").option("header", True).options(**_QUOTING, **_WRITTEN)


# Records of a written CSV file at most.
RECORDS_PER_FILE = 500_000


def write_csv(df: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """CSV with a header and no index."""
    _csv_writer(df).option("maxRecordsPerFile", records_per_file).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = True
) -> DataFrame:
    """What the CSV writers here wrote, with its nulls and its empty texts. A file with
    line breaks in its fields is read by one task: bound the records of a file when
    writing it, or pass `multi_line=False` where no field has any (`scrub_lines`)."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", multi_line)
    return reader.options(**_QUOTING, **_EMPTY_IS_TEXT).csv(path)


def write_csv_per_keyword(df: DataFrame, path: str, keyword: str = "keyword") -> None:
    """One folder of CSV files per keyword.

    The rebalance gathers the rows of a keyword into files of the advisory size
    and splits a keyword that is larger, so a popular one is not one task.
    """
    named = df.withColumn("keyword_slug", keyword_slug(keyword))
    _csv_writer(named.hint("rebalance", "keyword_slug")).partitionBy("keyword_slug").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; a field without a value stays visible as null."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_archive(spark: SparkSession, path: str, *, date_range=None) -> DataFrame:
    """Scored posts of the archive; a (first, last) pair of dates prunes folders."""
    posts = spark.read.schema(ARCHIVE).parquet(path)
    if date_range is not None:
        posts = posts.filter(F.col("event_date").between(*(F.lit(d) for d in date_range)))
    return posts.select(*SCORED_POST.names)
