"""Tokens of a text column and the vocabulary they form."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.functions.stopwords import ENGLISH
from tallywind.functions.text import drop_blank_tokens


def tokenize(df: DataFrame, text: str = "Text", tokens: str = "tokens") -> DataFrame:
    """Lower-case and split at each single blank; empty tokens stay."""
    return Tokenizer(inputCol=text, outputCol=tokens).transform(df)


def content_tokens(df: DataFrame, text: str = "Text", tokens: str = "final_tokens") -> DataFrame:
    """Tokens without stop words and blanks."""
    remover = StopWordsRemover(
        inputCol="tokens", outputCol="filtered_tokens", stopWords=ENGLISH
    )
    kept = remover.transform(tokenize(df, text))
    return kept.withColumn(tokens, drop_blank_tokens("filtered_tokens")).drop(
        "tokens", "filtered_tokens"
    )


def vocabulary(
    df: DataFrame, tokens: str = "final_tokens", size: int = 10_000, min_docs: int = 5
) -> DataFrame:
    """The terms a term-count model keeps, with corpus and document counts.

    A row sends each of its tokens once for the corpus count and each distinct
    token once for the document count. Both are sums combined before the one
    shuffle, so a frequent word costs a row per task and no distinct is needed.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def counted(term, tf, df_):
        return F.struct(term.alias("term"), tf.alias("tf"), df_.alias("df"))

    marks = F.concat(
        F.transform(tokens, lambda t: counted(t, one, none)),
        F.transform(F.array_distinct(tokens), lambda t: counted(t, none, one)),
    )
    return (
        df.select(F.inline(marks))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        .filter(F.col("df") >= min_docs)
        .orderBy(F.desc("tf"), "term")
        .limit(size)
    )


def frequent_terms(
    df: DataFrame,
    tokens: str = "final_tokens",
    size: int = 10_000,
    min_docs: int = 5,
    buckets: int = 1 << 16,
) -> DataFrame:
    """The rows of `vocabulary`, for corpora whose terms are too many to count each.

    Terms are first counted by hash buckets: a task sends a row per bucket, not per term,
    and a bucket's count bounds that of all its terms. The terms of the fullest buckets
    are then counted one by one. Of these the `size`-th count is a floor: a term that
    reaches it is in a bucket that does. Where such buckets are left their terms are
    counted as well, so the result is exact; with few or evenly frequent terms that is
    all of them. Each count reads the tokens again: store them first.
    """
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets))
    counts = (
        df.select(F.explode(tokens).alias("term"))
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("bound"))
    )
    # A row per bucket at most, which is what the driver and the broadcasts get.
    fullest = {r["bucket"]: r["bound"] for r in counts.collect()}
    ranked = sorted(fullest, key=lambda b: (-fullest[b], b))

    def counted(chosen: list[int]) -> DataFrame:
        spark = df.sparkSession
        wanted = spark.createDataFrame([(b,) for b in chosen], "bucket long")
        one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

        def mark(term, tf, df_):
            return F.struct(term.alias("term"), tf.alias("tf"), df_.alias("df"))

        marks = F.concat(
            F.transform(tokens, lambda t: mark(t, one, none)),
            F.transform(F.array_distinct(tokens), lambda t: mark(t, none, one)),
        )
        listed = df.select(F.inline(marks)).withColumn("bucket", bucket)
        held = listed.join(F.broadcast(wanted), "bucket", "left_semi")
        sums = held.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
        return sums.filter(F.col("df") >= min_docs)

    order = (F.desc("tf"), "term")
    chosen = ranked[: 2 * size]
    top = counted(chosen).orderBy(*order).limit(size)
    if len(chosen) < len(ranked):
        least = top.agg(F.count("*").alias("n"), F.min("tf").alias("tf")).first()
        floor = least["tf"] if least["n"] == size else min_docs
        more = [b for b in ranked if fullest[b] >= floor]
        if len(more) > len(chosen):
            top = counted(more).orderBy(*order).limit(size)
    return top
