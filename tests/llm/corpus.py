"""Small invented tables for the corpus operators."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("label", T.StringType()),
        T.StructField("fp", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def docs(spark, rows):
    """Documents from `(doc_id, text[, source])`, with clashing extra columns."""
    full = [
        (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 7, None, 5, 0.5)
        for r in rows
    ]
    return spark.createDataFrame(full, DOCS)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}


ODD = [
    None,
    "",
    " \n\t ",
    "one",
    "A b c",
    "Ünï cödé — 漢字かな交じり文 😀 ok",
    "x" * 5000,
    "word " * 3000,
    "line\n" * 400,
    "tab\tand nbsp em\x1cfs",
]
