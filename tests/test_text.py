"""Cleaning against the contract written with Python's own regular expressions."""

import random
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywind.functions.stopwords import ENGLISH
from tallywind.functions.text import clean_text, drop_blank_tokens, keyword_slug
from tallywind.operators.terms import content_tokens, tokenize, vocabulary
from tests.helpers import plan

# Fixed values here and in the two functions: the patterns of the cleaning contract.
LINK = re.compile(r"https?://\S+|www\.\S+|\.com\S+|youtu\.be/\S+")


def cleaned(text):
    if text is None:
        return ""
    text = re.sub(r"(@|#)\w+", "", LINK.sub("", text)).lower()
    return " ".join(re.sub(r"[^a-zA-Z\s]", "", text).split())


def cleaned_for_training(text):
    if text is None:
        return None
    link = re.compile(r"https?://\S+|www\.\S+|S+\.com\S+|youtu\.be/\S+", re.ASCII)
    text = re.sub(r"(@|#)\w+", "", link.sub("", text), flags=re.ASCII).lower()
    return re.sub(r"[^a-zA-Z\s]", "", text, flags=re.ASCII)


EXAMPLES = [
    None,
    "",
    "   ",
    "Look https://a.b/c now",
    "HTTPS://X.Y/z stays",
    "foo.com and foo.com/x",
    "Sfoo.com S.com/x SS.comx",
    "see www.a.b youtu.be/q end",
    "#công @ngư_ời tail",
    "#a#b @@c",
    "a b c\u0085d　e",
    "line\nbreak\r\n\ttab",
    "İstanbul Kelvin ſlong",
    "emoji 😀 and 中文 and á",
    "www.\x0bx http://\x1cy",
]


def test_examples(spark):
    df = spark.createDataFrame([(t,) for t in EXAMPLES], "t string")
    got = df.select(clean_text("t"), clean_text("t", "train")).collect()
    assert [r[0] for r in got] == [cleaned(t) for t in EXAMPLES]
    # Java's \s has the vertical tab and its lower-casing no other blanks.
    assert [r[1] for r in got] == [cleaned_for_training(t) for t in EXAMPLES]


PIECES = st.sampled_from(
    ["http://", "https://", "www.", ".com", "youtu.be/", "@", "#", "_", " ", "\n", " ", "S"]
    + list("aZé9中İKſ.́😀")
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=50, max_size=200))
def test_random_texts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(clean_text("t")).collect()] == [cleaned(t) for t in texts]


def test_random_code_points(spark):
    """All of Unicode below the letters on which Unicode versions disagree."""
    dice = random.Random(4)
    points = [chr(c) for c in range(1, 0x870) if unicodedata.category(chr(c)) != "Cn"]
    texts = ["".join(dice.choices(points, k=30)) + " #" + dice.choice(points) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(clean_text("t")).collect()] == [cleaned(t) for t in texts]


def test_unknown_variant():
    with pytest.raises(ValueError):
        clean_text(F.lit("x"), "other")


def test_cleaning_starts_no_python_worker(spark):
    df = spark.createDataFrame([("a",)], "t string").select(clean_text("t"))
    assert "EvalPython" not in plan(df)


def test_blank_tokens(spark):
    df = spark.createDataFrame(
        [(1, ["", None, " \t", "a", " ", "b"]), (2, [""]), (3, None)], "id int, t array<string>"
    )
    got = {r.id: r.k for r in df.select("id", drop_blank_tokens("t").alias("k")).collect()}
    assert got == {1: ["a", "b"], 2: [], 3: []}


def test_tokens_keep_empty_ones(spark):
    df = spark.createDataFrame([(1, ""), (2, "  a  B "), (3, "x")], "id int, Text string")
    got = {r.id: r.tokens for r in tokenize(df).collect()}
    assert got == {1: [""], 2: ["", "", "a", "", "b"], 3: ["x"]}


def test_stop_words_are_removed_in_any_case(spark):
    assert len(ENGLISH) == 198
    assert sum("'" in word for word in ENGLISH) == 45
    df = spark.createDataFrame([("The cat  and YOU ran",)], "Text string")
    assert content_tokens(df).first().final_tokens == ["cat", "ran"]


def test_vocabulary_equals_that_of_the_term_count_stage(spark):
    from pyspark.ml.feature import CountVectorizer

    dice = random.Random(1)
    words = [f"w{i}" for i in range(40)]
    data = [([dice.choice(words[: dice.randint(1, 40)]) for _ in range(30)],) for _ in range(60)]
    df = spark.createDataFrame(data, "final_tokens array<string>")
    stage = CountVectorizer(inputCol="final_tokens", outputCol="v", minDF=5.0).fit(df)
    found = vocabulary(df, min_docs=5).collect()
    assert {r.term for r in found} == set(stage.vocabulary)
    tf = {r.term: r.tf for r in found}
    assert [tf[t] for t in stage.vocabulary] == [r.tf for r in found]
    for r in found:
        assert r.df == sum(r.term in tokens for (tokens,) in data)


def test_slug(spark):
    words = ["#python", "machine learning", "A OR B AND c", "FORWARD BAND", "x" * 60, None]
    df = spark.createDataFrame([(w,) for w in words], "k string")
    got = [r[0] for r in df.select(keyword_slug("k")).collect()]
    assert got == ["python", "machine_learning", "A___B___c", "F_WARD_B_", "x" * 50, None]


