"""Text cleaning and tokens as native column expressions.

Regular expressions run inside the JVM; nothing here starts a Python worker.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and their order are the cleaning contract. The
# serving form follows Unicode rules for words and spaces, spelled out because
# \w and \s are ASCII-only in Java; the training form is the ASCII one. The
# letters pattern is applied to lower-case text.
_SPACE = r" \t-\r\x1c-\x1f\x{85}\p{Z}"
_NOT_SPACE = rf"[^{_SPACE}]"
_WORD = r"[\p{L}\p{N}_]"
SERVING_URL = (
    rf"https?://{_NOT_SPACE}+|www\.{_NOT_SPACE}+|\.com{_NOT_SPACE}+|youtu\.be/{_NOT_SPACE}+"
)
SERVING_TAG = rf"(@|#){_WORD}+"
SERVING_DROP = rf"[^a-z{_SPACE}]"
SERVING_BLANKS = rf"[{_SPACE}]++"
TRAINING_URL = r"https?://\S+|www\.\S+|S+\.com\S+|youtu\.be/\S+"
TRAINING_TAG = r"(@|#)\w+"
TRAINING_DROP = r"[^a-zA-Z\s]"
# Every link holds one of these.
_LINK_MARKS = ("http", "www.", ".com", "youtu.be/")


def _removed(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def _without_links(text: Column, pattern: str) -> Column:
    """A byte search is much cheaper than trying four alternatives at each
    character, so texts without any mark of a link skip the pattern."""
    marked = reduce(or_, (F.contains(text, F.lit(mark)) for mark in _LINK_MARKS))
    return F.when(marked, _removed(text, pattern)).otherwise(text)


def clean_text(text: Column | str, variant: str = "serve") -> Column:
    """Links, then tags, then case, then everything but ASCII letters and spaces.

    `serve` also squeezes and trims blanks and turns null into the empty text;
    `train` keeps blanks and nulls as they are.
    """
    column = F.col(text) if isinstance(text, str) else text
    if variant == "train":
        untagged = _removed(_without_links(column, TRAINING_URL), TRAINING_TAG)
        return _removed(F.lower(untagged), TRAINING_DROP)
    if variant != "serve":
        raise ValueError(f"unknown variant {variant!r}")
    untagged = _removed(_without_links(column, SERVING_URL), SERVING_TAG)
    letters = _removed(F.lower(untagged), SERVING_DROP)
    return F.coalesce(F.trim(F.regexp_replace(letters, SERVING_BLANKS, " ")), F.lit(""))


def drop_blank_tokens(tokens: Column | str) -> Column:
    """Tokens that hold something besides blanks; a null array becomes empty."""
    column = F.col(tokens) if isinstance(tokens, str) else tokens
    kept = F.filter(column, lambda token: token.rlike(_NOT_SPACE))
    return F.coalesce(kept, F.array().cast("array<string>"))


def keyword_slug(keyword: Column | str) -> Column:
    """File-name form of a search keyword, 50 characters at most."""
    column = F.col(keyword) if isinstance(keyword, str) else keyword
    # Replaced in this order, case-sensitive, also inside words.
    for found, put in ((" ", "_"), ("#", ""), ("OR", "_"), ("AND", "_")):
        column = F.replace(column, F.lit(found), F.lit(put))
    return F.substring(column, 1, 50)
