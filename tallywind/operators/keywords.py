"""Search for any number of keywords in one pass over the posts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywind.operators.posts import DEFAULT_SEARCH_SPAN, newest_per_keyword, searched

#: Letters of the piece by which a keyword is looked up; shorter keywords are their own.
GRAM = 4


def _pieces(text: Column, size: int) -> Column:
    """All pieces of a text of a size, overlapping ones too: a look ahead uses no letters
    up. (A piece cut out of the text by its place would count the letters before it.)"""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def matches(posts: DataFrame, keywords: Sequence[str], text: str = "text") -> DataFrame:
    """Posts with each `keyword` their text contains, whatever its case; a post that
    matches two keywords appears twice.

    Instead of a comparison per keyword, a post's pieces are looked up among those that
    stand for the keywords (each its rarest one among all keywords), which are a set; what
    is found is joined to the table of keywords, and only then compared. The plan does not
    grow with the keywords but for that set. Keywords come with the call, so their table
    fits a broadcast.
    """
    spark = posts.sparkSession
    given = sorted(set(keywords))
    table = spark.createDataFrame([(k,) for k in given], "keyword string")
    # Lower-cased where the texts are, since that of another library may differ.
    needles = [(r[0], r[1]) for r in table.select("keyword", F.lower("keyword")).collect()]
    always = [k for k, needle in needles if needle == ""]
    cuts = {
        needle: sorted({needle[i : i + GRAM] for i in range(max(1, len(needle) - GRAM + 1))})
        for _, needle in needles
        if needle
    }
    uses: dict[str, int] = {}
    for pieces in cuts.values():
        for piece in pieces:
            uses[piece] = uses.get(piece, 0) + 1
    found = posts.withColumn("_lower", F.lower(text))
    listed = [
        (min(cuts[needle], key=lambda piece: (-len(piece), uses[piece], piece)), needle, keyword)
        for keyword, needle in needles
        if needle
    ]
    every = F.array(*(F.lit(k) for k in always)).cast("array<string>")
    if not listed:
        rows = found.where(F.col("_lower").isNotNull())
        return rows.drop("_lower").withColumn("keyword", F.explode(every))
    known = spark.createDataFrame(listed, "_piece string, _needle string, keyword string")
    wanted: dict[int, list[str]] = {}
    for piece in sorted({piece for piece, _, _ in listed}):
        wanted.setdefault(len(piece), []).append(piece)
    hit = F.concat(
        *(
            F.array_distinct(
                F.filter(_pieces(F.col("_lower"), size), lambda piece: piece.isin(pieces))
            )
            for size, pieces in wanted.items()
        )
    )
    hits = found.where(F.col("_lower").isNotNull()).withColumn("_piece", F.explode(hit))
    exact = hits.join(F.broadcast(known), "_piece").where(F.contains("_lower", "_needle"))
    kept = exact.select(*posts.columns, "keyword")
    if always:
        whole = posts.where(F.col(text).isNotNull()).withColumn("keyword", F.explode(every))
        kept = kept.unionByName(whole)
    return kept


def collect_by_many_keywords(
    posts: DataFrame,
    keywords: Sequence[str],
    *,
    as_of: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    newest: int | None = None,
) -> DataFrame:
    """What `collect_by_keywords` returns, for keywords by the thousand."""
    found = matches(searched(posts, since or as_of - DEFAULT_SEARCH_SPAN, until), keywords)
    return found if newest is None else newest_per_keyword(found, newest)
