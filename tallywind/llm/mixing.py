"""Mix sources to target weights by repeating and thinning their documents.

Sizes are summed per source; a source's target over its size is the repetition
rate of its documents. A document is taken floor(rate) times, and once more if a
number drawn from the hash of its id falls below the fraction. Nothing is random
between runs, and no document needs to see another one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.llm.common import bounded_broadcast, whole_text, word_count, written

#: Weights dealt to the sources in order, again and again.
WEIGHTS = (3, 1, 2)
#: Words of the mix over words of the corpus, and the most a source may repeat.
SHARE, MOST = 1.5, 2.0
#: Up to so many sources their targets are broadcast (some 100 bytes each).
BROADCAST_SOURCES = 20_000


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """`source, source_size, target` from rows of `source, size`.

    Sources by code point, null last, get the weights in turn. Targets share
    `share` times all sizes by weight; one that would exceed `most` times its
    source's size stops there and the excess goes to the others by weight. Sorted
    by limit over weight, the stopped sources come first: a source is stopped if
    the share per weight that is left when all before it have stopped reaches its
    limit. The windows run over one row per source, never over documents. Sources
    without words get a target of zero; an empty table gives no rows.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    dealt = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    ranked = per_source.select(
        "source",
        "source_size",
        dealt.alias("weight"),
        (F.col("source_size") * F.lit(most)).alias("limit"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("budget"),
    )
    by_limit = Window.orderBy(
        F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ranked.withColumns(
        {
            "limit_before": F.sum("limit").over(by_limit) - F.col("limit"),
            "weight_left": F.sum("weight").over(everything)
            - F.sum("weight").over(by_limit)
            + F.col("weight"),
        }
    )
    stopped = F.col("limit") * F.col("weight_left") <= F.col("weight") * (
        F.col("budget") - F.col("limit_before")
    )
    marked = filled.withColumn("stopped", stopped)
    spent = F.sum(F.when(F.col("stopped"), F.col("limit")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("stopped"), 0.0).otherwise(F.col("weight"))).over(everything)
    level = (F.col("budget") - spent) / open_weight
    return marked.select(
        "source",
        "source_size",
        F.when(F.col("stopped"), F.col("limit"))
        .otherwise(F.col("weight") * level)
        .alias("target"),
    )


def drawn(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """A number in [0, 1) from the hash of the id; documents without an id draw by
    their text. 52 bits, so that every value is an exact double."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(text)))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def decide(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    *,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
    carry: bool = False,
) -> DataFrame:
    """`doc_id, size, source_size, target, copies` per row of the documents, and
    with `carry` the row itself as the struct `row`, safe from clashing names.

    A null text has no words; a null source is a source of its own; repeated rows
    are taken alike; rows without words follow their source's rate, which is zero
    if no row of it has words.
    """
    measured = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        word_count(text).alias("size"),
        drawn(F.col(doc_id), whole_text(text), seed).alias("draw"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    targets = written(
        source_targets(measured.select("source", "size"), weights, share, most), "targets"
    )
    few = bounded_broadcast(
        targets.withColumnRenamed("source", "named"), targets.count(), BROADCAST_SOURCES
    )
    joined = measured.join(few, F.col("source").eqNullSafe(F.col("named")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate)
    return joined.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (whole + F.when(F.col("draw") < rate - whole, 1).otherwise(0)).cast("long").alias("copies"),
        *(["row"] if carry else []),
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of the documents as often as it is taken."""
    taken = decide(docs, carry=True, **options).where(F.col("copies") > 0)
    repeated = taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("row.*")
