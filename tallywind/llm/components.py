"""Connected components of a graph given as edges, by joins and grouping only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours meet the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(
        F.col("a").alias("node"), "m"
    )
    return (
        both.where("b > a")
        .join(least, F.col("a") == F.col("node"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours meet the smallest of these neighbours."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
    joined = down.join(least, F.col("a") == F.col("node"))
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionByName(least.select(F.col("node").alias("a"), F.col("m").alias("b")))
        .where("a <> b")
        .distinct()
    )


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """`node, component` for every node of the edges `a, b` (longs, either order,
    repeats and loops allowed): component is the smallest node reachable.

    Large and small stars alternate until the edges no longer change; each round is
    a written table, so no lineage grows and nothing is lost with an executor. A
    node's neighbours are only ever aggregated to a minimum, so a hub costs a row
    per task; joins back to the edges can be split where they are skewed. An empty
    graph has no rows.
    """
    state = F.struct(F.count("*"), F.bit_xor(F.xxhash64("a", "b")))
    current = written(edges.select("a", "b").where("a <> b").distinct(), purpose)
    seen = None
    while True:
        now = current.agg(state.alias("s")).first()["s"]
        if now == seen or now[0] == 0:
            break
        seen = now
        current = written(_small_star(_large_star(current)), purpose)
    stars = current.groupBy(F.greatest("a", "b").alias("node")).agg(
        F.min(F.least("a", "b")).alias("component")
    )
    roots = current.select(F.least("a", "b").alias("node")).distinct()
    return stars.unionByName(roots.select("node", F.col("node").alias("component")))
