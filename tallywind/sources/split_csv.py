"""CSV with line breaks inside quotes, read by as many tasks as a file has splits.

Whether a line break ends a record depends on all quotes before it. What a line does to
that is a function of two states, inside quotes or not: it keeps them, swaps them, or
leads to one of them from both. Such functions are composed by a running sum of swaps
since the last line that leads to one state. So each split is worked out by itself for
both states, the splits of a file (a row each) tell with which one each begins, and then
every line knows its own. Records of one line, by far the most, are never grouped; the
lines of longer ones meet by the place of their first line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where a reader can be: at the start of a field, inside one without quotes, inside
# quotes, behind a quote that ends them or is the first of a doubled one.
_START, _PLAIN, _QUOTED, _BEHIND = range(4)


def _after(line: Column, state: int) -> Column:
    """Whether the line ends inside quotes, if it begins in the given state. The pieces
    between its quotes are read one by one."""

    def text(at: Column, piece: Column) -> Column:
        moved = F.when(piece.endswith(","), _START).otherwise(_PLAIN)
        return F.when((piece == "") | (at == _QUOTED), at).otherwise(moved)

    def quote(at: Column) -> Column:
        return (
            F.when(at.isin(_START, _BEHIND), _QUOTED)
            .when(at == _QUOTED, _BEHIND)
            .otherwise(_PLAIN)
        )

    pieces = F.split(line, '"')
    first = text(F.lit(state), pieces[0])
    rest = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    ends = F.aggregate(rest, first, lambda at, piece: text(quote(at), piece)) == _QUOTED
    return F.when(F.contains(line, F.lit('"')), ends).otherwise(F.lit(state == _QUOTED))


def _entries(lines: DataFrame) -> DataFrame:
    """Lines with `inside`, whether they begin inside quotes, and `first`, the place of
    the line where their record begins."""
    from_out, from_in = F.col("from_out"), F.col("from_in")
    swaps = ~from_in & from_out
    leads = F.when(from_out == from_in, from_out)
    split = Window.partitionBy("file", "split").orderBy("place")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    turned = lines.withColumns(
        {"turns": F.sum(swaps.cast("int")).over(split), "leads": leads}
    )
    # The last line that leads to one state, and the swaps up to it.
    known = F.when(F.col("leads").isNotNull(), F.struct("leads", "turns"))
    scanned = turned.withColumns(
        {
            "known": F.last(known, ignorenulls=True).over(before),
            "turns": F.coalesce(F.lag("turns").over(split), F.lit(0)),
            "own": known,
            "own_turns": F.col("turns"),
        }
    )

    def odd(turns: Column) -> Column:
        return turns % 2 == 1

    # Of a split as a whole: what it leads to, if anything, and whether it swaps.
    whole = scanned.groupBy("file", "split").agg(
        F.max_by("own", F.when(F.col("own").isNotNull(), F.col("place"))).alias("own"),
        F.max("own_turns").alias("all_turns"),
    )
    leads_to = F.col("own.leads") != odd(F.col("all_turns") - F.col("own.turns"))
    splits = whole.select("file", "split", leads_to.alias("leads"), "all_turns")
    earlier = Window.partitionBy("file").orderBy("split")
    passed = earlier.rowsBetween(Window.unboundedPreceding, -1)
    turns_from = F.sum(F.when(F.col("leads").isNull(), F.col("all_turns")).otherwise(0))
    splits = splits.withColumn("turns", turns_from.over(earlier))
    mark = F.when(F.col("leads").isNotNull(), F.struct("leads", "turns"))
    splits = splits.withColumns(
        {
            "mark": F.last(mark, ignorenulls=True).over(passed),
            "turns": F.coalesce(F.lag("turns").over(earlier), F.lit(0)),
        }
    )
    begins = F.coalesce(
        F.col("mark.leads") != odd(F.col("turns") - F.col("mark.turns")), odd(F.col("turns"))
    )
    starts = splits.select("file", "split", begins.alias("begins"))
    entered = scanned.join(F.broadcast(starts), ["file", "split"])
    inside = F.coalesce(
        F.col("known.leads") != odd(F.col("turns") - F.col("known.turns")),
        F.col("begins") != odd(F.col("turns")),
    )
    told = entered.select(
        "file", "split", "place", "value", "from_out", "from_in", inside.alias("inside")
    )
    begun = F.when(~F.col("inside"), F.col("place"))
    return told.withColumn("first", F.last(begun, ignorenulls=True).over(split))


def records(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The records of CSV files, one `record` each, however many lines it has. Lines end
    with a line feed, or with a carriage return and a line feed; a record that begins
    with a quote that never ends goes on to the end of its file. Empty lines between
    records are none."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    text = F.regexp_replace("value", r"\r$", "")
    lines = lines.withColumns(
        {"from_out": _after(text, _START), "from_in": _after(text, _QUOTED)}
    )
    placed = _entries(lines)
    ends_inside = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    alone = ~F.col("inside") & ~ends_inside
    single = placed.where(alone).select(F.col("value").alias("record"))
    # Lines of a record that began in an earlier split have no first line in their own:
    # it is the last beginning before. There is a row per split to look it up in.
    parts = placed.where(~alone)
    last = placed.groupBy("file", "split").agg(F.max("first").alias("last"))
    ordered = Window.partitionBy("file").orderBy("split")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(
        "file", "split", F.last("last", ignorenulls=True).over(earlier).alias("carried")
    )
    parts = parts.join(F.broadcast(carried), ["file", "split"]).select(
        "file",
        F.coalesce("first", "carried").alias("first"),
        F.struct("split", "place", "value").alias("line"),
    )
    joined = F.array_join(
        F.transform(F.sort_array(F.collect_list("line")), lambda part: part["value"]), "\n"
    )
    longer = parts.groupBy("file", "first").agg(joined.alias("record")).select("record")
    ended = F.regexp_replace("record", r"\r\z", "").alias("record")
    return single.unionByName(longer).select(ended).where("record <> ''")


def read_split_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    options: dict[str, str],
) -> DataFrame:
    """CSV files without a header as Spark's reader with `multiLine` reads them, but with
    a task per split of a file instead of one per file."""
    parsed = F.from_csv("record", schema.toDDL(), {**options, "multiLine": "true"})
    return records(spark, path).select(parsed.alias("row")).select("row.*")
