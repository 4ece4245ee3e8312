"""Document fingerprints: Merkle trees over clauses, paragraphs and sections.

A text's lines are its paragraphs. A paragraph's leaves are clauses of some 32 to 256
characters that end where a word ends in one of a few letters or signs, so an edit
moves only the clauses around it. A section ends with a paragraph whose hash has three
zero bits, so an added paragraph moves only its own section. The root hashes the
sections, these their paragraphs, these their clauses: equal roots mean equal texts,
and two trees are compared from the top, branch by branch.

A fingerprint is the tree written down: 32 digits of the root, a colon, and for each
paragraph the codes of its clauses (six digits each) and `;`, or `/` where a section
ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.llm.common import whole_text

CLAUSE = r"(?s).{32,256}?(?:(?<=[,.;:!?|nsey] )|\z)|.{1,256}"
CODE = 6
ROOT = 32
#: Rows that a task orders at once when each document meets the next one.
BUCKET_ROWS = 2_000
MOST_BUCKETS = 4_000


def _hex(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; a null text is an empty one."""
    leaves = F.transform(
        F.split(whole_text(text), "\n", -1),
        lambda p: F.transform(F.regexp_extract_all(p, F.lit(CLAUSE), F.lit(0)), lambda c: _hex(F.xxhash64(c))),
    )
    paragraphs = F.transform(
        leaves,
        lambda hashes: F.struct(
            F.xxhash64(F.array_join(hashes, "")).alias("node"),
            F.array_join(F.transform(hashes, lambda h: F.right(h, F.lit(CODE))), "").alias("codes"),
        ),
    )
    parted = F.transform(
        paragraphs,
        lambda p: F.struct(
            _hex(p["node"]).alias("node"),
            F.concat(p["codes"], F.when(p["node"].bitwiseAND(F.lit(7)) == 0, "/").otherwise(";")).alias("codes"),
        ),
    )
    # both strings end sections at the same places
    written_down = F.transform(
        F.array(parted),
        lambda tree: F.struct(
            F.array_join(
                F.transform(tree, lambda p: F.concat(p["node"], F.right(p["codes"], F.lit(1)))), ""
            ).alias("nodes"),
            F.array_join(F.transform(tree, lambda p: p["codes"]), "").alias("codes"),
        ),
    )
    return F.transform(
        written_down,
        lambda t: F.concat(
            F.left(
                F.sha2(
                    F.array_join(F.transform(F.split(t["nodes"], "/", -1), lambda s: _hex(F.xxhash64(s))), ""), 256
                ),
                F.lit(ROOT),
            ),
            F.lit(":"),
            t["codes"],
        ),
    )[0]


def root_of(print_: Column) -> Column:
    return F.left(print_, F.lit(ROOT))


def likeness(a: Column, b: Column) -> Column:
    """1 if the roots are equal, else the share of clauses that two trees have in common,
    by descent: sections that both have count with all their clauses and are not opened,
    of the others the paragraphs that both have, and of the other paragraphs the clauses
    that both have. The share is twice what is common over all of both (0 if neither has
    any clause). Equal nodes that are met at one level of a tree count once. Two different
    clauses have the same code with a chance of one in 16 million."""
    weight = lambda nodes: F.length(F.translate(F.array_join(nodes, ""), ";", "")) / CODE
    bound = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def compared(left: Column, right: Column, use) -> Column:
        """`use` of the nodes that both have, and those that one alone has."""
        return bound(
            F.struct(left.alias("left"), right.alias("right")),
            lambda t: bound(
                F.struct(
                    F.array_intersect(t["left"], t["right"]).alias("both"),
                    F.array_except(t["left"], t["right"]).alias("left"),
                    F.array_except(t["right"], t["left"]).alias("right"),
                ),
                use,
            ),
        )

    paragraphs = lambda opened: F.split(F.array_join(opened, ";"), ";", -1)
    clauses = lambda opened: F.regexp_extract_all(
        F.array_join(opened, ";"), F.lit("[0-9a-f]{%d}" % CODE), F.lit(0)
    )
    # twice the common clauses, and the clauses that one tree alone has
    found = compared(
        sections(a),
        sections(b),
        lambda s: compared(
            paragraphs(s["left"]),
            paragraphs(s["right"]),
            lambda p: compared(
                clauses(p["left"]),
                clauses(p["right"]),
                lambda c: F.struct(
                    (2.0 * (weight(s["both"]) + weight(p["both"]) + F.size(c["both"]))).alias("common"),
                    (F.size(c["left"]) + F.size(c["right"])).alias("alone"),
                ),
            ),
        ),
    )
    share = bound(
        found,
        lambda f: F.when(f["common"] + f["alone"] > 0, f["common"] / (f["common"] + f["alone"])).otherwise(0.0),
    )
    return F.when(root_of(a) == root_of(b), 1.0).otherwise(share)


def sections(print_: Column) -> Column:
    """The written-down sections of a fingerprint, in order."""
    return F.split(F.substring(print_, ROOT + 2, 1 << 30), "/", -1)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """The numbers, from zero, of the paragraphs of `a` that `b` has nowhere: only the
    sections that differ are opened. An empty array if the roots are equal."""
    known = F.array_distinct(F.split(F.array_join(F.array_except(sections(b), sections(a)), ";"), ";", -1))
    opened = F.transform(
        sections(a),
        lambda s: F.struct(F.split(s, ";", -1).alias("paragraphs"), F.array_contains(sections(b), s).alias("same")),
    )
    flags = F.flatten(
        F.transform(
            opened,
            lambda s: F.transform(s["paragraphs"], lambda p: s["same"] | F.array_contains(known, p)),
        )
    )
    places = F.filter(
        F.transform(flags, lambda same, k: F.when(~same, k)), lambda k: k.isNotNull()
    )
    return F.when(root_of(a) == root_of(b), F.array().cast("array<int>")).otherwise(places)


def _place(value: Column, cuts: list) -> Column:
    """How many of the sorted cuts are at most the value: every 64th is tried, and then
    those of one step."""
    if not cuts:
        return F.lit(0)
    step = 64
    upto = lambda xs: F.size(F.filter(xs, lambda c: c <= value))
    every = F.array(*[F.lit(c) for c in cuts])
    steps = cuts[step - 1 :: step]
    before = (upto(F.array(*[F.lit(c) for c in steps])) if steps else F.lit(0)) * step
    return before + upto(F.slice(every, before + 1, F.lit(step)))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows of `doc_id, text` with `fingerprint`, and `next_text, next_fingerprint` of the
    row that follows by ascending id; the first follows the last.

    Rows are dealt into ranges of ids by quantiles, one window per range, so no task
    orders more than its range; the first row of the next range is lent to each range.
    Rows of equal ids are ordered by the hash of their text, rows without an id come
    last. Ids are numbers.
    """
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.count()
    buckets = min(MOST_BUCKETS, max(shuffles, rows // BUCKET_ROWS))
    cuts = docs.agg(
        F.percentile_approx("doc_id", F.array(*[F.lit(k / buckets) for k in range(1, buckets)]) if buckets > 1 else F.array(F.lit(0.5)), 10 * buckets).alias("q")
    ).first()["q"]
    cuts = sorted(set(cuts or []))
    bucket = F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(_place(F.col("doc_id"), cuts)).cast("int")
    dealt = docs.withColumn("bucket", bucket)
    firsts = docs.select(bucket.alias("at"), "doc_id").groupBy("at").agg(F.min("doc_id").alias("first_id"))
    # at most one row per bucket: this window and the broadcast are bounded by that
    order = Window.partitionBy().orderBy("at")
    lent_to = firsts.select(
        F.col("at").alias("lent_to"),
        F.coalesce(F.lead("at").over(order), F.min("at").over(Window.partitionBy())).alias("lent_from"),
    )
    lent_ids = lent_to.join(firsts, F.col("lent_from") == F.col("at")).select("lent_to", "lent_from", "first_id")
    lent = (
        dealt.join(
            F.broadcast(lent_ids),
            F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("bucket") == F.col("lent_from")),
        )
        .withColumn("bucket", F.col("lent_to"))
        .select(*docs.columns, "bucket", F.lit(True).alias("lent"))
    )
    window = Window.partitionBy("bucket").orderBy(
        "lent", F.col("doc_id").asc_nulls_last(), F.xxhash64("text")
    )
    return (
        dealt.withColumn("lent", F.lit(False))
        .unionByName(lent)
        # after the few lent rows are found, and once for all others
        .withColumn("fingerprint", fingerprint(F.col("text")))
        .withColumns(
            {
                "next_text": F.lead("text").over(window),
                "next_fingerprint": F.lead("fingerprint").over(window),
            }
        )
        .where("not lent")
        .drop("lent", "bucket")
    )


def compare_with_edit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next`.

    The edited text is a text with its last floor(n_chars / 2) characters replaced by
    the first as many (or all) of the next document. A null text is an empty one; a
    single document is its own next; repeated rows follow each other; an empty table
    gives no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    printed = with_next(rows)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = printed.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited",
        F.concat(
            F.expr("substring(text, 1, cast(n_chars - floor(n_chars / 2) as int))"),
            F.substring("next_text", F.lit(1), half),
        ),
    )
    return edited.withColumn("edited_fingerprint", fingerprint(F.col("edited"))).select(
        "doc_id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
