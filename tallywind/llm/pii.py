"""Personal data: fixed patterns, and contextual extraction bootstrapped from them.

The fixed patterns give seeds, which are the known instances. Words with a digit or `@`
that no seed touches are instances, too, as far as nothing but signs stands between them.
The word before an instance, the word after it, both, the label glued to its front and
its form (digits by number, letters as one) are its lexical patterns. Spark scores this
graph of patterns and instances in rounds: a pattern is as good, for a kind, as the share
of its instances that are of that kind; an instance is as good as its patterns make it
together (noisy or). Instances that good patterns vouch for become spans of the kind these
patterns carry. What a fixed pattern matches and its test refuses is never of that kind,
and says nothing about patterns of that kind.

All of it is column expressions and joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywind.llm.common import bounded_broadcast, whole_text, written

KINDS = ("email", "ip", "card", "phone")

# The four base patterns, with possessive repeats where nothing could be given back,
# so that long runs cost one pass. A match starts at the start of its run, or where
# the last match ended (\G).
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_W = r"\x20\x09-\x0D"
#: A word with a digit or `@`.
MARKED = rf"(?<![^{_W}])[^{_W}0-9@]*+[0-9@][^{_W}]*+"
#: What may stand between two words of one instance: signs, on the same line.
BETWEEN = r"^[^\p{L}\p{N}\n]*\z"
#: Signs that are no part of an instance's form.
NOISE = r"[^\p{L}\p{N}@+().:/_\x20-]"
#: Code points of a text's pieces: words and seeds that touch meet in one of these.
BLOCK = 64


@dataclass(frozen=True)
class Settings:
    rounds: int = 3
    #: Least pattern score, distinct seeds and instance score of a discovery.
    pattern: float = 0.8
    seeds: int = 5
    instance: float = 0.8
    #: Unknown instances that every pattern is thought to have had besides.
    doubt: float = 1.0


SETTINGS = Settings()
#: Discovered rows up to which they are broadcast to the documents.
BROADCAST_FOUND = 50_000
_STEP = 256
#: Code points of the pieces from which a text is put together again.
_PIECE = 1_024


def _found(text: Column, pattern: str, may: Column) -> Column:
    """`gaps, hits`: the text between the matches of a pattern, and the matches."""
    none = F.array().cast("array<string>")
    return F.struct(
        F.when(may, F.split(text, pattern, -1)).otherwise(none).alias("gaps"),
        F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none).alias("hits"),
    )


def _bound(value: Column, use) -> Column:
    """What `use` makes of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _totals(steps: Column, combine, of: Column, use) -> Column:
    """`use(total, x, i)` for each `x` of an array `of`: total is what an associative
    function with the neutral element 0 makes of `steps` up to and with number i. It is
    taken from totals at every `_STEP`th place."""
    total = lambda xs: F.aggregate(xs, F.lit(0), combine)
    places = F.sequence(F.lit(0), F.floor(F.size(steps) / _STEP).cast("int"))
    return _bound(
        F.transform(places, lambda k: total(F.slice(steps, F.lit(1), k * _STEP))),
        lambda before: F.transform(
            of,
            lambda x, i: use(
                combine(
                    F.get(before, F.floor(i / _STEP).cast("int")),
                    total(F.slice(steps, (i - i % _STEP) + 1, i % _STEP + 1)),
                ),
                x,
                i,
            ),
        ),
    )


def _steps(found: Column) -> Column:
    """The lengths from the end of a match to the end of the next one."""
    return F.transform(
        found["hits"], lambda v, i: F.length(F.get(found["gaps"], i)) + F.length(v)
    )


def _placed(steps: Column, hits: Column) -> Column:
    """`s, e, v` of each match: where it starts and ends in code points, and its text.
    `steps` is a column that is not computed again per match."""
    return _totals(
        steps, lambda a, x: a + x, hits, lambda end, v, i: _span(end - F.length(v), v)
    )


def _span(start: Column, value: Column) -> Column:
    return F.struct(
        start.cast("int").alias("s"),
        (start + F.length(value)).cast("int").alias("e"),
        value.alias("v"),
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
    total = F.aggregate(
        F.transform(
            F.filter(F.split(F.reverse(value), ""), lambda c: c != ""), lambda c: c.cast("int")
        ),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("sum")),
        lambda a, d: F.struct(
            (a["n"] + 1).alias("n"),
            (a["sum"] + F.when(a["n"] % 2 == 1, doubled(d)).otherwise(d)).alias("sum"),
        ),
    )["sum"]
    return total % 10 == 0


#: A decimal part of at most 255, leading zeros allowed.
_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


def _holds(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(13, 19) & passes_luhn(digits)
    return F.length(digits).between(9, 15)


def _base(kind: str) -> Column:
    """The spans of the kind's column whose match passes the kind's test."""
    return F.transform(
        F.filter(F.col(kind), lambda x: _holds(kind, x["v"])),
        lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v")),
    )


def refused(value: Column) -> Column:
    """The kind whose pattern an instance matches as a whole and whose test it fails."""
    shapes = {"ip": IP, "card": CARD, "phone": PHONE}
    return F.coalesce(
        *[F.when(value.rlike(f"^(?:{shape})$") & ~_holds(k, value), k) for k, shape in shapes.items()]
    )


def _last_word(gap: Column) -> Column:
    return F.reverse(F.regexp_extract(F.reverse(gap), rf"^[{_W}]+([^{_W}]+)", 1))


def scanned(docs: DataFrame, doc_id: str, text: str, carry: bool) -> DataFrame:
    """`row, doc_id, seeds, words` per row of the documents, written: the base spans with
    their texts by kind and start, and the marked words with what stands beside them: the
    nearest words, and whether the word before is marked and part of the same instance.
    `row` numbers the rows."""
    body = F.col("_text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        whole_text(text).alias("_text"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")] if carry else []),
    )
    digit, at = body.rlike("[0-9]"), F.instr(body, "@") > 0
    searched = rows.select(
        "*",
        _found(body, EMAIL, at).alias("email"),
        _found(body, IP, digit).alias("ip"),
        _found(body, CARD, digit).alias("card"),
        _found(body, PHONE, digit & (F.instr(body, "+") > 0)).alias("phone"),
        _found(body, MARKED, digit | at).alias("word"),
    )
    found = (*KINDS, "word")
    stepped = searched.select("*", *[_steps(F.col(k)).alias(f"{k}_steps") for k in found])
    placed = stepped.select(
        *rows.columns,
        *[_placed(F.col(f"{k}_steps"), F.col(k)["hits"]).alias(k) for k in KINDS],
        _placed(F.col("word_steps"), F.col("word.hits")).alias("marked"),
        "word.gaps",
    )
    gap = lambda i: F.get(F.col("gaps"), i)
    beside = lambda i: F.get(F.col("marked"), i)["v"]
    blank = lambda g: ~g.rlike(rf"[^{_W}]")
    words = F.transform(
        F.col("marked"),
        lambda x, i: F.struct(
            i.alias("i"),
            x["s"].alias("s"),
            x["e"].alias("e"),
            x["v"].alias("v"),
            # the words beside it may be marked ones, of which the form counts
            F.when(blank(gap(i)), form(F.coalesce(beside(i - 1), F.lit(""))))
            .otherwise(_last_word(gap(i)))
            .alias("before"),
            F.when(blank(gap(i + 1)), form(F.coalesce(beside(i + 1), F.lit(""))))
            .otherwise(F.regexp_extract(gap(i + 1), rf"^[{_W}]+([^{_W}]+)", 1))
            .alias("after"),
            gap(i).rlike(BETWEEN).alias("joins"),
        ),
    )
    return written(
        placed.select(
            "row",
            "doc_id",
            F.concat(*[_base(k) for k in KINDS]).alias("seeds"),
            words.alias("words"),
            *(["_text", "kept"] if carry else []),
        ),
        "pii-scan",
    )


def form(value: Column) -> Column:
    """The form of an instance: letters as `a`, digits as so many `9`, or one where an
    `@` is; without signs that only stand around."""
    lettered = F.regexp_replace(F.regexp_replace(value, NOISE, ""), r"\p{L}+", "a")
    digits = F.regexp_replace(lettered, r"\p{N}", "9")
    return F.trim(
        F.regexp_replace(
            F.when(F.instr(value, "@") > 0, F.regexp_replace(digits, "9+", "9")).otherwise(digits), r"\x20+", " "
        )
    )


def instances(scan: DataFrame) -> DataFrame:
    """`row, s, e, v, kind, label, before, after` per instance, written. Seeds have their
    kind; the others are words that no seed touches.

    Words and seeds meet by the blocks of the text that they lie in, so a text with many
    of both costs their number, not their product.
    """
    words = scan.select("row", F.explode("words").alias("w")).select("row", "w.*")
    seeds = scan.select("row", F.explode("seeds").alias("b")).select("row", "b.*")
    blocks = lambda s, e: F.explode(
        F.sequence(F.floor(s / BLOCK), F.floor((e - 1) / BLOCK))
    ).alias("block")
    lying = words.select("*", blocks(F.col("s"), F.col("e")))
    placed = seeds.select(
        F.col("row").alias("seed_row"),
        "kind",
        F.col("s").alias("from"),
        F.col("e").alias("to"),
        F.col("v").alias("seed"),
        blocks(F.col("s"), F.col("e")).alias("seed_block"),
    )
    touching = lying.join(
        placed,
        (F.col("row") == F.col("seed_row"))
        & (F.col("block") == F.col("seed_block"))
        & (F.col("from") < F.col("e"))
        & (F.col("to") > F.col("s")),
    )
    touched = written(touching.drop("block", "seed_block", "seed_row", "joins"), "pii-touched")
    front = F.struct("before", F.expr("substring(v, 1, greatest(`from` - s, 0))").alias("front"))
    known = (
        touched.groupBy("row", "kind", F.col("from").alias("s"), F.col("to").alias("e"), F.col("seed").alias("v"))
        .agg(F.min_by(front, "i").alias("first"), F.max_by("after", "i").alias("after"))
        .select(
            "row", "s", "e", "v", "kind",
            F.lower(F.regexp_extract("first.front", r"([A-Za-z_]+[=:])[^0-9A-Za-z]*$", 1)).alias("label"),
            "first.before", "after",
        )
    )
    order = Window.partitionBy("row").orderBy("i")
    begins = ~(F.col("joins") & F.coalesce(F.lag("i").over(order) == F.col("i") - 1, F.lit(False)))
    parts = (
        words.join(touched.select("row", "i").distinct(), ["row", "i"], "left_anti")
        .withColumn("begins", begins.cast("int"))
        .withColumn("part", F.sum("begins").over(order))
        .groupBy("row", "part")
        .agg(
            F.array_sort(F.collect_list(F.struct("i", "s", "e", "v"))).alias("ws"),
            F.min_by("before", "i").alias("before"),
            F.max_by("after", "i").alias("after"),
        )
        .withColumn("whole", F.array_join(F.transform("ws", lambda w: w["v"]), " "))
    )
    # a label and signs at either end are not part of the instance
    ends = r"(?s)^([^0-9A-Za-z+(]*+(?:[A-Za-z_]++[=:][^0-9A-Za-z+(]*+)?+)(.*[0-9A-Za-z)])(.*)$"
    unknown = parts.select(
        "row",
        (F.col("ws")[0]["s"] + F.length(F.regexp_extract("whole", ends, 1))).cast("int").alias("s"),
        (F.element_at("ws", -1)["e"] - F.length(F.regexp_extract("whole", ends, 3))).cast("int").alias("e"),
        F.regexp_extract("whole", ends, 2).alias("v"),
        F.lit(None).cast("string").alias("kind"),
        F.lower(F.regexp_extract(F.regexp_extract("whole", ends, 1), r"([A-Za-z_]+[=:])", 1)).alias("label"),
        "before",
        "after",
    ).where("v <> ''")
    return written(known.unionByName(unknown), "pii-instances")


def with_patterns(found: DataFrame) -> DataFrame:
    """`pattern, v, kind, refused` per instance and pattern. A pattern of neighbours carries
    the class of the instance (with `@`, digits alone, digits and letters)."""
    shape = (
        F.when(F.instr("v", "@") > 0, "at").when(F.col("v").rlike("[A-Za-z]"), "mixed").otherwise("digits")
    )
    plain = lambda c: F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")
    before, after = plain(F.col("before")), plain(F.col("after"))
    has = lambda c: c != ""
    return (
        found.select(
            F.explode(
                F.filter(
                    F.array(
                        F.when(has(before), F.concat_ws(" ", F.lit("after"), before, shape)),
                        F.when(has(after), F.concat_ws(" ", F.lit("before"), after, shape)),
                        F.when(has(before) & has(after), F.concat_ws(" ", F.lit("between"), before, after, shape)),
                        F.when(has(F.col("label")), F.concat_ws(" ", F.lit("glued"), "label", shape)),
                        F.concat_ws(" ", F.lit("form"), form(F.col("v"))),
                    ),
                    lambda x: x.isNotNull(),
                )
            ).alias("pattern"),
            "v",
            "kind",
        )
        .groupBy("pattern", "v")
        .agg(F.max("kind").alias("kind"))
        .withColumn("refused", F.when(F.col("kind").isNull(), refused(F.col("v"))))
    )


def scored_instances(found: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """`v, kind`: instances that no base pattern knows and good patterns vouch for.

    Rounds over distinct pairs of pattern and instance; every score is a sum over
    them, combined by each task before the shuffle.
    """
    edges = written(with_patterns(found), "pii-edges")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("members"))
    # instances that are surely not of a kind do not speak against its patterns
    others = (
        edges.where("refused is not null")
        .groupBy("pattern", F.col("refused").alias("kind"))
        .agg(F.count("*").alias("others"))
    )
    known = edges.where("kind is not null").select("pattern", "kind", F.lit(1.0).alias("p"), F.lit(1).alias("seed"))
    unknown = edges.where("kind is null").select("pattern", "v", "refused")
    beliefs = known
    for _ in range(settings.rounds):
        patterns = (
            beliefs.groupBy("pattern", "kind")
            .agg(F.sum("p").alias("belief"), F.sum("seed").alias("seeds"))
            .where(F.col("seeds") >= settings.seeds)
            .join(sizes, "pattern")
            .join(others, ["pattern", "kind"], "left")
            .withColumn(
                "score",
                F.col("belief") / (F.col("members") - F.coalesce("others", F.lit(0)) + settings.doubt),
            )
            .where(F.col("score") >= settings.pattern)
            .select("pattern", "kind", "score")
        )
        good = written(patterns, "pii-patterns")
        votes = unknown.join(good, "pattern").where("refused is null or refused <> kind")
        voted = votes.groupBy("v", "kind").agg(
            (1.0 - F.exp(F.sum(F.log(1.0 - F.col("score"))))).alias("p")
        )
        believed = unknown.join(voted, "v").where("refused is null or refused <> kind")
        beliefs = known.unionByName(believed.select("pattern", "kind", "p", F.lit(0).alias("seed")))
    best = voted.groupBy("v").agg(F.max(F.struct("p", F.col("kind"))).alias("best"))
    return best.where(F.col("best.p") >= settings.instance).select("v", F.col("best.kind").alias("as_kind"))


def _ordered(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.transform(
        spans,
        lambda x: F.struct(
            F.array_position(rank, x["kind"]).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")),
    )


def _extracted(docs, doc_id, text, settings, carry) -> DataFrame:
    scan = scanned(docs, doc_id, text, carry)
    found = instances(scan)
    accepted = scored_instances(found, settings)
    base = F.transform("seeds", lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    discovered = written(
        found.where("kind is null")
        .join(accepted, "v")
        .select("row", F.struct(F.col("as_kind").alias("kind"), "s", "e").alias("span"))
        .groupBy(F.col("row").alias("found_row"))
        .agg(F.collect_set("span").alias("more")),
        "pii-found",
    )
    few = bounded_broadcast(discovered, discovered.count(), BROADCAST_FOUND)
    return (
        scan.drop("words")
        .withColumn("base", base)
        .join(few, F.col("row") == F.col("found_row"), "left")
        .withColumn(
            "spans",
            F.when(F.col("more").isNull(), F.col("base")).otherwise(_ordered(F.concat("base", "more"))),
        )
    )


def extract(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = SETTINGS
) -> DataFrame:
    """`doc_id, base, spans` for every row: arrays of `kind, s, e`, offsets in code
    points, end exclusive, by kind as listed in KINDS and then start. `base` holds
    what the fixed patterns match, `spans` these and the discovered ones.

    A null text is an empty one and has no spans. Repeated rows are searched alike,
    and count once as instances. An instance with equal scores for two kinds is of the
    later kind by name. An empty table gives no rows.
    """
    return _extracted(docs, doc_id, text, settings, False).select("doc_id", "base", "spans")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def joined(spans: Column) -> Column:
    """Spans as `kind:start:end`, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def covered_text(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap
    are replaced by the first one's kind."""
    by_place = F.array_sort(
        F.transform(
            spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["kind"].alias("kind"))
        )
    )
    pieces = F.regexp_extract_all(text, F.lit(r"(?s).{1,%d}" % _PIECE), F.lit(0))

    def between(cut: Column, s: Column, e: Column) -> Column:
        """The text from s to e, of its pieces: what is far from both is not looked at."""
        first, last = F.floor(s / _PIECE).cast("int"), F.floor((e - 1) / _PIECE).cast("int")
        front = F.substring(F.get(cut, first), s % _PIECE + 1, F.lit(_PIECE))
        return (
            F.when(e <= s, "")
            .when(first == last, F.substring(F.get(cut, first), s % _PIECE + 1, e - s))
            .otherwise(
                F.concat(
                    front,
                    F.array_join(F.slice(cut, first + 2, last - first - 1), ""),
                    F.substring(F.get(cut, last), F.lit(1), (e - 1) % _PIECE + 1),
                )
            )
        )

    def cover(t: Column) -> Column:
        put = lambda at, x: F.when(
            x["s"] >= at,
            F.concat(between(t["cut"], at, x["s"]), F.lit("["), F.upper(x["kind"]), F.lit("]")),
        ).otherwise("")
        further = lambda a, x: F.greatest(a, x)
        covered = _totals(t["ends"], further, t["spans"], lambda at, x, i: put(at, x))
        rest = between(t["cut"], F.array_max(t["ends"]), t["n"])
        return F.concat(F.array_join(covered, ""), rest)

    # where the text before a span ends: at the furthest end of the spans before it
    ends = lambda xs: F.concat(F.array(F.lit(0)), F.transform(xs, lambda x: -x["e"]))
    ending = _bound(
        F.struct(by_place.alias("spans"), ends(by_place).alias("ends"), pieces.alias("cut"), F.length(text).alias("n")),
        cover,
    )
    return F.when(F.size(spans) > 0, ending).otherwise(text)


def redact(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = SETTINGS
) -> DataFrame:
    """The rows of the documents with personal data covered in their text; null texts
    stay null, other columns as they are."""
    found = _extracted(docs, doc_id, text, settings, True)
    clean = F.when(
        F.col(f"kept.`{text}`").isNotNull(), covered_text(F.col("_text"), F.col("spans"))
    )
    return found.select(
        *[clean.alias(c) if c == text else F.col(f"kept.`{c}`").alias(c) for c in docs.columns]
    )
