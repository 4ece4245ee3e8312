"""Repair of the structure of conversations.

A conversation is well formed if the first letters of its roles read `(s?(ua)+)?`:
one system turn at most, at the start, then user and assistant in turn. Rows are kept,
given another role, deleted, or joined by new empty turns; the cheapest way is found by
depth-first branch and bound and told as an audit, one letter per edit in order: Keep,
Rerole, Delete, Insert.

How it is spread. What the search needs of a row is one character (its role's first
letter and its fault), so rows are put in order without their texts, by ranges, and cut
into blocks of BLOCK rows whatever conversation they belong to. A block that holds a
whole conversation is solved at once. Of longer conversations each block is solved from
every state to every state, and MERGED blocks at a time become one, in rounds. No task
ever holds the rows of a conversation; what a conversation ends up with in one row is its
audit, a character per row. Texts are shuffled once, to be written out in order as a
stream of rows.

Nulls: a null role or text is one space; a null turn comes first; rows with a null
conversation are one conversation. Rows of one turn are ordered by role and the hash of
role and text, so repeated rows are interchangeable. An empty table has no rows in any
result. Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywind.llm.common import ready_for_python, written

#: Rows of a block, and blocks that become one in a round.
BLOCK = 1_024
MERGED = 256

#: What each edit costs, and what a truncated row costs that stays.
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5

_VISIBLE = r"[^\x20\x09-\x0D]"

# A row is one character: the first letter of its role (o: any other), lower case if
# nothing is wrong, upper case if it is truncated, shifted to a digit if it must go.
_INITIALS = "suao"
_GONE = "1234"
_LEGAL = {"su", "ua", "au"}

# States of `(s?(ua)+)?`: nothing yet, after s, after u, after a.
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_NEXT = {
    _EMPTY: {"s": _SYSTEM, "u": _USER},
    _SYSTEM: {"u": _USER},
    _USER: {"a": _ASSISTANT},
    _ASSISTANT: {"u": _USER},
}
_REACHES = {
    _EMPTY: {_EMPTY, _SYSTEM, _USER, _ASSISTANT},
    _SYSTEM: {_SYSTEM, _USER, _ASSISTANT},
    _USER: {_USER, _ASSISTANT},
    _ASSISTANT: {_USER, _ASSISTANT},
}
_ENDS = {_EMPTY, _ASSISTANT}
_NEVER = 1 << 60


def _bounds(codes: str, goal: int | None) -> list[tuple[int, int]]:
    """Per suffix the least cost where a user, and where an assistant is due next.

    The rules are relaxed to the alternation of user and assistant: a system turn can
    be reroled or deleted but not kept, and after one alone a conversation may end.
    """
    if goal is None:
        user, assistant = 0, INSERT
    elif goal == _USER:
        user, assistant = _NEVER, 0
    else:
        user, assistant = 0, _NEVER
    found = [(user, assistant)]
    for code in reversed(codes):
        if code in _GONE:
            user, assistant = user + DELETE, assistant + DELETE
        else:
            extra = CUT_SHORT if code.isupper() else 0
            letter = code.lower()
            as_user = extra + (0 if letter == "u" else REROLE)
            as_assistant = extra + (0 if letter == "a" else REROLE)
            user, assistant = (
                min(user + DELETE, assistant + as_user),
                min(assistant + DELETE, user + as_assistant),
            )
        user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
        found.append((user, assistant))
    found.reverse()
    return found


def _least(state: int, bound: tuple[int, int]) -> int:
    """A lower bound of what is still to pay. A kept system turn could be deleted
    instead, which is the relaxed problem, at DELETE more."""
    if state == _USER:
        return bound[1]
    return max(0, bound[0] - DELETE) if state == _EMPTY else bound[0]


@lru_cache(maxsize=20_000)
def search(codes: str, entry: int = _EMPTY, goal: int | None = None) -> tuple[int, str] | None:
    """The cheapest (cost, audit) that leads from a state over the rows to the goal
    state, or with goal None to an end; of equal cost the ASCII-least audit; None if no
    way leads there. With a goal, turns are inserted only before rows.

    Depth first with an explicit stack. A node is a number of rows done and a state; its
    prefix is given up if its cost and the suffix's lower bound exceed the incumbent's
    cost, if they equal it and its audit comes later, or if the node has been reached by
    a prefix as good. (Audits of one cost and as many rows are never prefixes of each
    other, since each letter has a cost of its own row, so comparing prefixes is safe.)
    The incumbent is optimal when the stack is empty.
    """
    bounds = _bounds(codes, goal)
    rows = len(codes)
    best: tuple[int, str] | None = None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        done, state, cost, audit = stack.pop()
        if best is not None:
            least = cost + _least(state, bounds[done])
            if least > best[0] or (least == best[0] and audit > best[1][: len(audit)]):
                continue
        known = reached.get((done, state))
        if known is not None and known <= (cost, audit):
            continue
        reached[done, state] = (cost, audit)
        if done == rows and (state in _ENDS if goal is None else state == goal):
            if best is None or (cost, audit) < best:
                best = (cost, audit)
            continue
        ways = []
        if done < rows:
            code = codes[done]
            ways.append((DELETE, "D", done + 1, state))
            if code not in _GONE:
                extra = CUT_SHORT if code.isupper() else 0
                for role, after in _NEXT[state].items():
                    if role == code.lower():
                        ways.append((extra, "K", done + 1, after))
                    elif role != "s":
                        ways.append((extra + REROLE, "R", done + 1, after))
        if done < rows or goal is None:
            for role, after in _NEXT[state].items():
                if role != "s":
                    ways.append((INSERT, "I", done, after))
        children = []
        for price, letter, at, after in ways:
            if goal is not None and goal not in _REACHES[after]:
                continue
            rest = _least(after, bounds[at])
            if rest < _NEVER:
                children.append((cost + price + rest, letter, at, after, cost + price))
        children.sort(reverse=True)  # the most promising one is popped first
        for _, letter, at, after, spent in children:
            stack.append((at, after, spent, audit + letter))
    return best


def _initials(codes: str) -> str:
    return codes.lower().translate(str.maketrans(_GONE, _INITIALS))


def _illegal(initials: str) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))


# A solved piece of a conversation: its outer initials, its illegal neighbours, and
# (entry, goal, cost, audit) for every pair of states that a way joins.
_WAY = T.StructType(
    [
        T.StructField("entry", T.IntegerType()),
        T.StructField("goal", T.IntegerType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
    ]
)


def _piece(codes: str, whole: bool) -> dict:
    initials = _initials(codes)
    if whole:
        ways = [(_EMPTY, -1, *search(codes))]
    else:
        ways = [
            (entry, goal, *found)
            for entry in _STATES
            for goal in _REACHES[entry]
            if (found := search(codes, entry, goal)) is not None
        ]
    names = _WAY.names
    return {
        "first": initials[0],
        "last": initials[-1],
        "illegal": _illegal(initials),
        "ways": [dict(zip(names, way)) for way in ways],
    }


def _joined(pieces: list[dict], closing: bool) -> dict:
    """Neighbouring pieces as one; closing: also to the end of the conversation."""
    whole = pieces[0]
    ways = {(w["entry"], w["goal"]): (w["cost"], w["audit"]) for w in whole["ways"]}
    illegal, last = whole["illegal"], whole["last"]
    for piece in pieces[1:]:
        illegal += piece["illegal"] + (last + piece["first"] not in _LEGAL)
        last = piece["last"]
        longer: dict[tuple[int, int], tuple[int, str]] = {}
        for w in piece["ways"]:
            for entry in _STATES:
                if (before := ways.get((entry, w["entry"]))) is not None:
                    way = (before[0] + w["cost"], before[1] + w["audit"])
                    place = (entry, w["goal"])
                    if place not in longer or way < longer[place]:
                        longer[place] = way
        ways = longer
    if closing:
        missing = {_EMPTY: 0, _SYSTEM: 2, _USER: 1, _ASSISTANT: 0}
        ends = [
            (cost + INSERT * missing[goal], audit + "I" * missing[goal])
            for (entry, goal), (cost, audit) in ways.items()
            if entry == _EMPTY
        ]
        ways = {(_EMPTY, -1): min(ends)}
    names = _WAY.names
    return {
        "first": whole["first"],
        "last": last,
        "illegal": illegal,
        "ways": [dict(zip(names, (*place, *way))) for place, way in ways.items()],
    }


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the crc32 of `conv_id:turn` modulo 20 (nulls: one space): 0 drops
    the row, 1 empties its text, 2 takes out its `.`, `!` and `?`, 3 repeats it, 4 makes
    it the user's. `conv_id, turn, role, text`."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("harm"),
    ).where("harm <> 0")
    harm = F.col("harm")
    return rows.select(
        "conv_id",
        "turn",
        F.when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(harm == 1, "")
        .when(harm == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(harm == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _plain(rows: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return rows.select(
        "conv_id", "turn", *(F.coalesce(n, space).alias(n) for n in ("role", "text"))
    )


def _content() -> Column:
    """What makes two rows of a conversation the same, as a hash of 256 bits."""
    return F.unhex(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))


_ORDER = ("conv_id", "turn", "role", "content")


def in_order(rows: DataFrame) -> DataFrame:
    """Per row, without its text: `conv_id, turn, content, initial, blank, cut, pos`.
    Positions number all rows of the table in the order of conversations and turns.

    Rows are dealt by ranges of the whole sort key, a row number last, so neither a long
    conversation nor many equal rows meet in one task.
    """
    initial = F.substring("role", 1, 1)
    ends = F.regexp_extract("text", rf"(?s)({_VISIBLE})[\x20\x09-\x0D]*\z", 1)
    keyed = _plain(rows).select(
        "conv_id",
        "turn",
        "role",
        _content().alias("content"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (ends == "").alias("blank"),
        ((ends != "") & ~ends.isin(".", "!", "?")).alias("cut"),
        F.monotonically_increasing_id().alias("number"),
    )
    key = (*_ORDER, "number")
    dealt = keyed.repartitionByRange(*key).sortWithinPartitions(*key)
    sorted_rows = written(
        dealt.drop("role", "number").withColumns(
            {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}
        ),
        "turns-in-order",
    )
    # One row per task, numbered on the driver: how many rows come before its own.
    counts = sorted_rows.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before, starts = 0, []
    for row in sorted(counts.collect()):
        starts.append((row["part"], before - row["first"]))
        before += row["n"]
    shifts = rows.sparkSession.createDataFrame(starts, "part int, shift long")
    return sorted_rows.join(F.broadcast(shifts), "part").select(
        "conv_id",
        "turn",
        "content",
        "initial",
        "blank",
        "cut",
        (F.col("place") + F.col("shift")).alias("pos"),
    )


def with_faults(ordered: DataFrame) -> DataFrame:
    """Each row's first fault, `fault`: blank, duplicate, truncated or null."""
    # The hash names the content; with the conversation in it one key is never null.
    conv = F.coalesce(F.concat(F.lit(":"), F.col("conv_id").cast("string")), F.lit(""))
    keyed = ordered.withColumn("same", F.sha2(F.concat(conv.cast("binary"), "content"), 256))
    repeated = (
        keyed.groupBy("same")
        .agg(F.min("pos").alias("earliest"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    fault = (
        F.when(F.col("blank"), "blank")
        .when(F.col("pos") > F.col("earliest"), "duplicate")
        .when(F.col("cut"), "truncated")
    )
    return keyed.join(repeated, "same", "left").select(
        "conv_id", "turn", "initial", "pos", fault.alias("fault")
    )


def _pieces(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            {"conv_id": r["conv_id"], "block": r["block"], "whole": r["whole"]}
            | _piece(r["codes"], r["whole"])
            for r in batch.to_pylist()
        ]
        yield pa.RecordBatch.from_pylist(rows, schema)


def _merged(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            {"conv_id": r["conv_id"], "block": r["block"], "whole": r["closing"]}
            | _joined(r["pieces"], r["closing"])
            for r in batch.to_pylist()
        ]
        yield pa.RecordBatch.from_pylist(rows, schema)


def repairs(faulty: DataFrame, block: int = BLOCK, merged: int = MERGED) -> DataFrame:
    """`conv_id, cost, audit, illegal` for every conversation of rows with faults:
    illegal counts neighbours whose initials are none of su, ua, au. `block` and `merged`
    change how the work is cut, never a result."""
    ready_for_python(faulty)
    must_go = F.col("fault").isin("blank", "duplicate")
    code = (
        F.when(must_go, F.translate("initial", _INITIALS, _GONE))
        .when(F.col("fault") == "truncated", F.upper("initial"))
        .otherwise(F.col("initial"))
    )
    blocks = (
        faulty.withColumns({"code": code, "block": F.floor(F.col("pos") / block)})
        .groupBy("conv_id", "block")
        .agg(F.expr("listagg(code, '') within group (order by pos)").alias("codes"))
    )
    blocks = written(blocks, "turn-blocks")
    ends = blocks.groupBy(F.col("conv_id").alias("of")).agg(
        (F.min("block") == F.max("block")).alias("whole")
    )
    told = blocks.join(ends, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    schema = T.StructType(
        [
            faulty.schema["conv_id"],
            T.StructField("block", T.LongType()),
            T.StructField("whole", T.BooleanType()),
            T.StructField("first", T.StringType()),
            T.StructField("last", T.StringType()),
            T.StructField("illegal", T.LongType()),
            T.StructField("ways", T.ArrayType(_WAY)),
        ]
    )
    arrow = to_arrow_schema(schema)
    solved = written(told.mapInArrow(lambda b: _pieces(b, arrow), schema), "turn-pieces")
    found = solved.where("whole")
    parted = solved.where("not whole")
    last = parted.agg(F.max("block")).first()[0]
    while last is not None:
        last //= merged
        piece = F.struct("block", "first", "last", "illegal", "ways")
        grouped = parted.groupBy("conv_id", F.floor(F.col("block") / merged).alias("into")).agg(
            F.sort_array(F.collect_list(piece)).alias("pieces")
        )
        grouped = grouped.select(
            "conv_id", F.col("into").alias("block"), F.lit(last == 0).alias("closing"), "pieces"
        )
        larger = grouped.mapInArrow(lambda b: _merged(b, arrow), schema)
        parted = written(larger, "turn-pieces-merged")
        if last == 0:
            found, last = found.unionByName(parted), None
    way = F.col("ways")[0]
    return found.select(
        "conv_id", way["cost"].alias("cost"), way["audit"].alias("audit"), "illegal"
    )


_ROLES = {"s": None, "u": "user", "a": "assistant"}


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, place, role, text, edit) of the repaired turns from rows in order, each
    conversation's audit before its rows; after each conversation (conv_id, None, ...)."""
    current, audit, at, place, system = object(), "", 0, 0, False

    def due() -> str:
        return "user" if (place - system) % 2 == 0 else "assistant"

    def inserted():
        nonlocal at, place
        while at < len(audit) and audit[at] == "I":
            yield current, place, due(), "", "I"
            at, place = at + 1, place + 1

    begun = False
    for batch in batches:
        for conv, is_row, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if not is_row:
                if begun:
                    yield from inserted()
                    yield current, None, None, None, None
                current, audit, at, place, begun = conv, text, 0, 0, True
                # Only with a kept system turn is the number of turns odd.
                system = (len(audit) - audit.count("D")) % 2 == 1
                continue
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = due()
            yield current, place, role, text, edit
            place += 1
    if begun:
        yield from inserted()
        yield current, None, None, None, None


#: Characters of text in a batch that goes back.
_CHARS = 4_000_000


def _turns(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept, chars = [], 0
    for turn in _edited(batches):
        if turn[1] is None:
            continue
        kept.append(dict(zip(schema.names, turn)))
        chars += len(turn[3])
        if chars >= _CHARS or len(kept) >= 10_000:
            yield pa.RecordBatch.from_pylist(kept, schema)
            kept, chars = [], 0
    yield pa.RecordBatch.from_pylist(kept, schema)


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    kept, state = [], hashlib.sha256()
    for conv, place, role, text, _ in _edited(batches):
        if place is None:
            kept.append({"conv_id": conv, "repaired_sha256": state.hexdigest()})
            state = hashlib.sha256()
            if len(kept) >= 10_000:
                yield pa.RecordBatch.from_pylist(kept, schema)
                kept = []
        else:
            state.update(f"{chr(10) if place else ''}{role}:{text}".encode())
    yield pa.RecordBatch.from_pylist(kept, schema)


def _streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows in order behind the audit of their conversation, a conversation in one task
    as a sorted stream: nothing but its audit is held."""
    plain = _plain(rows)
    texts = plain.select("*", F.lit(True).alias("is_row"), _content().alias("content"))
    heads = audits.select(
        "conv_id",
        F.lit(None).cast(plain.schema["turn"].dataType).alias("turn"),
        F.lit("").alias("role"),
        F.col("audit").alias("text"),
        F.lit(False).alias("is_row"),
        F.lit(b"").alias("content"),
    )
    both = texts.unionByName(heads).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "is_row", *_ORDER[1:])
    ready_for_python(rows)
    return both.select("conv_id", "is_row", "role", "text")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The turns of the repaired conversations: `conv_id, place, role, text, edit`, with
    places from 0 and the edit that led to the turn (K, R or I). `audits` has `conv_id,
    audit` of `repairs`."""
    schema = T.StructType(
        [
            rows.schema["conv_id"],
            T.StructField("place", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
            T.StructField("edit", T.StringType()),
        ]
    )
    arrow = to_arrow_schema(schema)
    return _streamed(rows, audits).mapInArrow(lambda b: _turns(b, arrow), schema)


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """`conv_id, repaired_sha256`: the hash of the repaired turns as `role:text`, joined
    by line ends. A hash reads its conversation from start to end, so this is the one
    step whose length is that of the longest conversation."""
    schema = T.StructType(
        [rows.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())]
    )
    arrow = to_arrow_schema(schema)
    return _streamed(rows, audits).mapInArrow(lambda b: _digests(b, arrow), schema)


def missing_turns(rows: DataFrame) -> DataFrame:
    """`conv_id, gaps`: numbers between a conversation's first and last turn that no row
    has; 0 if no row has a turn."""
    per_turn = rows.where("turn is not null").select("conv_id", "turn").distinct()
    span = F.max("turn") - F.min("turn") + 1 - F.count("*")
    return per_turn.groupBy("conv_id").agg(span.alias("gaps"))


def inspect_and_repair(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """Every `conv_id` of `conversations` with what is wrong with its `rows` and how it
    is repaired: `gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256`. A conversation without rows: zeros, an empty audit and the hash of
    the empty string."""
    faulty = written(with_faults(in_order(rows)), "turn-faults")
    fixed = written(repairs(faulty), "turn-repairs")
    kinds = ("blank", "duplicate", "truncated")
    counts = faulty.groupBy("conv_id").agg(
        *(F.count_if(F.col("fault") == kind).alias(kind) for kind in kinds)
    )
    found = conversations.select("conv_id").distinct()
    for part in (missing_turns(faulty), counts, fixed, digests(rows, fixed)):
        part = part.withColumnRenamed("conv_id", "of")
        found = found.join(part, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    numbers = ("gaps", *kinds, "illegal", "cost")
    return found.select(
        "conv_id",
        *(F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias(
            "repaired_sha256"
        ),
    )
