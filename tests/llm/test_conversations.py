import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import types as T

from tallywind.llm import conversations, queries
from tallywind.llm.conversations import search

ROWS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
        # names that the operator uses inside
        T.StructField("block", T.StringType()),
        T.StructField("fault", T.LongType()),
        T.StructField("pos", T.StringType()),
    ]
)
RESULT = (
    "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
)
WELL_FORMED = re.compile(r"(s?(ua)+)?")


def every_way(codes, most_inserts=3):
    """All audits by trying every edit of every row and every insertion."""
    found = None
    options = []
    for code in codes:
        letter = conversations._initials(code)
        ways = [(2, "D", "")]
        if code not in "1234":
            extra = 5 if code.isupper() else 0
            ways.append((extra, "K", letter if letter != "o" else "?"))
            ways += [(extra + 1, "R", role) for role in "ua"]
        options.append(ways)
    for chosen in itertools.product(*options):
        for inserts in range(most_inserts + 1):
            for at in itertools.combinations_with_replacement(range(len(codes) + 1), inserts):
                for roles in itertools.product("ua", repeat=inserts):
                    cost, audit, out = 5 * inserts, "", ""
                    put = list(zip(at, roles))
                    for i, way in enumerate([*chosen, (0, "", "")]):
                        for place, role in put:
                            if place == i:
                                audit, out = audit + "I", out + role
                        cost, audit, out = cost + way[0], audit + way[1], out + way[2]
                    if WELL_FORMED.fullmatch(out) and (found is None or (cost, audit) < found):
                        found = (cost, audit)
    return found


def shortest(codes):
    """The same by trying the rows one after the other, keeping the best of each state."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def with_inserts(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                for role, to in after[state].items():
                    if role != "s":
                        way = (cost + 5, audit + "I")
                        states[to] = min(states.get(to, way), way)
        return states

    states = {0: (0, "")}
    for code in codes:
        grown = {}
        for state, (cost, audit) in with_inserts(states).items():
            ways = [(2, "D", state)]
            if code not in "1234":
                extra = 5 if code.isupper() else 0
                for role, to in after[state].items():
                    if role == code.lower():
                        ways.append((extra, "K", to))
                    elif role != "s":
                        ways.append((extra + 1, "R", to))
            for price, letter, to in ways:
                way = (cost + price, audit + letter)
                grown[to] = min(grown.get(to, way), way)
        states = grown
    ends = with_inserts(states)
    return min(ends[s] for s in (0, 3) if s in ends)


def test_search_finds_what_trying_everything_finds():
    codes = "suaoSUAO14"
    for length in range(4):
        for sample in itertools.product(codes, repeat=length):
            text = "".join(sample)
            assert search(text) == every_way(text, 2) == shortest(text), text


def test_search_on_long_sequences():
    dice = random.Random(5)
    for weights in ((4, 4, 4, 1, 1, 1, 1, 1, 1, 1), (9, 1, 1, 0, 0, 0, 0, 0, 0, 0), (1,) * 10):
        for length in (5, 40, 600):
            text = "".join(dice.choices("suaoSUAO14", weights, k=length))
            assert search(text) == shortest(text)


def test_pieces_join_to_the_whole():
    dice = random.Random(6)
    for _ in range(60):
        text = "".join(dice.choices("suaoSUAO14", k=dice.randint(2, 30)))
        cuts = sorted(dice.sample(range(1, len(text)), dice.randint(1, min(4, len(text) - 1))))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        joined = conversations._joined([conversations._piece(p, False) for p in parts], True)
        (way,) = joined["ways"]
        assert (way["cost"], way["audit"]) == shortest(text)
        assert joined["illegal"] == conversations._illegal(conversations._initials(text))


def brute_force(original):
    """Every conversation by the contract's words."""
    convs = {}
    for conv, turn, role, text in original:
        convs.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(name.encode()) % 20
        if harm == 0:
            continue
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub(r"[.!?]", "", text)
        if harm == 4:
            role = "user"
        convs[conv] += [(turn, role, text)] * (2 if harm == 3 else 1)
    found = {}
    for conv, rows in convs.items():
        rows.sort(
            key=lambda r: (
                r[0] is not None,
                r[0] or 0,
                r[1],
                hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest(),
            )
        )
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, codes, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        initials = ""
        for _, role, text in rows:
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            initials += letter
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            if not visible:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif visible[-1] not in ".!?":
                fault = "truncated"
            else:
                fault = None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            if fault in ("blank", "duplicate"):
                codes += "1234"["suao".index(letter)]
            else:
                codes += letter.upper() if fault else letter
        cost, audit = shortest(codes)
        out, place, at = [], 0, 0
        kept = len(audit.replace("D", ""))
        for letter in audit:
            due = "user" if (place - kept % 2) % 2 == 0 else "assistant"
            if letter == "I":
                out.append((due, ""))
                place += 1
                continue
            _, role, text = rows[at]
            at += 1
            if letter != "D":
                out.append((due if letter == "R" else role, text))
                place += 1
        joined = "\n".join(f"{role}:{text}" for role, text in out)
        found[conv] = dict(
            zip(
                RESULT,
                (
                    conv,
                    gaps,
                    *counts.values(),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost,
                    audit,
                    hashlib.sha256(joined.encode()).hexdigest(),
                ),
            )
        )
    return found


def odd_rows(n=260):
    dice = random.Random(11)
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    texts = ["Yes.", "No", "", " \n", None, "Why?", "ünï。", "a" * 5000 + ".", "Long\nline!\t"]
    return [
        (
            dice.choice([None, 0, 1, 2, 3, -7, 2**61 + 1]),
            dice.choice([None, *range(12), 2**40]),
            dice.choices(roles, (6, 6, 2, 1, 1, 1, 1))[0],
            dice.choice(texts),
        )
        for _ in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 3, "y") for r in rows], ROWS)


def results(df):
    return {r["conv_id"]: r.asDict() for r in df.collect()}


def test_odd_rows_against_brute_force(spark):
    rows = odd_rows() + [(100, t, None, None) for t in range(4)]
    df = frame(spark, rows)
    got = results(conversations.inspect_and_repair(df, conversations.damage(df)))
    assert got == brute_force(rows)


def test_query_against_brute_force(spark, tables):
    got = queries.op13_conversations(spark, tables)
    assert got.columns == RESULT
    rows = [tuple(r) for r in queries.table(spark, tables, "conversations").collect()]
    assert results(got) == brute_force(rows)


def test_sql_against_brute_force(tables):
    rows = odd_rows() + [(100, t, None, None) for t in range(4)] + [(101, 1, "system", "Be.")]
    database = duckdb.connect()
    database.execute("create table conversations (conv_id long, turn long, role text, text text)")
    database.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    found = database.execute(queries.ORACLES["op13_conversations"])
    names = [column[0] for column in found.description]
    got = {r[0]: dict(zip(names, r)) for r in found.fetchall()}
    assert got == brute_force(rows)


def test_a_long_conversation_in_small_blocks(spark):
    rows = [(9, t, *r[2:]) for t, r in enumerate(odd_rows(150))] + odd_rows(60)
    df = frame(spark, rows)
    faulty = conversations.with_faults(conversations.in_order(conversations.damage(df)))
    expected = brute_force(rows)
    for block, merged in ((4, 3), (7, 100)):
        for conv, found in results(conversations.repairs(faulty, block, merged)).items():
            wanted = expected[conv]
            assert all(found[k] == wanted[k] for k in ("cost", "audit", "illegal"))


def test_the_repaired_turns(spark):
    rows = [
        (1, 0, "system", "Be kind."),
        (1, 1, "assistant", "Hello."),
        (1, 2, "user", "Bye."),
        (1, 3, "user", "Really cut"),
        (2, 0, "user", " "),
        (3, 5, "user", "Alone."),
    ]
    df = frame(spark, rows)
    faulty = conversations.with_faults(conversations.in_order(df))
    audits = conversations.repairs(faulty)
    got = sorted(tuple(r) for r in conversations.repaired(df, audits).collect())
    assert got == [
        (1, 0, "system", "Be kind.", "K"),
        (1, 1, "user", "Hello.", "R"),
        (1, 2, "assistant", "Bye.", "R"),
    ]
    assert {r["conv_id"]: r["audit"] for r in audits.collect()} == {1: "KRRD", 2: "D", 3: "D"}


def test_no_rows(spark):
    none = frame(spark, [])
    got = conversations.inspect_and_repair(none, conversations.damage(none))
    assert got.columns == RESULT and got.count() == 0


@pytest.mark.parametrize("role", ["user", "system"])
def test_one_text_in_many_rows(spark, role):
    rows = [(1, None, role, "Same.")] * 300
    df = frame(spark, rows)
    got = results(conversations.inspect_and_repair(df, df))
    assert got[1]["duplicate"] == 299 and got[1]["audit"] == "D" * 300
